import random
import time

from corpuskiln.plans import registry
from corpuskiln.storage import shared_dir
from corpuskiln.streaming import streams
from pyspark.sql import functions as F


def source(spark, tmp_path, df, files=3):
    df.repartition(files).write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_output_is_a_table_in_the_shared_folder(spark, sf):
    got = registry.streamed_first_seen(spark, sf)
    where = shared_dir(spark).removeprefix("file:").lstrip("/")
    assert got.inputFiles() and all(where in f for f in got.inputFiles())


def test_a_source_without_rows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = spark.readStream.schema("a int").parquet(str(tmp_path / "none"))
    assert streams.drained(stream, "none").collect() == []


def test_parts_of_shards_lose_no_token(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(i % 2, i // 50, [i] * rnd.randrange(5)) for i in range(600)] + [(2, 0, [1]), (None, 0, [1] * 9)]
    stream = source(spark, tmp_path, spark.createDataFrame(rows, "shard int, part int, ids array<int>"))
    out = streams.drained(streams.packed(stream, ["shard", "part"], "ids", 8), "test")
    size = {}
    for shard, _, ids in rows:
        size[shard] = size.get(shard, 0) + len(ids)
    assert {r["shard"]: r["blocks"] for r in streams.totals(out, ["shard", "part"], "shard", 8).collect()} == {s: n // 8 for s, n in size.items()}
    full = out.where(F.size("ids") == 8)
    assert full.groupBy("shard", "part", "n").count().where("count > 1").count() == 0
    assert full.select("shard", "part").distinct().count() > 4


def test_packing_is_dealt_into_more_parts_than_shards(spark, tmp_path, monkeypatch):
    events = spark.range(70_000).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    monkeypatch.setattr(streams, "drained", lambda s, n, f=streams.drained: seen.append(f(s, n)) or seen[-1])
    got = {r["shard"]: r["blocks"] for r in registry.streamed_packing(spark, str(tmp_path)).collect()}
    assert got == {s: sum(i % 7 % 4 == s for i in range(70_000)) * 3 // 256 for s in range(4)}
    assert seen[0].select("shard", "part").distinct().count() == 20


def test_quotes_follow_positions_within_and_across_batches(spark, tmp_path):
    rnd = random.Random(7)
    rows = []
    for thread in range(6):
        for pos in range(25):
            rows.append((f"t{thread}", f"c{thread}-{rnd.randrange(12)}", f"c{thread}-{rnd.randrange(12)}", f"text {thread} {pos}", pos))
    df = spark.createDataFrame(rows, "thread string, comment string, quoted string, text string, pos int")
    for k in range(2):  # two batches, each out of order
        df.where(f"pos {'<' if k == 0 else '>='} 12").orderBy(F.rand(3)).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = streams.drained(streams.quoted(stream, "thread", "comment", "quoted", "text", "pos"), "quotes").collect()
    known, expected = {}, []
    for thread, comment, quoted, text, _ in sorted(rows, key=lambda r: (r[0], r[4])):
        known[thread, comment] = text
        expected.append((comment, known.get((thread, quoted))))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_first_seen_with_a_watermark(spark, tmp_path):
    df = spark.sql("select id % 10 as k, timestamp_seconds(id) as ts from range(200)")
    got = streams.drained(streams.first_seen(source(spark, tmp_path, df, 1), "k", "ts"), "watermark")
    assert sorted(r["k"] for r in got.collect()) == list(range(10))


def test_masked_ids_as_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "x 010190-123A y"), (2, None)], "i int, text string")
    got = streams.drained(streams.masked_ids(source(spark, tmp_path, df, 1)), "masks")
    assert {r["i"]: r["text"] for r in got.collect()} == {1: "x 010101-001Z y", 2: None}


def quotes_of(stream, base, forget=None):
    """Run over what the source holds, from the checkpoint on."""
    out = streams.quoted(stream, "thread", "comment", "quoted", "text", "pos", forget)
    q = out.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_quotes_after_a_restart_and_only_named_ids_are_touched(spark, tmp_path):
    schema = "thread string, comment string, quoted string, text string, pos int"
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    write = lambda rows, name: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))
    write([("t", f"c{k}", "none", f"text {k}", k) for k in range(500)] + [(None, None, None, "null", None), (None, "n", None, "of null", 1)], "0")
    quotes_of(stream(), tmp_path)
    write([("t", "new", "c7", "x", 501), ("u", "new", "c7", "x", 1), (None, "m", None, "x", 2), ("t", "c7", "c7", "later", 502), ("t", "end", "c7", None, 503)], "1")
    q = quotes_of(stream(), tmp_path)  # another run of the same checkpoint
    got = sorted(map(str, (tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).where("comment is null or not comment like 'c%' or comment = 'c7'").collect())))
    assert got == sorted(map(str, [("c7", None), (None, "null"), ("n", "null"), ("new", "text 7"), ("new", None), ("m", "null"), ("c7", "later"), ("end", "later")]))
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 500 + 2 + 4 and state["numRowsUpdated"] < 10


def test_forgotten_texts_go(spark, tmp_path):
    schema = "thread string, comment string, quoted string, text string, pos int"
    write = lambda rows, name: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))
    write([("t", "a", "a", "old", 1)], "0")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    out = streams.quoted(stream, "thread", "comment", "quoted", "text", "pos", "1 second")
    q = out.writeStream.outputMode("append").format("memory").queryName("forgotten").trigger(processingTime="1 second").start()
    kept = lambda: q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress else None

    def until(condition):
        end = time.time() + 60
        while time.time() < end and not condition():
            time.sleep(0.2)
        assert condition()

    try:
        until(lambda: spark.table("forgotten").count() == 1)
        until(lambda: kept() == 0)
        write([("t", "b", "a", "x", 2)], "1")
        until(lambda: spark.table("forgotten").count() == 2)
    finally:
        q.stop()
    assert sorted(map(tuple, spark.table("forgotten").collect()), key=str) == sorted([("a", "old"), ("b", None)], key=str)
