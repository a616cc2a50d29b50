import random

import pytest
from corpuskiln import storage
from corpuskiln.llm import common, components
from corpuskiln.operators import joins
from pyspark.sql import functions as F


def found(df):
    return {r["node"]: r["component"] for r in df.collect()}


def test_a_star_of_many_leaves_is_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 0)
    star = spark.range(1, 100_001).select(F.lit(50_000_000).alias("a"), F.col("id").alias("b"))
    got = components.connected_components(star)
    assert got.count() == 100_001 and got.select("component").distinct().collect()[0][0] == 1


def test_long_path_loops_and_random_edges(spark, monkeypatch):
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 3)
    path = [(k, k + 1) for k in range(300)]
    rnd = random.Random(1)
    edges = path + [(1000 + rnd.randrange(200), 1000 + rnd.randrange(200)) for _ in range(90)] + [(5, 5), (7, None), (None, None), (3, 2), (2, 3)]
    label = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in range(400):
        for a, b in edges:
            if a is not None and b is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found(components.connected_components(spark.createDataFrame(edges, "a long, b long"))) == label
    assert found(components.connected_components(spark.createDataFrame([], "a long, b long"))) == {}


def test_rounds_that_run_out_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(components, "MAX_ROUNDS", 1)
    with pytest.raises(RuntimeError):
        components.connected_components(spark.createDataFrame([(k, k + 1) for k in range(50)], "a long, b long"))


def test_spread_join_equals_a_join(spark, monkeypatch):
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    rows = spark.range(500).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), F.col("id").alias("v"))
    other = spark.createDataFrame([(k, f"x{k}") for k in range(8)], "k long, x string")
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"))
    for how, right in (("inner", other), ("left", other.where("k < 4"))):
        got = sorted(map(tuple, common.spread_join(rows, right, "k", sizes, "v", how).collect()))
        assert got == sorted(map(tuple, rows.join(right, "k", how).collect())) and got
    # no part of a key has more rows than the bound allows by more than chance
    plan = common.spread_join(rows, other, "k", sizes, "v")._jdf.queryExecution().executedPlan().toString()
    assert "__part" in plan


def test_pieces_cut_at_white_space_only():
    rnd = random.Random(3)
    data = b"".join(bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(1, 30))) + rnd.choice([b" ", b"\n", b"\t  "]) for _ in range(500))
    got = list(common.pieces(data, 64))
    assert b"".join(got) == data and [w for p in got for w in p.split()] == data.split() and len(got) > 50
    assert b"".join(common.pieces(b"x" * 1000, 64)) == b"x" * 1000 and len(common.word_hashes(b"a b " * 10)) == 20
