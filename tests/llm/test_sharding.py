import pytest

from corpuskiln.llm import sharding
from corpuskiln.llm.sharding import Conflict, ShardStore


def test_documents_come_back(spark, sf):
    from corpuskiln.llm.common import table

    got = sharding.op2_sharding(spark, sf).select("doc_id", "n_chars").collect()
    assert sorted((r[0], r[1]) for r in got) == sorted((r["doc_id"], r["n_chars"]) for r in table(spark, sf, "documents").collect())


def test_tiers_are_merged_and_old_versions_stay_readable(spark, tmp_path):
    store = ShardStore(spark, f"file://{tmp_path}/s")
    assert store.version() == 0
    schema = "a long, b string"
    rows = [(i, None if i % 7 == 0 else "x" * (i % 50)) for i in range(100)] + [(1, "x"), (1, "x")]
    for k in range(5):
        store.append(spark.createDataFrame(rows[k::5], schema).coalesce(1))
    assert store.version() == 5 and store.manifest().count() == 5
    before = sorted(map(tuple, store.read().collect()), key=str)
    assert before == sorted(rows, key=str)
    assert store.compact() == 6 and store.manifest().count() == 1
    assert sorted(map(tuple, store.read().collect()), key=str) == before
    assert store.compact() == 6  # nothing left to merge
    assert sorted(map(tuple, store.read(5).collect()), key=str) == before
    assert store.manifest().agg({"n_rows": "sum"}).first()[0] == len(rows)
    assert store.expire() and sorted(map(tuple, store.read().collect()), key=str) == before
    assert store.version() == 6


def test_a_taken_version_is_a_conflict_and_empty_arrivals(spark, tmp_path):
    store = ShardStore(spark, f"file://{tmp_path}/s")
    empty = spark.createDataFrame([], "a long")
    assert store.append(empty) == 1 and store.read().collect() == []
    with pytest.raises(Conflict):
        store._commit(0, store.manifest(1), empty.schema, "append")
    assert store.version() == 1
    with pytest.raises(ValueError):
        store.append(spark.createDataFrame([], "b long"))
    assert store.append(spark.createDataFrame([(5,)], "a long")) == 2


def operations(store):
    return [store._head(v)["operation"] for v in store._numbers()]


def test_documents_are_compacted_in_two_tiers(spark, tmp_path):
    from corpuskiln.llm.common import table

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    store, most = ShardStore(spark, f"file://{tmp_path}/s"), 0
    for part in sharding.arrivals(docs, "doc_id", f"file://{tmp_path}/landing"):
        store.append(part)
        before = store.manifest().count()
        version = store.version()
        if store.compact() > version:
            assert store.manifest().count() < before
        most = max(most, before)
    assert most >= 4 and operations(store).count("append") == 7 and operations(store).count("compact") >= 2
    assert store.manifest().count() < 4
    assert sorted(map(tuple, store.read().select("doc_id", "text").collect())) == sorted(map(tuple, docs.select("doc_id", "text").collect()))
    assert store.expire() and operations(store) == ["compact"] or operations(store) == ["append"]
    data = [p.name for p in (tmp_path / "s" / "data").glob("*")]
    assert len(data) == store.manifest().selectExpr("substring_index(file, '/', 2) as f").distinct().count()


def test_two_writers_and_a_compaction_that_comes_too_late(spark, tmp_path, monkeypatch):
    one, two = ShardStore(spark, f"file://{tmp_path}/s"), ShardStore(spark, f"file://{tmp_path}/s")
    rows = lambda k: spark.createDataFrame([(k, "x", None)], "file long, bytes string, n_rows string").coalesce(1)
    for k in range(4):
        one.append(rows(k))
    plain = ShardStore._commit
    state = {"other": True}

    def late(self, base, manifest, schema, what):
        if state.pop("other", False):  # another writer appends first
            two.append(rows(9))
        return plain(self, base, manifest, schema, what)

    monkeypatch.setattr(ShardStore, "_commit", late)
    assert one.append(rows(5)) == 6 and sorted(r["file"] for r in one.read().collect()) == [0, 1, 2, 3, 5, 9]
    state["other"] = True
    assert one.compact() == 8 and sorted(r["file"] for r in one.read().collect()) == [0, 1, 2, 3, 5, 9, 9]

    def merged_before(self, base, manifest, schema, what):
        if state.pop("merge", False):
            two.compact(min_run=2)
        return plain(self, base, manifest, schema, what)

    monkeypatch.setattr(ShardStore, "_commit", merged_before)
    one.append(rows(11))
    state["merge"] = True
    folders = lambda: {p.name for p in (tmp_path / "s" / "data").glob("*")}
    reader = one.read()
    version = one.compact(min_run=2)
    assert operations(one)[version - 1] == "compact" and sorted(r["file"] for r in one.read().collect()) == [0, 1, 2, 3, 5, 9, 9, 11]
    named = {r["file"].split("/")[1] for v in one._numbers() for r in one.manifest(v).collect()}
    assert folders() == named  # nothing is left of the compaction that gave up
    assert len(list((tmp_path / "s" / "manifests").glob("*"))) == len(one._numbers())
    assert reader.count() == 8  # a reader of a version that is not expired yet
    one.expire(keep=2)
    assert len(one._numbers()) == 2 and one.read().count() == 8


def test_nulls_long_texts_and_repeated_rows(spark, tmp_path):
    rows = [(None, None), (1, "x" * 3_000_000), (1, "y"), (1, "y"), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    store = ShardStore(spark, f"file://{tmp_path}/s")
    for part in sharding.arrivals(df, "doc_id", f"file://{tmp_path}/landing"):
        store.append(part)
        store.compact()
    assert sorted(map(tuple, store.read().collect()), key=str) == sorted(rows, key=str)
