"""Interval anti-join against all pairs, one long key over many ranges, and a mass-copied toxic text."""

import random

from corpuskiln.operators import filters, joins, relations
from pyspark.sql import functions as F

SPANS, KEEPS = "k string, start int, end int, note string, __in2 int", "k string, start int, end int"


def plain(spans, keeps):
    over = lambda s, k: None not in (*s[:3], *k) and s[0] == k[0] and s[1] < k[2] and s[2] > k[1]
    return sorted((s for s in spans if not any(over(s, k) for k in keeps)), key=repr)


def test_intervals_against_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(joins, "RANGE_ROWS", 50)
    some = lambda: (rng.choice("aaaab"), a := rng.randrange(3000), a + rng.randrange(-1, 12))
    spans, keeps = [(*some(), f"n{i}", i) for i in range(900)], [some() for _ in range(200)] + [("c", 0, 10**6)]
    spans += [("c", 5, 6, "x", 0), ("d", 5, 6, "x", 0), (None, 1, 2, "x", 0), ("a", None, 2, "x", 0), ("a", 1, None, "x", 0), ("a", 7, 7, "x", 0), *spans[:5]]
    keeps += [(None, 0, 9), ("d", None, 9), ("d", 0, None)]
    got = relations.interval_anti_join(spark.createDataFrame(spans, SPANS).repartition(4), spark.createDataFrame(keeps, KEEPS), "k")
    assert got.columns == ["k", "start", "end", "note", "__in2"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(spans, keeps)
    assert sorted(map(tuple, relations.interval_anti_join(spark.createDataFrame(spans, SPANS), spark.createDataFrame([], KEEPS), "k").collect()), key=repr) == sorted(spans, key=repr)
    assert relations.interval_anti_join(spark.createDataFrame([], SPANS), spark.createDataFrame(keeps, KEEPS), "k").count() == 0


def test_one_key_holds_all_spans(spark):
    """100,000 spans and keeps of one key: pairs would be 10^9."""
    spans = spark.range(100_000).selectExpr("'k' as k", "cast(id * 10 as int) as start", "cast(id * 10 + 5 as int) as end")
    keeps = spark.range(100_000).where("id % 4 = 0").selectExpr("'k' as k", "cast(id * 10 + 4 as int) as start", "cast(id * 10 + 9 as int) as end")
    assert relations.interval_anti_join(spans, keeps, "k").count() == 75_000


def test_a_mass_copied_toxic_text(spark, monkeypatch):
    monkeypatch.setattr("corpuskiln.storage.BROADCAST_BYTES", 0)  # the join of a large table
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    labelled = [(i, "vile rotten scum" if i % 2 else "kind gentle words", i % 2) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string").union(spark.range(1000, 4000).selectExpr("id", "if(id % 3 = 0, 'vile scum', concat('kind words ', id % 50))"))
    marks = spark.createDataFrame([(i, m) for i, _, m in labelled], "doc_id long, toxic int")
    kept = filters.toxicity_filter(docs, marks)
    assert kept.count() == 20 + 2000 and kept.where(F.col("text").contains("scum")).count() == 0
    assert filters.toxicity_filter(docs, marks, invert=True).count() == 20 + 1000
