"""Scores of rows by models that didn't see them, against a model a fold."""

import random
from zlib import crc32

from corpuskiln.operators import language_model as L

SCHEMA = "doc_id long, text string, lang string, f int"


def docs(spark, rows):
    return spark.createDataFrame([(*x, 9) for x in rows], SCHEMA).repartition(3)


def cases():
    rng = random.Random(2)
    words = {"a": [f"a{i}" for i in range(30)], "b": [f"b{i}" for i in range(30)], "c": ["c1", "a1", "b1"]}
    rows = [(i, " ".join(rng.choice(words[k]) if rng.random() < 0.7 else f"x{rng.randrange(40)}" for _ in range(rng.randrange(0, 25))), k if i % 4 else None) for i, k in enumerate(rng.choices("aabbc", k=160))]
    return [*rows, (500, None, "a"), (501, "", None), (502, "only here here", "d")]


def test_equals_a_model_for_each_fold(spark):
    rows, folds = cases(), 3
    got = {r["doc_id"]: r["lang_prob"] for r in L.cross_fitted(docs(spark, rows), "a", folds).collect()}
    assert len(got) == len(rows)
    for f in range(folds):
        own = [x for x in rows if crc32(str(x[0]).encode()) % folds == f]
        model = L.word_gains(docs(spark, [x for x in rows if x not in own]))
        for r in L.label_shares(docs(spark, own), model, "a").collect():
            assert abs(got[r["doc_id"]] - r["lang_prob"]) < 1e-9, r


def test_a_row_does_not_speak_for_itself(spark):
    """Texts of words of their own: the model of all rows knows each by heart, the others' models know nothing."""
    rows = [(i, f"own{i} word{i}", "a" if i % 2 else "b") for i in range(40)]
    seen = {r["doc_id"]: r["lang_prob"] for r in L.language_classes(docs(spark, rows), "a").collect()}
    assert all((seen[i] > 0.9) == (k == "a") for i, _, k in rows)
    assert {r["lang_prob"] for r in L.cross_fitted(docs(spark, rows), "a").collect()} == {0.0}


def test_held_out_accuracy(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in table.where("length(text) > 40").collect()}
    got = {r["doc_id"]: r["lang_prob"] for r in L.cross_fitted(table, "en").collect()}
    right = [(got[i] > 0.5) == (x == "en") for i, x in lang.items() if x]
    assert sum(right) > 0.97 * len(right)
    assert L.cross_fitted(table.limit(0), "en").count() == 0
