"""Numbered words in buckets: packing, counts over many buckets and parts, and how much is shuffled."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpuskiln.operators import encoded, language_model


def shuffled(spark) -> int:
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").repartition(4)


@pytest.fixture
def small(monkeypatch):
    for name, n in (("BUCKET", 300), ("PART", 200), ("SMALL", 50)):
        monkeypatch.setattr(encoded, name, n)


def test_packed_numbers_and_words():
    rows = [np.array([], dtype=np.int64), np.array([0, 1, 255, 256, 1 << 40]), np.zeros(5, dtype=np.int64)]
    assert [x.tolist() for x in encoded.unpack(encoded.pack(*rows))] == [x.tolist() for x in rows]
    for words in ([], [""], ["", "ä", "日本", "", "a" * 3000]):
        some = pa.array(words, pa.string())
        assert encoded.unpack_words(encoded.pack_words(some)).to_pylist() == words
        rest = pa.array(["x", *words], pa.string()).slice(1)  # parts go by the word alone
        assert encoded.word_parts(rest, 7).tolist() == encoded.word_parts(some, 7).tolist()
    keys = np.array([5, 9, (1 << 32) + 2, (1 << 32) + 3, (7 << 32) + 1])
    assert encoded.pair_keys(*encoded.pair_deltas(keys)).tolist() == keys.tolist()


def test_line_scores_over_many_buckets(spark, small):
    rng = random.Random(3)
    rows = [(None if i == 5 else i // 2, "\n".join(" ".join(rng.choice(["a", "b,", "ç", "日本", f"w{rng.randrange(400)}"]) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(1, 9)))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "​"), (903, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = language_model.line_scores(df, language_model.bigram_model(df)).collect()
    got = {(r["doc_id"], r["line"]): (r["n"], r["log10p"]) for r in language_model.own_line_scores(df).collect()}
    assert len(got) == len(want) and all(got[r["doc_id"], r["line"]][0] == r["n"] and math.isclose(got[r["doc_id"], r["line"]][1], r["log10p"]) for r in want)


def test_no_lines(spark):
    assert language_model.own_line_scores(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")).collect() == []


def test_transitions_are_not_sent_with_their_lines(spark):
    """Before, each transition went through four shuffles with its words: 834 MB for 173 MB of text when a run was stopped."""
    docs = documents(spark, "/root/testdata/sf0.01")
    size, before = sum(len(r["text"].encode()) for r in docs.collect()), shuffled(spark)
    language_model.document_perplexity(docs).write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 4 * size


def test_sentences_keep_the_tokens(spark):
    rows = [("a,b  c",), (" x  y\t",), ("​",), ("日本語 ok!",), ("¿qué? ×÷ ½",)]
    df = spark.createDataFrame(rows, "text string").selectExpr("1 as doc_id", "text")
    pairs = zip(language_model.line_tokens(df).collect(), language_model.line_texts(df).collect(), strict=True)
    assert all(" ".join(a["t"]) == b["s"] for a, b in pairs)
    assert Counter(r["s"] for r in language_model.line_texts(df).collect())["<s> ¿ qué ? ×÷ ½ </s>"] == 1


def kneser_ney_of(spark, n):
    """Sentences with repeats, a hot word and a hot pair, by their text."""
    rng = random.Random(11)
    word = lambda: rng.choice(["of", "of the", ",", f"w{rng.randrange(60)}", f"r{rng.randrange(3000)}"])
    rows = [(i // 3, i % 3, " ".join(["<s>", *(word() for _ in range(rng.choice([0, 1, 2, 7, 12]))), "</s>"])) for i in range(n)]
    return spark.createDataFrame(rows + rows[:40], "doc_id long, line int, s string").repartition(3)


def test_trigram_model_over_many_buckets(spark, small):
    """Equal to the general estimator, which joins tables of n-grams, and each n-gram once."""
    from corpuskiln.operators import kneser_ney as K

    lines = kneser_ney_of(spark, 600)
    general = K.general_model(lines.select(language_model.F.split("s", " ").alias("t")), 3).collect()
    got = K.trigram_model(lines).collect()
    want = {(r["order"], r["ngram"]): (r["log10p"], r["backoff"]) for r in general}
    assert len(got) == len(general) == len(want)
    assert all(math.isclose(r["log10p"], want[r["order"], r["ngram"]][0], abs_tol=1e-9) and math.isclose(r["backoff"], want[r["order"], r["ngram"]][1], abs_tol=1e-9) for r in got)


def test_own_scores_equal_the_scorer(spark, small):
    from corpuskiln.operators import kneser_ney as K
    from pyspark.sql import functions as F

    lines = kneser_ney_of(spark, 200).dropDuplicates(["doc_id", "line"]).localCheckpoint()
    scored = language_model.backoff_scores(lines.select("doc_id", "line", F.split("s", " ").alias("t")), K.trigram_model(lines), 3)
    want = {(r["doc_id"], r["line"]): (r["n"], r["log10p"]) for r in scored.collect()}
    got = {(r["doc_id"], r["line"]): (r["n"], r["log10p"]) for r in K.own_scores(lines).collect()}
    assert set(got) == set(want) and all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][1], abs_tol=1e-9) for k in want)


@pytest.mark.parametrize("name,bound", [("kneser_ney_model", 6), ("kneser_ney_perplexity", 6)])
def test_trigrams_are_not_sent_as_texts(spark, name, bound):
    """Every n-gram went through several shuffles as a text."""
    from corpuskiln.plans import registry

    size, before = sum(len(r["text"].encode()) for r in documents(spark, "/root/testdata/sf0.01").collect()), shuffled(spark)
    registry.QUERIES[name](spark, "/root/testdata/sf0.01").write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < bound * size


@pytest.mark.parametrize("name", ["line_filter_retention", "perplexity_filtered_lines"])
def test_filtered_lines_shuffle_little(spark, name):
    from corpuskiln.plans import registry

    size, before = sum(len(r["text"].encode()) for r in documents(spark, "/root/testdata/sf0.01").collect()), shuffled(spark)
    registry.QUERIES[name](spark, "/root/testdata/sf0.01").write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 4 * size


def test_lines_dropped_by_their_own_model(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    want = {tuple(r) for r in language_model.drop_lines(docs, language_model.bigram_model(docs), 2000).collect()}
    assert {tuple(r) for r in language_model.drop_lines(docs, None, 2000).collect()} == want
