import itertools
import zlib

import numpy as np
from corpuskiln.llm import quality
from corpuskiln.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    rows = quality.op9_quality(spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged)


def test_marginals_against_brute_force():
    rnd = np.random.default_rng(1)
    counts = np.array([1, 4, 2, 5])
    unary, trans = rnd.normal(size=counts.sum()), rnd.normal(size=(2, 2))
    got, pairs, norm = quality.forward_backward(unary, counts, trans)
    at, seen, total = 0, np.zeros((2, 2)), 0.0
    for n in counts:
        paths = list(itertools.product((0, 1), repeat=int(n)))
        score = np.array([sum(unary[at + k] * s for k, s in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])) for p in paths])
        z = np.log(np.exp(score).sum())
        p = np.exp(score - z)
        assert np.allclose(got[at : at + n], [sum(x for x, path in zip(p, paths) if path[k]) for k in range(n)])
        for x, path in zip(p, paths):
            for a, b in zip(path, path[1:]):
                seen[a, b] += x
        total += z
        at += n
    assert np.allclose(pairs, seen) and np.isclose(norm, total)


def test_odd_texts_and_missing_labels(spark):
    good, bad = "A calm line of plain words.\nAnother one follows it.", "### !!! $$$ %%%\nx x x x x x x x"
    model = quality.fit([(good + f" {i}", 1) for i in range(20)] + [(bad + f" {i}", 0) for i in range(20)], 0.8)
    s = model.score([good, bad, None, "", "\n \n", (good + "\n") * 3000])
    assert s[0] > 0.7 > s[1] and s[2] == s[3] == s[4] == 0.8 and s[5] > 0.7
    docs = spark.createDataFrame([(1, good, 5), (1, good, 5), (2, None, 5), (None, bad, 5)], "doc_id long, text string, score int")
    assert len(quality.score(docs, model).collect()) == 4 and quality.score(docs.limit(0), model).collect() == []
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(docs, quality.learn(docs, none)).collect()} == {0.5}
    twice = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    assert quality.learn(docs, twice).base == 0.5
    assert quality.only_good(docs, model).columns == docs.columns


def test_long_texts_are_learned_from_all_over(spark):
    """Only the last third of the bad texts is bad; a prefix would not show it."""
    good, bad = "A calm line of plain words follows here.", "### !!! $$$ %%% x x x x"
    long_bad = "\n".join([good] * 300 + [bad] * 150)
    made = quality.examples([long_bad, good], [0, 1])
    assert len(made[0].length) == quality.TRAIN_LINES and made[0].runs.tolist() == [quality.RUN] * 8 and made[1].runs.tolist() == [1]
    assert (made[0].x[-1] != made[0].x[0]).any()
    rows = [(i, long_bad + f" {i}") for i in range(20)] + [(100 + i, "\n".join([good] * 450) + f" {i}") for i in range(20)]
    docs = spark.createDataFrame([*rows, rows[0], (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows], "doc_id long, quality int")
    s = quality.learn(docs, labels).score([rows[0][1], rows[30][1]])
    assert s[1] > 0.7 > s[0]
