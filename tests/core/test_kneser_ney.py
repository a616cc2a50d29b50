"""The estimator against plain dictionaries, its sums, and its ARPA text."""

import math
import random
from collections import Counter, defaultdict

import pytest
from corpuskiln.operators import kneser_ney as K
from corpuskiln.operators import language_model


def plain(sentences, highest):
    """{order: {ngram: p}} and {history: b} by the definition."""
    top, starts = Counter(), defaultdict(Counter)
    for t in sentences:
        for i in range(2, len(t) + 1):
            g = tuple(t[max(0, i - highest) : i])
            (top if len(g) == highest else starts[len(g)])[g] += 1
    counts = {highest: top}
    for k in range(highest - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1]) + starts[k]
    p, b, d = defaultdict(dict), {}, {}
    for k, c in counts.items():
        t = Counter(min(n, 5) for n in c.values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] + t[2] else 0
        d[k] = tuple(i - (i + 1) * y * t[i + 1] / t[i] for i in (1, 2, 3)) if all(t[i] for i in (1, 2, 3, 4)) else K.FALLBACK
        if not all(0 <= x <= i for i, x in zip((1, 2, 3), d[k])):
            d[k] = K.FALLBACK
    for k in range(1, highest + 1):
        of = defaultdict(dict)
        for g, n in counts[k].items():
            of[g[:-1]][g] = n
        for h, grams in of.items():
            total = sum(grams.values())
            b[h] = sum(d[k][min(n, 3) - 1] for n in grams.values()) / total
            for g, n in grams.items():
                lower = p[k - 1][g[1:]] if k > 1 else 1 / (len(counts[1]) + 1)
                p[k][g] = (n - d[k][min(n, 3) - 1]) / total + b[h] * lower
    p[1][(K.UNKNOWN,)] = b.get((), 1.0) / (len(counts[1]) + 1)
    return p, b


def sentences(seed, n, words):
    rng = random.Random(seed)
    return [["<s>", *(rng.choice(words[: 1 + rng.randrange(len(words))]) for _ in range(rng.randrange(0, 9))), "</s>"] for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, 0, t) for i, t in enumerate(rows)], "doc_id long, line int, t array<string>").repartition(3)


@pytest.mark.parametrize("highest,seed,n", [(1, 1, 50), (2, 2, 200), (3, 3, 300), (5, 4, 120), (3, 5, 2)])
def test_equals_the_definition(spark, highest, seed, n):
    rows = sentences(seed, n, [f"w{i}" for i in range(30)])
    p, b = plain(rows, highest)
    model = {(r["order"], tuple(r["ngram"].split(" "))): (r["log10p"], r["backoff"]) for r in K.estimated(frame(spark, rows), highest).collect()}
    assert set(model) == {(k, g) for k in p for g in p[k] if p[k]} | {(1, (K.START,))}
    for (k, g), (q, w) in model.items():
        if g != (K.START,):
            assert math.isclose(10**q, p[k][g], rel_tol=1e-9)
        assert math.isclose(w, math.log10(b[g]) if k < highest and b.get(g) else 0.0, abs_tol=1e-9)


def test_probabilities_of_every_history_sum_to_one(spark):
    rows = sentences(7, 250, [f"w{i}" for i in range(12)])
    model = {tuple(r["ngram"].split(" ")): (r["log10p"], r["backoff"]) for r in K.estimated(frame(spark, rows), 3).collect()}
    vocabulary = [g[0] for g in model if len(g) == 1 and g != (K.START,)]

    def probability(h, w):
        if (*h, w) in model:
            return 10 ** model[(*h, w)][0]
        return 10 ** model.get(h, (0, 0.0))[1] * probability(h[1:], w)

    histories = {g for g in model if len(g) < 3} | {(), ("never", "seen"), ("w1", "never")}
    assert len(histories) > 100
    for h in histories:
        if h[-1:] != ("</s>",):
            assert math.isclose(sum(probability(h, w) for w in vocabulary), 1, rel_tol=1e-9), h


def test_text_is_read_back_and_scores_unseen_sentences(spark, tmp_path):
    rows = sentences(9, 200, [f"w{i}" for i in range(20)])
    model = K.estimated(frame(spark, rows), 3)
    K.write_arpa(model, str(tmp_path / "arpa"))
    lines = [x for f in sorted((tmp_path / "arpa").glob("part-*")) for x in f.read_text().split("\n") if x]
    assert lines[0] == "\\data\\" and lines[-1] == "\\end\\" and [x for x in lines if x.endswith("-grams:")] == [f"\\{k}-grams:" for k in (1, 2, 3)]
    back = language_model.read_arpa(spark, str(tmp_path / "arpa"))
    want = {(r["order"], r["ngram"]): (r["log10p"], r["backoff"]) for r in model.collect()}
    found = {(r["order"], r["ngram"]): (r["log10p"], r["backoff"]) for r in back.collect()}
    assert set(found) == set(want) and all(found[k] == pytest.approx(want[k], abs=1e-8) for k in want)
    new = [["<s>", "w1", "new", "w3", "w2", "w1", "</s>"], ["<s>", "</s>"], ["<s>", "w19", "w18", "w17", "</s>"]]
    table = {tuple(r["ngram"].split(" ")): (r["log10p"], r["backoff"]) for r in back.collect()}

    def score(t):
        t, out = [w if (w,) in table else K.UNKNOWN for w in t], 0.0
        for i in range(1, len(t)):
            h = tuple(t[max(0, i - 2) : i])
            while (*h, t[i]) not in table:
                out, h = out + table.get(h, (0, 0.0))[1], h[1:]
            out += table[(*h, t[i])][0]
        return out

    got = {r["doc_id"]: r["log10p"] for r in language_model.backoff_scores(frame(spark, new), back, 3).collect()}
    assert got == pytest.approx({i: score(t) for i, t in enumerate(new)}, abs=1e-6)


def test_no_sentences(spark):
    model = K.estimated(spark.createDataFrame([(1, 0, None), (2, 0, []), (3, 0, ["<s>"])], "doc_id long, line int, t array<string>"), 3)
    assert sorted((r["ngram"], r["log10p"]) for r in model.collect()) == [(K.START, K.NEVER), (K.UNKNOWN, 0.0)]


def test_hot_history(spark):
    """A third of all n-grams share a history and a shorter n-gram: parts of it are joined in several tasks."""
    rows = [["<s>", f"a{i}", "of", "the", f"b{i}", "</s>"] for i in range(1500)]
    p, b = plain(rows, 3)
    got = {tuple(r["ngram"].split(" ")): r["log10p"] for r in K.estimated(frame(spark, rows), 3).collect()}
    assert math.isclose(10 ** got["of", "the", "b7"], p[3]["of", "the", "b7"], rel_tol=1e-9) and len(got) == sum(map(len, p.values())) + 1
