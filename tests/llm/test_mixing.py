import numpy as np

from corpuskiln.llm import mixing
from corpuskiln.llm.common import table


def plain_rates(p, tokens, targets, floor=0.0):
    """The same iteration in numpy, with the step's rule spelled out."""
    load = p * tokens[:, None]
    own = load.sum(axis=0)
    scale = np.where(own > 0, 1 / np.maximum(own, 1e-300), 0)
    r, shrink, norms = np.ones(len(p)), 0.0, []
    for step in range(1, mixing.STEPS + 1):
        gap = np.where(scale > 0, load.T @ r - targets, 0)
        norm = np.sqrt((gap * gap * scale).sum())
        if (np.abs(gap) <= mixing.TOLERANCE * np.maximum(targets, 1)).all() or step == mixing.STEPS or (len(norms) >= 10 and norm > mixing.STALLED * norms[-5]):
            return r, step
        size = 1.0
        if norms and norms[-1]:
            if step <= 6:
                shrink = max(shrink, min(norm / norms[-1], 0.95))
            elif norm > norms[-1]:
                shrink = 0.0
            size = 2 / (2 - shrink) if step >= 6 else 1.0
        norms.append(norm)
        r = np.maximum(r - p @ (gap * scale) * size, floor)


def test_rates_meet_the_targets_and_match_brute_force(spark):
    rnd = np.random.default_rng(4)
    p = rnd.dirichlet([0.3] * 3, 200)
    tokens = rnd.integers(0, 500, 200)
    df = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(tokens, p))], "doc_id long, tokens long, p array<double>")
    targets = [9000.0, 15000.0, 12000.0]
    got, reached, steps = mixing.rates(df, targets)
    rate = np.array([r["rate"] for r in got.orderBy("doc_id").collect()])
    assert (rate >= 0).all() and np.allclose((p * tokens[:, None] * rate[:, None]).sum(axis=0), targets, rtol=1e-4) and np.allclose(reached, targets, rtol=1e-4)
    plain, n = plain_rates(p, tokens, np.array(targets))
    assert steps == n and np.allclose(plain, rate)


def test_query_against_brute_force(spark, tmp_path):
    """Posteriors, rates and copies restated in plain Python over a small table."""
    rnd = np.random.default_rng(8)
    words = {"en": ["the", "cat", "Of", "house"], "de": ["der", "hund", "und", "haus"], "fr": ["le", "chat", "et", "maison", "the"]}
    rows = [(i, " \n".join(rnd.choice(words[d], rnd.integers(1, 30)).tolist()), d) for i, d in enumerate(rnd.choice(["en"] * 3 + ["de", "fr"], 60).tolist())]
    rows += [(100, None, "en"), (101, "", None), (102, "the der le qqq", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    split = {i: (t or "").lower().split() for i, t, _ in rows}
    domains = sorted(words)
    named = [(split[i], d) for i, _, d in rows if d]
    vocabulary = {w for ws, _ in named for w in ws}
    count = {d: {w: sum(ws.count(w) for ws, e in named if e == d) for w in vocabulary} for d in domains}
    size = {d: sum(count[d].values()) + 0.5 * len(vocabulary) + 1 for d in domains}
    prior = {d: sum(e == d for _, e in named) / len(named) for d in domains}
    p = []
    for i, _, _ in rows:
        logs = np.array([mixing.EVIDENCE * sum(np.log((count[d][w] + 0.5) / size[d]) for w in split[i] if w in vocabulary) + np.log(prior[d]) for d in domains])
        e = np.exp(logs - logs.max())
        p.append(e / e.sum())
    p, tokens = np.array(p), np.array([len(split[i]) for i, _, _ in rows])
    rate, _ = plain_rates(p, tokens, np.full(3, tokens.sum() / 3))
    got = {r["doc_id"]: r for r in mixing.op4_mixing(spark, str(tmp_path)).collect()}
    for k, (i, _, _) in enumerate(rows):
        r = got[i]
        assert r["tokens"] == tokens[k] and np.allclose([r["posterior"][d] for d in domains], p[k]) and abs(r["rate"] - rate[k]) < 1e-6 * max(1, rate[k])
        assert r["copies"] in (int(np.floor(r["rate"])), int(np.floor(r["rate"])) + 1) and 0 <= r["residual"] < 1e-5


def test_documents_reach_equal_weights(spark):
    sf = "/root/testdata/sf0.01"
    rows = mixing.op4_mixing(spark, sf).collect()
    docs = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").collect()}
    assert len(rows) == len(docs)
    total = {}
    for r in rows:
        assert r["rate"] >= 0 and abs(r["copies"] - r["rate"]) <= 1 and abs(sum(r["posterior"].values()) - 1) < 1e-9
        for d, x in r["posterior"].items():
            total[d] = total.get(d, 0) + x * r["tokens"] * r["rate"]
    share = sum(total.values()) / len(total)
    assert all(abs(t - share) < 1e-3 * share for t in total.values())
    right = sum(max(r["posterior"], key=r["posterior"].get) == docs[r["doc_id"]] for r in rows if docs[r["doc_id"]])
    assert right > 0.95 * len(rows)


def test_resampling_keeps_every_row_and_all_columns(spark):
    rows = [(i, f"the cat {i} of the", "en", 1, i) for i in range(60)] + [(100 + i, f"der hund {i} und die", "de", 2, i) for i in range(10)]
    rows += [(200, None, "en", 1, 0), (201, "", None, 1, 0), (202, "zzz qqq", None, 1, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, rate int, p long")
    got = mixing.resampled(df, 0.5)
    assert got.columns == df.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert set(ids) == {r[0] for r in rows}
    assert sum(100 <= i < 200 for i in ids) > 15 and sum(i < 100 for i in ids) == 60


def test_no_labels_and_empty_table(spark):
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame([(1, "a b", None), (1, "a b", None)], schema)
    assert [(r["rate"], r["copies"]) for r in mixing.mixed(df)[0].collect()] == [(1.0, 1)] * 2
    assert mixing.mixed(spark.createDataFrame([], schema))[0].collect() == []
    assert mixing.resampled(df).count() == 2


def test_plan_is_native(spark, sf):
    plan = mixing.op4_mixing(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_very_long_text_and_ties(spark):
    rows = [(1, "cat " * 500_000, "en"), (2, "hund " * 10, "de"), (3, "hund " * 10, "de"), (4, None, None)]
    got, domains, residuals = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 1.0)
    found = {r["doc_id"]: r for r in got.collect()}
    assert found[1]["tokens"] == 500_000 and found[2]["rate"] == found[3]["rate"] and found[4]["tokens"] == 0 and domains == ["de", "en"]


def test_a_rare_word_decides_and_both_joins_agree(spark, monkeypatch):
    """Three thousand common words that tell nothing, and one word of each domain that occurs in one training row."""
    common = " ".join(f"c{i}" for i in range(3000))
    rows = [(i, f"{common} {common}", "a" if i % 2 else "b") for i in range(10)] + [(20, "rareone", "a"), (21, "raretwo", "b")]
    rows += [(30, "rareone " * 40, None), (31, "raretwo " * 40, None), (32, None, None), (33, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = {}
    for size in (mixing.TABLE_BYTES, 0):
        monkeypatch.setattr(mixing, "TABLE_BYTES", size)
        monkeypatch.setattr("corpuskiln.storage.BROADCAST_BYTES", size)
        p[size] = {r["doc_id"]: r["p"] for r in mixing.mixed(df, 1.0)[0].collect()}
    first, second = p.values()
    assert first[30][0] > 0.9 and first[31][1] > 0.9 and len(first) == len(rows)
    assert all(np.allclose(first[i], second[i]) for i in first)
