from corpuskiln.operators import language_model


def shares(df, target, **kw):
    return {r["doc_id"]: r["lang_prob"] for r in language_model.language_classes(df, target, **kw).collect()}


def test_rare_words_past_the_commonest_decide(spark, monkeypatch):
    common = " ".join(f"w{k}" for k in range(6000))
    rows = [(1, common + " " + common, "en"), (2, common + " " + common + " zeldzaam", "nl"), (3, "zeldzaam", None), (4, "zeldzaam w1", None), (5, "", None), (6, "unheard", None), (7, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = shares(df, "nl")
    assert got[3] > 0.6 and got[4] > 0.6 and got[5] == got[6] == got[7] == 0.0 and len(got) == 7
    # the same when most words are joined by a shuffle
    model = language_model.word_gains(df)
    cut = {r["doc_id"]: r["lang_prob"] for r in language_model.label_shares(df, model, "nl", common=10).collect()}
    assert all(abs(cut[i] - got[i]) < 1e-9 for i in got)


def test_more_than_256_labels(spark):
    df = spark.createDataFrame([(i, f"word{i} shared", f"l{i:03}") for i in range(300)], "doc_id long, text string, lang string")
    got = shares(df, "l299")
    assert got[299] > 0.5 and all(got[i] == 0.0 for i in range(299))


def test_lines_with_pairs_that_the_model_lacks(spark):
    import math
    from collections import Counter

    known = [(1, "a b a\nb c"), (2, "a b")]
    new = [(7, "a b\nb x y\n\n x"), (8, "c c c"), (9, None), (10, "")]
    model = language_model.bigram_model(spark.createDataFrame(known, "doc_id long, text string"))
    got = {(r["doc_id"], r["line"]): (r["n"], r["log10p"]) for r in language_model.line_scores(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    pairs = lambda line: list(zip(["<s>", *line.split()], [*line.split(), "</s>"]))
    n_ab = Counter(p for _, t in known for x in t.split("\n") for p in pairs(x))
    n_a, v = Counter(a for a, _ in n_ab.elements()), len({b for _, b in n_ab})
    want = {(i, k): (len(pairs(x)), sum(math.log10((n_ab[p] + 1) / (n_a[p[0]] + v)) for p in pairs(x))) for i, t in new if t for k, x in enumerate(t.split("\n")) if x.strip()}
    assert set(got) == set(want) and all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][1]) for k in want)
