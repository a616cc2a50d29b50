import zlib

from corpuskiln.llm import language
from corpuskiln.llm.common import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").collect()}
    rows = language.op5_language(spark, sf).collect()
    assert len(rows) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    judged = [r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"] and langs[r["doc_id"]]]
    assert sum(judged) > 0.97 * len(judged)


def test_viterbi_against_brute_force():
    import itertools

    import numpy as np

    rnd = np.random.default_rng(0)
    counts = np.array([0, 1, 5, 3, 0, 6, 2])
    scores = rnd.normal(size=(counts.sum(), 3)).astype(np.float32) * 2
    got, at = language.viterbi(scores, counts, 1.5), 0
    for n in counts:
        s = scores[at : at + n]
        total = lambda p: sum(s[k, c] for k, c in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        best = max(map(total, itertools.product(range(3), repeat=int(n)))) if n else 0
        assert abs(total(got[at : at + n]) - best) < 1e-4
        at += n


def test_spans_scripts_and_odd_texts(spark):
    rows = [("the cat and the dog are in the house", "en"), ("der hund und die katze sind im haus", "de"), ("кошка и собака в доме", "ru")] * 3
    model = language.fit(rows)
    assert [s[2] for s in language.spans_of(model, "the cat and the dog in the house der hund und die katze im haus")] == ["en", "de"]
    got, score = language.predict_batch(model, ["в доме кошка", None, "", "123 !?", "the cat", "the " * 20_000])
    assert got == ["ru", "und", "und", "und", "en", "en"] and score[1] == 0 and score[4] == 1
    df = spark.createDataFrame([(1, "the cat", None, 1), (1, "the cat", None, 1), (None, None, None, 1)], "doc_id long, text string, lang string, score int")
    assert [r["lang_pred"] for r in language.identify(df, model).collect()] == ["en", "en", "und"]
    assert [len(r["spans"]) for r in language.spans(df, model).collect()] == [1, 1, 0]
    empty = language.learn(language.training_rows(df, df["doc_id"].isNotNull(), "doc_id", "text", "lang", 5))
    assert {r["lang_pred"] for r in language.identify(df, empty).collect()} == {"und"}
    assert language.identify(df.limit(0), model).collect() == []


def test_counting_in_tasks_equals_counting_in_memory(spark):
    import numpy as np

    rows = [(i, f"the cat {i} and the dog" if i % 2 else f"der hund {i} und ein haus", "en" if i % 2 else "de") for i in range(40)] + [(50, "the " * 300_000, "en"), (51, None, "fr"), (52, "кошка", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = language.learn(language.training_rows(df, df["doc_id"].isNotNull(), "doc_id", "text", "lang", 100))
    plain = language.fit([(t, x) for _, t, x in rows if t and x])
    assert got.langs == plain.langs == ["de", "en"] and np.allclose(got.table, plain.table) and (got.allowed == plain.allowed).all()


def test_letters_of_the_last_planes_and_long_texts_in_pieces(monkeypatch):
    model = language.fit([("the cat and the dog", "en"), ("\U00030010\U00030011\U00030012 \U00030010\U00030013", "zh")])
    assert language.predict_batch(model, ["\U00030010\U00030011", "the dog"])[0] == ["zh", "en"]
    text = " ".join(["the cat and the dog"] * 50 + ["\U00030010\U00030011"] * 40) + "x" * 500
    whole = language.predict_batch(model, [text, None, "dog"])
    monkeypatch.setattr(language, "CHUNK_CHARS", 64)
    monkeypatch.setattr(language.text_pieces, "__defaults__", (64,))
    monkeypatch.setattr(language.in_parts, "__defaults__", (64,))
    assert len(language.text_pieces(text)) > 10 and "".join(language.text_pieces(text)) == text
    cut = language.predict_batch(model, [text, None, "dog"])
    assert cut[0] == whole[0] and (cut[1] == whole[1]).all()
