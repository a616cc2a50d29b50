import corpus_pipeline
import pytest
from corpuskiln.llm.common import materialize, table
from test_near_dedup import brute as near_brute
from test_substrings import brute as cut_brute


@pytest.fixture(scope="module")
def stages(spark, sf):
    out, docs = [table(spark, sf, "documents")], table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), f"test-{name}")
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "repeats", "mixing", "bpe"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality_drops_bad_documents_only(spark, sf, stages):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    kept = set(texts(stages[1]))
    bad = [i for i, q in labels.items() if q == 0]
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in bad) <= 0.05 * len(bad) and sum(i in kept for i in good) >= 0.98 * len(good)


def test_near_dedup_and_repeats_against_brute_force(stages):
    before = texts(stages[1])
    kept = texts(stages[2])
    assert set(kept) == {i for i, (_, c, k) in near_brute(list(before.items())).items() if k}
    import hashlib

    cut, expected = texts(stages[3]), cut_brute(list(kept.items()))
    assert set(cut) == set(kept)
    assert all(hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest() == expected[i][2] for i, t in cut.items())


def test_mixing_loses_nothing_and_bpe_encodes_every_row(stages):
    assert set(texts(stages[4])) == set(texts(stages[3])) and stages[4].count() >= stages[3].count()
    assert stages[5].count() == stages[4].count()


def test_token_ids_are_the_librarys(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    text = texts(stages[4])
    for r in stages[5].collect():
        assert r["token_ids"] == library.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids and r["n_tokens"] == len(r["token_ids"])


def test_clashing_columns_repeated_rows_and_a_very_long_text(spark, sf):
    long = " ".join(f"word{k} and line\n" if k % 9 == 0 else f"word{k}" for k in range(200_000))
    rows = [(1, long, "en", "s", 1, "k", 0.5), (2, "A calm line of words. It goes on.", "en", "s", 1, "k", 0.5), (2, "A calm line of words. It goes on.", "en", "s", 1, "k", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rep string, rate double")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), f"wide-{name}")
        assert docs.columns == columns or name == "bpe"
    assert {r["doc_id"] for r in docs.collect()} == {1, 2}


def test_odd_rows(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a", "en", None, 1)], schema)
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            rows = materialize(stage(spark, rows, sf), f"odd-{name}")
    assert rows.collect() == []
