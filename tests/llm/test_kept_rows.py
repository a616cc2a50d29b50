import corpus_pipeline
from corpuskiln.llm import near_dedup
from corpuskiln.llm.common import materialize, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (2, "other words here", "en", "s", 0), (None, "a", "en", None, 1), (None, "b", "en", None, 1), (None, None, "en", None, 1)]


def key(rows):
    return sorted((repr((r[0], r[1])) for r in rows))


def test_near_dedup_keeps_null_ids_and_other_texts(spark):
    got = near_dedup.one_of_each(spark.createDataFrame(ODD, SCHEMA))
    assert key(got.collect()) == key(ODD[:1] + ODD[2:])


def test_rows_that_cannot_be_judged_stay(spark, sf, monkeypatch):
    docs = spark.createDataFrame(ODD, SCHEMA)
    rows = materialize(corpus_pipeline.quality_stage(spark, docs, sf), "kept")
    assert key(rows.collect()) == key(ODD)  # the labels are of other documents: there is no model
    labels = table(spark, sf, "labels").limit(0)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: labels)
    assert corpus_pipeline.quality_stage(spark, docs, sf).count() == len(ODD)
    from corpuskiln.llm import quality

    good, bad = "A calm line of plain words.\nAnother one follows it.", "### !!! $$$ %%%\nx x x x x x x x"
    model = quality.fit([(good + f" {i}", 1) for i in range(20)] + [(bad + f" {i}", 0) for i in range(20)], 0.3)
    mixed = spark.createDataFrame([(1, good), (2, bad), (3, ""), (4, None), (5, " \n")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in quality.only_good(mixed, model).collect()) == [1, 3, 4, 5]


def test_all_stages_on_odd_rows(spark, sf):
    rows = spark.createDataFrame(ODD, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        rows = materialize(stage(spark, rows, sf), f"odd-{name}")
    assert sorted((r["doc_id"] for r in rows.collect()), key=str) == [1, 2, 2, None, None, None]
