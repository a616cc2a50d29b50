import numpy as np
from corpuskiln.llm import language, mixing
from pyspark.sql import functions as F


def test_seventy_domains_are_all_learned_and_met(spark, tmp_path):
    rows = [(1000 * k + i, f"w{k} x{k} y{k} z{k} same " * (1 + i % 3), f"d{k:02d}") for k in range(70) for i in range(4 + k % 5)]
    rows += [(900_000 + i, "w69 x69 same " * 9, "d69") for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op4_mixing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(len(r["posterior"]) == 70 for r in got)
    total: dict[str, float] = {}
    for r in got:
        for d, x in r["posterior"].items():
            total[d] = total.get(d, 0) + x * r["tokens"] * r["rate"]
    share = sum(total.values()) / 70
    worst = max(abs(t - share) / share for t in total.values())
    assert np.isclose(worst, got[0]["residual"], rtol=0.05, atol=1e-6) and worst < 0.01


def test_residuals_tell_whether_targets_are_met(spark, monkeypatch):
    rows = [(i, "the cat of the house", "en") for i in range(30)] + [(100 + i, "der hund und die katze", "de") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert max(map(abs, mixing.mixed(df, 1.0)[2])) <= mixing.TOLERANCE
    monkeypatch.setattr(mixing, "STEPS", 1)
    assert max(map(abs, mixing.mixed(df, 1.0)[2])) > 0.1


def test_three_hundred_languages_are_learned(spark):
    df = spark.createDataFrame([(i, "same " + f"{chr(i % 300 + 0x4E00)} " * 20, f"l{i % 300}") for i in range(1200)], "doc_id long, text string, lang string")
    sample = language.training_rows(df, F.lit(True), "doc_id", "text", "lang", 3)
    assert sample.count() == 900 and sample.select("l").distinct().count() == 300
    model = language.learn(sample)
    assert len(model.langs) == 300
    got, _ = language.predict_batch(model, [chr(k + 0x4E00) for k in range(300)])
    assert sum(g == f"l{k}" for k, g in enumerate(got)) > 290
