"""Goldens of the text rules, and a comparison with a plain restatement over mixed scripts."""

import re

from corpuskiln.functions import news
from corpuskiln.functions import text as T
from corpuskiln.operators import filters
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "text string").select(column.alias("x")).first()["x"]


def test_metrics_of_the_goldens(spark):
    rows = [("Suomen kieli on kaunis, a b 12.\n\nToinen kappale 3½ straße!",), ("ABC",), ("",), (None,)]
    m = [r["metrics"] for r in filters.with_metrics(spark.createDataFrame(rows, "text string")).collect()]
    assert (m[0]["chars"], m[0]["words"], m[0]["paragraphs"], m[0]["avg_len"]) == (58, 6, 2, 3.0)
    assert (round(m[0]["digit_ratio"] * 58), round(m[0]["upper_ratio"] * 58), round(m[0]["foreign_ratio"] * 58), round(m[0]["punct_ratio"] * 58)) == (3, 2, 2, 3)
    assert m[0]["short_ratio"] == 0.25 and m[0]["type_token_ratio"] == 1.0
    assert (m[1]["words"], m[1]["short_words"], m[1]["short_ratio"], m[1]["upper_ratio"], m[1]["avg_len"]) == (0, 0, 0.0, 1.0, 0.0)
    assert m[2]["punct_ratio"] is None and m[3]["chars"] is None


def test_repetition(spark):
    for text, most in (("aaaaaaa", 5), ("abababababab", 4), ("abcabcabc", 1)):
        assert [k for k in range(9) if one(spark, text, T.repeats_unit("text", k))] == list(range(most + 1))


def test_cascade_order(spark):
    docs = spark.createDataFrame([("12345",), ("  \n",), (None,), ("Tämä on hyvä lause ja toinen.",)], "text string")
    outcome = lambda **o: [r["outcome"] for r in filters.judged(docs, filters.config_from(**o)).collect()]
    assert outcome(digit_ratio=0.1, min_words=5) == ["digit-ratio", "empty", "empty", "pass-all"]
    assert outcome(digit_ratio=0.1, min_words=5, avg_len=5)[0] == "avg-len"
    kept, inverted = (filters.kept(docs, filters.config_from(min_words=5, invert=x)).count() for x in (False, True))
    assert kept + inverted == docs.count() and kept == 1


SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"
ALPHABET = st.text(st.sampled_from("aAbåÄxyZé½²①Ⅷ9_.,!?-…¿日本😀ßΣ́​�\x00\n" + SPACES), max_size=40)


@settings(max_examples=25, deadline=None)
@given(st.lists(ALPHABET, min_size=30, max_size=30))
def test_metrics_against_a_restatement(spark, texts):
    texts = [t.replace("\x00", "") for t in texts]
    native = "a-zåäöA-ZÅÄÖ"
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(
        "i", F.size(T.words("text")).alias("w"), F.size(T.short_words("text")).alias("s"), T.digits("text").alias("d"), T.uppers("text").alias("u"),
        T.foreign_letters("text").alias("f"), F.size(T.tokens("text")).alias("t"), F.size(T.paragraphs("text")).alias("p"), T.is_blank("text").alias("b"), T.collapse("text").alias("c"),
    )
    for r in rows.collect():
        t = texts[r["i"]]
        assert r["w"] == len(re.findall(r"\b(?:[A-ZÅÄÖ][a-zåäö]{1,}|[a-zåäö]{2,})\b", t))
        assert r["s"] == len(re.findall(rf"\b[{native}]\b", t))
        assert (r["d"], r["u"]) == (sum(c.isdigit() for c in t), sum(c.isupper() for c in t))
        assert r["f"] == len(re.findall(rf"[^\W\d_{native}]", t))
        assert r["t"] == sum(1 for x in re.findall(r"[^\W\d_]+|\s+|.", t) if not x.isspace())
        assert r["p"] == len([p for p in re.split(r"\n\n+", t) if p and not p.isspace()])
        assert r["b"] == (not t or t.isspace()) and r["c"] == " ".join(t.split())


def test_basic_tokens(spark):
    assert one(spark, "Hei, maailma! Maksaa 5€.", T.basic_tokens("text")) == ["Hei", ",", "maailma", "!", "Maksaa", "5€", "."]
    assert one(spark, "a\x0bb\tc", T.basic_tokens("text")) == ["ab", "c"]
    assert one(spark, "日本語 ok", T.basic_tokens("text")) == ["日", "本", "語", "ok"]
    assert one(spark, "zero​width x", T.basic_tokens("text")) == ["zerowidth", "x"]


def test_masks(spark):
    assert one(spark, "010190-123A", T.mask_ids("text")) == "010101-001Z"
    assert one(spark, "010190+9999.", T.mask_ids("text")) == "010101-001Z."
    for same in ("x010190A1234", "1010190-123A"):
        assert one(spark, same, T.mask_ids("text")) == same


def test_formats_and_headings(spark):
    for n, s in ((1000, "1000.0"), (1001, "1.0K"), (999950, "1000.0K")):
        assert spark.range(1).select(T.si_format(F.lit(n)).alias("x")).first()["x"] == s
    parts = F.array(*map(F.lit, ["Otsikko", "jatkuu taas", "ja vielä", "Lause loppuu.", "pieni alku"]))
    assert spark.range(1).select(T.join_split_headings(parts).alias("x")).first()["x"] == ["Otsikko jatkuu taas ja vielä", "Lause loppuu.", "pieni alku"]


def test_news_chain(spark):
    parts = ["puolueet", "kiinan puoluekokous", "///jatkettu versio///", "Kahdeksan voimahahmoa jättämässä puolueen johtopaikat Kiinassa\nPeking, 16. 10. (STT—Reuter—TT—AFP)"]
    got = spark.range(1).select(news.clean_paragraphs(F.array(*map(F.lit, parts))).alias("x")).first()["x"]
    assert got == ["Kahdeksan voimahahmoa jättämässä puolueen johtopaikat Kiinassa\nPeking, 16. 10."]


def test_line_filter(spark):
    df = spark.createDataFrame([(["a", "", "b", "c"], [10.0, 0.0, 900.0, 20.0])], "l array<string>, s array<double>")
    cut = lambda t, m=None: df.select(filters.filter_lines(F.col("l"), F.col("s"), t, m).alias("x")).first()["x"]
    assert cut(100) == "a\n\nc" and cut(1000) == "a\n\nb\nc" and cut(100, 0.9) == ""
