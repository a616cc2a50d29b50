"""No text ends a job: every text function over long runs of each mark that it looks for, and over the shapes that used
to take a stack frame or a pass a character."""

import time

import pytest
from corpuskiln.functions import html, markdown, masking, news
from corpuskiln.functions import text as T
from pyspark.sql import functions as F

UNITS = [
    "\n", " ", "a\n", "a ", "A\na\n", "-", "*", "_", "`", "[", "[a](", "](", "![", "![a](", "<", "<p ", "<p>", "<script ", "<script>", "</p", "&", "&amp;", "&gt; ", ">!", "> ", ">",
    "(STT", "(STT)", "***A", "***a ", "**a ", "__a ", "//a", "//", "12 ", "1", "12-", "040 ", "2005 - ", "u@ab.", "ab.", "ab dot ", "a at ", "***", "|", "| a ", "a|", "#", "# ", "=", " ", "<http://",
    "(", "()", "`a", "\\*", "a\t", "a\r\n", " ", "1€", "12 e ", "<!--", "a@b.fi ", "u@ab.fi", " \n", "\n \n",
]
FUNCTIONS = {
    "collapse": T.collapse, "strip": T.strip, "web": T.web_spaces, "forum": T.forum_spaces, "encyclopedia": T.wiki_spaces, "corpus": T.corpus_spaces, "news spaces": T.news_spaces, "tokens": T.basic_tokens,
    "paragraphs": T.paragraphs, "repeats": lambda c: T.repeats_unit(c, 5), "html presence": T.has_html, "ids": T.mask_ids, "headings": lambda c: T.join_split_headings(F.split(c, "\n")), "mails": masking.mask_emails,
    "numbers": masking.mask_numbers, "post": lambda c: markdown.post_text(c, c), "html": lambda c: html.html_text(c, "main"), "news": lambda c: news.clean_paragraphs(F.split(c, "\n"), ["ah"]), "book": news.book_paragraphs,
}


@pytest.fixture(scope="module")
def long(spark):
    rows = [(a + u * (30_000 // len(u)) + b,) for u in UNITS for a, b in (("", ""), ("a", "z"))]
    df = spark.createDataFrame(rows, "text string").repartition(8).cache()
    df.count()
    return df


@pytest.mark.parametrize("name", sorted(FUNCTIONS))
def test_long_runs(long, name):
    began = time.time()
    got = long.select(F.hash(FUNCTIONS[name]("text")).alias("x"))
    assert got.agg(F.count("*"), F.sum(F.col("x").cast("bigint"))).first()[0] == 2 * len(UNITS)
    assert time.time() - began < 90  # 4 million characters


def test_a_million_characters(spark):
    n = 1_000_000
    texts = {
        "number": "12" + " " * n + "3456789", "address": "u@" + "ab." * (n // 3) + "fi", "labels": "u@" + "ab." * (n // 3) + "x", "link": "[a](" + "x" * n + ") b", "quotes": ">" * n + "a", "rule": "-" * n + "x",
        "line ends": "a" + "\n" * n + "b", "blanks": " a" + " " * n + "b", "signs": "1" + "." * n + "2345678",
    }
    rows = spark.createDataFrame(list(texts.items()), "k string, text string").repartition(4)
    got = {r["k"]: r for r in rows.select("k", masking.mask_numbers("text").alias("n"), masking.mask_emails("text").alias("m"), markdown.markdown_text("text").alias("d"), T.strip("text").alias("s"), T.forum_spaces("text").alias("f")).collect()}
    assert got["number"]["n"] == "12" + " " * n + "0000000" and got["signs"]["n"] == "1" + "." * n + "2000000"
    assert got["address"]["m"] == "email@example.com" and got["labels"]["m"] == texts["labels"]  # the last part is a domain's, or none is
    assert got["link"]["d"] == "a b" and got["quotes"]["d"] == "a" and got["rule"]["d"] == texts["rule"]
    assert got["line ends"]["f"] == "a\n\nb" and got["line ends"]["s"] == texts["line ends"] and got["blanks"]["f"] == "a  b"


def test_headings_against_a_fold(spark):
    import random

    rng = random.Random(4)
    some = lambda: rng.choice(["Otsikko", "jatkuu", "ja", "Loppu.", "x" * 30, "9 a", "", " ", "z", "Y" * 48])
    rows = [(i, [some() for _ in range(rng.randrange(0, 60))]) for i in range(300)] + [(300, ["A", *["b"] * 60]), (301, None)]

    def fold(parts):
        out = []
        short = lambda s: len(s) < 50 and not s.strip().endswith((".", ":", "!", "?"))
        for p in parts:
            if out and p[:1].islower() and short(p) and (out[-1][:1].isupper() or out[-1][:1].isdigit()) and short(out[-1]):
                out[-1] += " " + p
            else:
                out.append(p)
        return out

    got = {r["i"]: r["x"] for r in spark.createDataFrame(rows, "i int, p array<string>").select("i", T.join_split_headings("p").alias("x")).collect()}
    assert got == {i: p if p is None else fold(p) for i, p in rows}
