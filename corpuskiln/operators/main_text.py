"""The running text of web pages, by the density of links and of common words, block by block.

Jan Pomikálek, "Removing boilerplate and duplicate content from web corpora", 2011. A page is cut into blocks at the elements
that stand on lines of their own. A block is judged by itself first: many links, or short with a link, is bad; short is
open; a long one is good or nearly so if enough of its words are among the commonest, else bad. Open blocks then take the
class of their neighbours, so that a short line between good ones stays and a menu entry doesn't, and nearly good ones go
only between bad ones.

Blocks are rows, and neighbours are found by windows over a page's blocks. The common words are counted over all pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions import html as H
from corpuskiln.functions import text as T
from corpuskiln.storage import materialize

# fixed values: the published thresholds: share of link characters, lengths in characters, shares of common words
LINKS, SHORT, LONG, NEARLY, GOOD = 0.2, 70, 200, 0.30, 0.32
#: Common words that are counted.
COMMON = 100
LINK = r"(?is)<a(?:\s[^>]*)?>"
LINK_EVENT = r"(?is)<a(?:\s[^>]*)?>|</a\s*>"
LINKED = r"(?is)<a(?:\s[^>]*)?>(.*?)(?:</a\s*>|$)"


def blocks(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(row, id, pos, text, links): a row for each block, at least one a page; links counts its characters inside links,
    which can have begun in an earlier block."""
    shown = H.shown(F.coalesce(F.col(html_col), F.lit("")))
    rows = pages.select(F.col(id_col).alias("id"), F.split(shown, H.BLOCK).alias("pieces")).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows.select("row", "id", F.posexplode("pieces").alias("pos", "piece")), "blocks")
    before = Window.partitionBy("row").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    event = F.try_element_at(F.regexp_extract_all("piece", F.lit(LINK_EVENT), F.lit(0)), F.lit(-1))
    inside = F.coalesce(F.last(event, ignorenulls=True).over(before).rlike(LINK), F.lit(False))
    piece = F.concat(F.when(inside, "<a>").otherwise(""), F.col("piece"))
    linked = F.array_join(F.regexp_extract_all(piece, F.lit(LINKED), F.lit(1)), " ")
    return rows.select("row", "id", "pos", plain(F.col("piece")).alias("text"), F.length(plain(linked)).alias("links"))


def plain(piece: Column) -> Column:
    return T.collapse(H.resolved(F.regexp_replace(piece, H.TAG, "")))


def common_words(found: DataFrame, n: int = COMMON) -> list[str]:
    """The commonest words of all blocks, in lower case; of equally common ones the first by the alphabet."""
    words = found.select(F.explode(F.split(F.lower("text"), " ")).alias("w")).where("w <> ''")
    return [r["w"] for r in words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(n).collect()]


def classed(found: DataFrame, common: list[str]) -> DataFrame:
    """found with ``class``: good or bad; blocks without text are left out."""
    words = F.split(F.lower("text"), " ")
    share = F.size(F.filter(words, lambda w: w.isin(*common))) / F.size(words)
    n = F.length("text")
    own = (
        F.when(F.col("links") / n > LINKS, "bad").when(n < SHORT, F.when(F.col("links") > 0, "bad").otherwise("short"))
        .when(share >= GOOD, F.when(n > LONG, "good").otherwise("near")).when(share >= NEARLY, "near").otherwise("bad")
    )
    rows = found.where("text <> ''").withColumn("own", own if common else F.lit("bad"))
    w = Window.partitionBy("row").orderBy("pos")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)

    def beside(c: str, kinds: tuple[str, ...]) -> tuple[Column, Column]:
        """The nearest class of those kinds on both sides; bad at the ends of a page."""
        known = F.when(F.col(c).isin(*kinds), F.col(c))
        return F.coalesce(F.last(known, ignorenulls=True).over(before), F.lit("bad")), F.coalesce(F.first(known, ignorenulls=True).over(after), F.lit("bad"))

    names = ["left", "right", "left_near", "right_near"]
    rows = rows.withColumns(dict(zip(names, (*beside("own", ("good", "bad")), *beside("own", ("good", "bad", "near"))), strict=True)))
    near = ((F.col("left") == "bad") & (F.col("left_near") == "near")) | ((F.col("right") == "bad") & (F.col("right_near") == "near"))
    open_ = F.when(F.col("left") == F.col("right"), F.col("left")).when(near, "good").otherwise("bad")
    rows = rows.withColumn("settled", F.when(F.col("own") == "short", open_).otherwise(F.col("own"))).drop(*names)
    left, right = beside("settled", ("good", "bad"))
    rows = rows.withColumns({"left": left, "right": right})
    last = F.when(F.col("settled") == "near", F.when((F.col("left") == "bad") & (F.col("right") == "bad"), "bad").otherwise("good")).otherwise(F.col("settled"))
    return rows.withColumn("class", last).drop("own", "settled", "left", "right")


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", common: list[str] | None = None) -> DataFrame:
    """(id, text, n_blocks, n_good) of every page: the good blocks, a line each. common: the common words to judge by, those
    of all pages if none are given.

    Defined cases: null, empty and textless pages have no blocks and an empty text; rows that repeat an id are
    pages of their own; an empty table gives an empty result; further columns are ignored.
    """
    found = materialize(blocks(pages, id_col, html_col), "block-texts")
    kept = classed(found, common_words(found) if common is None else common)
    good = F.when(F.col("class") == "good", F.struct("pos", "text"))
    texts = kept.groupBy("row").agg(F.array_sort(F.collect_list(good)).alias("t"), F.count("*").alias("b"))
    every = found.groupBy("row").agg(F.first("id").alias("id"))
    return every.join(texts, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce(F.array_join(F.transform("t", lambda x: x["text"]), "\n"), F.lit("")).alias("text"),
        F.coalesce("b", F.lit(0)).cast("bigint").alias("n_blocks"), F.greatest(F.size("t"), F.lit(0)).cast("bigint").alias("n_good"),
    )
