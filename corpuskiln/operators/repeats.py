"""N-gram near-duplicate removal of paragraphs: what a paragraph shares with what came before it.

Every token n-gram is first seen at the smallest position that holds it; a paragraph goes if more
than a share of its n-grams were seen before. The direction of the order decides whether the first
or the latest copy stays. The n-grams of dropped paragraphs count as seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import text as T
from corpuskiln.operators.joins import spread_join
from corpuskiln.storage import materialize


def paragraph_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(T.paragraphs(text_col)).alias("par", "paragraph"))


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, par, paragraph): lines that aren't blank in the place of paragraphs."""
    parts = F.filter(F.split(F.col(text_col), "\n"), lambda p: ~T.is_blank(p))
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(parts).alias("par", "paragraph"))


def duplicate_shares(docs: DataFrame, n: int = 7, id_col: str = "doc_id", text_col: str = "text", latest: bool = False, lines: bool = False) -> DataFrame:
    """(doc_id, par, n_grams, n_seen): paragraphs, or lines, of fewer than n tokens have one n-gram, themselves.

    Only n-grams that several places have are looked up, and one that very many have is spread over tasks.
    """
    tokens = F.filter(F.split(F.col("paragraph"), f"[{T.P.SPACES}]+"), lambda t: t != "")
    units = (line_rows if lines else paragraph_rows)(docs, id_col, text_col).select("doc_id", "par", tokens.alias("t"))
    count = F.greatest(F.size("t") - n + 1, F.lit(1))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.array_join(F.slice("t", i, F.lit(n)), " "))))
    units = materialize(units.select("doc_id", "par", grams.alias("grams")), "grams")
    order = F.struct("doc_id", "par")
    rows = units.select("doc_id", "par", F.explode("grams").alias("g"))
    first = rows.groupBy("g").agg((F.max if latest else F.min)(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = materialize(first, "shared-grams")
    hits = spread_join(rows, first.select("g", "first"), "g", first.select("g", "n"), "doc_id").where(F.col("first") != order)
    seen = hits.groupBy("doc_id", "par").agg(F.count("*").alias("n_seen"))
    out = units.select("doc_id", "par", F.size("grams").cast("bigint").alias("n_grams")).join(seen, ["doc_id", "par"], "left")
    return out.select("doc_id", "par", "n_grams", F.coalesce("n_seen", F.lit(0).cast("bigint")).alias("n_seen"))


def without_duplicates(docs: DataFrame, threshold: float = 0.5, n: int = 7, id_col: str = "doc_id", text_col: str = "text", latest: bool = False, lines: bool = False) -> DataFrame:
    """(doc_id, text): the paragraphs that stay, joined by blank lines (lines by line ends); documents that keep none go."""
    gone = duplicate_shares(docs, n, id_col, text_col, latest, lines).where(F.col("n_seen") > F.col("n_grams") * F.lit(threshold)).select("doc_id", "par")
    left = (line_rows if lines else paragraph_rows)(docs, id_col, text_col).join(gone, ["doc_id", "par"], "left_anti")
    parts = F.array_sort(F.collect_list(F.struct("par", "paragraph")))
    return left.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["paragraph"]), "\n" if lines else "\n\n").alias("text"))
