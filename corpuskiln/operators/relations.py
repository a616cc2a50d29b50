"""Relational operators: keyed dedup, quote lookup, inverse distribution, interval anti-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.operators.joins import carried, ranged, running_sum, spread_join
from corpuskiln.storage import if_small, materialize


def keyed_dedup(rows: DataFrame, key: str, order: list[Column], deleted: Column | None = None) -> DataFrame:
    """The first row of each key; rows that are deleted go afterwards, so a deleted first copy
    suppresses later ones. Reverse the order to keep the latest."""
    first = rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")
    return first.where(~F.coalesce(deleted, F.lit(False))) if deleted is not None else first


def quote_lookup(rows: DataFrame, id_col: str, quoted_col: str, pos_col: str, text_col: str, none="0") -> DataFrame:
    """rows with ``quoted_text``: the latest text stored under the quoted id at or before the row.

    Stores and lookups are one table in the order of comment id and position, in which the last text is carried
    forward: no pairs, and no id meets in one task. At one position a row is stored before it looks up.
    """
    stores = rows.select(F.col(id_col).alias("__k"), F.col(pos_col).alias("__p"), F.lit(0).alias("__lookup"), F.col(text_col).alias("__t"))
    looks = rows.where(F.col(quoted_col) != F.lit(none)).select(F.col(quoted_col).alias("__k"), F.col(pos_col).alias("__p"), F.lit(1).alias("__lookup"), F.lit(None).cast("string").alias("__t"))
    found = carried(stores.unionByName(looks), ["__k"], ["__p", "__lookup"], "__t", "quoted_text").where("__lookup = 1").select(F.col("__p").alias("__row"), "quoted_text")
    return rows.join(found, rows[pos_col] == found["__row"], "left").drop("__row")


def frequency_table(freqs: DataFrame, word: str = "word", freq: str = "freq") -> DataFrame:
    """(word, freq, below, upto, cum, total): running totals by falling frequency, then word; cum is a share.

    The order is cut into ranges of about equal size, so that words seen once, half of any vocabulary, are in many.
    """
    rows = materialize(freqs.select(F.col(word).alias("word"), F.col(freq).alias("freq")), "frequencies")
    total = rows.agg(F.sum("freq").alias("__total"))
    out = running_sum(rows, [F.desc("freq"), F.desc("word")], "freq", "below").join(F.broadcast(total))
    upto = F.col("below") + F.col("freq")
    return out.select("word", "freq", "below", upto.alias("upto"), (upto / F.col("__total")).alias("cum"), F.col("__total").alias("total"))


def inverse_distribution(draws: DataFrame, table: DataFrame, u: str = "u") -> DataFrame:
    """draws with ``word``: the first of the table whose cumulative share reaches u (0 to 1); null for a null u.

    Draws and words are one table in the order of their places, in which the last word is carried forward;
    equal draws are one row of it.
    """
    table = materialize(table.select("word", "below", "total"), "distribution")
    size = table.agg(F.max("total").alias("__total"))
    place = F.when(F.col(u).isNotNull(), F.greatest(F.ceil(F.col(u) * F.col("__total")), F.lit(1)) - 1)
    want = draws.join(F.broadcast(size)).withColumn("__place", place.cast("bigint")).drop("__total")
    marks = table.select(F.lit(0).alias("__one"), F.col("below").cast("bigint").alias("__at"), F.lit(0).alias("__draw"), "word")
    marks = marks.unionByName(want.where("__place is not null").select(F.lit(0).alias("__one"), F.col("__place").alias("__at"), F.lit(1).alias("__draw"), F.lit(None).cast("string").alias("word")).distinct())
    found = carried(marks, ["__one"], ["__at", "__draw"], "word", "__word").where("__draw = 1").select(F.col("__at").alias("__place"), F.col("__word").alias("word"))
    found = materialize(found, "drawn")
    sizes = want.groupBy("__place").agg(F.count("*").alias("n"))
    return spread_join(want, found, "__place", sizes, u, "left").drop("__place")


def interval_anti_join(spans: DataFrame, keeps: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """spans that overlap no keep of the same key; touching spans do not overlap.

    One ordered pass by ranges: a span overlaps a keep if, of the keeps that begin before its end, the one that reaches
    furthest ends behind its start. No span meets all keeps of its key. Nulls overlap nothing.
    """
    k = keeps.where(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull())
    none = F.lit(None).cast(dict(keeps.dtypes)[end])
    rows = spans.select(F.struct("*").alias("__row"), F.col(key).alias("__key"), F.col(end).alias("__at"), F.lit(0).alias("__keep"), none.alias("__reach"))
    marks = k.select(F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), F.col(key).alias("__key"), F.col(start).alias("__at"), F.lit(1).alias("__keep"), F.col(end).alias("__reach"))
    # keeps that begin where a span ends come behind it
    order = ["__key", "__at", "__keep"]
    cut = ranged(rows.unionByName(marks), [F.col(c) for c in order], "intervals")
    ends = cut.groupBy("__key", "__cell").agg(F.max("__reach").alias("r"))
    before = F.max("r").over(Window.partitionBy("__key").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(F.col("__key").alias("__k"), F.col("__cell").alias("__c"), before.alias("__before")).where("__before is not null")  # keys that lie in several ranges
    w = Window.partitionBy("__cell", "__key").orderBy("__at", "__keep").rowsBetween(Window.unboundedPreceding, 0)
    both = cut.withColumn("__in", F.max("__reach").over(w)).where("__keep = 0").join(if_small(ends), (F.col("__key") == F.col("__k")) & (F.col("__cell") == F.col("__c")), "left")
    reach = F.greatest("__in", "__before")
    return both.where(F.col("__row")[start].isNull() | reach.isNull() | (reach <= F.col("__row")[start])).select("__row.*")


def downsample(freqs: DataFrame, ratio: float = 0.01, freq: str = "freq") -> DataFrame:
    """Frequencies times the ratio, rounded half to even; what rounds to nothing goes."""
    return freqs.withColumn(freq, F.bround(F.col(freq) * F.lit(ratio)).cast("bigint")).where(F.col(freq) > 0)
