"""Joins and running values that no hot key and no single task can stall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln import storage
from corpuskiln.storage import materialize, measured

#: Rows of one key that may meet in a task, and keys with more that may be broadcast: the bound on rows grows
#: with the table so that the keys beyond it stay that few.
HOT_ROWS, HOT_KEYS = 256, 100_000
#: Rows of a range at most, about; there are never fewer ranges than shuffle partitions.
RANGE_ROWS = 2_000_000


def spread_join(rows: DataFrame, other: DataFrame, key: str, sizes: DataFrame, by: str, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with other, which has one row a key, so that no key meets in one task.

    sizes: (key, n) of at least the keys that have many rows. Keys over the bound, at most HOT_KEYS of them
    by arithmetic, are cut into parts by a hash of the column ``by``; their row of other goes to every part. A
    table other that is measured small is broadcast instead.
    """
    if measured(other) <= storage.BROADCAST_BYTES:
        return rows.join(F.broadcast(other), key, how)
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    bound = max(HOT_ROWS, total // HOT_KEYS)
    hot = F.broadcast(sizes.where(F.col("n") > bound).select(key, F.ceil(F.col("n") / bound).cast("int").alias("__parts")))
    left = rows.join(hot, key, "left").withColumn("__part", F.expr(f"cast(pmod(xxhash64({by}), if({key} is null, 1000000, coalesce(__parts, 1))) as int)")).drop("__parts")
    right = other.join(hot, key, "left").withColumn("__part", F.explode(F.expr("sequence(0, coalesce(__parts, 1) - 1)"))).drop("__parts")
    return left.join(right, [key, "__part"], how).drop("__part")


def ranged(rows: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """rows with ``__cell``, the number of the range that a row is in by the order; ranges follow one another.

    Ranges are drawn by a sample of the rows, so they are about equal whatever the values are, and their number
    grows with the rows. The table is written, so that ranges stay what they are.
    """
    spark, rows = rows.sparkSession, materialize(rows, tag)  # counted, sampled and dealt: three passes
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS + 1)
    return materialize(rows.repartitionByRange(n, *order).withColumn("__cell", F.spark_partition_id()), tag)


def running_sum(rows: DataFrame, order: list[Column], size: str, name: str) -> DataFrame:
    """rows with ``name``: the sum of size over the rows before, in order; nulls of the order come where it puts them."""
    cut = ranged(rows, order, "ranges")
    totals = cut.groupBy("__cell").agg(F.sum(size).alias("__sum"))  # one row a range
    before = totals.select(F.col("__cell").alias("__c"), (F.sum("__sum").over(Window.orderBy("__cell")) - F.col("__sum")).alias("__before"))
    w = Window.partitionBy("__cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.withColumn("__in", F.sum(size).over(w) - F.col(size)).join(F.broadcast(before), F.col("__cell") == F.col("__c"))
    return out.withColumn(name, F.col("__before") + F.col("__in")).drop("__cell", "__c", "__before", "__in")


def carried(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """rows with ``name``: the latest value that isn't null at or before a row among those of equal keys.

    Within a range by a window; where a key began in an earlier range, by the last value of the ranges before.
    """
    cut = ranged(rows, [F.col(c) for c in keys + order], "carried")
    w = Window.partitionBy("__cell", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = F.max_by(F.struct(*keys, F.col(value).alias("__v")), F.struct(*keys, *order)).alias("__end")
    ends = cut.select("__cell").distinct().join(cut.where(F.col(value).isNotNull()).groupBy("__cell").agg(last), "__cell", "left")  # one row a range
    earlier = F.last("__end", ignorenulls=True).over(Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(F.col("__cell").alias("__c"), earlier.alias("__end"))
    out = cut.withColumn("__inside", F.last(value, ignorenulls=True).over(w)).join(F.broadcast(ends), F.col("__cell") == F.col("__c"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__end.{k}"))
    return out.withColumn(name, F.coalesce("__inside", F.when(same, F.col("__end.__v")))).drop("__cell", "__c", "__end", "__inside")
