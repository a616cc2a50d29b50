"""Sequence packing, batches and splits by position, without a window over all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.operators.joins import running_sum


def with_offsets(rows: DataFrame, order: str, size: str) -> DataFrame:
    """rows with ``offset``: the sum of size over the rows before, by an order column; nulls of it come first."""
    return running_sum(rows, [F.col(order)], size, "offset")


def pack(rows: DataFrame, order: str, tokens: str, block: int) -> DataFrame:
    """(block, ids): the token streams of all rows end to end in blocks of equal size, the rest dropped.

    A row becomes one slice for each block that it touches; a block is put together from its slices.
    """
    sized = with_offsets(rows.select(order, F.col(tokens).alias("__tokens"), F.size(tokens).cast("bigint").alias("__n")).where("__n > 0"), order, "__n")
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("__n") - 1) / block)
    cut = sized.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("block") * block - F.col("offset"), F.lit(0))
    end = F.least((F.col("block") + 1) * block - F.col("offset"), F.col("__n"))
    part = F.struct((F.col("offset") + begin).alias("at"), F.slice("__tokens", (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids"))
    blocks = cut.select("block", part.alias("part")).groupBy("block").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    out = blocks.select("block", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
    return out.where(F.size("ids") == block)


def pack_in_batches(rows: DataFrame, order: str, tokens: str, block: int, batch: int = 1000) -> DataFrame:
    """(batch, block, ids, labels): packed within batches of so many rows; each batch drops its rest."""
    n = with_offsets(rows.select(order, F.col(tokens).alias("tokens"), F.lit(1).cast("bigint").alias("one")), order, "one")
    n = n.withColumn("batch", F.floor(F.col("offset") / batch)).select("batch", order, "tokens")
    joined = n.groupBy("batch").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, "tokens"))), lambda x: x["tokens"])).alias("all"))
    full = F.floor(F.size("all") / block).cast("int")
    cut = joined.where(full > 0).withColumn("block", F.explode(F.sequence(F.lit(0), full - 1)))
    ids = F.slice("all", F.col("block") * block + 1, F.lit(block))
    return cut.select("batch", "block", ids.alias("ids"), ids.alias("labels"))


def head_split(rows: DataFrame, order: str, percent: float = 5.0) -> DataFrame:
    """rows with ``split``: the first floor(n * percent / 100) by order are validation, the rest train."""
    n = rows.agg(F.floor(F.count("*") * F.lit(percent) / 100).alias("__n"))
    placed = with_offsets(rows.withColumn("__one", F.lit(1).cast("bigint")), order, "__one").join(F.broadcast(n))
    return placed.withColumn("split", F.when(F.col("offset") < F.col("__n"), "validation").otherwise("train")).drop("__one", "__n", "offset")


def hash_sample(rows: DataFrame, key: str, share: float) -> DataFrame:
    """A Bernoulli sample that is the same on every run: by the md5 of the key."""
    point = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return rows.where(point < F.lit(int(share * (1 << 32))))


def line_chunks(lines: DataFrame, size: int, file: str = "file", pos: str = "pos", value: str = "value") -> DataFrame:
    """(file, chunk, text): every so many lines of a file joined; pos counts from 0; the last chunk may be short."""
    numbered = lines.withColumn("chunk", F.floor(F.col(pos) / size))
    parts = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))))
    return numbered.groupBy(file, "chunk").agg(F.array_join(F.transform(parts, lambda x: x["v"]), "\n").alias("text"))


def with_end_mark(rows: DataFrame, ids: str, mark: int) -> DataFrame:
    """Token arrays with an end-of-document id."""
    return rows.withColumn(ids, F.array_append(F.coalesce(ids, F.expr("cast(array() as array<int>)")), F.lit(mark)))


def shuffled(rows: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """All rows in an order that depends on the seed and the key only."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)
