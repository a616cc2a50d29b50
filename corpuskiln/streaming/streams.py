"""The stream forms of filters, dedup, quote lookup and packing, over Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpuskiln.functions import text as T
from corpuskiln.operators import filters
from corpuskiln.storage import shared_dir


def filtered(docs: DataFrame, config: filters.FilterConfig, text_col: str = "text") -> DataFrame:
    """Stateless: the same columns as on a table, in append mode."""
    return filters.kept(docs, config, text_col)


def masked_ids(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.withColumn(text_col, T.mask_ids(text_col))


def first_seen(rows: DataFrame, key: str, event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; with an event time the seen keys are forgotten after the delay."""
    if event_time is None:
        return rows.dropDuplicates([key])
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def quoted(rows: DataFrame, thread: str, comment: str, quoted_comment: str, text: str, position: str, forget: str | None = None) -> DataFrame:
    """(comment, quoted_text) by thread: the latest text seen so far under the quoted id, null if there is none.

    The rows of a thread in one batch are taken in the order of their position; a row is stored before it looks
    up. A row stores under its id and asks under the one it quotes, so state is one text an id, a batch touches the
    ids that it names and no others, and what meets in one task is one id's rows of one batch. On an endless stream a
    text goes after ``forget`` without rows that name its id ("1 day", say; a stream with such a clock never runs dry, so it
    can't be drained).

    Defined cases: null positions come first; a null thread or id is a thread or an id like others.
    """
    keep = pd.Timedelta(forget) // pd.Timedelta("1ms") if forget else None

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        all_ = pd.concat(list(frames)).sort_values(["position", "asks"], kind="stable", na_position="first")
        asks = all_["asks"].to_numpy(dtype=bool)
        texts = [state.get[0] if state.exists else None, *all_["text"]]
        last = np.maximum.accumulate(np.where(asks, 0, np.arange(1, len(asks) + 1)))  # 0: what was known before the batch
        yield pd.DataFrame({"comment": all_["comment"].to_numpy()[asks], "quoted_text": [texts[k] for k in last[asks]]}, dtype=object)
        if last[-1]:
            state.update((texts[last[-1]],))
        if keep and state.exists:
            state.setTimeoutDuration(keep)

    id_of = lambda c: F.col(c).cast("string")
    stores = F.struct(id_of(comment).alias("id"), F.lit(False).alias("asks"), F.lit(None).cast("string").alias("comment"), F.col(text).alias("text"))
    asks = F.struct(id_of(quoted_comment).alias("id"), F.lit(True).alias("asks"), id_of(comment).alias("comment"), F.lit(None).cast("string").alias("text"))
    both = rows.select(F.col(thread).alias("thread"), F.col(position).alias("position"), F.explode(F.array(stores, asks)).alias("r")).select("thread", "position", "r.*")
    clock = GroupStateTimeout.ProcessingTimeTimeout if keep else GroupStateTimeout.NoTimeout
    return both.groupBy("thread", "id").applyInPandasWithState(step, "comment string, quoted_text string", "text string", "append", clock)


def packed(rows: DataFrame, shard: str | list[str], ids: str, block: int) -> DataFrame:
    """(shard columns, n, ids): fixed blocks of each shard's token stream, and at the end of each batch what is left.

    What is left over waits in the state; its row is shorter than a block and n is the number of blocks before
    it, so that of each shard's short rows the last by (n, length) holds what no block holds yet, see totals().
    """
    keys = [shard] if isinstance(shard, str) else list(shard)

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, left = state.get if state.exists else (0, [])
        left = list(left)
        for frame in frames:
            out = []
            for row in frame[ids]:
                left.extend(int(x) for x in row)
                at = 0
                while len(left) - at >= block:
                    out.append((*key, done, left[at : at + block]))
                    at, done = at + block, done + 1
                left = left[at:]
            yield pd.DataFrame(out, columns=[*keys, "n", "ids"])
        state.update((done, left))
        yield pd.DataFrame([(*key, done, left)], columns=[*keys, "n", "ids"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return rows.groupBy(*keys).applyInPandasWithState(step, f"{schema}, n bigint, ids array<int>", "done bigint, left array<int>", "append", GroupStateTimeout.NoTimeout)


def totals(out: DataFrame, parts: list[str], shard: str, block: int) -> DataFrame:
    """(shard, blocks): blocks of each shard over the written output of packed() by parts of the shard; what the
    parts leave over is put together. Python-free, and one row a part."""
    rest = out.where(F.size("ids") < block).groupBy(*parts).agg(F.max(F.struct("n", F.size("ids").alias("size"))).alias("last"))
    return rest.groupBy(shard).agg((F.sum("last.n") + F.floor(F.sum("last.size") / block)).cast("bigint").alias("blocks"))


def windowed_counts(events: DataFrame, event_time: str, by: str, length: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Counts of tumbling windows, final once the watermark has passed."""
    return events.withWatermark(event_time, delay).groupBy(F.window(event_time, length), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def drained(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what its source holds now, and return the table of its output, written to the shared folder."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/out")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)  # a source without rows writes nothing
    q = stream.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
