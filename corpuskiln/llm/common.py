"""What the operators share: the cluster's shared folder, materialised tables and Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.operators.joins import spread_join  # noqa: F401
from corpuskiln.storage import discard, if_small, materialize, shared_dir  # noqa: F401

#: Characters of text that one numpy pass works on; bounds a Python worker's memory.
CHUNK_CHARS = 750_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, schema: str, each: Callable[[dict[str, list], int], dict], chunk: int = CHUNK_CHARS) -> DataFrame:
    """mapInArrow by whole batches: each(columns as Python lists, number of rows) gives the output columns."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, chunk):
                cols = each(part, len(part[batch.schema.names[0]]))
                yield pa.RecordBatch.from_arrays([as_array(cols[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(released(run), schema)


def release() -> None:
    """Give freed memory back to the system: workers stay for later tasks and would hold it while idle."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def released(run: Callable) -> Callable:
    """A function over batches that releases memory when its task ends."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def as_array(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def slices(batch: pa.RecordBatch, chunk: int = CHUNK_CHARS) -> Iterator[dict[str, list]]:
    """A batch in slices whose text columns hold about chunk bytes; a longer row stands alone."""
    n = batch.num_rows
    if not n:
        return
    size = np.zeros(n, dtype=np.int64)
    for col in batch.columns:
        if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) or pa.types.is_binary(col.type):
            import pyarrow.compute as pc

            size += np.asarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = np.cumsum(size)
    start = 0
    while start < n:
        base = at[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(at, base + chunk, side="right")))
        part = batch.slice(start, end - start)
        yield {name: part.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        start = end


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text's bytes in pieces of about size, cut where white space (x20, x09-x0D) is, so that no word is cut."""
    start, n = 0, len(data)
    while n - start > size:
        cut = max(data.rfind(c, start, start + size) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut <= start:  # a word longer than a piece
            found = [i for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (i := data.find(c, start + 1)) > 0]
            cut = min(found, default=n)
        yield data[start:cut]
        start = cut
    yield data[start:]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ in order; the words of one piece at a time are held."""
    parts = [np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, p.split())), dtype=">u8").astype(np.uint64) for p in pieces(data)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def fmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's constants) over an array of uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive elements (uint64); empty where there are fewer than k."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return fmix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum over every run of w elements, by doubling."""
    size, out = 1, x
    while size * 2 <= w:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    return np.minimum(out[: len(out) - (w - size)], out[w - size :]) if w > size else out


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def without_ids(docs: DataFrame, dropped: DataFrame, id_col: str) -> DataFrame:
    """The rows of docs, all its columns, whose id isn't in the one column of dropped."""
    gone = if_small(dropped.toDF("__gone").distinct())
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
