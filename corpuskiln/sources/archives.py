"""Web archives read by ranges of bytes, each from a place where a record begins.

A gzip archive is a row of members, usually one a record; no mark inside compressed bytes says surely where one begins.
So every range guesses: the first place that looks like a member, inflates soundly and holds a record. It goes on from
there to the first member behind its end. The guesses of a file are then linked: a range's true beginning is where the
range before it ended. Where a guess differs from that (an archive stored inside a record), the linking task walks
that range itself, so the index is exact whatever the records hold. What a task holds is one piece and one record.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.storage import materialize

#: Bytes of an archive that are a task's share.
RANGE_BYTES = 64_000_000
#: Tasks of one job at most; beyond it a task has several ranges.
MOST_TASKS = 100_000
#: Bytes that are read at once.
PIECE = 1 << 20
GZIP = b"\x1f\x8b\x08"
INDEX = "file string, block bigint, first bigint, end bigint"


def opened(path: str):
    """A file of the cluster's file system, by its URI, for reading at any place."""
    from pyarrow import fs

    uri = re.sub(r"^s3[an]:", "s3:", path)
    system, name = fs.FileSystem.from_uri(uri if ":/" in uri else "file://" + uri)
    return system.open_input_file(name)


class Reader:
    """Lines and bytes of an archive from a place on.

    ``place`` is where the next part (a gzip member, or a record of a plain archive) may begin, and is sound where
    ``between`` is true.
    """

    def __init__(self, raw, at: int, packed: bool):
        self.raw, self.at, self.packed = raw, at, packed
        self.raw.seek(at)
        self.rest, self.held, self.unpack = b"", bytearray(), None  # packed bytes not used yet, bytes not read yet, the open member

    def fill(self) -> bool:
        """Read on by a piece, which a member's end cuts short; False at the end of the file. Zeros behind a member are padding."""
        if not self.packed:
            piece = self.raw.read(PIECE)
            self.held += piece
            return bool(piece)
        self.rest = self.rest or self.raw.read(PIECE)
        if not self.rest:
            if self.unpack is not None:
                raise ValueError("archive ends inside a member")
            return False
        out, left = b"", self.rest.lstrip(b"\0") if self.unpack is None else self.rest
        if left:
            self.unpack = self.unpack or zlib.decompressobj(31)
            out = self.unpack.decompress(left, PIECE)
            left = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            self.unpack = None if self.unpack.eof else self.unpack
        self.at += len(self.rest) - len(left)
        self.rest = left
        self.held += out
        return True

    def between(self) -> bool:
        """Whether nothing of the part that was opened last is left."""
        while self.packed and self.unpack is not None and not self.held:
            self.fill()
        return self.unpack is None and not self.held

    def line(self) -> bytes:
        looked = 0
        while (found := self.held.find(b"\n", looked)) < 0:
            looked = len(self.held)
            if not self.fill():
                return self.take(len(self.held))
        return self.take(found + 1)

    def take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        if not self.packed:
            self.at += n
        return out

    def body(self, n: int, keep: bool) -> bytes:
        """The next n bytes, fewer at the end of the file; b"" if they aren't kept."""
        if not keep and not self.packed and n > len(self.held):  # a plain archive is passed over without reading
            self.at = min(self.at + n, self.raw.size())
            self.held.clear()
            self.raw.seek(self.at)
            return b""
        out = bytearray()
        while n > 0 and (self.held or self.fill()):
            part = self.take(min(n, len(self.held)))
            n -= len(part)
            if keep:
                out += part
        return bytes(out)


def records_between(reader: Reader, until: int | None, keep: bool = True) -> Iterator[tuple[dict[str, str], bytes]]:
    """(lower-case headers, body) of the records from the reader's place to the first part at or behind ``until``, which is
    the reader's place afterwards. What stands between records is passed over."""
    while True:
        if reader.packed and reader.between() and until is not None and reader.at >= until:
            return
        place, line = reader.at, reader.line()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        if not reader.packed and until is not None and place >= until:
            reader.at = place
            return
        fields: dict[str, str] = {}
        while (line := reader.line()) and line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields.get("content-length") or 0)
        if size < 0:
            raise ValueError("negative length of a record")
        yield fields, reader.body(size, keep)


def is_packed(raw) -> bool:
    raw.seek(0)
    return raw.read(2) == GZIP[:2]


def guesses(raw, low: int, high: int, packed: bool) -> Iterator[int]:
    """Places from low up to high that look like the beginning of a part."""
    mark = GZIP if packed else b"\nWARC/"
    shift = 0 if packed else 1
    at = low - shift
    while at < high - shift:
        raw.seek(at)
        piece = raw.read(PIECE + len(mark) - 1)
        found = piece.find(mark)
        while 0 <= found < PIECE and at + found < high - shift:
            yield at + found + shift
            found = piece.find(mark, found + 1)
        at += PIECE


def walked(raw, first: int, high: int, packed: bool) -> int:
    """Where the first part at or behind high begins, or the file ends, counted from a part that begins at first."""
    reader = Reader(raw, first, packed)
    for _ in records_between(reader, high, keep=False):
        pass
    return reader.at


def guessed(raw, low: int, high: int, packed: bool) -> tuple[int | None, int | None]:
    """(first, end) of the first sound guess of a range. Guesses that aren't sound fail within their first member."""
    for first in [0] if low == 0 else guesses(raw, low, high, packed):
        try:
            reader = Reader(raw, first, packed)
            reader.fill()
            if low and not reader.held.startswith(b"WARC/"):
                continue
            return first, walked(raw, first, high, packed)
        except (ValueError, zlib.error):
            if low == 0:
                return None, None
    return None, None


def spread_ranges(rows: DataFrame) -> DataFrame:
    """Rows of ranges dealt out, a task each as far as a job may have tasks."""
    return rows.repartition(max(1, min(rows.count(), MOST_TASKS)))


def archive_index(spark: SparkSession, path: str, glob: str = "*.gz", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, block, first, end): the bytes of each range of all archives below a path, from a record to a record.

    Files are gzip or plain, told by their first bytes. Empty files have no range; a range in which no record begins has no
    row. A row is 64 MB of archive, and a file's rows are linked in one task. A damaged archive fails the job.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    found = found.where("length > 0").select(F.col("path").alias("file"), F.col("length").alias("size"))
    ranges = materialize(found.select("file", "size", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / range_bytes))).alias("block")), "ranges")

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, block in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "block")), strict=True):
                with opened(file) as raw:
                    low, high = block * range_bytes, min((block + 1) * range_bytes, size)
                    first, end = guessed(raw, low, high, is_packed(raw))
                yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "first": first, "end": end}], schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("end", pa.int64())]))

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows, file, out, want = rows.sort_values("block"), rows["file"].iloc[0], [], 0
        with opened(file) as raw:
            packed, size = is_packed(raw), raw.size()
            for block, first, end in zip(rows["block"], rows["first"], rows["end"], strict=True):
                high = min((block + 1) * range_bytes, size)
                if want >= high:
                    continue
                known = pd.notna(first) and first == want
                out.append((file, block, want, int(end) if known else walked(raw, want, high, packed)))
                want = out[-1][-1]
        return pd.DataFrame(out, columns=["file", "block", "first", "end"])

    first = materialize(spread_ranges(ranges).mapInArrow(guess, INDEX), "guesses")
    return materialize(first.groupBy("file").applyInPandas(link, INDEX), "archive-index")
