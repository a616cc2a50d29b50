"""Sentences as numbers of words in buckets, and counts of all their n-grams by two shuffles of packed numbers.

A join by n-gram sends every place of a text with its words, several times. Here the lines of a task are cut into buckets
of about BUCKET tokens, and a bucket sends each different word and n-gram that it holds once to the part that its hash
names; parts number the words and add up what the buckets sent, and answer in the order they were asked, without n-grams.
Frequent words have small numbers, and n-grams travel in order, as differences, byte by byte and compressed.

Neither a frequent word nor a repeated line meets in one task: a bucket sends an n-gram once however often it holds it,
and parts are dealt by whole n-grams or pairs. No hash stands for a word.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.storage import discard, materialize

#: Tokens of a bucket and n-grams of a part, about; parts are as many as shuffle partitions at least, down to SMALL tokens.
BUCKET, PART, SMALL = 1_200_000, 2_000_000, 100_000
TOKEN_BYTES = 6  # about, with a space
LOW = 0xFFFFFFFF
#: What buckets send to parts and parts to buckets; kind 0 is a bucket itself, kind 1 numbers of words.
ROW = "bucket bigint, kind int, part int, data binary"
LINES, WORDS = 0, 1


class Encoded(NamedTuple):
    rows: DataFrame
    """A row a bucket: (bucket, doc_id array, line array, words, data): packed words in the order of their numbers, if asked
    for, and packed (sizes of lines, tokens as places in words, numbers, how often each word begins a pair)."""
    parts: int
    types: int
    """How many words end a pair."""
    doc_type: str
    line_type: str


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers that aren't negative, byte planes apart."""
    head, planes = [len(arrays)], []
    for x in arrays:
        x = np.ascontiguousarray(x, dtype="<u8")
        width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
        head += [len(x), width]
        planes += [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, k]).tobytes() for k in range(width)]
    raw = b"".join([np.array(head, dtype="<i8").tobytes(), *planes])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8), 8 + 16 * n, []
    for size, width in head.reshape(-1, 2).tolist():
        x = np.zeros((size, 8), dtype=np.uint8)
        for k in range(width):
            x[:, k] = np.frombuffer(raw, np.uint8, size, at)
            at += size
        out.append(x.reshape(-1).view("<i8"))
    return out


def pair_deltas(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending keys a << 32 | b: the steps of a, and those of b where a stays, else b."""
    a, b = keys >> 32, keys & LOW
    da = np.diff(a, prepend=0)
    return da, np.where(da == 0, np.diff(b, prepend=0), b)


def pair_keys(da: np.ndarray, db: np.ndarray) -> np.ndarray:
    return (np.cumsum(da) << 32) | restarted(db, da > 0)


def restarted(steps: np.ndarray, anew: np.ndarray) -> np.ndarray:
    """Running sums of steps that begin again where ``anew`` holds."""
    if not len(steps):
        return steps
    sums, first = np.cumsum(steps), anew.copy()
    first[0] = True
    at = np.flatnonzero(first)
    return sums - np.repeat(sums[at] - steps[at], np.diff(at, append=len(steps)))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by part, where each part begins and the last ends)."""
    order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at starts, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def unique_sum(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys, which of them each is, sum of n of each); sums below 2^53 are exact."""
    u, inv = np.unique(keys, return_inverse=True)
    return u, inv, np.bincount(inv, n, len(u)).astype(np.int64)


def split_words(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """(tokens of all rows, their number in each) of tokens joined by a space."""
    lists = pc.split_pattern(column.combine_chunks(), " ")
    return lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def not_last(sizes: np.ndarray, n: int = 1) -> np.ndarray:
    """Places with n more tokens of their line behind them; each line has two tokens at least."""
    ends, keep = np.cumsum(sizes), np.ones(int(sizes.sum()), dtype=bool)
    for k in range(1, n + 1):
        keep[ends - k] = False
    return np.flatnonzero(keep)


def pairs_of(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    at = not_last(sizes)
    return (x[at] << 32) | x[at + 1]


def numbered(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Pairs of places in a bucket's words as pairs of the words' numbers, which are in the same order."""
    return (ids[keys >> 32] << 32) | ids[keys & LOW]


def pack_words(words: pa.StringArray) -> bytes:
    sizes, text = word_bytes(words)
    head = pack(sizes)
    return len(head).to_bytes(8, "little") + head + len(text).to_bytes(8, "little") + pa.compress(text.tobytes(), codec="zstd", asbytes=True)


def unpack_words(data: bytes) -> pa.StringArray:
    cut = 8 + int.from_bytes(data[:8], "little")
    sizes, n = unpack(data[8:cut])[0], int.from_bytes(data[cut : cut + 8], "little")
    text = pa.decompress(data[cut + 8 :], decompressed_size=n, codec="zstd")
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), text)


def word_bytes(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each word, all bytes one after the other)."""
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, dtype=np.int64)
    text = words.buffers()[2]
    return np.diff(at), np.frombuffer(text, np.uint8)[at[0] : at[-1]] if text is not None else np.zeros(0, dtype=np.uint8)


def word_parts(words: pa.StringArray, parts: int) -> np.ndarray:
    """The part of each word, by a sum of its bytes times powers."""
    sizes, text = word_bytes(words)
    ends = np.cumsum(sizes)
    place = np.arange(len(text)) - np.repeat(ends - sizes, sizes)
    powers = np.cumprod(np.full(int(sizes.max(initial=0)) + 1, 0x100000001B3, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[place])])
    return part_of(sums[ends] - sums[ends - sizes], parts)


def out_rows(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """(bucket, kind, part, data) rows."""
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.table({"bucket": pa.array(cols[0], pa.int64()), "kind": pa.array(cols[1], pa.int32()), "part": pa.array(cols[2], pa.int32()), "data": pa.array(cols[3], pa.binary())})


def sliced(cut: np.ndarray):
    """(part, begin, end) of parts that have rows."""
    return ((p, i, j) for p, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if i < j)


def lengths(arrays: list) -> list[int]:
    return np.cumsum([0, *map(len, arrays)]).tolist()


def encoded(lines: DataFrame, texts: bool = False) -> Encoded:
    """(doc_id, line, s), where s has two or more tokens joined by spaces, in buckets of numbered words; with their texts if asked.

    Numbers go by the count of words, about: by their places among the words of their part.
    """
    spark, kinds, full = lines.sparkSession, dict(lines.dtypes), BUCKET * TOKEN_BYTES

    def bucket(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches)
        flat, sizes = split_words(rows["s"])
        d = flat.dictionary_encode()
        order = pc.sort_indices(d.dictionary).to_numpy()
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order), dtype=order.dtype)
        data = pack(sizes, rank[d.indices.to_numpy(zero_copy_only=False)])
        one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        cols = {"doc_id": one(rows["doc_id"].combine_chunks()), "line": one(rows["line"].combine_chunks()), "words": pa.array([pack_words(d.dictionary.take(pa.array(order)))], pa.binary())}
        return pa.RecordBatch.from_pydict(cols | {"data": pa.array([data], pa.binary()), "n": pa.array([len(flat)], pa.int64())})

    def gather(batches):
        held, size = [], 0
        for batch in batches:
            for k in range(0, len(batch), 1000):
                held.append(batch.slice(k, 1000))
                size += pc.sum(pc.binary_length(held[-1]["s"])).as_py() or 0
                if size >= full:
                    yield bucket(held)
                    held, size = [], 0
        if size:
            yield bucket(held)

    schema = f"doc_id array<{kinds['doc_id']}>, line array<{kinds['line']}>, words binary, data binary, n bigint"
    rows = lines.select("doc_id", "line", "s").mapInArrow(gather, schema)
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("bucket"), "*"), "sentences")
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = max(1, total // PART, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // SMALL))

    def send(batches):
        for batch in batches:
            for bucket, words, data in zip(batch["bucket"].to_pylist(), batch["words"], batch["data"], strict=True):
                words, (sizes, x) = unpack_words(words.as_py()), unpack(data.as_py())
                ends = np.cumsum(sizes)
                n, last, first = (np.bincount(at, minlength=len(words)) for at in (x, x[ends - 1], x[ends - sizes]))
                order, cut = by_part(word_parts(words, parts), parts)
                words, n_a, n_b = words.take(pa.array(order)), (n - last)[order], (n - first)[order]
                yield from out_rows([(bucket, WORDS, p, pack_words(words.slice(i, j - i)) + (sent := pack(n_a[i:j], n_b[i:j])) + len(sent).to_bytes(8, "little")) for p, i, j in sliced(cut)]).to_batches()

    def number(rows: pa.Table) -> pa.Table:
        part, asks = rows["part"][0].as_py(), []
        for d in rows["data"]:
            d = d.as_py()
            at = len(d) - 8 - int.from_bytes(d[-8:], "little")
            asks.append((unpack_words(d[:at]), *unpack(d[at:-8])))
        names = pa.concat_arrays([a[0] for a in asks]).dictionary_encode()
        inv, cut = names.indices.to_numpy(zero_copy_only=False), lengths([a[0] for a in asks])
        n_a, n_b = (np.bincount(inv, joined(asks, k)).astype(np.int64) for k in (1, 2))
        ids = np.empty(len(n_a), dtype=np.int64)
        ids[np.argsort(-(n_a + n_b), kind="stable")] = np.arange(len(n_a)) * parts + part
        of = [(b, WORDS, part, pack(ids[inv[i:j]], n_a[inv[i:j]])) for b, i, j in zip(rows["bucket"].to_pylist(), cut[:-1], cut[1:], strict=True)]
        return out_rows([*of, (-1, WORDS, part, pack(np.array([np.count_nonzero(n_b)])))])

    numbers = materialize(rows.select("bucket", "words", "data").mapInArrow(send, ROW).groupBy("part").applyInArrow(number, ROW), "word-numbers")
    types = sum(int(x[0]) for x in part_values(numbers, WORDS))

    def encode(number, doc_ids, lines, words, data, found) -> pa.Table:
        words, (sizes, x) = unpack_words(words), unpack(data)
        order, _ = by_part(word_parts(words, parts), parts)
        ids, n_a = np.empty((2, len(words)), dtype=np.int64)
        ids[order], n_a[order] = joined(found[WORDS], 0), joined(found[WORDS], 1)
        order = np.argsort(ids)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        kept = pack_words(words.take(pa.array(order))) if texts else None
        cols = {"bucket": pa.array([number], pa.int64()), "doc_id": one(doc_ids), "line": one(lines), "words": pa.array([kept], pa.binary())}
        return pa.table(cols | {"data": pa.array([pack(sizes, rank[x], np.diff(ids[order], prepend=0), n_a[order])], pa.binary())})

    schema = f"bucket bigint, doc_id array<{kinds['doc_id']}>, line array<{kinds['line']}>, words binary, data binary"
    out = materialize(met(rows.drop("n"), [numbers], encode, schema), "encoded")
    discard(rows)
    discard(numbers)
    return Encoded(out, parts, types, kinds["doc_id"], kinds["line"])


def part_values(answers: DataFrame, kind: int) -> list[np.ndarray]:
    """The few numbers that every part tells the driver, an array a part."""
    return [unpack(r["data"])[0] for r in answers.where((F.col("bucket") < 0) & (F.col("kind") == kind)).select("data").collect()]


class Bucket(NamedTuple):
    """Lines with their words in the order of their numbers."""

    sizes: np.ndarray
    x: np.ndarray
    """Tokens as places in words."""
    ids: np.ndarray
    n_a: np.ndarray
    words: pa.StringArray | None


def read_bucket(words: bytes | None, data: bytes) -> Bucket:
    sizes, x, steps, n_a = unpack(data)
    return Bucket(sizes, x, np.cumsum(steps), n_a, unpack_words(words) if words is not None else None)


def met(rows: DataFrame, answers: list[DataFrame], each: Callable, schema: str) -> DataFrame:
    """each(bucket's number, doc_ids, lines, words, data, {kind: answers of its parts in order}) of every bucket."""
    both = rows.select("bucket", F.lit(LINES).alias("kind"), F.lit(0).alias("part"), "data", "doc_id", "line", "words")
    for df in answers:
        both = both.unionByName(df.where("bucket >= 0").select("bucket", "kind", "part", "data"), allowMissingColumns=True)

    def run(rows: pa.Table) -> pa.Table:
        kinds, of = rows["kind"].to_numpy(), rows["part"].to_numpy()
        own = int(np.flatnonzero(kinds == LINES)[0])
        found = {k: [unpack(rows["data"][int(i)].as_py()) for i in np.flatnonzero(kinds == k)[np.argsort(of[kinds == k])]] for k in set(kinds.tolist()) - {LINES}}
        return each(rows["bucket"][own].as_py(), rows["doc_id"][own].values, rows["line"][own].values, rows["words"][own].as_py(), rows["data"][own].as_py(), found)

    return both.groupBy("bucket").applyInArrow(run, schema)


def asked(enc: Encoded, ask: Callable) -> DataFrame:
    """ROW of what ask(bucket's number, Bucket) gives, of all buckets."""

    def run(batches):
        for batch in batches:
            for bucket, data in zip(batch["bucket"].to_pylist(), batch["data"], strict=True):
                yield from ask(bucket, read_bucket(None, data.as_py())).to_batches()

    return enc.rows.select("bucket", "data").mapInArrow(run, ROW)


def answered(enc: Encoded, answers: list[DataFrame], finish: Callable, schema: str) -> DataFrame:
    """finish(doc_ids, lines, Bucket, {kind: answers of its parts in order}) of every bucket."""
    return met(enc.rows, answers, lambda number, doc_ids, lines, words, data, found: finish(doc_ids, lines, read_bucket(words, data), found), schema)


def joined(found: list[list[np.ndarray]], k: int) -> np.ndarray:
    """The k-th array of all parts' answers, one after the other."""
    return np.concatenate([x[k] for x in found]) if found else np.zeros(0, dtype=np.int64)


def line_rows(doc_ids: pa.Array, lines: pa.Array, n: np.ndarray, log10p: np.ndarray) -> pa.Table:
    return pa.table({"doc_id": doc_ids, "line": lines, "n": pa.array(n, pa.int64()), "log10p": pa.array(log10p, pa.float64())})


def line_schema(enc: Encoded) -> str:
    return f"doc_id {enc.doc_type}, line {enc.line_type}, n bigint, log10p double"


def pair_scores(lines: DataFrame) -> DataFrame:
    """(doc_id, line, n, log10p) of encoded()'s lines: add-one log-probability by their own pairs, and the number of transitions.

    One row a line, also where an id repeats.
    """
    enc = encoded(lines)
    parts, v = enc.parts, enc.types

    def send(number, b: Bucket):
        keys, n = np.unique(pairs_of(b.x, b.sizes), return_counts=True)
        keys = numbered(keys, b.ids)
        order, cut = by_part(part_of(keys, parts), parts)
        keys, n = keys[order], n[order]
        return out_rows([(number, 2, p, pack(*pair_deltas(keys[i:j]), n[i:j])) for p, i, j in sliced(cut)])

    def add(rows: pa.Table) -> pa.Table:
        part, asks = rows["part"][0].as_py(), [unpack(d.as_py()) for d in rows["data"]]
        _, inv, n = unique_sum(np.concatenate([pair_keys(da, db) for da, db, _ in asks]), joined(asks, 2))
        cut = lengths([a[0] for a in asks])
        return out_rows([(b, 2, part, pack(n[inv[i:j]])) for b, i, j in zip(rows["bucket"].to_pylist(), cut[:-1], cut[1:], strict=True)])

    def score(doc_ids, lines, b: Bucket, found):
        keys, inv = np.unique(pairs_of(b.x, b.sizes), return_inverse=True)
        order, _ = by_part(part_of(numbered(keys, b.ids), parts), parts)
        n = np.empty(len(keys), dtype=np.int64)
        n[order] = joined(found[2], 0)
        p = np.log10((n + 1) / (b.n_a[keys >> 32] + v))[inv]
        return line_rows(doc_ids, lines, b.sizes - 1, np.add.reduceat(p, np.cumsum(b.sizes - 1) - (b.sizes - 1)))

    counts = materialize(asked(enc, send).groupBy("part").applyInArrow(add, ROW), "pair-counts")
    return answered(enc, [counts], score, line_schema(enc))
