"""Importance resampling towards a target collection, by hashed features with a head-tail vocabulary.

ASCII letters are lower-cased; words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+. Features are all runs of 1 to ``longest``
words joined by one space, repeats counted, and a feature's bucket is the CRC-32 of its bytes modulo BUCKETS. A bucket's
gain is the logarithm of how much commoner it is in the target than in the documents, a document's weight the sum of its
features' gains, and its score the weight plus Gumbel noise of its id, so that the highest scores are a sample without
replacement in proportion to the exponential of the weights.

Words are a short head and a long tail. The head, the HEAD_WORDS commonest words and pairs of words of the
documents, is found in one pass in which each task keeps a bounded summary, and is sent to all tasks: for a word its
CRC-32 as a state, from which the CRC of a run that begins with it goes on, for a pair its bucket. What isn't
in the head gets its CRC directly. Both ways give the same bucket, so bucket totals are exact whatever the head is;
tasks hand on one row a bucket at most.

Ranks are given by ranges of the score, so no task holds all documents.

Defined cases: null and empty texts have no features, weight 0; a null id has no noise, no score and is never
drawn, nor counted among the documents to draw from; rows that repeat an id have the same noise, each its own weight, and of
equal scores and ids the one with fewer features comes first; without target texts, or without documents, the totals are 0
and the formula holds as it is; further columns are ignored. A very long text is gone through in pieces.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import pieces, released, slices, table
from corpuskiln.operators.joins import running_sum

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
#: Words, and pairs of words, in the head, and the bytes of such a word at most: together they bound what is broadcast.
HEAD_WORDS, HEAD_BYTES = 20_000, 64
#: Bytes of words as they are, A-Z lower-cased, all others a space.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def pieces_of_words(text: str | None) -> Iterator[list[bytes]]:
    for piece in pieces((text or "").encode("utf-8").translate(FOLDED)):
        yield piece.split()


def runs(text: str | None, longest: int) -> Iterator[tuple[list[bytes], list[tuple[bytes, ...]]]]:
    """By piece: the words, and the runs of 2 to longest words that end in it."""
    held: list[bytes] = []
    for words in pieces_of_words(text):
        line = held + words
        yield words, [tuple(line[i : i + n]) for n in range(2, longest + 1) for i in range(max(0, len(held) - n + 1), len(line) - n + 1)]
        held = line[max(0, len(line) - longest + 1) :] if longest > 1 else []


class Buckets:
    """The bucket of a feature: by the head where it is there, else by its CRC."""

    def __init__(self, states: dict[bytes, int], pairs: dict[tuple[bytes, bytes], int], buckets: int):
        self.states, self.pairs, self.buckets = states, pairs, buckets

    def of_word(self, w: bytes) -> int:
        return (self.states[w] if w in self.states else crc32(w)) % self.buckets

    def of_run(self, run: tuple[bytes, ...]) -> int:
        if run in self.pairs:
            return self.pairs[run]
        state = self.states.get(run[0])
        return crc32(b" " + b" ".join(run[1:]), crc32(run[0]) if state is None else state) % self.buckets

    def counts(self, text: str | None, longest: int) -> Iterator[tuple[int, int]]:
        """(bucket, times) of a text's features, distinct ones of a piece once."""
        for words, more in runs(text, longest):
            yield from ((self.of_word(w), n) for w, n in Counter(words).items())
            yield from ((self.of_run(r), n) for r, n in Counter(more).items())


def head(texts: DataFrame, longest: int, size: int = HEAD_WORDS) -> tuple[list[bytes], list[tuple[bytes, bytes]]]:
    """The commonest words and pairs of (text), about: each task keeps up to 8 * size of each, and drops the rarer half
    beyond that. Which they are changes no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for cols in slices(batch):
                for text in cols["text"]:
                    for words, more in runs(text, min(longest, 2)):
                        found[0].update(words)
                        found[1].update(more)
                for c in found:
                    if len(c) > 8 * size:
                        _halve(c, 4 * size)
        for c in found:
            common = [(w, n) for w, n in c.most_common(2 * size) if len(w if isinstance(w, bytes) else b" ".join(w)) <= HEAD_BYTES]
            words = [w if isinstance(w, bytes) else b" ".join(w) for w, _ in common]
            yield pa.RecordBatch.from_pydict({"feature": pa.array(words, pa.binary()), "n": pa.array([n for _, n in common], pa.int64())})

    counts = texts.mapInArrow(released(run), "feature binary, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    pair = F.instr(F.col("feature").cast("string"), " ") > 0
    words, pairs = ([bytes(r["feature"]) for r in counts.where(w).orderBy(F.desc("n"), "feature").limit(size).collect()] for w in (~pair, pair))
    return words, [tuple(p.split(b" ")) for p in pairs]


def _halve(counts: Counter, keep: int) -> None:
    """Drop all but the commonest, at most ``keep``."""
    least = sorted(counts.values(), reverse=True)[keep]
    for w in [w for w, n in counts.items() if n <= least]:
        del counts[w]


def totals(texts: DataFrame, known: Buckets, longest: int) -> np.ndarray:
    """Features of all rows of (text) by bucket, exact: one row a bucket and task is shuffled."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [0] * shared.value.buckets
        for batch in batches:
            for cols in slices(batch):
                for text in cols["text"]:
                    for b, n in shared.value.counts(text, longest):
                        out[b] += n
        n = np.array(out, dtype=np.int64)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used.astype(np.int32)), "n": pa.array(n[used])})

    rows = texts.mapInArrow(released(run), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS rows
    out = np.zeros(known.buckets, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B)))) of every bucket, in doubles."""
    b, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    return [math.floor(1000.0 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)]


def weighed(rows: DataFrame, known: Buckets, gain: list[int], longest: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of rows (doc_id, text)."""
    shared = rows.sparkSession.sparkContext.broadcast((known, gain))
    kind = dict(rows.dtypes)["doc_id"]

    class Gains(dict):
        def __missing__(self, w: bytes) -> int:
            return shared.value[1][crc32(w) % len(shared.value[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = shared.value
        word = Gains({w: gain[s % known.buckets] for w, s in known.states.items()})
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for cols in slices(batch):
                for text in cols["text"]:
                    n = m = total = 0
                    for words, more in runs(text, longest):
                        n, m = n + len(words), m + len(more)
                        total += sum(map(word.__getitem__, words)) + sum(gain[known.of_run(r)] for r in more)
                    n_words.append(n)
                    n_features.append(n + m)
                    weight.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(released(run), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def noise(id_col: str, seed: int) -> Column:
    """floor(-1000 * ln(-ln((h + 0.5) / 2^32))), h being the first 8 hexadecimal digits of SHA-256 of ``seed:id``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", longest: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, head_words: int = HEAD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; rank is null where it isn't drawn."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words, pairs = head(rows.select("text"), longest, head_words)
    states = {w: crc32(w) for w in words}
    known = Buckets(states, {p: crc32(b" ".join(p)) % buckets for p in pairs}, buckets)
    gain = gains(totals(rows.select("text"), known, longest), totals(target.select(F.col(target_text).alias("text")), known, longest))
    scored = weighed(rows, known, gain, longest).withColumn("score", F.col("weight") + noise("doc_id", seed))
    may = F.coalesce((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull(), F.lit(False))
    order = [F.desc("may"), F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranked = running_sum(scored.withColumn("may", may).withColumn("one", F.lit(1)), order, "one", "before")
    n = ranked.where("may").count() * percent // 100
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", F.when(F.col("may") & (F.col("before") < n), F.col("before") + 1).cast("bigint").alias("rank"))


def op13_resampling(spark, sf_dir: str) -> DataFrame:
    """The contract query: all documents, towards the benchmark."""
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
with docs as (select row_number() over () as row, doc_id, coalesce({_WORDS}, []) as w from documents),
used as (
    select row, false as target, unnest(w) as word from docs
    union all select 0, true, unnest({_WORDS}) from benchmark
),
step as (select list(x order by i) as steps from (
    select i, list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as x from range(0, 256) t(i)
)),
bucket as (
    select word, xor(list_reduce(
        list_transform(range(1, strlen(word) + 1), lambda i: ('0x' || substr(hex(encode(word)), 2 * i - 1, 2))::bigint),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295) % {BUCKETS} as bucket
    from (select distinct word from used), step
),
counts as (select bucket, count(*) filter (where not target) as s, count(*) filter (where target) as t from used join bucket using (word) group by bucket),
gain as (
    select bucket, floor(1000 * ln(((t + 1)::double * ((sum(s) over ())::double + {BUCKETS})) / ((s + 1)::double * ((sum(t) over ())::double + {BUCKETS}))))::bigint as gain
    from counts
),
weights as (select row, sum(gain)::bigint as weight from used join bucket using (word) join gain using (bucket) where not target group by row),
scored as (
    select row, doc_id, len(w)::bigint as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint as score
    from docs left join weights using (row)
),
ranked as (select row, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scored where n_features >= {LEAST_WORDS} and doc_id is not null)
select doc_id, n_features, weight, score, case when r <= n * {PERCENT} // 100 then r end as rank from scored left join ranked using (row)
"""
