"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor if the smallest of its inner s-mers stands at either edge; that
depends on the k-mer alone, so equal passages have equal anchors wherever they stand. A fingerprint
holds the SIZE anchors with the smallest hashes, each with its place in the text. Two fingerprints
are compared over the smallest hashes of both together: an anchor counts if both have it and its
shift agrees with the commonest shift, give or take SLACK of the longer text.

Defined cases: a null text is an empty one; an empty text has an empty fingerprint, alike (1) to an
empty one only; a text shorter than k, or without an anchor, is one anchor, the whole text; equal
texts have equal fingerprints; of equal hashes the first place counts, of equally common shifts neither is
preferred, as only their number counts; a very long text is worked through in pieces that overlap by K - 1
code points; ids are integers; rows with a null id sort first, rows that share an id in a fixed order of
their own; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import CHUNK_CHARS, fmix, map_arrow, sliding_min, table

K, S = 16, 5
#: Anchors kept of a text, and the shift that counts as the same place, as a share of the length.
SIZE, SLACK = 96, 0.05
SEP = "\x00"
#: Rows of one range of ids, and ranges at most; beyond that ranges grow, and are streamed all the same.
ROWS_PER_RANGE, MAX_RANGES = 5_000, 100_000
#: A null id sorts before all others.
NULL_ID = -(1 << 63)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def inner_hashes(c: np.ndarray) -> np.ndarray:
    """Hashes of all runs of S code points."""
    n = len(c) - S + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(S):
        out = out * np.uint64(0x100000001B3) + c[i : n + i]
    return fmix(out)


def anchors(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the closed syncmers of a run of code points."""
    if len(code) < K:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    c = code.astype(np.uint64)
    inner = inner_hashes(c)
    w = K - S + 1
    low = sliding_min(inner, w)
    at = np.flatnonzero((inner[: len(low)] == low) | (inner[w - 1 :] == low))
    h = np.zeros(len(at), dtype=np.uint64)
    for i in range(K):
        h = h * np.uint64(0x9E3779B97F4A7C15) + c[at + i]
    return at, fmix(h) >> np.uint64(32)


def smallest(place: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The SIZE smallest hashes, each once, at its first place."""
    order = np.lexsort((place, h))
    place, h = place[order], h[order]
    fresh = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, dtype=bool)
    return place[fresh][:SIZE], h[fresh][:SIZE]


def of_long_text(text: str, step: int) -> list[tuple[int, int]]:
    """The same fingerprint, from pieces of a long text."""
    place, h = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    for at in range(0, len(text), step):
        p, x = anchors(code_points(text[at : at + step + K - 1]))
        place, h = smallest(np.concatenate((place, p + at)), np.concatenate((h, x)))
    return list(zip(h.tolist(), place.tolist(), strict=True))


def fingerprints(texts: list[str], step: int = CHUNK_CHARS) -> list[list[tuple[int, int]]]:
    """For each text its (hash, place) pairs by rising hash, each hash once, at its first place."""
    long = {i: of_long_text(t, step) for i, t in enumerate(texts) if len(t) > step}
    if any(long.values()):
        rest = iter(fingerprints([t for i, t in enumerate(texts) if not long.get(i)], max(map(len, texts))))
        return [long.get(i) or next(rest) for i in range(len(texts))]
    joined = SEP.join(texts)
    place, h = anchors(code_points(joined))
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    owner = np.searchsorted(starts, place, side="right") - 1
    inside = place + K <= starts[owner + 1] - 1  # not across two texts
    place, h, owner = place[inside] - starts[owner[inside]], h[inside], owner[inside]
    order = np.lexsort((place, h, owner))
    place, h, owner = place[order], h[order], owner[order]
    fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))) if len(h) else np.zeros(0, dtype=bool)
    place, h, owner = place[fresh], h[fresh], owner[fresh]
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i, t in enumerate(texts):
        a, b = cut[i], min(cut[i + 1], cut[i] + SIZE)
        if a < b:
            out.append(list(zip(h[a:b].tolist(), place[a:b].tolist(), strict=True)))
        elif t:
            out.append([(int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little"), 0)])
        else:
            out.append([])
    return out


def as_string(fp: list[tuple[int, int]], n_chars: int) -> str:
    """'length;hash:place,...' in hexadecimal; empty for an empty text."""
    return f"{n_chars:x};" + ",".join(f"{h:x}:{p:x}" for h, p in fp) if fp else ""


def from_string(s: str) -> tuple[list[tuple[int, int]], int]:
    if not s:
        return [], 0
    n, _, rest = s.partition(";")
    return [(int(h, 16), int(p, 16)) for h, _, p in (x.partition(":") for x in rest.split(","))], int(n, 16)


def likeness(a: list[tuple[int, int]], n_a: int, b: list[tuple[int, int]], n_b: int) -> float:
    """0 to 1: share of the smallest hashes of both that both have at the commonest shift."""
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    in_a, in_b = dict(a), dict(b)
    # a sketch that is not full holds all its text's anchors
    full = [x[-1][0] for x in (a, b) if len(x) >= SIZE]
    limit = min(full) if full else max(a[-1][0], b[-1][0])
    pool = {h for h in (*in_a, *in_b) if h <= limit}
    shifts = [in_a[h] - in_b[h] for h in pool if h in in_a and h in in_b]
    if not shifts:
        return 0.0
    step = max(1.0, SLACK * max(n_a, n_b))
    bins: dict[int, int] = {}
    for s in shifts:
        k = int(s // step)
        bins[k] = bins.get(k, 0) + 1
    best = max(n + bins.get(k + 1, 0) for k, n in bins.items())
    best = max(best, max(n + bins.get(k - 1, 0) for k, n in bins.items()))
    return best / len(pool)


def compare(left: str, right: str) -> float:
    return likeness(*from_string(left), *from_string(right))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every whole text."""

    def each(cols: dict, n: int) -> dict:
        texts = [t or "" for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "n_chars": list(map(len, texts)), "fingerprint": [as_string(f, len(t)) for f, t in zip(fingerprints(texts), texts, strict=True)]}

    kind = dict(docs.dtypes)[id_col]
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), f"doc_id {kind}, n_chars bigint, fingerprint string", each)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first as many code points of the next text."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def range_bounds(docs: DataFrame, id_col: str, rows_per_range: int = ROWS_PER_RANGE) -> np.ndarray:
    """Bounds that cut the ids into about equal ranges: approximate quantiles, at most MAX_RANGES of
    them, so what reaches the driver and the tasks is bounded."""
    ids = docs.select(F.col(id_col).alias("i")).where("i is not null")
    parts = max(1, min(MAX_RANGES, ids.count() // rows_per_range + 1))
    if parts == 1:
        return np.zeros(0, dtype=np.int64)
    return np.unique(np.array(ids.approxQuantile("i", [k / parts for k in range(1, parts)], 0.2 / parts), dtype=np.int64))


def op10_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to it and to the next text.

    One row a document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The next document is that of the next higher id; after the last comes the first. Texts
    are shuffled once, compressed, to ranges of ascending ids; each range also gets the first row of
    the range after it as a guard.
    """
    sc = docs.sparkSession.sparkContext
    bounds = sc.broadcast(range_bounds(docs, id_col, rows_per_range))
    place = lambda ids: [0 if i is None else int(np.searchsorted(bounds.value, i, side="right")) for i in ids]

    def lows(cols: dict, n: int) -> dict:
        low: dict[int, int] = {}
        for i, r in zip(cols["doc_id"], place(cols["doc_id"]), strict=True):
            low[r] = min(low.get(r, NULL_ID if i is None else i), NULL_ID if i is None else i)
        return {"r": list(low), "low": list(low.values())}

    ids = map_arrow(docs.select(F.col(id_col).alias("doc_id")), "r int, low bigint", lows)
    firsts = sorted((r["r"], r["low"]) for r in ids.groupBy("r").agg(F.min("low").alias("low")).collect())  # one row a range
    if not firsts:
        return docs.sparkSession.createDataFrame([], OUT)
    numbers = [r for r, _ in firsts]
    # the first row of every range goes to the range before it too, that of the first to the last
    before = sc.broadcast({low: numbers[i - 1] for i, (_, low) in enumerate(firsts)})
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    packed = map_arrow(rows, "doc_id bigint, r int, guard int, packed binary", lambda cols, n: pack(cols, place(cols["doc_id"]), before.value), 4 * CHUNK_CHARS)
    dealt = packed.repartitionById(len(bounds.value) + 1, "r").sortWithinPartitions("r", "guard", "doc_id", "packed")
    return dealt.mapInArrow(follow, OUT)


OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def pack(cols: dict, ranges: list[int], before: dict[int, int]) -> dict:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    out: dict[str, list] = {"doc_id": [], "r": [], "guard": [], "packed": []}
    for i, r, t in zip(cols["doc_id"], ranges, cols["text"], strict=True):
        blob = squeeze((t or "").encode("utf-8"))
        low = NULL_ID if i is None else i
        for where, guard in [(r, 0), *([(before[low], 1)] if low in before else [])]:
            out["doc_id"].append(i)
            out["r"].append(where)
            out["guard"].append(guard)
            out["packed"].append(blob)
    return out


def follow(batches):
    """Rows of a range in order, guards last: every row but a guard with the row after it."""
    open_ = zstandard.ZstdDecompressor().decompress
    rows, size, current = [], 0, None

    for batch in batches:
        for r, guard, i, blob in zip(*(batch.column(c).to_pylist() for c in ("r", "guard", "doc_id", "packed")), strict=True):
            if current is not None and (r != current or size > CHUNK_CHARS and not guard and i != rows[-1][1]):
                if r == current:
                    rows.append((1, i, open_(blob).decode("utf-8")))
                yield from pairs_of(rows)
                rows, size = [], 0
            current = r
            rows.append((guard, i, open_(blob).decode("utf-8")))
            size += len(rows[-1][2])
    if rows:
        yield from pairs_of(rows)


def pairs_of(rows):
    """rows: (guard, id, text) in order; the first guard ends them."""
    own = [r for r in rows if not r[0]]
    if not own:
        return
    guard = next((r for r in rows if r[0]), own[0])
    texts = [r[2] for r in own] + [guard[2]]
    n = len(own)
    changed = [edited(texts[k], texts[k + 1]) for k in range(n)]
    plain, after = fingerprints(texts), fingerprints(changed)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r[1] for r in own], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed]),
            pa.array([as_string(f, len(t)) for f, t in zip(plain[:n], texts, strict=False)]),
            pa.array([as_string(f, len(t)) for f, t in zip(after, changed, strict=True)]),
            pa.array([likeness(plain[k], len(texts[k]), after[k], len(changed[k])) for k in range(n)], pa.float64()),
            pa.array([likeness(plain[k], len(texts[k]), plain[k + 1], len(texts[k + 1])) for k in range(n)], pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def op10_fingerprint(spark, sf_dir: str) -> DataFrame:
    """The contract query: every whole text of documents and its edited text."""
    return op10_pairs(table(spark, sf_dir, "documents"))
