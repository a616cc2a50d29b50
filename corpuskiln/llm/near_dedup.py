"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A text's set holds the hashes of its distinct five-word shingles. Its signature has K minhashes cut
to 16 bits. Sets of similarity 0.75 differ in a quarter of the symbols on average; RADIUS leaves 4.5
standard deviations above. By pigeonhole two signatures within RADIUS have at most one wrong symbol
in at least one of CHUNKS chunks, so each chunk gives one key for every symbol left out, and all
pairs within the radius share a key. Links are confirmed on the full sets.

Equal sets are one class. First every class is compared with one other only, the bucket leader that
it shares most keys with; what that links is merged, and only then members of a bucket that are
still of different classes are compared with one another, in blocks of BLOCK rows. So copies are never
expanded into pairs, and no bucket meets in one task: joins by key cut keys with many rows into parts.

Defined cases: null texts and texts without words have an empty set (n_shingles 0) and link with
nothing; texts of one to four words have one shingle, the sequence; a null id links with nothing and
has a null component; rows that share id and text are equal; ids are otherwise taken as unique (of
texts under one id one stands for all); a very long text is split into words piece by piece and then takes
8 bytes a word; equal similarities need no order, as every link counts; an empty table gives an empty
result; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import as_signed, discard, fmix, if_small, map_arrow, materialize, released, rolling, spread_join, table, without_ids, word_hashes
from corpuskiln.llm.components import connected_components

WORDS = 5
#: Similarity in hundredths from which two sets are linked.
PERCENT = 75
K, CHUNKS, RADIUS = 64, 16, 31
BLOCK = 8192
#: Smallest hashes of a set kept to judge a pair before its full sets are fetched, and the standard
#: deviations that their estimate may lie below the similarity.
SKETCH, DEVIATIONS = 192, 4.75

_rng = np.random.default_rng(20240501)
_A = _rng.integers(1, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.integers(1, 1 << 63, (CHUNKS, K // CHUNKS), dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; bytes.split cuts at exactly x20 and x09-x0D."""
    h = word_hashes((text or "").encode("utf-8").lower())
    if not len(h):
        return np.zeros(0, dtype=np.uint64)
    if len(h) < WORDS:
        return fmix(rolling(h, len(h)) + np.uint64(len(h)))
    return np.unique(rolling(h, WORDS))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """[set, K] minhashes of non-empty sets, cut to 16 bits."""
    joined = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), K), dtype=np.uint16)
    for i in range(K):
        h = joined * _A[i]
        h ^= h >> np.uint64(32)
        h *= _B[i]
        out[:, i] = (np.minimum.reduceat(h, starts) >> np.uint64(8)) & np.uint64(0xFFFF)
    return out


def sketch(s: np.ndarray) -> bytes:
    """The SKETCH smallest 32-bit hashes of a set, in order; all of a small set."""
    return np.unique((fmix(s) >> np.uint64(32)).astype(np.uint32))[:SKETCH].tobytes()


def likely(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Whether pairs of sketches can be of linked sets. Sketches that hold whole sets are exact."""
    n = len(left)
    if not n:
        return np.zeros(0, dtype=bool)
    both = np.empty((n, 2 * SKETCH), dtype=np.uint64)
    limit = np.full(n, 1 << 32, dtype=np.uint64)
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        both[i, : len(x)], both[i, len(x) : len(x) + len(y)] = x, y
        both[i, len(x) + len(y) :] = np.arange(1 << 33, (1 << 33) + 2 * SKETCH - len(x) - len(y))
        full = [s[-1] for s in (x, y) if len(s) >= SKETCH]
        if full:
            limit[i] = min(full)
    both.sort(axis=1)
    inside = both <= limit[:, None]
    twice = ((both[:, 1:] == both[:, :-1]) & inside[:, 1:]).sum(axis=1)
    k = np.maximum(inside.sum(axis=1) - twice, 1)
    p = PERCENT / 100
    slack = np.where(limit < 1 << 32, DEVIATIONS * np.sqrt(p * (1 - p) / k), 0) + 0.01
    return twice >= (p - slack) * k


def keys(sig: np.ndarray) -> np.ndarray:
    """[set, K] keys: of each chunk all variants with one symbol left out."""
    part = sig.reshape(len(sig), CHUNKS, K // CHUNKS).astype(np.uint64)
    term = fmix(part + _SALT)
    return fmix(term.sum(axis=2, dtype=np.uint64)[:, :, None] - term + _SALT).reshape(len(sig), K)


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, digest, sig, low): digest, sig and low, the sketch, are null for empty sets."""

    def each(cols: dict, n: int) -> dict:
        sets = [shingles(t) for t in cols["text"]]
        full = [i for i, s in enumerate(sets) if len(s) and cols["doc_id"][i] is not None]
        digest, sig, low = [None] * n, [None] * n, [None] * n
        if full:
            made = signatures([sets[i] for i in full])
            for row, i in enumerate(full):
                digest[i], sig[i], low[i] = blake2b(sets[i].tobytes(), digest_size=16).digest(), made[row].tobytes(), sketch(sets[i])
        return {"doc_id": cols["doc_id"], "n_shingles": [len(s) for s in sets], "digest": digest, "sig": sig, "low": low}

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, f"doc_id {kind}, n_shingles bigint, digest binary, sig binary, low binary", each)


def keyed(reps: DataFrame) -> DataFrame:
    """(key, rep): K rows of every class."""

    def each(cols: dict, n: int) -> dict:
        k = keys(np.frombuffer(b"".join(cols["sig"]), dtype=np.uint16).reshape(n, K))
        return {"key": pa.array(as_signed(k.reshape(-1))), "rep": pa.array(cols["rep"], kinds[kind]).take(np.repeat(np.arange(n), K))}

    from pyspark.sql.pandas.types import to_arrow_type

    kind = dict(reps.dtypes)["rep"]
    kinds = {kind: to_arrow_type(reps.schema["rep"].dataType)}
    return map_arrow(reps.select("rep", "sig"), f"key bigint, rep {kind}", each, 1 << 18)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=-1)


def both_sides(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pairs (a, b) joined with a table by a and one by b; one end may be that of very many pairs."""
    ends = [materialize(pairs.groupBy(c).agg(F.count("*").alias("n")).where("n > 1"), "ends") for c in ("a", "b")]
    return spread_join(spread_join(pairs, left, "a", ends[0], "b"), right, "b", ends[1], "a")


def near(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sizes and signatures allow a link."""
    left = reps.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    right = reps.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))
    both = both_sides(pairs, left, right).where("4 * least(na, nb) >= 3 * greatest(na, nb)")

    def each(cols: dict, n: int) -> dict:
        d = distance(*(np.frombuffer(b"".join(cols[c]), dtype=np.uint16).reshape(n, K) for c in ("sa", "sb")))
        hit = np.flatnonzero(d <= RADIUS)
        return {c: [cols[c][i] for i in hit] for c in ("a", "b")}

    kind = dict(pairs.dtypes)["a"]
    return map_arrow(both.select("a", "b", "sa", "sb"), f"a {kind}, b {kind}", each)


def confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) linked on the full sets of their texts."""
    kind = dict(pairs.dtypes)["a"]
    ids = if_small(materialize(pairs.select(F.col("a").alias("i")).union(pairs.select(F.col("b").alias("i"))).distinct(), "ids"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.join(ids, rows["doc_id"] == ids["i"], "left_semi")
    sets = map_arrow(rows, f"doc_id {kind}, s binary", lambda cols, n: {"doc_id": cols["doc_id"], "s": [shingles(t).tobytes() for t in cols["text"]]})
    sets = materialize(sets.dropDuplicates(["doc_id"]), "sets")
    both = both_sides(pairs, sets.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("s").alias("y")))

    def each(cols: dict, n: int) -> dict:
        hit = []
        for i, (x, y) in enumerate(zip(cols["x"], cols["y"], strict=True)):
            p, q = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            common = len(np.intersect1d(p, q, assume_unique=True))
            if common and 100 * common >= PERCENT * (len(p) + len(q) - common):
                hit.append(i)
        return {c: [cols[c][i] for i in hit] for c in ("a", "b")}

    return map_arrow(both.select("a", "b", "x", "y"), f"a {kind}, b {kind}", each)


def across(rows: DataFrame, reps: DataFrame, sketched: bool = True) -> DataFrame:
    """Pairs (a, b) of different classes that share a key and lie within the radius; if sketched, less those that
    their sketches rule out.

    rows: (key, rep, c), c the class found so far; reps: (rep, n_shingles, sig, low). Buckets are cut into blocks by a
    hash of rep; each pair of blocks is one group, compared as arrays and streamed in key order.
    """
    kind = dict(rows.dtypes)["rep"]
    size = materialize(rows.groupBy("key").agg(F.count("*").alias("n"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "sizes")
    cut = spread_join(rows, size.select("key", "blocks"), "key", size.select("key", "n"), "rep").withColumn("own", F.expr("cast(pmod(xxhash64(rep), blocks) as int)"))
    cut = cut.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cut = cut.join(reps, "rep").select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "c", "n_shingles", "sig", "low")
    dealt = cut.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            group = list(zip(*(t.column(c).to_pylist() for c in ("key", "i", "j")), strict=True))
            last = len(group)
            while last and group[last - 1] == group[-1]:
                last -= 1
            held = t.slice(last)
            if last:
                yield from compared(t.slice(0, last), group[:last])
        if held is not None and held.num_rows:
            yield from compared(held, list(zip(*(held.column(c).to_pylist() for c in ("key", "i", "j")), strict=True)))

    def compared(t: pa.Table, group: list) -> Iterator[pa.RecordBatch]:
        t = t.combine_chunks()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), dtype=np.uint16).reshape(-1, K)
        low = [np.frombuffer(x, dtype=np.uint32) for x in t.column("low").to_pylist()]
        n, own = t.column("n_shingles").to_numpy(), t.column("own").to_numpy()
        rep = t.column("rep").combine_chunks()
        c = t.column("c").combine_chunks().dictionary_encode().indices.to_numpy()
        found_a, found_b, own_keys = [], [], keys(sig)
        edges = [0, *(k for k in range(1, len(group)) if group[k] != group[k - 1]), len(group)]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            _, i, j = group[lo]
            rows = np.arange(lo, hi)
            left, right = (rows, rows) if i == j else (rows[own[lo:hi] == i], rows[own[lo:hi] == j])
            step = max(1, 131_072 // max(1, len(right)))
            for at in range(0, len(left), step):
                a = left[at : at + step]
                ok = (c[a][:, None] != c[right][None, :]) & (4 * np.minimum(n[a][:, None], n[right]) >= 3 * np.maximum(n[a][:, None], n[right]))
                if i == j:
                    ok &= a[:, None] < right[None, :]
                p, q = np.nonzero(ok)
                p, q = a[p], right[q]
                hit = distance(sig[p], sig[q]) <= RADIUS
                p, q = p[hit], q[hit]
                # a pair comes from the first of the keys that it shares
                first = (own_keys[p] == own_keys[q]).argmax(axis=1)
                once = own_keys[p, first].view(np.int64) == group[lo][0]
                p, q = p[once], q[once]
                for cut in range(0, len(p), 4096):
                    x, y = p[cut : cut + 4096], q[cut : cut + 4096]
                    ok = likely([low[k] for k in x], [low[k] for k in y]) if sketched else np.ones(len(x), dtype=bool)
                    found_a.append(x[ok])
                    found_b.append(y[ok])
        if found_a:
            yield pa.RecordBatch.from_arrays([rep.take(pa.array(np.concatenate(x))) for x in (found_a, found_b)], names=["a", "b"])

    return dealt.mapInArrow(released(run), f"a {kind}, b {kind}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sketched: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): component_id is the smallest id reachable by links.

    sketched: leave out pairs whose sketches, DEVIATIONS below the estimate, rule a link out; without it every
    pair within the radius is confirmed on its full sets.
    """
    rows = materialize(signed(docs, id_col, text_col), "signatures")
    classes = rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    classes = materialize(classes.where("rep < last").select("digest", "rep", "n"), "equal")
    members = spread_join(rows.select("doc_id", "n_shingles", "digest"), classes.select("digest", "rep"), "digest", classes.select("digest", "n"), "doc_id", "left")
    members = materialize(members.select("doc_id", "n_shingles", F.coalesce("rep", F.when(F.col("digest").isNotNull(), F.col("doc_id"))).alias("rep")), "members")
    firsts = materialize(members.where("doc_id = rep").select("rep").distinct(), "firsts")
    reps = rows.where("digest is not null").join(if_small(firsts), rows["doc_id"] == firsts["rep"]).select("rep", "n_shingles", "sig", "low").dropDuplicates(["rep"])
    links, component = link_classes(docs, id_col, text_col, reps, sketched)
    component = materialize(component.withColumnRenamed("node", "rep"), "component")
    discard(rows)
    out = spread_join(members.select("doc_id", "n_shingles", "rep"), component, "rep", classes.select("rep", "n"), "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def link_classes(docs: DataFrame, id_col: str, text_col: str, reps: DataFrame, sketched: bool = True) -> tuple[DataFrame, DataFrame]:
    """Links between classes of equal sets, and (node, component) of the classes that have any."""
    reps = materialize(reps, "classes")
    buckets = materialize(keyed(reps).groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = materialize(spread_join(keyed(reps), buckets.select("key", F.col("n").alias("of")), "key", buckets, "rep").select("key", "rep", F.col("of").alias("n")), "shared")
    # the member that meets most others leads a bucket: the original of a group rather than a copy
    hubs = shared.groupBy("rep").agg(F.sum("n").alias("hub"))
    leads = shared.join(hubs, "rep").groupBy("key").agg(F.max(F.struct("hub", "rep")).alias("lead"))
    leads = materialize(leads.select("key", F.col("lead.rep").alias("b")), "leads")
    meets = spread_join(shared.select("key", "rep"), leads, "key", buckets, "rep").where("rep <> b").groupBy("rep", "b").count()
    best = meets.groupBy("rep").agg(F.max(F.struct("count", "b")).alias("m")).select("rep", F.col("m.b").alias("b"))
    best = materialize(best.select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct(), "best")
    stars = materialize(near(best, reps), "stars")
    links = materialize(confirmed(stars, docs, id_col, text_col), "links")
    component = connected_components(links)
    # members of one bucket that are still apart
    now = shared.select("key", "rep").join(component, F.col("rep") == component["node"], "left").select("key", "rep", F.coalesce("component", "rep").alias("c"))
    apart = materialize(now.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key"), "apart")
    rest = materialize(spread_join(now, apart, "key", buckets, "rep").select("key", "rep", "c"), "rest")
    more = materialize(across(rest, reps, sketched), "pairs")
    more = materialize(more.join(stars, ["a", "b"], "left_anti"), "pairs")
    extra = materialize(confirmed(more, docs, id_col, text_col), "links")
    if extra.limit(1).count():
        links = links.union(extra)
        component = connected_components(links)
    discard(reps)
    return links, component


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, less those that are near-duplicates of a row with a smaller id.

    Rows that repeat both an id and a text stay once; an id goes only if none of its texts is kept. Rows with a
    null id link with nothing and all stay.
    """
    found = materialize(near_duplicates(docs, id_col, text_col), "near")
    named = found.where("doc_id is not null")
    if not named.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return without_ids(docs, named.where("not kept").select("doc_id"), id_col)
    gone = named.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select("doc_id")
    left = without_ids(docs.where(F.col(id_col).isNotNull()), gone, id_col).dropDuplicates([id_col, text_col])
    return left.unionByName(docs.where(F.col(id_col).isNull()))


def op1_minhash(spark, sf_dir: str) -> DataFrame:
    """The contract query: all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
