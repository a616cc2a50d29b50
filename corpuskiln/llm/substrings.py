"""Removal of word runs that repeat across documents, by prefix-partitioned suffix trees.

Words are [^\\x20\\x09-\\x0D]+. A window of WINDOW consecutive words is removed where its words also
start in a document with a smaller id. The suffixes that can matter are counted under their first
words: a prefix that starts more than GROUP_ROWS of them is lengthened along LADDER until each of its
groups fits (a prefix of WINDOW words is one node, which is read as a stream whatever its size). Suffixes
are dealt by these prefixes of different lengths and arrive sorted; the words that neighbours have in
common are the depths of a group's suffix tree, and the leaves below a node of depth WINDOW are a
repeat: the smallest id among them is its first place, all others are removed. Suffixes are cut at
WINDOW words, since every deeper node lies below one of that depth; the removed windows of a document
that overlap or touch make its maximal repeats.

What can't repeat is left out first: word sequences that equal a smaller document's are removed
whole, and a window is looked at only if its minimizer (the smallest hash of its runs of GRAM words)
occurs in another document too; equal windows have equal minimizers, so nothing is lost. Of a document
only the words of such windows go on (passages), with their places, and are judged once more by longer runs, of
LONG words: runs of GRAM words recur by chance, the more so the larger the table is. Before
suffixes are sent, those of a batch are made a tree of their own by prefix doubling, and of each of its nodes of
depth WINDOW one leaf stands for all, so that a passage in a third of all documents sends one row a batch.
Words stand in suffixes as SYMBOL bytes each, and suffixes are compared word by word.

Defined cases: null texts have no words; texts of fewer than WINDOW words lose none; a null id is
neither a source nor loses words; repeats inside one document stay, and so do those between rows of one id, each of
which is cut by its own spans; of equal windows the smallest id's stays, wherever it
stands; a very long text is split piece by piece and then takes some 40 bytes a word, about 100 where
words are cut out of it; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b, sha256
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import CHUNK_CHARS, as_signed, discard, fmix, if_small, map_arrow, materialize, pieces, released, rolling, slices, sliding_min, spread_join, table, word_hashes
from corpuskiln.storage import BROADCAST_BYTES, measured

WINDOW, GRAM = 13, 4
#: Words of the runs whose smallest hash the windows of passages are judged by: few of such runs recur by chance.
LONG = 8
#: Bytes of a word in a suffix, of its 64-bit hash.
SYMBOL = 5
#: Words of the prefixes that groups are made by, tried in this order.
LADDER = (3, 6, 9, WINDOW)
#: Suffixes of a group at most, and prefixes with more that are held at once: the bound grows with the number of
#: suffixes so that they stay that few.
GROUP_ROWS, HEAVY_PREFIXES = 200_000, 1_000_000
EMPTY = sha256(b"").hexdigest()


def single_spaced(text: str | None) -> Iterator[tuple[bytes, int]]:
    """A text's words joined by one space, in pieces with their numbers of words."""
    first = True
    for piece in pieces((text or "").encode("utf-8")):
        if w := piece.split():
            yield (b"" if first else b" ") + b" ".join(w), len(w)
            first = False


class Batch:
    """Word hashes of some texts laid end to end, and where their windows start: all of them, or those of runs if the texts are
    passages()."""

    def __init__(self, texts: list[bytes], runs: list[list[int]] | None = None):
        hashes = [word_hashes(t) for t in texts]
        n = np.array([len(h) for h in hashes], dtype=np.int64)
        self.h = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        self.start = np.concatenate(([0], np.cumsum(n)))
        if runs is not None:
            found, none = [places_of(x) for x in runs], np.zeros(0, dtype=np.int64)
            self.owner = np.repeat(np.arange(len(found)), [len(place) for place, _ in found])
            self.place = np.concatenate([none, *(place for place, _ in found)])
            self.at = np.concatenate([none, *(words for _, words in found)]) + self.start[self.owner]
            return
        owner = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(owner)) - self.start[owner]
        self.at = np.flatnonzero(place + WINDOW <= n[owner])
        self.owner, self.place = owner[self.at], place[self.at]

    def minimizers(self, gram: int = GRAM) -> np.ndarray:
        """Of every window, the smallest hash of its runs of gram words."""
        if not len(self.at):
            return np.zeros(0, dtype=np.uint64)
        return sliding_min(rolling(self.h, gram), WINDOW - gram + 1)[self.at]


def sequences(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, digest, whole_sha256) of rows (doc_id, text_hash, text): of the words joined by one space."""

    def each(cols: dict, n: int) -> dict:
        out: dict[str, list] = {"doc_id": cols["doc_id"], "text_hash": cols["text_hash"], "n_words": [], "digest": [], "whole_sha256": []}
        for text in cols["text"]:
            short, sha, total = blake2b(digest_size=16), sha256(), 0
            for piece, count in single_spaced(text):
                short.update(piece)
                sha.update(piece)
                total += count
            out["n_words"].append(total)
            out["digest"].append(short.digest())
            out["whole_sha256"].append(sha.hexdigest())
        return out

    return map_arrow(rows, f"doc_id {dict(rows.dtypes)['doc_id']}, text_hash bigint, n_words bigint, digest binary, whole_sha256 string", each)


def minimizers(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, ms array<bigint>) of docs (doc_id, copy, text): the distinct minimizers of a document's windows."""

    def each(cols: dict, n: int) -> dict:
        b = Batch([(t or "").encode("utf-8") for t in cols["text"]])
        m, cut = b.minimizers(), np.searchsorted(b.owner, np.arange(n + 1))
        return {"doc_id": cols["doc_id"], "copy": cols["copy"], "ms": [as_signed(np.unique(m[lo:hi])) for lo, hi in zip(cut[:-1], cut[1:], strict=True)]}

    return map_arrow(docs, f"doc_id {dict(docs.dtypes)['doc_id']}, copy bigint, ms array<bigint>", each)


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, n_words, packed): words joined by one space, compressed, for the shuffle."""

    def each(cols: dict, n: int) -> dict:
        squeeze = zstandard.ZstdCompressor(level=6).compress
        joined = [list(single_spaced(t)) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "copy": cols["copy"], "n_words": [sum(c for _, c in j) for j in joined], "packed": [squeeze(b"".join(p for p, _ in j)) for j in joined]}

    return map_arrow(docs, f"doc_id {dict(docs.dtypes)['doc_id']}, copy bigint, n_words bigint, packed binary", each)


def marked_windows(b: Batch, marks: list[list[int]], gram: int = GRAM) -> np.ndarray:
    """Which windows of a batch have one of their text's marks as minimizer."""
    m, cut = b.minimizers(gram), np.searchsorted(b.owner, np.arange(len(marks) + 1))
    sought = (np.sort(np.array(x, dtype=np.int64).view(np.uint64)) for x in marks)
    hit = [lo + np.flatnonzero(among(m[lo:hi], x)) for x, lo, hi in zip(sought, cut[:-1], cut[1:], strict=True)]
    return np.concatenate(hit) if hit else np.zeros(0, dtype=np.int64)


def among(m: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of m are in the sorted x: np.isin for many small arrays, without sorting m."""
    return x[np.minimum(np.searchsorted(x, m), len(x) - 1)] == m if len(x) else np.zeros(len(m), dtype=bool)


def passages(marked: DataFrame, gram: int = GRAM, longer: int = 0) -> DataFrame:
    """(doc_id, copy, low, packed, runs) of marked (doc_id, copy, packed, marks): of every text only the words of windows to look at, and
    the first place and the number of each run of such windows, one after the other; low is the smallest mark. With runs in
    marked its texts are passages themselves. With ``longer``, also ms array<bigint>: the distinct minimizers of these
    windows by runs of so many words."""

    def each(cols: dict, n: int) -> dict:
        unpack, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=6).compress
        texts = [unpack(t) for t in cols["packed"]]
        b = Batch(texts, cols.get("runs"))
        hit = marked_windows(b, cols["marks"], gram)
        cut = np.searchsorted(b.owner[hit], np.arange(n + 1))
        out: dict[str, list] = {"doc_id": cols["doc_id"], "copy": cols["copy"], "low": [min(x) for x in cols["marks"]], "packed": [], "runs": []}
        for k, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            place = b.place[hit[lo:hi]]
            first = np.flatnonzero(np.concatenate(([True], np.diff(place) != 1))) if len(place) else place
            out["runs"].append(np.stack((place[first], np.diff(np.append(first, len(place)))), axis=1).ravel().astype(np.int32))
            inside, at, words = covered(int(b.start[k + 1] - b.start[k]), b.at[hit[lo:hi]] - b.start[k]), 0, []
            for piece in pieces(texts[k]):
                w = piece.split()
                words.extend(compress(w, inside[at : at + len(w)].tobytes()))
                at += len(w)
            out["packed"].append(squeeze(b" ".join(words)))
        if longer:
            m = b.minimizers(longer)[hit]
            out["ms"] = [as_signed(np.unique(m[lo:hi])) for lo, hi in zip(cut[:-1], cut[1:], strict=True)]
        return out

    kind, ms = dict(marked.dtypes)["doc_id"], ", ms array<bigint>" if longer else ""
    runs = ["runs"] if "runs" in marked.columns else []
    return map_arrow(marked.select("doc_id", "copy", "packed", "marks", *runs), f"doc_id {kind}, copy bigint, low bigint, packed binary, runs array<int>{ms}", each, CHUNK_CHARS // 2)


def shared_marks(active: DataFrame) -> DataFrame:
    """(doc_id, copy, marks) of active (doc_id, copy, ms): of every document those of its minimizers that other documents have too."""
    found = active.select("doc_id", "copy", F.explode("ms").alias("m"))
    shared = materialize(found.groupBy("m").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a < b").select("m", "n"), "shared")
    marks = materialize(spread_join(found, shared.select("m"), "m", shared, "doc_id").groupBy("doc_id", "copy").agg(F.collect_set("m").alias("marks")), "marks")
    discard(shared)
    return marks


def places_of(runs: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(place in the text, place in the words of its passages) of every window of runs, as passages() gives them."""
    first, n = np.array(runs, dtype=np.int64).reshape(-1, 2).T
    end = first + n + WINDOW - 1
    before = np.concatenate(([0], end[:-1])) if len(end) else end
    held = np.cumsum(end - np.maximum(first, before))  # words of this and the runs before it
    base = held - (end - first)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(first, n) + step, np.repeat(base, n) + step


def leaf_order(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, depth) of the suffixes of the words h that begin at the places, cut at WINDOW words: their order as leaves
    of a suffix tree, and the words that each has in common with the one before it, as far as WINDOW is concerned.

    By prefix multiplication: words are ranked, then runs of up to WINDOW words by the ranks of shorter ones, as many of
    them at a time as fit 63 bits; a rank holds no hash but those of words.
    """
    if not len(at):
        return at, np.zeros(0, dtype=np.int64)
    edge = np.bincount(at, minlength=len(h) + 1) - np.bincount(at + WINDOW, minlength=len(h) + 1)
    inside = np.cumsum(edge)[:-1] > 0  # other words are left out; the words of a suffix stay together
    _, rank = np.unique(h[inside], return_inverse=True)
    at, size = (np.cumsum(inside) - 1)[at], 1
    while size < WINDOW:
        base = int(rank.max()) + 1
        times = min(-(-WINDOW // size), 63 // base.bit_length())
        # the last run may overlap the one before it, so that none is longer than WINDOW words
        steps = [min(k * size, WINDOW - size) for k in range(times)]
        n = len(rank) - steps[-1]
        code = rank[:n].astype(np.int64)
        for step in steps[1:]:
            code = code * base + rank[step : step + n]
        size += steps[-1]
        _, rank = np.unique(code if size < WINDOW else code[at], return_inverse=True)
    order = np.argsort(rank, kind="stable")
    return order, np.where(rank[order][1:] == rank[order][:-1], WINDOW, 0)


class Subtree:
    """The windows to look at of some documents, as the leaves of their own suffix tree: (doc_id, copy, packed, runs) of passages(),
    or (doc_id, copy, packed, marks) of whole texts."""

    def __init__(self, cols: dict, id_type: pa.DataType):
        unpack = zstandard.ZstdDecompressor().decompress
        order = sorted(range(len(cols["doc_id"])), key=lambda i: (cols["doc_id"][i], cols["copy"][i]))
        ids = [cols["doc_id"][i] for i in order]
        self.ids, self.copies = pa.array(ids, id_type), pa.array([cols["copy"][i] for i in order], pa.int64())
        number = np.cumsum([0] + [a != b for a, b in zip(ids[1:], ids, strict=False)]) if ids else np.zeros(0, dtype=np.int64)
        b = Batch([unpack(cols["packed"][i]) for i in order], [cols["runs"][i] for i in order] if "runs" in cols else None)
        hit = slice(None) if "runs" in cols else marked_windows(b, [cols["marks"][i] for i in order])
        at, self.owner, self.place = b.at[hit], b.owner[hit], b.place[hit]
        # places are in the order of ids, and so are the leaves below a node: its first is of the smallest document
        self.leaves, self.depth = leaf_order(b.h, at)
        owner = self.owner[self.leaves]
        node = np.concatenate(([True], self.depth < WINDOW)) if len(at) else np.zeros(0, dtype=bool)
        home = owner[np.flatnonzero(node)][np.cumsum(node) - 1]
        # later places within a row of the smallest document go along with its first
        first = node | np.concatenate(([True], owner[1:] != owner[:-1])) if len(at) else node
        gone, same, self.lead = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=np.int64)
        gone[self.leaves], same[self.leaves] = number[owner] > number[home], ~first
        self.lead[self.leaves] = self.leaves[np.flatnonzero(first)][np.cumsum(first) - 1]
        self.gone, self.send, self.inside = np.flatnonzero(gone), np.flatnonzero(~gone & ~same), np.flatnonzero(~gone & same)
        self.h, self.sent = b.h, at[self.send]

    def symbols(self, length: int = WINDOW) -> np.ndarray:
        """Of the leaves to send, the first words: [leaf, word] as numbers."""
        drop = np.uint64(8 * (8 - SYMBOL))
        return (self.h >> drop)[self.sent[:, None] + np.arange(length)]

    def suffixes(self) -> np.ndarray:
        """Of the leaves to send, all words as bytes."""
        words = self.h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :SYMBOL]
        return words[self.sent[:, None] + np.arange(WINDOW)].reshape(len(self.sent), -1)


def prefix_hash(symbols: np.ndarray, length: int) -> np.ndarray:
    """Of every suffix, a 64-bit hash of the symbols of its first words."""
    h = np.zeros(len(symbols), dtype=np.uint64)
    for i in range(length):
        h = fmix(h + symbols[:, i] + np.uint64(1))
    return h


def prefix_lengths(symbols: np.ndarray, heavy: list[np.ndarray]) -> np.ndarray:
    """Of every suffix, the words of its group's prefix: the first of LADDER under which the group fits.

    heavy: for each length tried so far the sorted hashes of the prefixes that start too many suffixes.
    """
    length = np.full(len(symbols), LADDER[0])
    for k, h in enumerate(heavy):
        open_ = np.flatnonzero(length == LADDER[k])
        length[open_[np.isin(prefix_hash(symbols[open_], LADDER[k]), h)]] = LADDER[k + 1]
    return length


def heavy_prefixes(marked: DataFrame) -> list[np.ndarray]:
    """Prefixes to lengthen, by length: those that start more suffixes than a group may have.

    A pass over the documents for each length, counting under prefixes that are still too heavy only; the
    hashes that come to the driver are at most HEAVY_PREFIXES by arithmetic.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    heavy: list[np.ndarray] = []
    bound, id_type = None, to_arrow_type(marked.schema["doc_id"].dataType)
    for k, length in enumerate(LADDER[:-1]):

        def count(cols: dict, n: int, k=k, length=length) -> dict:
            symbols = Subtree(cols, id_type).symbols(LADDER[k])
            open_ = symbols[prefix_lengths(symbols, heavy) == length] if k else symbols
            p, c = np.unique(prefix_hash(open_, length), return_counts=True)
            return {"p": pa.array(as_signed(p)), "n": pa.array(c.astype(np.int64))}

        counts = materialize(map_arrow(windows(marked), "p bigint, n bigint", count, CHUNK_CHARS // 4).groupBy("p").agg(F.sum("n").alias("n")), "prefixes")
        if bound is None:
            total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
            bound = max(GROUP_ROWS, total // HEAVY_PREFIXES)
        found = counts.where(F.col("n") > bound).select("p").toArrow().column("p").to_numpy()
        discard(counts)
        if not len(found):
            break
        heavy.append(np.sort(found.astype(np.int64).view(np.uint64)))
    return heavy


def windows(marked: DataFrame) -> DataFrame:
    """What a Subtree takes."""
    return marked.select("doc_id", "copy", "packed", "runs" if "runs" in marked.columns else "marks")


def suffix_rows(marked: DataFrame, heavy: list[np.ndarray] = ()) -> DataFrame:
    """(prefix, suffix, doc_id, copy, place, found) of marked, of which a Subtree takes windows().

    Either a leaf that stands for its node of the batch, its words being the prefix of its group and the suffix, or, with a
    null suffix, the places of a document's leaves below nodes that a smaller document of the same batch has leaves below too.
    """
    kind = dict(marked.dtypes)["doc_id"]
    shared = marked.sparkSession.sparkContext.broadcast(list(heavy))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cols in slices(batch, CHUNK_CHARS // 4):
                s = Subtree(cols, batch.schema.field("doc_id").type)
                send = s.send
                if len(send):
                    words = s.suffixes()
                    length = SYMBOL * prefix_lengths(s.symbols(LADDER[len(shared.value)]), shared.value)
                    inside = np.arange(words.shape[1]) < length[:, None]
                    more: dict[int, list[int]] = {}
                    for k in s.inside:
                        more.setdefault(int(s.lead[k]), []).append(int(s.place[k]))
                    extra = [more.get(int(k), None) for k in send] if more else [None] * len(send)
                    owner = pa.array(s.owner[send])
                    yield pa.RecordBatch.from_arrays(
                        [
                            binaries(words[inside], length), binaries(words[~inside], words.shape[1] - length), s.ids.take(owner), s.copies.take(owner),
                            pa.array(s.place[send].astype(np.int32)), pa.array(extra, pa.list_(pa.int32())),
                        ], names=NAMES,
                    )
                if len(s.gone):
                    gone = s.gone[np.argsort(s.owner[s.gone], kind="stable")]
                    docs, begin = np.unique(s.owner[gone], return_index=True)
                    n = len(docs)
                    yield pa.RecordBatch.from_arrays(
                        [
                            binaries(docs.astype(">u4").view(np.uint8), np.full(n, 4)), pa.nulls(n, pa.binary()), s.ids.take(pa.array(docs)), s.copies.take(pa.array(docs)), pa.nulls(n, pa.int32()),
                            pa.ListArray.from_arrays(pa.array(np.concatenate((begin, [len(gone)])).astype(np.int32)), pa.array(s.place[gone].astype(np.int32))),
                        ], names=NAMES,
                    )

    return windows(marked).mapInArrow(released(run), f"prefix binary, suffix binary, doc_id {kind}, copy bigint, place int, found array<int>")


NAMES = ["prefix", "suffix", "doc_id", "copy", "place", "found"]


def binaries(data: np.ndarray, width: np.ndarray) -> pa.Array:
    """Bytes laid end to end as a binary column."""
    ends = np.concatenate(([0], np.cumsum(width))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(width), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def depths(tree: np.ndarray) -> np.ndarray:
    """Of sorted suffixes [row, byte], the words that each has in common with the one before it: the depth of the
    node that joins them."""
    words = tree.reshape(len(tree), WINDOW, SYMBOL)
    same = (words[1:] == words[:-1]).all(axis=2)
    return np.where(same.all(axis=1), WINDOW, same.argmin(axis=1))


def deep_nodes(depth: np.ndarray, least: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(first leaf, leaf after the last) of the topmost internal nodes at least so deep."""
    deep = np.concatenate(([0], (depth >= least).astype(np.int8), [0]))
    edge = np.diff(deep)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1


def repeats(suffixes: DataFrame) -> DataFrame:
    """(doc_id, copy, found array<int>): places of windows to remove, from the suffix trees of the prefix groups."""
    kind = dict(suffixes.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the group that is still open at the end of a batch
        for batch in batches:
            t = pa.Table.from_batches([batch])
            plain = t.filter(pc.is_null(t.column("suffix")))
            if plain.num_rows:
                yield pa.RecordBatch.from_arrays([plain.column(c).combine_chunks() for c in ("doc_id", "copy", "found")], names=["doc_id", "copy", "found"])
            t = t.filter(pc.is_valid(t.column("suffix")))
            if not t.num_rows:
                continue
            t = pa.concat_tables([held, t]) if held is not None else t
            last = t.column("prefix")[-1]
            other = np.flatnonzero(~pc.equal(t.column("prefix"), last).to_numpy())
            cut = int(other[-1]) + 1 if len(other) else 0
            yield from subtrees(t.slice(0, cut))
            held = t.slice(cut)
            if len(last.as_py()) == SYMBOL * WINDOW and held.num_rows > 1:
                # a prefix of all words is one node: its first leaf is kept, the others go as they come
                yield from subtrees(held)
                held = held.slice(0, 1)
        if held is not None:
            yield from subtrees(held)

    def subtrees(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Removed leaves of whole groups: neighbours of different groups have less than WINDOW words in common."""
        if t.num_rows < 2:
            return
        t = t.combine_chunks()
        whole = pc.binary_join_element_wise(t.column("prefix"), t.column("suffix"), b"").combine_chunks()
        bytes_ = np.frombuffer(whole.buffers()[2], dtype=np.uint8)[: len(whole) * SYMBOL * WINDOW]
        begin, end = deep_nodes(depths(bytes_.reshape(len(whole), -1)))
        if not len(begin):
            return
        codes = t.column("doc_id").combine_chunks().dictionary_encode()
        code = codes.indices.to_numpy()
        node = np.repeat(np.arange(len(begin)), end - begin)
        leaf = np.arange(len(node)) + np.repeat(begin - np.concatenate(([0], np.cumsum(end - begin)[:-1])), end - begin)
        gone = leaf[code[leaf] != code[begin[node]]]  # leaves are sorted by id within a node
        if not len(gone):
            return
        place, copy, extra = t.column("place").to_numpy()[gone].tolist(), t.column("copy").to_numpy()[gone].tolist(), t.column("found").take(pa.array(gone)).to_pylist()
        docs: dict[tuple[int, int], list[int]] = {}
        for c, k, at, more in zip(code[gone].tolist(), copy, place, extra, strict=True):
            docs.setdefault((c, k), []).extend((at, *more) if more else (at,))
        yield pa.RecordBatch.from_arrays(
            [codes.dictionary.take(pa.array([c for c, _ in docs], pa.int32())), pa.array([c for _, c in docs], pa.int64()), pa.array(list(docs.values()), pa.list_(pa.int32()))],
            names=["doc_id", "copy", "found"],
        )

    dealt = suffixes.repartition("prefix").sortWithinPartitions("prefix", "suffix", "doc_id")
    return dealt.mapInArrow(released(run), f"doc_id {kind}, copy bigint, found array<int>")


def removed_mask(n: int, places: list[int]) -> np.ndarray:
    """Words covered by the windows that start at the places."""
    return covered(n, np.unique(np.array(places, dtype=np.int64)))


def covered(n: int, p: np.ndarray) -> np.ndarray:
    """Which of n words are covered by the windows that start at the distinct places p."""
    edge = np.zeros(n + WINDOW + 1, dtype=np.int64)
    edge[p] += 1
    edge[p + WINDOW] -= 1
    return np.cumsum(edge)[:n] > 0


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """(first word, words) of the maximal runs of removed words."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return [(int(a), int(b - a)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_words, n_removed, kept_sha256, spans): spans are the removed runs of words, in order; the hash of
    the text tells rows apart that share an id."""
    return _found(docs, id_col, text_col, True)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """find_repeats() without kept_sha256, so texts aren't fetched again for what is left of them."""
    return _found(docs, id_col, text_col, False)


def _found(docs: DataFrame, id_col: str, text_col: str, hashed: bool) -> DataFrame:
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    seqs = materialize(sequences(rows), "sequences")
    ids = seqs.where("doc_id is not null").groupBy("doc_id").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"), F.count("*").alias("n"))
    ids = materialize(ids.where("n > 1"), "repeated-ids")
    several = ids.where("low < high").select(F.col("doc_id").alias("__id"))
    rows, seqs = (numbered(df, several) for df in (rows, seqs))
    long = seqs.where(f"doc_id is not null and n_words >= {WINDOW}").select("doc_id", "copy", "digest")
    copied = long.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("rep < last")
    copied = materialize(copied.select("digest", "rep", "n"), "copied")
    copies = spread_join(long, copied.select("digest", "rep"), "digest", copied.select("digest", "n"), "doc_id")
    copies = materialize(copies.where("doc_id > rep").select(F.col("doc_id").alias("__id"), F.col("copy").alias("__copy")).distinct(), "copies")
    row = (F.col("doc_id") == F.col("__id")) & (F.col("copy") == F.col("__copy"))
    # copies are taken out of the minimizers, and marks bring what is left to the texts, which are shuffled once
    named = rows.where("doc_id is not null").select("doc_id", "copy", "text")
    active = minimizers(named).where(F.size("ms") > 0).join(if_small(copies), row, "left_anti")
    once = ids.limit(1).count() > 0  # rows that repeat an id and its text are one document
    active = materialize(active.dropDuplicates(["doc_id", "copy"]) if once else active, "minimizers")
    marks = shared_marks(active)
    discard(active)
    marked = packed(named).join(marks, ["doc_id", "copy"])
    marked = materialize(passages(marked.dropDuplicates(["doc_id", "copy"]) if once else marked, longer=LONG), "marked")
    discard(marks)
    # most windows that repeat nowhere go here, before their suffixes would be sent
    marks = shared_marks(marked)
    closer = materialize(passages(marked.join(marks, ["doc_id", "copy"]), LONG), "closer")
    discard(marked)
    discard(marks)
    # texts that share passages lie together, so that most leaves of a node are of one batch; ranges
    # split a mark that many documents have
    text = materialize(closer.repartitionByRange("low", "doc_id").sortWithinPartitions("low", "doc_id").drop("low"), "neighbours")
    discard(closer)
    flags = materialize(repeats(suffix_rows(text, heavy_prefixes(text))).groupBy("doc_id", "copy").agg(F.flatten(F.collect_list("found")).alias("places")), "places")
    discard(text)

    def each(cols: dict, n: int) -> dict:
        out: dict[str, list] = {"__id": cols["doc_id"], "__copy": cols["copy"], "removed": [], "sha": [], "spans": []}
        unpack = zstandard.ZstdDecompressor().decompress
        for blob, total, places in zip(cols["packed"], cols["n_words"], cols["places"], strict=True):
            gone, sha, at, space = removed_mask(total, places), sha256(), 0, b""
            for piece in pieces(unpack(blob)):
                w = piece.split()
                if kept := [x for x, g in zip(w, gone[at : at + len(w)].tolist(), strict=True) if not g]:
                    sha.update(space + b" ".join(kept))
                    space = b" "
                at += len(w)
            out["removed"].append(int(gone.sum()))
            out["sha"].append(sha.hexdigest())
            out["spans"].append([{"first_word": a, "n_words": b} for a, b in runs(gone)])
        return out

    def spans_only(cols: dict, n: int) -> dict:
        spans = [runs(removed_mask(max(p) + WINDOW, p)) for p in cols["places"]]
        return {
            "__id": cols["doc_id"], "__copy": cols["copy"], "removed": [sum(b for _, b in x) for x in spans],
            "spans": [[{"first_word": a, "n_words": b} for a, b in x] for x in spans],
        }

    if hashed:
        # texts that lose nothing are left out before the shuffle, if the ids of the others are few enough
        lost = flags.select("doc_id", "copy")
        some = named.join(F.broadcast(lost), ["doc_id", "copy"], "left_semi") if measured(lost) <= BROADCAST_BYTES else named
        some = packed(some).join(flags, ["doc_id", "copy"])
        changed = map_arrow(some.dropDuplicates(["doc_id", "copy"]) if once else some, f"__id {kind}, __copy bigint, removed bigint, sha string, {SPANS}", each)
    else:
        changed = map_arrow(flags, f"__id {kind}, __copy bigint, removed bigint, {SPANS}", spans_only)
    changed = materialize(changed, "changed")
    out = seqs.join(changed, row, "left").drop("__id", "__copy").join(if_small(copies), row, "left")
    copy = F.col("__id").isNotNull()
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("first_word"), F.col("n_words")))
    return out.select(
        "doc_id", "text_hash", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
        *([F.when(copy, EMPTY).otherwise(F.coalesce("sha", "whole_sha256")).alias("kept_sha256")] if hashed else []),
        F.when(copy, whole).otherwise(F.coalesce("spans", F.expr(f"cast(array() as {SPANS.partition(' ')[2]})"))).alias("spans"),
    )


def numbered(rows: DataFrame, several: DataFrame) -> DataFrame:
    """rows with ``copy``: 0, but for rows whose id is among several, which has other texts too, their text_hash."""
    other = if_small(several.withColumn("__several", F.lit(True)))
    return rows.join(other, F.col("doc_id") == F.col("__id"), "left").withColumn("copy", F.when(F.col("__several"), F.col("text_hash")).otherwise(0).cast("bigint")).drop("__id", "__several")


SPANS = "spans array<struct<first_word: bigint, n_words: bigint>>"
_WORD = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def cut_spans(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans and the white space after them."""
    parts = _WORD.findall(text)
    for s in reversed(spans):
        del parts[s["first_word"] : s["first_word"] + s["n_words"]]
    return "".join(parts)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns and rows, with the repeated words cut out of the texts."""
    edits = find_spans(docs, id_col, text_col).where("n_removed > 0").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
    edits = materialize(edits.dropDuplicates(["__id", "__hash"]), "edits")
    both = docs.join(if_small(edits), (docs[id_col] == edits["__id"]) & (F.xxhash64(docs[text_col]) == edits["__hash"]), "left").drop("__id", "__hash")
    cut = F.pandas_udf(lambda t, s: _cut_series(t, s), "string")
    text = F.when(F.col("__spans").isNotNull(), cut(F.col(text_col), F.col("__spans"))).otherwise(F.col(text_col))
    return both.withColumn(text_col, text).drop("__spans").select(*docs.columns)


def _cut_series(texts, spans):
    import pandas as pd

    return pd.Series([t if s is None or t is None else cut_spans(t, list(s)) for t, s in zip(texts, spans, strict=True)])


def op6_substrings(spark, sf_dir: str) -> DataFrame:
    """The contract query: all documents."""
    return find_repeats(table(spark, sf_dir, "documents")).drop("spans", "text_hash")
