"""Benchmark passages in documents, found by winnowing.

ASCII letters are lower-cased; words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+. A window is SPAN consecutive words
of an item, or all words of a shorter one. Of every span of ``size`` words the smallest hash of its runs of k words
is kept, its fingerprint, with k + w - 1 = size for the w runs that a span holds; equal spans have equal
fingerprints, so a shared span of that size is never missed, and neighbouring spans mostly share theirs. Documents'
and items' fingerprints are joined; a hit is extended to the spans that chose it, and these are compared as words,
so no hash decides what is hit. Items shorter than SPAN are looked for with spans of their own size.

Windows that the same items hold are one class, so a document carries a few classes, not all pairs of
places and items; and documents with the same classes, as copies and sharers of one passage are, get their list
of items once.

The items' windows go to the tasks as a table if they were measured to take at most WINDOW_BYTES. Else
fingerprints are joined by a shuffle, hot ones cut into parts, equal texts once; both ways give the same rows.

Defined cases: null texts, and texts without words, have no words and no hits, as items they are in no document;
equal rows, and rows that repeat an id, are judged each by its own text; a null item id hits words but is
not listed; items that repeat an id are one item with the windows of all of them; a table without rows, of either
kind, gives no hits; further columns are ignored. Very long texts are gone through in pieces and take
some 20 bytes a word of a piece.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import fmix, map_arrow, materialize, pieces, rolling, sliding_min, spread_join, table
from corpuskiln.storage import measured

#: Words of a window, and the bytes of windows up to which tasks get them all.
SPAN, WINDOW_BYTES = 10, 16_000_000
#: Bytes of words as they are, A-Z lower-cased, all others a space.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SPANS = "array<struct<first_word: bigint, n_words: bigint>>"


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8").translate(FOLDED)


def fingerprints(words: list[bytes], size: int) -> np.ndarray:
    """Of every span of size words the smallest hash of its runs of k words; sizes don't share fingerprints."""
    k = (size + 1) // 2
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    runs = rolling(hashes, k)
    w = size - k + 1
    return fmix(sliding_min(runs, w) + np.uint64(size)) if len(runs) >= w else runs[:0]


def candidates(text: str | None, prints: dict[int, np.ndarray]) -> tuple[int, list[tuple[int, int, bytes]]]:
    """A text's number of words, and (first word, words, the words) of its spans whose fingerprint is among the sorted ones."""
    held: list[bytes] = []
    before, found = 0, []
    keep = max(prints, default=1) - 1
    for piece in pieces(folded(text)):
        words = held + piece.split()
        for size, known in prints.items():
            f = fingerprints(words, size)
            if not len(f) or not len(known):
                continue
            first = np.concatenate(([True], f[1:] != f[:-1]))
            at = np.minimum(np.searchsorted(known, f[first]), len(known) - 1)
            for i in np.flatnonzero((known[at] == f[first])[np.cumsum(first) - 1]).tolist():
                if i + size > len(held):  # the others were in the piece before
                    found.append((before + i, size, b" ".join(words[i : i + size])))
        done = max(0, len(words) - keep)
        before, held = before + done, words[done:]
    return before + len(held), found


def merged(hits: list[tuple[int, int]]) -> list[dict]:
    """Maximal runs of words that the (first word, words) cover."""
    out: list[list[int]] = []
    for start, size in sorted(hits):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], start + size)
        else:
            out.append([start, start + size])
    return [{"first_word": a, "n_words": b - a} for a, b in out]


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """(item, words, size, print): the distinct windows of all items; ids as strings."""

    def each(cols: dict, n: int) -> dict:
        out: dict[str, list] = {"item": [], "words": [], "size": [], "print": []}
        for item, text in zip(cols["item"], cols["text"], strict=True):
            words = folded(text).split()
            size = min(len(words), span)
            if size:
                f = fingerprints(words, size).view(np.int64).tolist()
                out["item"] += [item] * len(f)
                out["words"] += [b" ".join(words[i : i + size]) for i in range(len(f))]
                out["size"] += [size] * len(f)
                out["print"] += f
        return out

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return materialize(map_arrow(rows, "item string, words binary, size int, print bigint", each).distinct(), "windows")


def window_classes(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words, size, print, class) and (class, items array): windows that the same items hold are of one class."""
    sets = F.xxhash64(F.count("item"), F.bit_xor(F.xxhash64("item")), F.bit_xor(F.xxhash64("item", F.lit(1))))
    classes = materialize(windows.groupBy("words", "size", "print").agg(sets.alias("class")), "classes")
    chosen = classes.groupBy("class").agg(F.min("words").alias("words"))
    of = windows.where("item is not null").join(chosen, "words").groupBy("class").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return classes, materialize(of, "class-items")


def sorted_prints(sizes: list[int], prints: list[int]) -> dict[int, np.ndarray]:
    size, p = np.array(sizes, dtype=np.int64), np.array(prints, dtype=np.int64).view(np.uint64)
    return {int(s): np.unique(p[size == s]) for s in np.unique(size)}


def hits_by_table(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, classes) of rows (doc_id, text), the windows being in every task."""
    known = classes.select("words", "size", "print", "class").toArrow().to_pydict()
    prints = sorted_prints(known["size"], known["print"])
    shared = rows.sparkSession.sparkContext.broadcast((prints, dict(zip(map(bytes, known["words"]), known["class"], strict=True))))

    def each(cols: dict, n: int) -> dict:
        prints, windows = shared.value
        out: dict[str, list] = {"doc_id": cols["doc_id"], "n_words": [], "n_hit": [], "spans": [], "classes": []}
        for text in cols["text"]:
            total, found = candidates(text, prints)
            found = [(start, size, windows[w]) for start, size, w in found if w in windows]
            spans = merged([(start, size) for start, size, _ in found])
            out["n_words"].append(total)
            out["n_hit"].append(sum(s["n_words"] for s in spans))
            out["spans"].append(spans)
            out["classes"].append(sorted({c for _, _, c in found}))
        return out

    return map_arrow(rows, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words bigint, n_hit bigint, spans {SPANS}, classes array<bigint>", each)


def hits_by_join(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """As hits_by_table, for any number of windows: fingerprints, then windows, are joined by shuffles."""
    kind = dict(rows.dtypes)["doc_id"]
    sizes = sorted(r["size"] for r in classes.select("size").distinct().collect())  # at most one a length up to the span

    def choose(cols: dict, n: int) -> dict:
        out: dict[str, list] = {"doc_id": cols["doc_id"], "digest": [digest(t) for t in cols["text"]], "n_words": [], "prints": []}
        for text in cols["text"]:
            held, total, found = [], 0, [np.zeros(0, dtype=np.uint64)]
            for piece in pieces(folded(text)):
                new = piece.split()
                total += len(new)
                words = held + new
                found += [np.unique(fingerprints(words, size)) for size in sizes]
                held = words[max(0, len(words) - max(sizes, default=1) + 1) :]
            out["n_words"].append(total)
            out["prints"].append(np.unique(np.concatenate(found)).view(np.int64))
        return out

    texts = materialize(map_arrow(rows, f"doc_id {kind}, digest binary, n_words bigint, prints array<bigint>", choose), "prints")
    copies = materialize(texts.groupBy("digest").agg(F.count("*").alias("n")), "copies")
    prints = texts.select("digest", F.explode("prints").alias("print")).distinct()
    prints = materialize(prints, "prints")
    shared = materialize(prints.groupBy("print").agg(F.count("*").alias("n")).join(classes.select("print").distinct(), "print"), "shared")
    marks = spread_join(prints, shared.select("print"), "print", shared, "digest").groupBy("digest").agg(F.collect_set("print").alias("marks"))
    marks = materialize(marks, "marks")
    keyed = map_arrow(rows, f"doc_id {kind}, digest binary, text string", lambda c, n: c | {"digest": [digest(t) for t in c["text"]]})
    some = spread_join(keyed, marks.select("digest"), "digest", copies, "doc_id").select("digest", "text")
    some = some.dropDuplicates(["digest"]).join(marks, "digest")

    def extend(cols: dict, n: int) -> dict:
        out: dict[str, list] = {"digest": [], "start": [], "size": [], "words": []}
        for key, text, of in zip(cols["digest"], cols["text"], cols["marks"], strict=True):
            p = np.sort(np.array(of, dtype=np.int64).view(np.uint64))
            for start, size, words in candidates(text, dict.fromkeys(sizes, p))[1]:
                for name, value in zip(out, (key, start, size, words), strict=True):
                    out[name].append(value)
        return out

    found = materialize(map_arrow(some, "digest binary, start bigint, size int, words binary", extend), "candidates")
    often = found.groupBy("words").agg(F.count("*").alias("n"))
    found = spread_join(found, classes.select("words", "class"), "words", often, "digest")
    places = F.collect_list(F.struct("start", "size")).alias("places")
    found = found.groupBy("digest").agg(places, F.sort_array(F.collect_set("class")).alias("classes"))

    def cover(cols: dict, n: int) -> dict:
        spans = [merged([(p["start"], p["size"]) for p in places]) for places in cols["places"]]
        return {"digest": cols["digest"], "n_hit": [sum(s["n_words"] for s in x) for x in spans], "spans": spans, "classes": cols["classes"]}

    hits = materialize(map_arrow(found, f"digest binary, n_hit bigint, spans {SPANS}, classes array<bigint>", cover), "hits")
    out = spread_join(texts.select("doc_id", "digest", "n_words"), hits, "digest", copies, "doc_id", "left")
    none = F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans"), F.coalesce("classes", F.expr("cast(array() as array<bigint>)")).alias("classes")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"), *none)


def digest(text: str | None) -> bytes:
    """Of the words of a text."""
    short = blake2b(digest_size=16)
    for piece in pieces(folded(text)):
        short.update(b"".join(w + b" " for w in piece.split()))
    return short.digest()


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", span: int = SPAN, window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items): the runs of words that windows of items cover, and the items as sorted
    strings, of every row of docs."""
    classes, class_items = window_classes(item_windows(items, item_id, item_text, span))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hits = hits_by_table if measured(classes) <= window_bytes else hits_by_join
    found = materialize(hits(rows, classes).withColumn("key", F.when(F.size("classes") > 0, F.md5(F.concat_ws(",", "classes")))), "found")
    sets = materialize(found.where("key is not null").groupBy("key").agg(F.any_value("classes").alias("classes"), F.count("*").alias("n")), "sets")
    parts = sets.select("key", F.explode("classes").alias("class"))
    listed = spread_join(parts, class_items, "class", parts.groupBy("class").agg(F.count("*").alias("n")), "key")
    listed = listed.select("key", F.explode("items").alias("item")).groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = spread_join(found, materialize(listed, "listed"), "key", sets.select("key", "n"), "doc_id", "left")
    return out.select("doc_id", "n_words", "n_hit", "spans", F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    """The contract query: all documents against all benchmark items."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP11_SQL = f"""
with docs as (select row_number() over () as row, doc_id, coalesce({_WORDS.format("text")}, []) as w from documents),
items as (select item_id, coalesce({_WORDS.format("text")}, []) as w from benchmark),
windows as (
    select distinct item_id, least(len(w), 10) as size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as words
    from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)
),
spans as (
    select row, i, size, array_to_string(w[i : i + size - 1], ' ') as words
    from (select row, w, size, unnest(range(1, len(w) - size + 2)) as i from docs, (select distinct size from windows) where len(w) >= size)
),
hits as (select row, i, s.size, words from spans s where words in (select words from windows)),
covered as (select row, count(distinct place) as n_hit from (select row, unnest(range(i, i + size)) as place from hits) group by row),
found as (
    select row, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as sha
    from (select distinct row, cast(item_id as varchar) as item from (select distinct row, words from hits) join windows using (words) where item_id is not null) group by row
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(sha, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (row) left join found using (row)
"""
