import hashlib
import random
from collections import Counter

from corpuskiln.llm import substrings
from corpuskiln.llm.common import table


def brute(rows):
    first = {}
    split = {i: (t or "").encode().split() for i, t in rows}
    for i, w in split.items():
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(i, first.get(key, i))
    out = {}
    for i, w in split.items():
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def answers(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_documents_against_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    assert answers(substrings.op6_substrings(spark, sf)) == brute(rows)


def test_shared_passages_copies_and_odd_rows(spark):
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(4000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(150):
        w = [word() for _ in range(rnd.randrange(3, 80))]
        if i % 3 == 0:
            at = rnd.randrange(len(w))
            w[at:at] = passage[rnd.randrange(20) : 40 + rnd.randrange(20)]
        if i % 10 == 0:
            w = w + w
        if i % 7 == 0:
            w = ["a"] * rnd.randrange(30) + w
        rows.append((1000 - i, rnd.choice([" ", "  ", "\n", "  "]).join(w)))
    rows += [(2000 + i, rows[4][1]) for i in range(20)]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "a b c"), (5, " ".join(passage))]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(a, b, 0, None) for a, b in rows], "doc_id long, text string, n_removed int, copy string").repartition(5)
    found = substrings.find_repeats(df)
    assert answers(found) == brute(rows)
    for r in found.collect():
        assert sum(s["n_words"] for s in r["spans"]) == r["n_removed"]
    cut = substrings.remove_repeats(df)
    assert cut.columns == df.columns
    expected = brute(rows)
    for r in cut.collect():
        n, gone, sha = expected[r["doc_id"]]
        assert hashlib.sha256(b" ".join((r["text"] or "").encode().split())).hexdigest() == sha


def test_empty_table_repeated_rows_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert substrings.find_repeats(spark.createDataFrame([], schema)).collect() == []
    text = " ".join(f"v{i}" for i in range(20))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text + " tail")], schema)
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in substrings.find_repeats(df).collect())
    assert got == [("1", 0), ("1", 0), ("2", 20), ("None", 0)]


def marked_rows(spark, rows):
    """(doc_id, copy, packed, marks) of texts, every window marked."""
    import numpy as np
    from corpuskiln.llm.common import as_signed

    df = spark.createDataFrame([(i, 0, t) for i, t in rows], "doc_id long, copy long, text string")
    marks = {i: as_signed(np.unique(substrings.Batch([t.encode()]).minimizers())).tolist() for i, t in rows}
    return substrings.packed(df).join(spark.createDataFrame(list(marks.items()), "doc_id long, marks array<long>"), "doc_id")


def test_heavy_prefixes_are_lengthened_until_each_group_fits(spark, monkeypatch):
    """One four-word prefix starts most windows; no group may have more than the bound but one-node groups."""
    rnd = random.Random(9)
    rows = [(i, " ".join(w for k in range(12) for w in ("to", "be", "or", "not", *(f"w{rnd.randrange(40)}" for _ in range(rnd.randrange(1, 9)))))) for i in range(80)]
    passage = " ".join(f"p{k}" for k in range(30))
    rows += [(100 + i, f"{passage} tail{i} {rows[i][1]}") for i in range(20)]
    monkeypatch.setattr(substrings, "GROUP_ROWS", 40)
    monkeypatch.setattr(substrings, "CHUNK_CHARS", 2000)  # small batches, so that little is settled within one
    marked = marked_rows(spark, rows).repartition(8)
    marked = spark.createDataFrame(marked.collect(), marked.schema).repartition(8)
    heavy = substrings.heavy_prefixes(marked)
    assert 1 <= len(heavy) < len(substrings.LADDER)
    suffixes = substrings.suffix_rows(marked, heavy).where("suffix is not null").collect()
    size, lengths = {}, set()
    for r in suffixes:
        prefix = bytes(r["prefix"])
        assert len(prefix) + len(r["suffix"]) == substrings.SYMBOL * substrings.WINDOW
        size[prefix] = size.get(prefix, 0) + 1
        lengths.add(len(prefix) // substrings.SYMBOL)
    assert len(lengths) > 1 and all(n <= 40 or len(p) == substrings.SYMBOL * substrings.WINDOW for p, n in size.items())
    # prefixes of different lengths don't overlap
    assert not any(p != q and q.startswith(p) for p in size for q in size)
    assert answers(substrings.find_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))) == brute(rows)


def test_depths_and_nodes_against_plain_python():
    import numpy as np

    rnd, width = np.random.default_rng(3), substrings.SYMBOL
    words = rnd.integers(0, 2, (60, 13)).astype(np.uint8).tolist() + [[1] * 13] * 3
    rows = sorted([b for w in row for b in [7] * (width - 1) + [w]] for row in words)
    got = substrings.depths(np.array(rows, dtype=np.uint8))
    common = lambda a, b: next((k for k in range(13) if a[width * k : width * k + width] != b[width * k : width * k + width]), 13)
    assert got.tolist() == [common(a, b) for a, b in zip(rows, rows[1:])]
    for least in (1, 2, 13):
        begin, end = substrings.deep_nodes(got, least)
        for a, b in zip(begin, end):
            assert b - a >= 2 and (got[a : b - 1] >= least).all() and (a == 0 or got[a - 1] < least) and (b == len(rows) or got[b - 1] < least)


def test_a_very_long_text(spark):
    words = [f"w{k % 70001}" for k in range(400_000)]
    rows = [(1, " ".join(words[1000:1100])), (2, "\n".join(words)), (3, "x" * 3_000_000)]
    assert answers(substrings.find_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_leaf_order_against_sorting():
    import numpy as np

    rnd = np.random.default_rng(8)
    for n, words in ((0, 3), (1, 3), (50, 3), (388, 3), (388, 2), (388, 10**9), (50, 10**9)):
        h = rnd.integers(0, words, 400).astype(np.uint64)
        h[200:230] = h[20:50]
        at = np.sort(rnd.choice(388, n, replace=False))
        order, depth = substrings.leaf_order(h, at)
        suffix = [h[i : i + 13].tolist() for i in at]
        assert order.tolist() == sorted(range(n), key=lambda k: (suffix[k], k))
        assert [d == 13 for d in depth] == [suffix[a] == suffix[b] for a, b in zip(order, order[1:])]


def test_every_removed_window_lies_under_a_node(spark, sf):
    """No table of windows decides: what a batch removes are leaves of its tree's nodes, the rest comes from the groups' trees."""
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect() if r["text"]]
    rows = [(i, t) for k, (i, t) in enumerate(rows) if t not in {x for _, x in rows[:k]}]
    marked = marked_rows(spark, rows).toPandas().to_dict("list")
    import pyarrow as pa

    tree = substrings.Subtree(marked, pa.int64())
    begin, end = substrings.deep_nodes(tree.depth)
    below = {int(x) for a, b in zip(begin, end, strict=True) for x in tree.leaves[a:b]}
    assert len(tree.gone) > 100 and set(tree.gone.tolist()) <= below
    expected = brute(rows)
    ids = tree.ids.to_pylist()
    for k, i in enumerate(ids):
        places = tree.place[tree.gone[tree.owner[tree.gone] == k]]
        n, gone, _ = expected[i]
        assert int(substrings.removed_mask(n, places.tolist()).sum()) == gone


def test_one_id_with_several_texts(spark):
    """Each row loses its own repeats, in its own places; rows of one id aren't sources of one another."""
    p, q, r = ([f"{c}{k}" for k in range(n)] for c, n in (("p", 15), ("q", 30), ("r", 20)))
    rows = [(1, [*p, "end"]), (2, ["x0", "x1", *p, "y0", "y1"]), (2, q), (2, q), (2, [*q, "more"]), (2, p), (3, [*r, *q]), (3, [*r, "z"]), (None, q)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(4)
    first = {}
    for i, w in rows:
        for k in range(len(w) - 12 if i is not None else 0):
            first[tuple(w[k : k + 13])] = min(i, first.get(tuple(w[k : k + 13]), i))
    want = []
    for i, w in rows:
        gone = {j for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        want.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = [(x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substrings.find_repeats(df).collect()]
    assert sorted(got, key=repr) == sorted(((i, n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in want), key=repr)
    cut = [(x["doc_id"], " ".join(x["text"].split())) for x in substrings.remove_repeats(df).collect()]
    assert sorted(cut, key=repr) == sorted(((i, t) for i, _, _, t in want), key=repr)


def test_only_words_of_windows_to_look_at_go_on(spark):
    """A batch of passages has the leaves, places and removed windows of the whole texts, in fewer words."""
    import pyarrow as pa

    rnd = random.Random(12)
    word = lambda: f"w{rnd.randrange(10**6)}"
    passage = [word() for _ in range(40)]
    rows = []
    for i in range(30):
        w = [word() for _ in range(300)]
        for at in rnd.sample(range(300), i % 4):
            w[at:at] = passage[rnd.randrange(15) : 25 + rnd.randrange(15)]
        rows.append((i, " ".join(w)))
    rows += [(100, " ".join(passage[:13])), (101, " ".join(passage * 2))]
    whole = marked_rows(spark, rows).toPandas()
    shared = [m for m, n in Counter(m for x in whole["marks"] for m in x).items() if n > 1]
    whole["marks"] = [[m for m in x if m in shared] for x in whole["marks"]]
    whole = whole[whole["marks"].map(len) > 0]
    kept = substrings.passages(spark.createDataFrame(whole)).toPandas()
    assert kept["low"].tolist() == [min(x) for x in whole["marks"]]
    a, b = (substrings.Subtree(x.to_dict("list"), pa.int64()) for x in (whole, kept))
    for name in ("owner", "place", "leaves", "depth", "gone", "send", "inside", "lead"):
        assert getattr(a, name).tolist() == getattr(b, name).tolist(), name
    assert a.suffixes().tolist() == b.suffixes().tolist() and len(a.gone)
    assert len(b.h) < len(a.h) / 3


def test_spans_without_fetching_the_texts_again(spark, sf):
    docs = table(spark, sf, "documents")
    key = lambda df: sorted(map(repr, df.select("doc_id", "text_hash", "n_words", "n_removed", "spans").collect()))
    assert key(substrings.find_spans(docs)) == key(substrings.find_repeats(docs))
    tables = []
    real = substrings.packed
    try:
        substrings.packed = lambda df: tables.append(df) or real(df)
        substrings.remove_repeats(docs)
    finally:
        substrings.packed = real
    assert len(tables) == 1


def test_shuffle_files_of_a_table_are_deleted_when_it_stands(spark):
    import time
    from pathlib import Path

    from corpuskiln.storage import materialize

    dirs = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for f in d.rglob("shuffle_*.data")}
    before = files()
    df = materialize(spark.range(10_000).selectExpr("id % 1000 as k").groupBy("k").count(), "counts")
    end = time.time() + 10
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert df.count() == 1000


def test_windows_that_share_short_runs_only_send_no_suffixes(spark, monkeypatch):
    """Phrases of 6 words recur everywhere, whole windows in few documents: only windows around runs of LONG words go into the trees."""
    rnd = random.Random(21)
    phrases = [[f"f{p}_{k}" for k in range(6)] for p in range(5)]
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for i in range(60):
        w = [x for p in rnd.sample(phrases, 5) for x in (*p, *(f"u{i}_{rnd.randrange(10**9)}" for _ in range(8)))]
        if i % 10 == 0:
            w[20:20] = passage[i // 10 : 20 + i // 10]
        rows.append((i, " ".join(w)))
    looked_at = []
    real = substrings.suffix_rows
    monkeypatch.setattr(substrings, "suffix_rows", lambda text, heavy=(): looked_at.extend(r["runs"] for r in text.collect()) or real(text, heavy))
    assert answers(substrings.find_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))) == brute(rows)
    assert len(looked_at) == 6 and all(sum(r[1::2]) <= 20 for r in looked_at)


def test_passages_of_passages(spark):
    """The second round leaves the windows whose longer minimizers are shared, in their places and with all their words."""
    import numpy as np
    import zstandard

    rnd = random.Random(22)
    rows = [(i, " ".join(f"w{rnd.randrange(50)}" for _ in range(rnd.randrange(13, 200)))) for i in range(20)]
    whole = marked_rows(spark, rows).toPandas()
    whole["marks"] = [sorted(rnd.sample(x, (len(x) + 1) // 2)) for x in whole["marks"]]
    once = substrings.passages(spark.createDataFrame(whole), longer=substrings.LONG).toPandas()
    once["marks"] = [sorted(rnd.sample(list(x), (len(x) + 1) // 2)) for x in once["ms"]]
    twice = substrings.passages(spark.createDataFrame(once.drop(columns=["low", "ms"])), substrings.LONG).toPandas().set_index("doc_id")
    marks, longer = (dict(zip(x["doc_id"], x["marks"], strict=True)) for x in (whole, once))
    for i, t in rows:
        b = substrings.Batch([t.encode()])
        want = np.intersect1d(b.place[substrings.marked_windows(b, [marks[i]])], b.place[substrings.marked_windows(b, [longer[i]], substrings.LONG)])
        place, at = substrings.places_of(twice.loc[i, "runs"])
        assert place.tolist() == want.tolist() and len(want)
        words, kept = t.split(), zstandard.ZstdDecompressor().decompress(twice.loc[i, "packed"]).decode().split()
        assert all(kept[q : q + 13] == words[p : p + 13] for p, q in zip(place, at, strict=True))
