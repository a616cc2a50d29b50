"""Winnowing against a plain search for windows."""

import random
import re

import pytest
from corpuskiln.llm.decontamination import SPAN, candidates, find_contamination, fingerprints, item_windows, merged, sorted_prints

DOCS, ITEMS = "doc_id bigint, text string, items string", "item_id bigint, text string, n_words int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, span=SPAN):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - span + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + span]), set()).add(item)
    sizes, out = {len(k) for k in windows}, []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        spans = merged([(i, 1) for i in hit])
        out.append((doc, len(w), len(hit), [(s["first_word"], s["n_words"]) for s in spans], sorted(str(f) for f in found if f is not None)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, [tuple(s) for s in r.spans], r["items"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(3)
    few = [f"w{i}" for i in range(4)] + ["É1", "Straße", "x-y", "Ä.Ö"]
    some = lambda n: " ".join(rng.choice(few) for _ in range(n))
    items = [(i, some(rng.choice([1, 2, 3, 5, 9, 10, 11, 30]) if i % 3 else 14)) for i in range(40)]
    items += [(40, None), (41, ""), (42, "..."), (None, some(12)), (3, some(20)), (5, items[7][1]), (6, items[7][1])]
    docs = [(i, some(rng.choice([0, 1, 4, 12, 60]))) for i in range(60)]
    passage = next(t for _, t in items if t and len(words(t)) > 20)
    docs += [(60 + i, f"intro {i} {passage} end, {passage.upper()}") for i in range(5)]
    docs += [(70, None), (71, ""), (None, passage), (60, passage), (60, passage), (72, "a,b;" * 300 + passage.replace(" ", "\n,"))]
    return docs, items


@pytest.mark.parametrize("window_bytes", [10**9, 0])
def test_equals_plain_search(spark, cases, window_bytes):
    docs, items = cases
    d = spark.createDataFrame([(*x, "clash") for x in docs], DOCS)
    # items of a few words of a small alphabet are everywhere; the longer ones are tested without them too
    for kept in (items, [x for x in items if len(words(x[1])) >= 9 or x[0] in (40, 41, 42)]):
        found = find_contamination(d, spark.createDataFrame([(*x, 0) for x in kept], ITEMS), window_bytes=window_bytes)
        assert rows(found) == plain(docs, kept)


@pytest.mark.parametrize("window_bytes", [10**9, 0])
def test_empty_tables(spark, cases, window_bytes):
    docs, items = cases
    d, i = spark.createDataFrame([(*x, "") for x in docs], DOCS), spark.createDataFrame([(*x, 0) for x in items], ITEMS)
    assert find_contamination(d.limit(0), i, window_bytes=window_bytes).count() == 0
    found = find_contamination(d, i.limit(0), window_bytes=window_bytes).collect()
    assert len(found) == len(docs) and not any(r.n_hit or r["items"] for r in found)


def test_every_shared_span_shares_its_fingerprint():
    rng = random.Random(5)
    a = [b"%d" % rng.randrange(9) for _ in range(300)]
    for size in range(1, SPAN + 1):
        i = rng.randrange(200)
        b = [b"x"] * 7 + a[i : i + size] + [b"y"] * 9
        assert fingerprints(a, size)[i] == fingerprints(b, size)[7]
        assert len(fingerprints(a, size)) == 300 - size + 1


def test_very_long_text_in_pieces(spark):
    """4 MB of one text: passages at piece bounds, a word of 2 MB, no white space at all."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    text = ",".join([*(f"n{rng.randrange(10**6)}" for _ in range(120_000)), *passage, "z" * 2_000_000, *(f"n{rng.randrange(10**6)}" for _ in range(60_000)), *passage])
    items = spark.createDataFrame([(1, " ".join(passage), 0)], ITEMS)
    for bound in (10**9, 0):
        r = find_contamination(spark.createDataFrame([(1, text, "")], DOCS), items, window_bytes=bound).first()
        assert (r.n_words, r.n_hit, [s.first_word for s in r.spans]) == (180_081, 80, [120_000, 180_041])
    known = item_windows(items).collect()
    prints = sorted_prints([w["size"] for w in known], [w["print"] for w in known])
    for at in range(0, 30):  # the passage across the bound of a piece, at every place of it
        long = " ".join([*["f" * 99] * 10485, *(["g"] * at), *passage])
        total, found = candidates(long, prints)
        assert total == 10485 + at + 40 and [x[0] for x in found] == list(range(10485 + at, 10485 + at + 31))


def test_hot_passage(spark):
    """A third of all rows hold one passage: windows of one item are one class, so a row carries one number for it."""
    passage = " ".join(f"q{i}" for i in range(60))
    docs = spark.range(3000).selectExpr("id as doc_id", f"concat('doc ', id, if(id % 3 = 0, ' {passage}', ' nothing')) as text", "'' as items")
    for bound in (10**9, 0):
        found = find_contamination(docs, spark.createDataFrame([(8, passage, 0)], ITEMS), window_bytes=bound)
        assert found.where("n_hit = 60").count() == 1000 and found.where("n_hit = 0").count() == 2000
