import hashlib

import numpy as np
from corpuskiln.llm import fingerprint as fp
from corpuskiln.llm.common import table


def brute(rows):
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        out[i] = (len(t), hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest())
    return out


def test_edits_and_order_against_brute_force(spark, sf, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    plain = {}
    for limit in (2_000_000, 3_000):
        monkeypatch.setattr(fp, "CHUNK_CHARS", limit)
        got = {r["doc_id"]: r for r in fp.op10_fingerprint(spark, sf).collect()}
        assert {i: (r["n_chars"], r["edited_sha256"]) for i, r in got.items()} == brute(rows)
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got.values())
        assert np.median([r["near_edited"] for r in got.values() if r["n_chars"] > 400]) > 0.55
        assert np.mean([r["near_edited"] - r["near_next"] for r in got.values()]) > 0.4
        text = dict(rows)
        by_text = {}
        for i, r in got.items():
            assert by_text.setdefault(text[i], r["fingerprint"]) == r["fingerprint"]
        plain[limit] = {i: tuple(r) for i, r in got.items()}
    assert plain[2_000_000] == plain[3_000]


def test_many_ranges(spark):
    rows = [(i * 3, f"text number {i} " + "word " * (i % 40)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert len(fp.range_bounds(df, "doc_id", 50)) > 5
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in fp.op10_pairs(df, rows_per_range=50).collect()}
    assert got == brute(rows)


def test_anchors_depend_on_the_passage_alone():
    rnd = np.random.default_rng(3)
    text = "".join(chr(97 + x) for x in rnd.integers(0, 26, 600))
    at, h = fp.anchors(fp.code_points(text))
    at2, h2 = fp.anchors(fp.code_points("some other start " + text[100:400] + " and an end"))
    inside = [(a - 100 + 17, x) for a, x in zip(at.tolist(), h.tolist()) if 100 <= a and a + fp.K <= 400]
    assert set(inside) <= set(zip(at2.tolist(), h2.tolist()))
    for a in at:  # closed: the smallest inner substring stands at an edge
        inner = [text[a + k : a + k + fp.S] for k in range(fp.K - fp.S + 1)]
        values = [int(fp.inner_hashes(fp.code_points(x).astype(np.uint64))[0]) for x in inner]
        assert min(values) in (values[0], values[-1])


def test_odd_rows(spark):
    schema = "doc_id long, text string, fingerprint string"
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "short", "x"), (4, "short", "x"), (4, "short", "x"), (None, "z", "x")], schema)
    got = fp.op10_pairs(df).collect()
    assert len(got) == 6
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == "" and by[1]["near_edited"] == 1 and by[1]["near_next"] == 1 and by[2]["near_next"] == 0
    assert by[3]["fingerprint"] == by[4]["fingerprint"] != "" and by[3]["near_next"] == 1
    assert fp.op10_pairs(df.limit(0)).collect() == []
    assert fp.fingerprint(df).count() == 6 and fp.compare(by[3]["fingerprint"], by[4]["fingerprint"]) == 1


def plain_fingerprint(text):
    """Closed syncmers by the definition, with the module's hashes as Python integers."""
    mask = (1 << 64) - 1

    def mix(x):
        x ^= x >> 33
        x = x * 0xFF51AFD7ED558CCD & mask
        x ^= x >> 33
        x = x * 0xC4CEB9FE1A85EC53 & mask
        return x ^ x >> 33

    def run(codes, factor):
        h = 0
        for c in codes:
            h = (h * factor + c) & mask
        return mix(h)

    code, found = [ord(c) for c in text], {}
    for at in range(len(code) - fp.K + 1):
        inner = [run(code[at + k : at + k + fp.S], 0x100000001B3) for k in range(fp.K - fp.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.setdefault(run(code[at : at + fp.K], 0x9E3779B97F4A7C15) >> 32, at)
    if not found and text:
        return [(int.from_bytes(hashlib.blake2b(text.encode(), digest_size=4).digest(), "little"), 0)]
    return sorted(found.items())[: fp.SIZE]


def plain_likeness(a, n_a, b, n_b):
    if not a or not b:
        return float(not a and not b)
    x, y = dict(a), dict(b)
    limit = min([s[-1][0] for s in (a, b) if len(s) >= fp.SIZE] or [max(a[-1][0], b[-1][0])])
    pool = [h for h in set(x) | set(y) if h <= limit]
    step = max(1.0, fp.SLACK * max(n_a, n_b))
    bins = [int((x[h] - y[h]) // step) for h in pool if h in x and h in y]
    return max((sum(k in (v, v + 1) for k in bins) for v in range(min(bins) - 1, max(bins) + 1)), default=0) / len(pool) if bins else 0.0


def test_query_against_brute_force(spark, tmp_path):
    rnd = np.random.default_rng(12)
    word = lambda: "".join(chr(x) for x in rnd.choice([97, 98, 99, 228, 0x1F600], rnd.integers(1, 6)))
    rows = [(int(i), " ".join(word() for _ in range(rnd.integers(0, 160)))) for i in rnd.permutation(50)]
    rows += [(60, rows[0][1]), (61, None), (62, "tiny"), (63, rows[1][1] + " more words")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in fp.op10_fingerprint(spark, str(tmp_path)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        q = len(t) // 4
        new = t[: len(t) - q] + after[:q]
        a, b, c = map(plain_fingerprint, (t, new, after))
        r = got[i]
        assert fp.from_string(r["fingerprint"]) == (a, len(t) if a else 0) and fp.from_string(r["edited_fingerprint"]) == (b, len(new) if b else 0)
        assert r["near_edited"] == plain_likeness(a, len(t), b, len(new)) and r["near_next"] == plain_likeness(a, len(t), c, len(after))


def test_long_texts_in_pieces_have_the_same_fingerprint(spark):
    rnd = np.random.default_rng(13)
    text = "".join(chr(97 + x) for x in rnd.integers(0, 5, 30_000))
    texts = [text, "short one", text[:5000], "", "a" * 4000]
    assert fp.fingerprints(texts, 1000) == fp.fingerprints(texts)
    df = spark.createDataFrame([(1, "lorem ipsum " * 200_000), (2, "x")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_chars"] for r in fp.op10_pairs(df).collect()} == {1: 2_400_000, 2: 1}
