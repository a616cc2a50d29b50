import random

from corpuskiln.llm import near_dedup
from corpuskiln.llm.common import table


def brute(rows):
    sets = {}
    for i, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    shared = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :]}
    for a, b in shared:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def answers(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_documents_against_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    assert answers(near_dedup.op1_minhash(spark, sf)) == brute(rows)


def test_chains_copies_and_odd_rows(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    rows = []
    now = list(base)
    for i in range(40):  # each a little different from the one before
        rows.append((100 - i, " ".join(now)))
        now = list(now)
        now[rnd.randrange(120)] = f"x{i}"
    rows += [(i, " ".join(base)) for i in range(200, 260)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "one Two"), (304, "ONE two"), (305, "one two three"), (306, "É é"), (307, "é é")]
    rows += [(400 + i, " ".join(f"p{k}" for k in range(60)) + " " + " ".join(f"q{rnd.randrange(10**6)}" for _ in range(100))) for i in range(30)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, component_id int, key string")
    assert answers(near_dedup.near_duplicates(df)) == brute(rows)
    kept = near_dedup.one_of_each(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c, k) in brute(rows).items() if k}


def test_empty_table_repeated_rows_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert near_dedup.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f")], schema)
    got = sorted(near_dedup.near_duplicates(df).collect(), key=str)
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"]] == [(1, 1, True)] * 2
    assert sorted(str(r["doc_id"]) for r in near_dedup.one_of_each(df).collect()) == ["1", "None"]


def test_every_pair_within_the_radius_shares_a_key():
    import numpy as np

    rnd = np.random.default_rng(1)
    sig = rnd.integers(0, 1 << 16, (200, near_dedup.K)).astype(np.uint16)
    other = sig.copy()
    for i in range(200):
        at = rnd.choice(near_dedup.K, near_dedup.RADIUS, replace=False)
        other[i, at] ^= 1
    assert all(set(a) & set(b) for a, b in zip(near_dedup.keys(sig), near_dedup.keys(other)))
