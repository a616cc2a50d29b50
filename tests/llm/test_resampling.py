"""Buckets, weights and ranks against plain code."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from corpuskiln.llm.resampling import Buckets, head, resampled, runs

DOCS, TARGET = "doc_id bigint, text string, score string, rank int", "item_id bigint, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, target, longest, buckets, least, percent=10, seed=2024):
    def features(text):
        w = words(text)
        return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x)) for texts in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out, may = [], []
    for k, (i, text) in enumerate(docs):
        weight = sum(gain[bucket(f)] for f in features(text))
        score = None
        if i is not None:
            h = int(sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words(text)) >= least:
                may.append((-score, i, len(features(text)), weight, k))
        out.append([i, len(words(text)), len(features(text)), weight, score, None])
    for r, x in enumerate(sorted(may)[: len(may) * percent // 100]):
        out[x[-1]][-1] = r + 1
    return sorted(map(tuple, out), key=repr)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "Straße", "日本", "x-Y"]
    some = lambda n: " ".join(rng.choice(vocabulary) if rng.random() < 0.9 else f"rare{rng.randrange(10**6)}" for _ in range(n))
    docs = [(i, some(rng.choice([0, 1, 3, 19, 20, 21, 80]))) for i in range(200)]
    docs += [(200, None), (201, ""), (202, "..."), (None, some(40)), (None, some(30)), (5, docs[6][1]), (5, docs[6][1]), (6, some(50))]
    docs += [(300 + i, docs[50][1]) for i in range(90)]  # a third are copies
    return docs, [some(30) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("longest,size,least", [(1, 20_000, 20), (1, 0, 1), (1, 5, 20), (2, 20_000, 20), (2, 3, 20), (3, 7, 5)])
def test_equals_plain(spark, cases, longest, size, least):
    """Whatever is in the head, nothing or all of it, rows are the same."""
    docs, target = cases
    d = spark.createDataFrame([(*x, "clash", 1) for x in docs], DOCS).repartition(3)
    got = resampled(d, spark.createDataFrame(list(enumerate(target)), TARGET), longest=longest, buckets=97, least_words=least, head_words=size)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, target, longest, 97, least)


def test_empty_tables(spark, cases):
    docs, target = cases
    d, t = spark.createDataFrame([(*x, "", 1) for x in docs], DOCS), spark.createDataFrame(list(enumerate(target)), TARGET)
    assert sorted(map(tuple, resampled(d, t.limit(0)).collect()), key=repr) == plain(docs, [], 1, 10_000, 20)
    assert resampled(d.limit(0), t).count() == 0


def test_head_of_common_words(spark):
    """Common words are found over all rows, with summaries that drop rare ones; long words aren't sent."""
    rows = [("a b " * 50 + "z" * 500 + " " + " ".join(f"r{i}x{j}" for j in range(200)),) for i in range(40)]
    found, pairs = head(spark.createDataFrame(rows, "text string").repartition(4), 2, 4)
    assert found[:2] == [b"a", b"b"] and set(pairs[:2]) == {(b"a", b"b"), (b"b", b"a")}


def test_states_go_on():
    known = Buckets({b"a": crc32(b"a")}, {(b"a", b"b"): crc32(b"a b") % 97}, 97)
    for run in [(b"a", b"b"), (b"a", b"c"), (b"c", b"a"), (b"a", b"b", b"c"), (b"c", b"\xc3\x89")]:
        assert known.of_run(run) == crc32(b" ".join(run)) % 97


def test_very_long_text_in_pieces():
    text = ",".join(f"n{i}" for i in range(300_000)) + "," + "y" * 1_500_000 + ",end"
    found = [(w, r) for w, r in runs(text, 2)]
    assert len(found) > 2 and sum(len(w) for w, _ in found) == 300_002 and sum(len(r) for _, r in found) == 300_001
