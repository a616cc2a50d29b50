"""Nearest centroids and rounds against plain integer arithmetic."""

import math
import os
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from corpuskiln.llm import queries
from corpuskiln.llm.centroids import LARGEST, Nearest, clustered, fit
from hypothesis import given, settings
from hypothesis import strategies as st

SCHEMA = "vec_id bigint, embedding array<float>, id string, v int, cluster int"


def plain(rows, clusters, rounds, dims, seed=1, scale=64):
    """{id: (cluster, distance, centroid)} of (id, vector)."""
    kept = []
    for i, x in rows:
        if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) and abs(math.floor(c * scale)) <= LARGEST for c in x):
            kept.append((i, [math.floor(scale * float(np.float32(c))) for c in x]))
    key = lambda r: (sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    now = [v for _, v in sorted((r for r in kept if r[0] is not None), key=key)[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(now))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for k in range(len(now)):
            members = [v for (_, v), c in zip(kept, of, strict=True) if c == k]
            if members:
                now[k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    return sorted(((i, near(v)[1], near(v)[0], now[near(v)[1]]) for i, v in kept), key=repr)


def rows(df):
    return sorted(((r.id, r.cluster, r.distance, r.centroid) for r in df.collect()), key=repr)


def table(spark, data):
    return spark.createDataFrame([(i, x, "clash", 1, 2) for i, x in data], SCHEMA)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 12), st.integers(1, 6), st.sampled_from([2, 40, 10**4, LARGEST]), st.integers(0, 2**32 - 1))
def test_search_is_exact(k, dims, most, seed):
    """Small values make ties, the largest ones test the margins."""
    rng = np.random.default_rng(seed)
    c, x = rng.integers(-most, most + 1, size=(k, dims)), rng.integers(-most, most + 1, size=(40, dims))
    x[:5] = c[rng.integers(0, k, size=5)]
    if seed % 2:  # vectors of equal components: no deviation, the mean decides
        c, x = np.repeat(c[:, :1], dims, axis=1), np.repeat(x[:, :1], dims, axis=1)
    number, distance = Nearest(c)(x)
    exact = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert distance.tolist() == exact.min(axis=1).tolist() and number.tolist() == exact.argmin(axis=1).tolist()


def test_most_centroids_are_rejected_unseen():
    rng = np.random.default_rng(1)
    c = (rng.normal(size=(64, 16)) * 20 + rng.integers(-400, 400, size=(64, 1))).astype(np.int64)
    search = Nearest(c)
    search(c[rng.integers(0, 64, size=2000)] + rng.integers(-5, 6, size=(2000, 16)))
    assert search.seen - search.rejected < 2000 * 64 / 8


@pytest.mark.parametrize("seed", [0, 1])
def test_rounds_equal_plain(spark, seed):
    rng = np.random.default_rng(seed)
    data = [(i, [float(v) for v in rng.integers(-9, 10, size=8) / 32]) for i in range(90)]
    data += [(i, data[0][1]) for i in range(90, 120)]  # copies of one vector
    assert rows(clustered(table(spark, data).repartition(3), clusters=7, dims=8)) == plain(data, 7, 3, 8)


def test_odd_rows(spark):
    good = [(i, [i / 7, -i / 3, 1.0]) for i in range(6)]
    odd = [(10, None), (11, []), (12, [1.0, 2.0]), (13, [1.0, None, 2.0]), (14, [float("nan"), 0.0, 0.0]), (15, [float("inf"), 0.0, 0.0]), (16, [3e38, 0.0, 0.0]), (None, [9.0, 9.0, 9.0]), (2, [5.0, 5.0, 5.0]), (2, [5.0, 5.0, 5.0])]
    for clusters in (1, 4, 50):
        assert rows(clustered(table(spark, good + odd), clusters=clusters, dims=3)) == plain(good + odd, clusters, 3, 3)
    assert clustered(table(spark, odd[:7]), dims=3).count() == 0 and clustered(table(spark, []), dims=3).count() == 0


def test_empty_centroid_stays_and_sums_are_exact(spark):
    """Equal first centroids: the smaller number takes all. Sums beyond 64 bits, floors of negative means."""
    data = [(i, [1.0, 1.0]) for i in range(5)]
    assert {r[1] for r in rows(clustered(table(spark, data), clusters=3, dims=2))} == {0}
    big = [(i, [-2.0**20 - i, 2.0**20 - 3 * i]) for i in range(40)]
    assert rows(clustered(table(spark, big), clusters=2, dims=2)) == plain(big, 2, 3, 2)
    assert fit(spark.createDataFrame([(1, [0.5])], "id bigint, v array<float>"), dims=1).tolist() == [[32]]


def test_query_equals_sql(spark, sf):
    c = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        c.execute(f"create view {name} as select * from '{os.path.join(sf, name)}.parquet'")
    for name in ("op11_decontamination", "op12_centroids", "op13_resampling"):
        df, sql = queries.QUERIES[name](spark, sf), c.execute(queries.ORACLE_SQL[name])
        at = [d[0] for d in sql.description]
        assert sorted(at) == sorted(df.columns)
        assert sorted(map(tuple, df.select(*at).collect()), key=repr) == sorted(sql.fetchall(), key=repr), name
