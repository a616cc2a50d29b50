"""Clusters of integer vectors: Lloyd's rounds whose nearest centroids are found by equal-average equal-variance search.

A component x becomes the integer floor(SCALE * x). Centroids are sorted by the mean of their components. From the
place of a vector's own mean the search goes outward, always to the side whose next mean is nearer. With k components,
means m and m', and deviations v and v' (the norms of what is left when the mean is taken off), the squared distance
is at least k * (m - m')^2, so one side, and with the nearer side the whole search, ends once that is above the best
distance; and at least k * (m - m')^2 + (v - v')^2, by which single centroids are rejected unseen. What remains is
measured exactly, in integers. The inequalities are used in doubles with a margin for their rounding, so that they
never reject a centroid that could be nearest; ties go to the smaller number.

The search runs in the tasks, for all vectors of a batch at once; a task hands on one row a cluster of counts and sums of
its vectors, so what is shuffled doesn't grow with a cluster, and what reaches the driver is the centroids.

Defined cases: vectors that are null, of another length, or with null or non-finite components are left out; so are
vectors with a component beyond LARGEST after scaling, whose distances would not fit 64 bits; a row
with a null id is assigned and counted but can't be a first centroid, and among rows that repeat an id the smaller
vector comes first; of fewer vectors than centroids each is one; equal centroids are both kept, and the smaller number
takes the vectors; a table without such vectors gives no rows; the contract query's sums of distances are null
where they don't fit 64 bits; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialize, released, table

COMPONENTS, SCALE = 64, 64
CLUSTERS, ROUNDS = 16, 3
#: Largest absolute value of a scaled component: squared distances of 64 such components stay below 2^63.
LARGEST = 1 << 27
#: Vectors that one numpy pass works on.
SLAB = 16_384


def integers(col: pa.Array, scale: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept, vectors): which rows of a list column are whole, and the scaled integers of these [row, component]."""
    n = len(col)
    length = np.asarray(pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False))
    fits = np.flatnonzero(length == dims)
    flat = col.take(pa.array(fits)).flatten()
    x = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(fits), dims)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(x * scale)
        good = np.isfinite(x).all(axis=1) & (np.abs(x) <= LARGEST).all(axis=1)
    kept = np.zeros(n, dtype=bool)
    kept[fits[good]] = True
    return kept, x[good].astype(np.int64)


class Nearest:
    """Equal-average equal-variance search among centroids."""

    def __init__(self, centroids: np.ndarray):
        self.dims = centroids.shape[1]
        total = centroids.sum(axis=1)
        self.order = np.argsort(total, kind="stable")
        self.c = centroids[self.order]
        self.mean, self.dev = self.features(self.c)
        self.seen = self.rejected = 0

    def features(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean = x.sum(axis=1) / self.dims
        return mean, np.sqrt(((x - mean[:, None]) ** 2).sum(axis=1))

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of every row."""
        n, k = len(x), len(self.c)
        mean, dev = self.features(x)
        up = np.searchsorted(self.mean, mean)
        down = up - 1
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        # the inequalities hold in exact arithmetic; squares of sums of sizes this large are rounded by less
        slack = 1e-9 * (1 + np.abs(mean) + dev + np.abs(self.mean).max(initial=0) + self.dev.max(initial=0)) ** 2 * self.dims
        live = np.arange(n)
        padded = np.concatenate(([-np.inf], self.mean, [np.inf]))
        while len(live):
            below, above = mean[live] - padded[down[live] + 1], padded[np.minimum(up[live], k) + 1] - mean[live]
            low = below <= above
            gap = np.where(low, below, above)
            by_mean = self.dims * gap**2
            on = by_mean <= best[live] + slack[live]  # else the other side is further still
            live, low, by_mean = live[on], low[on], by_mean[on]
            at = np.where(low, down[live], up[live])
            down[live] -= low
            up[live] += ~low
            real = (at >= 0) & (at < k)
            live, at, by_mean = live[real], at[real], by_mean[real]
            maybe = by_mean + (dev[live] - self.dev[at]) ** 2 <= best[live] + slack[live]
            self.seen += len(at)
            self.rejected += len(at) - int(maybe.sum())
            rows, c = live[maybe], at[maybe]
            d = ((x[rows] - self.c[c]) ** 2).sum(axis=1)
            name = self.order[c]
            nearer = (d < best[rows]) | ((d == best[rows]) & (name < number[rows]))
            best[rows[nearer]], number[rows[nearer]] = d[nearer], name[nearer]
        return number, best


def first_centroids(vectors: DataFrame, n: int, seed: int, dims: int, scale: int) -> np.ndarray:
    """The n whole vectors with the smallest SHA-256 of ``seed:id``; at most n rows reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("key")
    chosen = whole(vectors.where("id is not null"), dims, scale).select(key, "v").orderBy("key", "v").limit(n)
    return np.array([r["v"] for r in chosen.collect()], dtype=np.int64).reshape(-1, dims)


def whole(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """(id, v array<bigint>) of the rows that are kept."""
    kind = dict(vectors.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = integers(batch.column("v"), scale, dims)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * dims)
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(kept)), pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))], names=["id", "v"])

    return vectors.select("id", "v").mapInArrow(released(run), f"id {kind}, v array<bigint>")


def sums(vectors: DataFrame, centroids: np.ndarray, scale: int) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (vectors, component sums)} of the clusters that aren't empty; sums are exact."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = shared.value.shape
        nearest, count, total = Nearest(shared.value), np.zeros(k, dtype=np.int64), [[0] * dims for _ in range(k)]
        for batch in batches:
            _, x = integers(batch.column("v"), scale, dims)
            for start in range(0, len(x), SLAB):
                part = x[start : start + SLAB]
                number, _ = nearest(part)
                count += np.bincount(number, minlength=k)
                for c in np.unique(number).tolist():  # a slab's sums fit 64 bits, a task's may not
                    total[c] = [a + b for a, b in zip(total[c], part[number == c].sum(axis=0).tolist(), strict=True)]
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(used.astype(np.int32)), "n": pa.array(count[used]), "total": pa.array([[str(t) for t in total[c]] for c in used], pa.list_(pa.string()))})

    tasks = vectors.select("v").mapInArrow(released(run), "cluster int, n bigint, total array<string>")
    tasks = tasks.select("cluster", "n", F.posexplode("total").alias("dim", "total"))
    found = tasks.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in found.orderBy("cluster", "dim").collect():  # centroids times components
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """(id, cluster, distance) of the rows that are kept."""
    kind = dict(vectors.dtypes)["id"]
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(shared.value)
        for batch in batches:
            kept, x = integers(batch.column("v"), scale, shared.value.shape[1])
            parts = [nearest(x[i : i + SLAB]) for i in range(0, len(x), SLAB)]
            if parts:
                number, distance = (np.concatenate(p) for p in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(kept)), pa.array(number.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return vectors.select("id", "v").mapInArrow(released(run), f"id {kind}, cluster int, distance bigint")


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1, dims: int = COMPONENTS, scale: int = SCALE) -> np.ndarray:
    """Centroids after the rounds, as integers, of vectors (id, v); an empty array if no row is whole."""
    now = first_centroids(vectors, clusters, seed, dims, scale)
    for _ in range(rounds if len(now) else 0):
        for c, (n, total) in sums(vectors, now, scale).items():
            now[c] = [t // n for t in total]
    return now


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1, dims: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id, cluster, distance, centroid array<bigint>) of every whole vector."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    spark, kind = vectors.sparkSession, dict(rows.dtypes)["id"]
    centroids = fit(rows, clusters, rounds, seed, dims, scale)
    if not len(centroids):
        return spark.createDataFrame([], f"id {kind}, cluster int, distance bigint, centroid array<bigint>")
    names = spark.createDataFrame([(k, c) for k, c in enumerate(centroids.tolist())], "cluster int, centroid array<bigint>")
    return assigned(rows, centroids, scale).join(F.broadcast(names), "cluster").select("id", "cluster", "distance", "centroid")


def digest(centroid: list[int]) -> str:
    return sha256(",".join(map(str, centroid)).encode()).hexdigest()


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    """The contract query: all embeddings."""
    rows = materialize(clustered(table(spark, sf_dir, "embeddings")).withColumn("centroid_sha256", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)).drop("centroid"), "clustered")
    each = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))  # a row a centroid
    parts = {r["cluster"]: int(r["s"]) for r in each.collect()}
    fits = lambda x: x if x < 1 << 63 else None
    known = spark.createDataFrame([(c, fits(s), fits(sum(parts.values()))) for c, s in parts.items()], "cluster int, cluster_inertia bigint, inertia bigint")
    return rows.join(F.broadcast(known), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds(n: int) -> str:
    """A round: all distances, the nearest, the floors of the means; a centroid without vectors stays."""
    far = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    nearest = "near{0} as (select id, v, arg_min(k, d * 1000 + k) as k, min(d) as d from (select r, id, v, k, {1} as d from kept, c{0}) group by r, id, v)"
    out = []
    for i in range(n + 1):
        out.append(nearest.format(i, far))
        if i < n:
            out.append(
                f"m{i} as (select k, j, sum(x) as s, count(*) as n from (select k, unnest(v) as x, unnest(range(1, {COMPONENTS} + 1)) as j from near{i}) group by k, j), "
                f"l{i} as (select k, list(((s - ((s % n) + n) % n) / n)::bigint order by j) as c from m{i} group by k), "
                f"c{i + 1} as (select c{i}.k, coalesce(l{i}.c, c{i}.c) as c from c{i} left join l{i} on c{i}.k = l{i}.k)"
            )
    return ",\n".join(out)


OP12_SQL = f"""
with kept as materialized (
    select row_number() over () as r, vec_id as id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v from embeddings
    where len(embedding) = {COMPONENTS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
c0 as (select row_number() over (order by key, v) - 1 as k, v as c from (select sha256('1:' || id) as key, v from kept where id is not null order by key, v limit {CLUSTERS})),
{_rounds(ROUNDS)}
select id as vec_id, near{ROUNDS}.k::int as cluster, d as distance, (sum(d) over (partition by near{ROUNDS}.k))::bigint as cluster_inertia,
    (sum(d) over ())::bigint as inertia, sha256(array_to_string(c{ROUNDS}.c, ',')) as centroid_sha256
from near{ROUNDS} join c{ROUNDS} on near{ROUNDS}.k = c{ROUNDS}.k
"""
