"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within the cells.

Every vector lies in the cell of its nearest centroid, its home, and visits other cells that can hold a
partner. If two unit vectors of cosine >= THRESHOLD, so at most d = sqrt(2 - 2 * THRESHOLD) apart, have
different homes, the plane between the two centroids parts them, and one of them is within d / 2 of it.
With exact=True a vector visits all cells to whose plane it is that near; every pair then meets whatever
the centroids are, but on vectors without clusters that is most cells. By default it visits the nearest of
them only, as many as pairs at the threshold itself need to meet with a chance of RECALL; that is measured
on the sample, with partners in random directions, before all vectors are placed (pairs of a higher cosine
meet more often). Cells are cut into blocks of BLOCK rows; each pair of blocks is one product, in double
precision. From a block come the rows' link counts and, for the classes, one edge a row to the smallest row
of its part of the block's graph, never the pairs.

The centroids are fitted on a bounded sample (SAMPLE vectors with the smallest hashes of their ids);
all vectors are assigned and compared. Their number grows with the table, CELL vectors a cell, up to
MAX_CELLS, so what is broadcast is bounded. Vectors of different lengths have no cosine: each length has cells of its
own, in proportion to its rows; lengths too rare to be in the sample share one cell for each of RARE hashes
of the length, in whose blocks they are told apart.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing
(n_links 0, component_id their own id), and vectors of different lengths not with one another; equal
vectors are linked, and merged before all else, so that copies are counted but not compared; of equally near
centroids the first is the home; ids are unique (equal rows count as one another's partners, rows that
share an id with different vectors get the links of all of them); an empty table gives an empty result;
further columns of the input are ignored; a vector takes its dimensions times 8 bytes for each cell of a
worker's slice, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import as_array, materialize, spread_join, table
from corpuskiln.llm.components import connected_components

THRESHOLD = 0.95
SAMPLE, CELL, MAX_CELLS, ROUNDS = 20_000, 1500, 4096, 8
BLOCK = 16_384
#: Cells of the lengths that the sample lacks.
RARE = 256
#: Chance that a pair at the threshold meets, and the sampled vectors that it is measured on.
RECALL, PROBED = 0.99, 2000
#: Added to the distance to a plane within which a cell is visited, for rounding.
EPSILON = 1e-9


def unit(rows: list, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, unit vectors) of the usable rows, in double precision."""
    good, out = [], []
    for i, r in enumerate(rows):
        if r is None or not len(r) or (dim is not None and len(r) != dim) or any(x is None for x in r):
            continue
        v = np.array(r, dtype=np.float64)
        size = np.abs(v).max()
        if not np.isfinite(size) or size == 0:
            continue
        v = v / size  # no overflow or underflow of the squares
        good.append(i)
        out.append(v / np.sqrt(v @ v))
    return np.array(good, dtype=np.int64), np.array(out) if out else np.zeros((0, dim or 1))


def fit(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centroids by spherical k-means on rows held in memory."""
    cells = max(1, min(cells, len(sample)))
    centre = sample[np.linspace(0, len(sample) - 1, cells).astype(int)]
    for _ in range(ROUNDS):
        home = np.concatenate([(sample[i : i + 4096] @ centre.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(centre)
        np.add.at(total, home, sample)
        size = np.linalg.norm(total, axis=1)
        centre = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], centre)
    return np.unique(centre, axis=0)


def gaps(centre: np.ndarray) -> np.ndarray:
    """[cell, cell] distances of the centroids, from their products."""
    dot = centre @ centre.T
    size = np.diag(dot)
    return np.sqrt(np.maximum(size[:, None] + size[None, :] - 2 * dot, 0))


def to_planes(x: np.ndarray, centre: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home of each row, [row, cell] distance to the plane between its home and the cell; infinite for its home)."""
    dot = x @ centre.T
    home = dot.argmax(axis=1)
    rows = np.arange(len(x))
    far = (dot[rows, home][:, None] - dot) / np.maximum(gap[home], 1e-12)
    far[rows, home] = np.inf
    return home, far


def visits(x: np.ndarray, centre: np.ndarray, gap: np.ndarray, threshold: float = THRESHOLD, probes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(home of each row, [row, cell] whether it visits the cell; never its home): the cells within reach, or the
    nearest of them, as many as probes says."""
    home, far = to_planes(x, centre, gap)
    near = far <= np.sqrt(2 - 2 * threshold) / 2 + EPSILON
    if probes is not None and probes < far.shape[1]:
        few = np.zeros_like(near)
        np.put_along_axis(few, np.argpartition(far, probes, axis=1)[:, :probes], True, axis=1)
        near &= few
    return home, near


def probes_needed(sample: np.ndarray, centre: np.ndarray, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """How many of the nearest cells a vector has to visit so that a pair at the threshold meets with the chance
    ``recall``: measured on sampled vectors and partners of exactly that cosine in random directions."""
    x = sample[:PROBED]
    if not len(x) or len(centre) < 2 or x.shape[1] < 2:
        return len(centre)
    side = np.random.default_rng(11).normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
    y = threshold * x + np.sqrt(1 - threshold**2) * side
    gap, rows = gaps(centre), np.arange(len(x))
    (home_x, far_x), (home_y, far_y) = to_planes(x, centre, gap), to_planes(y, centre, gap)
    rank = lambda far, cell: (far < far[rows, cell][:, None]).sum(axis=1) + 1
    need = np.where(home_x == home_y, 0, np.minimum(rank(far_x, home_y), rank(far_y, home_x)))
    return max(1, int(np.quantile(need, recall, method="higher")))


class Cells:
    """Of each length in the sample: number of its first cell, centroids, their distances, cells to visit."""

    def __init__(self, sample: list, sizes: dict[int, int], threshold: float, recall: float | None):
        self.of: dict[int, tuple[int, np.ndarray, np.ndarray, int | None]] = {}
        self.count = RARE
        for dim in sorted(sizes):
            x = unit(sample, dim)[1]
            if len(x):
                centre = fit(x, min(MAX_CELLS, sizes[dim] // CELL + 1))
                self.of[dim] = self.count, centre, gaps(centre), None if recall is None else probes_needed(x, centre, threshold, recall)
                self.count += len(centre)

    def place(self, x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
        """(home, visits as [row, cell]) of unit vectors of one length, and the number of its first cell."""
        found = self.of.get(x.shape[1])
        if found is None:
            return np.zeros(len(x), dtype=np.int64), np.zeros((len(x), 1), dtype=bool), x.shape[1] * 2_654_435_761 % (1 << 32) % RARE
        first, centre, gap, probes = found
        home, near = visits(x, centre, gap, threshold, probes)
        return home, near, first


def assigned(vectors: DataFrame, cells: Cells, threshold: float) -> DataFrame:
    """(cell, home, vec_id, w, visited array<int>, v binary): a row for the home and each visited cell.

    v holds the components as they are stored, single or double; all arithmetic is in double precision.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(cells)
    kind = dict(vectors.dtypes)["vec_id"]
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(vectors.schema["vec_id"].dataType)
    width = np.dtype(stored(vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rows = part.column("embedding").to_pylist()
                for dim in sorted({len(r) for r in rows if r}):
                    good, x = unit(rows, dim)
                    if not len(good):
                        continue
                    ids = part.column("vec_id").take(pa.array(good)).cast(id_type)
                    home, near, first = shared.value.place(x, threshold)
                    row, cell = np.nonzero(near)
                    row, cell = np.concatenate((np.arange(len(x)), row)), np.concatenate((home, cell)) + first
                    visited = [(np.flatnonzero(n) + first).astype(np.int32) for n in near]
                    raw = [np.array(rows[i], dtype=width).tobytes() for i in good]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell.astype(np.int32)), pa.array((home[row] + first).astype(np.int32)), ids.take(pa.array(row)), part.column("w").take(pa.array(good[row])),
                            as_array([visited[r] for r in row], pa.list_(pa.int32())), pa.array([raw[r] for r in row], pa.binary()),
                        ], names=["cell", "home", "vec_id", "w", "visited", "v"],
                    )

    return vectors.mapInArrow(run, f"cell int, home int, vec_id {kind}, w bigint, visited array<int>, v binary")


def stored(vectors: DataFrame) -> str:
    return "float32" if dict(vectors.dtypes)["embedding"] == "array<float>" else "float64"


def block_parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each of n rows reaches over the links a-b, by label spreading and jumping."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def compared(placed: DataFrame, threshold: float, width: str) -> DataFrame:
    """(vec_id, n, edge): links counted in one pair of blocks, each as often as its other end stands for rows (w),
    and a row of the same class there. Pairs are held for 256 rows at a time."""
    kind = dict(placed.dtypes)["vec_id"]
    size = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = placed.join(F.broadcast(size), "cell")  # a row a cell: at most RARE, MAX_CELLS and a row for each length in the sample
    cut = cut.withColumn("own", F.expr("cast(pmod(xxhash64(vec_id), blocks) as int)")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cut = cut.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "home", "vec_id", "w", "visited", "v")
    dealt = cut.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            group = np.stack([batch.column(c).to_numpy() for c in ("cell", "i", "j")], axis=1)
            edges = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1), len(group)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if held and tuple(group[lo]) != key:
                    yield from by_length(pa.Table.from_batches(held), key)
                    held = []
                key = tuple(group[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from by_length(pa.Table.from_batches(held), key)

    def by_length(t: pa.Table, key) -> Iterator[pa.RecordBatch]:
        size = pc.binary_length(t.column("v"))
        for n in pc.unique(size):
            yield from block(t.filter(pc.equal(size, n)), key)

    def block(t: pa.Table, key) -> Iterator[pa.RecordBatch]:
        cell, i, j = key
        t = t.combine_chunks()
        x = np.frombuffer(b"".join(t.column("v").to_pylist()), dtype=width).reshape(t.num_rows, -1).astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        own, home, ids = t.column("own").to_numpy(), t.column("home").to_numpy(), t.column("vec_id").combine_chunks()
        visited = t.column("visited").combine_chunks()
        # rows at home meet all rows, visitors only those at home; two visitors meet elsewhere
        local_i, all_j = np.flatnonzero((own == i) & (home == cell)), np.flatnonzero(own == j)
        sides = [(local_i, all_j)]
        if i != j:
            sides.append((np.flatnonzero((own == j) & (home == cell)), np.flatnonzero((own == i) & (home != cell))))
        w = t.column("w").to_numpy()
        n, part = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for left, right in sides:
            other = x[right].T
            for at in range(0, len(left), 256):
                a, b = np.nonzero(x[left[at : at + 256]] @ other >= threshold)
                a, b = left[at + a], right[b]
                if i == j:
                    ok = (a < b) | (home[b] != cell)
                    a, b = a[ok], b[ok]
                # of two cells where a pair meets the smaller counts it; those on the left are at home
                mixed = np.flatnonzero(home[b] != cell)
                if len(mixed):
                    rows = np.unique(a[mixed])
                    goes = np.zeros((len(rows), int(home.max()) + 1), dtype=bool)
                    for k, cells in enumerate(visited.take(pa.array(rows)).to_pylist()):
                        goes[k, [c for c in cells if c < goes.shape[1]]] = True
                    guest = home[b[mixed]]
                    keep = np.ones(len(a), dtype=bool)
                    keep[mixed[goes[np.searchsorted(rows, a[mixed]), guest] & (guest < cell)]] = False
                    a, b = a[keep], b[keep]
                if len(a):
                    n += np.bincount(a, w[b], len(x)).astype(np.int64) + np.bincount(b, w[a], len(x)).astype(np.int64)
                    moved = np.flatnonzero(part != np.arange(len(x)))
                    part = block_parts(len(x), np.concatenate((a, moved)), np.concatenate((b, part[moved])))
        if not n.any():
            return
        rows = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(n[rows].astype(np.int64)), ids.take(pa.array(part[rows]))], names=["vec_id", "n", "edge"])

    return dealt.mapInArrow(run, f"vec_id {kind}, n bigint, edge {kind}")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL, exact: bool = False) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; exact: all cells within reach are visited, else as many
    as the recall needs at the threshold."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("embedding"))
    number = lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))  # noqa: E731  (NaN is larger)
    usable = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0)
    # equal vectors are merged: the smallest id stands for all
    rows = rows.withColumn("key", F.when(usable, F.unhex(F.sha2(F.col("embedding").cast("string").cast("binary"), 256))))
    classes = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("w")).where("w > 1")
    classes = materialize(classes, "equal-vectors")
    copies = classes.select("key", F.col("w").alias("n"))
    marked = spread_join(rows, classes, "key", copies, "vec_id", "left")
    alone = marked.where("key is not null and rep is null").select("vec_id", "embedding", F.lit(1).cast("bigint").alias("w"))
    firsts = marked.where("vec_id = rep").dropDuplicates(["key"]).select("vec_id", "embedding", "w")
    points = alone.union(firsts)
    # the sample is chosen by ids alone: whole vectors of no more than the chosen are fetched
    chosen = points.select("vec_id", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id").limit(SAMPLE).select(F.col("vec_id").alias("i")).distinct()
    chosen = F.broadcast(materialize(chosen, "sample"))  # SAMPLE ids at most
    drawn = points.join(chosen, points["vec_id"] == chosen["i"], "left_semi").orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = [r for batch in drawn.select("embedding").toArrow().to_batches() for r in batch.column(0).to_pylist()]
    lengths = points.where(F.size("embedding").isin(sorted({len(r) for r in sample}))).groupBy(F.size("embedding").alias("d")).count().collect()  # those in the sample
    cells = Cells(sample, {r["d"]: r["count"] for r in lengths}, threshold, None if exact else recall)
    found = materialize(compared(assigned(points, cells, threshold), threshold, stored(points)), "vector-links")
    component = connected_components(found.select(F.col("vec_id").alias("a"), F.col("edge").alias("b")))
    links = found.groupBy("vec_id").agg(F.sum("n").alias("n")).select(F.col("vec_id").alias("linked"), "n")
    # one row for each id that has links or stands for several, then the rows of the classes by their own
    known = links.join(component, F.col("linked") == component["node"], "left").select("linked", "n", "component")
    merged = classes.join(known, classes["rep"] == known["linked"], "left")
    merged = merged.select("key", F.col("rep").alias("lead"), (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("m"), F.coalesce("component", "rep").alias("of"))
    merged = materialize(merged, "merged-vectors")
    out = spread_join(rows.select("vec_id", "key"), merged, "key", copies, "vec_id", "left")
    # copies have their answer already: only the others look for theirs, each under an id of its own
    known = materialize(known.withColumnRenamed("linked", "look"), "known")
    out = out.withColumn("look", F.when(F.col("lead").isNull(), F.col("vec_id")))
    out = spread_join(out, known, "look", known.select("look", F.lit(1).alias("n")), "vec_id", "left")
    out = out.select("vec_id", F.coalesce("m", "n", F.lit(0)).alias("n_links"), F.coalesce("of", "component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def one_of_each(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The rows of vectors, all columns, that stand for their group."""
    from corpuskiln.llm.common import without_ids

    return without_ids(vectors, near_vectors(vectors, id_col, vec_col).where("not kept").select("vec_id"), id_col)


def op7_embeddings(spark, sf_dir: str) -> DataFrame:
    """The contract query: all vectors."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
