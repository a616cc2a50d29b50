import numpy as np
import pytest
from corpuskiln.llm import embeddings
from test_embeddings import answers, brute


@pytest.mark.parametrize("kind", ["float", "double"])
def test_copies_among_near_vectors(spark, monkeypatch, kind):
    monkeypatch.setattr(embeddings, "CELL", 40)
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    rnd = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(size=4)]) for i in range(200, 500)]
    rows += [(i, rows[i % 7][1]) for i in range(500, 700)] + [(i, rows[0][1]) for i in range(90)]
    rows += [(900, [0.0] * 4), (901, [0.0] * 4), (902, [float("nan")] * 4), (903, [float("nan")] * 4), (904, [1.0, None, 1.0, 1.0]), (905, [1.0, None, 1.0, 1.0]), (906, None), (907, None)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    assert answers(embeddings.near_vectors(df, exact=True)) == brute(rows)


def test_copies_are_compared_once(spark, monkeypatch):
    """A group of copies is one row where blocks are compared, whatever its size."""
    met = []
    monkeypatch.setattr(embeddings, "assigned", lambda v, *a, f=embeddings.assigned: met.append(v.count()) or f(v, *a))
    df = spark.range(30_000).selectExpr("id as vec_id", "array(1.0D, 2.0D, 3.0D) as embedding")
    got = embeddings.near_vectors(df)
    assert met == [1] and got.count() == 30_000
    assert got.where("n_links <> 29999 or component_id <> 0 or kept <> (vec_id = 0)").count() == 0


def test_near_copies_keep_no_pairs(spark, monkeypatch):
    """The links of a block are folded slab by slab: no call sees the pairs of all of them."""
    fold = embeddings.block_parts

    def seen(n, a, b):
        assert len(a) <= 256 * n + n
        return fold(n, a, b)

    monkeypatch.setattr(embeddings, "block_parts", seen)
    rnd = np.random.default_rng(6)
    rows = [(i, (np.array([1.0, 2.0, 3.0]) + rnd.normal(size=3) * 1e-3).tolist()) for i in range(1500)]
    got = answers(embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert got == {i: (1499, 0, i == 0) for i in range(1500)}
