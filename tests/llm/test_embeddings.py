import numpy as np

from corpuskiln.llm import embeddings
from corpuskiln.llm.common import table


def brute(rows):
    ids, vecs = [], []
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ids.append(i)
            vecs.append(np.array(v, dtype=np.float64))
    out = {i: (0, i, True) for i, _ in rows}
    if ids:
        x = np.array(vecs)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        link = x @ x.T >= 0.95
        np.fill_diagonal(link, False)
        label = np.array(ids)
        while True:
            new = np.minimum(label, np.where(link, label[None, :], 1 << 60).min(axis=1))
            if (new == label).all():
                break
            label = new
        for k, i in enumerate(ids):
            out[i] = (int(link[k].sum()), int(label[k]), label[k] == i)
    return out


def answers(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def test_table_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 20)
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    docs = table(spark, "/root/testdata/sf0.01", "embeddings")
    exact = answers(embeddings.near_vectors(docs, exact=True))
    assert exact == brute(rows)
    got = answers(embeddings.op7_embeddings(spark, "/root/testdata/sf0.01"))
    links = sum(n for n, _, _ in exact.values())
    assert all(got[i][0] <= n for i, (n, _, _) in exact.items()) and sum(n for n, _, _ in got.values()) >= 0.98 * links


def test_dense_vectors_in_few_dimensions(spark, monkeypatch):
    """Many links across cells and blocks."""
    monkeypatch.setattr(embeddings, "CELL", 40)
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    rnd = np.random.default_rng(2)
    rows = [(int(i), rnd.normal(size=4).tolist()) for i in rnd.permutation(600)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, component_id int")
    assert answers(embeddings.near_vectors(df, exact=True)) == brute(rows)


def test_odd_vectors(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0] * 3), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]), (7, one), (8, one), (9, [2.0, 4.0, 6.0]), (10, [-1.0, -2.0, -3.0]), (11, [1e-300, 2e-300, 3e-300]), (12, [1.0])]
    schema = "vec_id long, embedding array<double>"
    got = answers(embeddings.near_vectors(spark.createDataFrame(rows, schema)))
    assert {i: got[i] for i in (7, 8, 9, 11)} == {7: (3, 7, True), 8: (3, 7, False), 9: (3, 7, False), 11: (3, 7, False)}
    assert all(got[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 12))
    assert embeddings.near_vectors(spark.createDataFrame([], schema)).collect() == []
    assert {r["vec_id"] for r in embeddings.one_of_each(spark.createDataFrame(rows, schema)).collect()} == {1, 2, 3, 4, 5, 6, 7, 10, 12}


def test_recall_on_vectors_without_clusters_and_visits_that_do_not_grow(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 60)
    rnd = np.random.default_rng(21)
    x = rnd.normal(size=(3000, 32))
    x[1500:] = x[:1500] / np.linalg.norm(x[:1500], axis=1, keepdims=True) + rnd.normal(size=(1500, 32)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got, exact = answers(embeddings.near_vectors(df)), brute(rows)
    links = sum(n for n, _, _ in exact.values())
    assert links > 1500 and all(got[i][0] <= n for i, (n, _, _) in exact.items())
    assert sum(n for n, _, _ in got.values()) >= 0.97 * links
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = embeddings.fit(unit, 50)
    few, all_ = (embeddings.visits(unit, centre, embeddings.gaps(centre), probes=p)[1].sum() for p in (embeddings.probes_needed(unit, centre), None))
    assert few < 0.6 * all_


def test_every_length_is_compared(spark, monkeypatch):
    """Rarer lengths too: in the sample with cells of their own, out of it in shared ones; equal and near vectors link."""
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=3).tolist()) for i in range(400)]
    for dim in (1, 2, 4, 7, 300):
        rows += [(1000 * dim + i, rnd.normal(size=dim).tolist()) for i in range(12)]
    rows += [(900, [1.0, 2.0]), (901, [1.0, 2.0]), (902, [2.0, 4.1]), (903, [0.0, 0.0]), (904, [5.0] * 20_000), (905, [5.0] * 19_999 + [5.1])]

    def plain():
        out = {}
        for dim in {len(v) for _, v in rows}:
            out |= brute([(i, v) for i, v in rows if len(v) == dim])
        return out

    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    want = plain()
    assert want[901][0] >= 2 and not want[901][2] and want[905][:2] == (1, 904)
    for cell, sample, rare in ((20_000, 20_000, 256), (30, 20_000, 256), (30, 40, 2)):
        monkeypatch.setattr(embeddings, "CELL", cell)
        monkeypatch.setattr(embeddings, "SAMPLE", sample)
        monkeypatch.setattr(embeddings, "RARE", rare)
        assert answers(embeddings.near_vectors(df, exact=True)) == want
