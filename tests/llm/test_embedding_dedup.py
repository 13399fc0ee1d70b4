import numpy as np
import pytest

from cairnlake.llm import embedding_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, groups=12, alone=150, size=16):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=size) for _ in range(alone)]
    for g in range(groups):
        centre = rng.normal(size=size)
        rows += [centre + rng.normal(size=size) * 0.05 for _ in range(2 + g)]
    rows = [[float(np.float32(x)) for x in r] for r in rows]
    rows += [rows[-1], rows[-1], [2 * x for x in rows[-1]], [1e-30 * x for x in rows[-1]]]
    odd = [None, [0.0] * size, [float("nan")] + [1.0] * (size - 1), [float("inf")] * size, [None] + [1.0] * (size - 1), []]
    return list(enumerate(rows + odd + [[1.0, 2.0], [1.0, 2.1]]))


def brute(rows, cosine=0.9):
    unit = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0):
            x = np.float32(v).astype(np.float64)
            x = x / np.abs(x).max()
            unit[i] = x / np.linalg.norm(x)
    links = {i: {j for j, y in unit.items() if j != i and len(x) == len(y) and x @ y >= cosine} for i, x in unit.items()}
    root = {i: i for i, _ in rows}
    for _ in rows:
        for i, near in links.items():
            root[i] = min([root[i], *(root[j] for j in near)])
    return sorted((i, len(links.get(i, ())), root[i], root[i] == i) for i, _ in rows)


@pytest.mark.parametrize("aim,shard", [(2048, 4096), (60, 40)])
def test_equals_brute_force(spark, monkeypatch, aim, shard):
    """One shard; then several, with clusters split into blocks."""
    monkeypatch.setattr(op, "AIM", aim)
    monkeypatch.setattr(op, "SHARD", shard)
    rows = vectors()
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    df = df.selectExpr("*", "1 AS node", "2 AS key", "3 AS v", "4 AS copies", "5 AS shard")
    got = sorted(tuple(r) for r in op.near_vectors(df).collect())
    true = brute(rows)
    assert [(r[0]) for r in got] == [r[0] for r in true]
    assert all(g[1] <= t[1] for g, t in zip(got, true))  # no link below the threshold
    assert sum(g[1] for g in got) >= 0.95 * sum(t[1] for t in true)
    if aim == 2048:
        assert got == true


def test_empty_and_null_keys(spark):
    assert op.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(None, [1.0, 0.0], 0), (4, [1.0, 0.0], 0)], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op.near_vectors(df).collect()}
    assert got == {None: (0, None, False), 4: (0, 4, True)}


def test_repeated_rows_and_the_largest_doubles(spark):
    rows = [(1, [1e200, 0.0]), (2, [2e200, 0.0]), (3, [1.0, 0.0]), (5, [0.0, 1.7e308]), (5, [0.0, 1.7e308]),
            (6, [0.0, float("inf")]), (7, None), (7, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in op.near_vectors(df).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (5, 1, 5, True), (5, 1, 5, True),
                   (6, 0, 6, True), (7, 0, 7, True), (7, 0, 7, True)]


def test_pruning_keeps_the_nearest_and_spreads(spark):
    x = np.array([[1, 0], [0.999, 0.0447], [0.995, 0.0998], [-1, 0]], np.float32)
    near = op.pruned(x)
    assert near[0][0] == 1  # the nearest one
    assert 2 not in near[0]  # hidden behind it


def test_a_dense_group_is_not_cut_up_by_centroids(spark, monkeypatch):
    """A third of the vectors are different near copies of one: they would get a third of the centroids."""
    monkeypatch.setattr(op, "AIM", 60)
    monkeypatch.setattr(op, "SHARD", 150)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    centre /= np.linalg.norm(centre)
    noise = rng.normal(size=(500, 64))
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    x = np.float32(np.concatenate([centre + 0.25 * noise, rng.normal(size=(1000, 64))])).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.9).sum(1) - 1
    assert (true[:500] == 499).all()
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in op.near_vectors(df).collect())
    assert sum(r[1] for r in got) >= 0.99 * true.sum()
    assert [r[2] for r in got] == [0] * 500 + list(range(500, 1500))


def test_a_recall_below_the_contract_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(op, "audited_recall", lambda *_: 0.89)
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors(alone=20)], SCHEMA)
    with pytest.raises(RuntimeError, match="0.89"):
        op.near_vectors(df)


def test_a_large_group_does_not_hide_missed_links_of_small_ones(spark):
    unit = np.eye(64)
    rows = [(i, unit[0].tolist(), 1, 299) for i in range(300)]  # all links of the large group were found
    rows += [(300 + i, unit[1 + i // 2].tolist(), 1, 0) for i in range(100)]  # and none of 50 pairs
    df = spark.createDataFrame(rows, "node long, v array<double>, copies long, n_links long")
    assert op.audited_recall(df.drop("n_links"), df.select("node", "n_links"), 0.9) == 0


def test_least_recall_takes_classes_of_enough_queries():
    assert op.least_recall(np.array([0, 0]), np.array([0, 0])) == 1
    assert op.least_recall(np.array([4, 1, 0]), np.array([4, 0, 0])) == 0.5  # too few for a class of their own
    assert op.least_recall(np.r_[np.ones(20), 99.0], np.r_[np.ones(20), 99.0]) == 1
    wanted = np.r_[np.ones(20), np.full(20, 100)].astype(int)
    assert op.least_recall(wanted, np.r_[np.ones(10), np.zeros(10), np.full(20, 100)].astype(int)) == 0.5
