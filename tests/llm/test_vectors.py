import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import ann, neardup_vectors
from textloom.operators.components import smallest_labels

NAN, INF = float("nan"), float("inf")
ODD = [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [NAN] + [1.0] * 15, 1), (904, [INF] + [1.0] * 15, 1), (905, [None] + [1.0] * 15, 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1)]


def vectors(n=600, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 6, 16))
    x = np.concatenate([base] + [base[rng.integers(0, len(base), n // 6)] + rng.normal(0, 0.08, (n // 6, 16)) for _ in range(5)]).astype(np.float32)
    return [(i, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(x, rng.integers(0, labels, len(x))))]


@pytest.mark.parametrize("fewest,block", [(100_000, 2048), (8, 16)])
def test_links_and_components_are_those_of_all_pairs(spark, monkeypatch, fewest, block):
    monkeypatch.setattr(neardup_vectors, "FEWEST", fewest)
    monkeypatch.setattr(neardup_vectors, "BLOCK", block)
    rows = vectors()
    rows += [(700 + i, rows[5][1], rows[5][2]) for i in range(5)] + [(720, rows[5][1], None), (721, (2 * np.array(rows[5][1])).tolist(), rows[5][2])]
    df = spark.createDataFrame([(*r, "clash") for r in rows + ODD], "vec_id long, embedding array<float>, label int, node string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neardup_vectors.near_duplicates(df).collect()}
    assert len(got) == len(rows) + len(ODD)
    own = [r for r in rows if r[2] is not None]
    x = np.array([r[1] for r in own], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    y, ids = np.array([r[2] for r in own]), np.array([r[0] for r in own])
    near = (x @ x.T >= 0.93) & (y[:, None] == y[None, :])
    np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    label = dict(zip(*smallest_labels(ids[a], ids[b])))
    for i, n in zip(ids, near.sum(axis=1)):
        assert got[i] == (n, label.get(i, i), label.get(i, i) == i)
    assert all(got[i] == (0, i, True) for i, _, _ in ODD if i < 907) and got[720] == (0, 720, True)
    assert got[907] == (1, 907, True) and got[908] == (1, 907, False)


def test_nearest_reach_nine_tenths_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 150)
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(500, 16)).astype(np.float32))]
    rows += [(600 + i, rows[10][1], 0) for i in range(20)]
    df = spark.createDataFrame([(*r, 0) for r in rows + ODD + [(None, rows[1][1], 0)]], "vec_id long, embedding array<float>, label int, rank int")
    out = ann.nearest(df, F.col("vec_id") % 10 == 0).collect()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 10 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        at = int(np.flatnonzero(ids == q)[0])
        c = x @ x[at]
        c[at] = -9
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        for _, v, s in found:
            assert v != q and abs(s - c[np.flatnonzero(ids == v)[0]]) < 1e-12
        hits += len({v for _, v, _ in found} & set(ids[np.lexsort((ids, -np.round(c, 12)))[:5]].tolist()))
    assert hits / (5 * len(got)) >= 0.9
    assert [v for _, v, _ in sorted(got[10])] == [600, 601, 602, 603, 604]


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0], 1), (1, [1.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df, F.col("vec_id") == 50).collect()] == [(50, 1, 1)]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0 and neardup_vectors.near_duplicates(df.limit(0)).count() == 0


def test_cells_are_a_labels_own_and_divide_its_work():
    rng = np.random.default_rng(2)
    group = lambda n: neardup_vectors._vectors.unit(np.repeat(rng.normal(size=(8, 32)), n, 0) + rng.normal(0, 0.02, (8 * n, 32)))
    x = group(60)
    c = neardup_vectors.centroids(x, 480, 0.93)
    home, visits = neardup_vectors.cells_of(x, c, 0.93)
    assert len(c) > 1 and visits.sum(axis=1).mean() < 0.7 * len(c) and visits[np.arange(len(x)), home].all()
    # every link is within a cell that both visit, one of them at home
    near = np.argwhere(x @ x.T >= 0.93)
    assert visits[near[:, 0], home[near[:, 1]]].all()
    assert len(neardup_vectors.centroids(x[:100], 100, 0.93)) == 1


def test_vectors_of_several_lengths_and_shared_ids(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0, 0.0, 0.0]), (3, [0.9, 0.1, 0.0]), (4, [0.0, 1.0, 0.0]), (10, [5.0, 0.0, 0.1]), (10, [0.0, 1.0, 0.1]), (10, [0.0, 1.0, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df, F.col("vec_id") % 10 == 0, 3).collect())
    # 10 has two different vectors: each asks, and finds the other among the rest
    assert got == [(0, 1, 1), (10, 1, 2), (10, 1, 4), (10, 2, 3), (10, 2, 3), (10, 3, 10), (10, 3, 10)]
