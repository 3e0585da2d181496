import hashlib
import random

import numpy as np
import pytest

from haulage.llm import op13_shallot_clusters as op

SCHEMA = "vec_id long, embedding array<double>, cluster string, V int"


def _plain(rows, k, rounds, scale, dims, seed=1):
    """Every distance of every round, in Python integers."""
    import math
    kept = []
    for i, x in rows:
        if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [math.floor(scale * c) if abs(c) < 1 << 53 else int(c) * scale for c in x]))
    name = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "")
    cents = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for step in range(rounds + 1):
        got = [min((far(v, c), j) for j, c in enumerate(cents)) for _, v in kept]
        if step < rounds:
            cents = [[sum(v[d] for (_, v), g in zip(kept, got) if g[1] == j) // max(1, sum(g[1] == j for g in got)) for d in range(dims)]
                     if any(g[1] == j for g in got) else c for j, c in enumerate(cents)]
    fits = lambda d: d if d < 1 << 63 else None
    return sorted(((i, j, fits(d)) for (i, _), (d, j) in zip(kept, got)), key=str), cents


def _got(spark, rows, **kw):
    df = spark.createDataFrame([(i, x, "c", 1) for i, x in rows], SCHEMA)
    out = op.cluster(df, **kw)
    return sorted(((r.vec_id, r.cluster, r.distance) for r in out.rows.collect()), key=str), out.centroids


@pytest.mark.parametrize("spread,dims,k", [(1.0, 3, 7), (40.0, 8, 16), (0.05, 2, 5)])
def test_against_brute_force_with_ties(spark, spread, dims, k):
    rng = random.Random(dims)
    rows = [(i, [rng.uniform(-spread, spread) for _ in range(dims)]) for i in range(400)]
    rows += rows[:40] + [(1000 + i, rows[3][1]) for i in range(200)]  # repeated rows, a hot vector
    kw = dict(k=k, rounds=3, scale=64, dims=dims)
    assert _got(spark, rows, **kw) == _plain(rows, **kw)


def test_bounds_spare_distances():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 3, (200, 4)) for c in range(0, 400, 40)]).astype(np.int64)
    cents = x[rng.permutation(len(x))[:16]].tolist()
    a, s, u, low, cost = op.Search(cents, None, 1 << 20).assign(x, np.zeros(2000, int), np.ones(2000, int), np.full(2000, np.inf), np.zeros(2000))
    moved = [[c + 1 for c in row] for row in cents]
    b, _, _, _, again = op.Search(moved, cents, 1 << 20).assign(x, a, s, u, low)
    plain = ((x[:, None, :] - np.array(moved)[None]) ** 2).sum(axis=2)
    assert (b == plain.argmin(axis=1)).all() and again < cost < plain.size


def test_rows_that_take_no_part_and_null_ids(spark):
    bad = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("-inf"), 1.0])]
    good = [(7, [0.5, -0.26]), (None, [3.0, 3.0]), (8, [0.5, -0.26]), (9, [-1.0, 2.0])]
    for k in (1, 2, 9):
        kw = dict(k=k, rounds=2, scale=64, dims=2)
        assert _got(spark, bad + good, **kw) == _plain(bad + good, **kw)


def test_wide_components_are_exact(spark):
    rows = [(1, [1e30, 2.0]), (2, [1e30, 2.5]), (3, [0.25, -7.0]), (4, [-3e38, 1e16]), (5, [0.3, -7.1]), (6, [1e308, -1e308])]
    for k in (2, 4):
        kw = dict(k=k, rounds=3, scale=64, dims=2)
        assert _got(spark, rows, **kw) == _plain(rows, **kw)


def test_totals_and_hashes(spark):
    rows = [(i, [i / 10, (i * 7 % 13) / 5]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = op.cluster(df, k=4, rounds=3, dims=2)
    out = op.inertia(found).collect()
    assert len(out) == 60 and {r.inertia for r in out} == {sum(r.distance for r in out)}
    for r in out:
        assert r.cluster_inertia == sum(q.distance for q in out if q.cluster == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, found.centroids[r.cluster])).encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert op.inertia(op.cluster(df)).collect() == []
