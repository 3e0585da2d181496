import random

import numpy as np
import pytest

from haulage.llm import op04_nra as op

SCHEMA = "vec_id long, v array<long>"


def _plain(rows, queries, k):
    out = []
    for q, qv in queries:
        scores = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if (i, v) != (q, qv)]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def _got(spark, rows, queries, k=5, **kw):
    out = op.top_k(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(queries, SCHEMA), k, **kw)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect())


@pytest.mark.parametrize("spread", [2, 100])
def test_against_brute_force_with_ties_and_small_blocks(spark, spread):
    rng = random.Random(spread)
    rows = [(i, [rng.randint(-spread, spread) for _ in range(6)]) for i in range(300)]
    queries = [r for r in rows if r[0] % 25 == 0]
    assert _got(spark, rows, queries, block_rows=40, query_rows=5) == _plain(rows, queries, 5)


def test_block_keeps_ties_whatever_the_depth():
    rng = np.random.default_rng(1)
    for n in (1, 3, 50, 400):
        x = rng.integers(-3, 4, (n, 5)).astype(float)
        x[n // 2:] = x[0]
        ids = rng.permutation(n)
        q = x[: min(n, 7)]
        keys = op.row_keys(ids, x.astype(int).tolist())
        r, i, s, _ = op.block_top_k(ids, x, keys, q, keys[:len(q)], 4)
        want = _plain([(int(a), b.tolist()) for a, b in zip(ids, x)], [(int(a), b.tolist()) for a, b in zip(ids, q)], 4)
        rank, got = {}, []
        for a, b, c in zip(r, i, s):
            rank[a] = rank.get(a, 0) + 1
            got.append((int(ids[a]), rank[a], b, c))
        assert sorted(got) == want


def test_fewer_rows_than_k_repeated_rows_and_null_ids(spark):
    rows = [(1, [1, 2]), (1, [1, 2]), (2, [3, 4]), (None, [9, 9]), (3, None), (4, [])]
    assert _got(spark, rows, [(1, [1, 2]), (1, [1, 2])]) == [(1, 1, 2, 11)]


def test_components_that_take_no_part(spark):
    rows = [(0, [0.5, -0.5]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, []), (6, [0.001, -0.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r.v for r in df.select("vec_id", op.to_integers(df.embedding).alias("v")).collect()}
    assert got == {0: [128, -128], 1: None, 2: None, 3: None, 4: None, 5: None, 6: [0, -1]}


def test_empty_tables(spark):
    assert _got(spark, [], []) == [] and _got(spark, [(1, [1])], []) == [] and _got(spark, [], [(1, [1])]) == []


def test_rows_of_one_id_are_told_apart(spark):
    rows = [(50, [-1, 5]), (50, [-2, 5]), (1, [1, 1]), (2, [3, 0])]
    assert _got(spark, rows, rows[:2]) == _plain(rows, rows[:2], 5)


def test_bounds_stop_most_queries_early():
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(20, 16))
    x = np.floor(256 * (centre[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 16)) / 4))
    ids = np.arange(3000)
    keys = op.row_keys(ids, x.astype(int).tolist())
    *_, stopped = op.block_top_k(ids, x, keys, x[:200], keys[:200], 5)
    assert (stopped < len(op.DEPTHS)).mean() > 0.9
