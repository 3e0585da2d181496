"""Quantiles by refinement against pandas: ties, nulls, one value, extremes, few bins."""

import math
import random

import pandas as pd
import pytest

from haulage.operators import selection

PROBS = {"p0": 0.0, "p10": 0.1, "q1": 0.25, "m": 0.5, "q3": 0.75, "p90": 0.9, "p100": 1.0}


def _check(spark, cols, **kw):
    n = max(map(len, cols.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in cols.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in cols))
    got = selection.select_quantiles(df, dict.fromkeys(cols, PROBS), **kw)
    for c, values in cols.items():
        s = pd.Series([v for v in values if v is not None], dtype="float64")
        assert got[c]["n"] == len(s)
        for name, p in PROBS.items():
            if len(s) == 0:
                assert got[c][name] is None
            else:
                want = s.sort_values().reset_index(drop=True)
                lo, hi = math.floor((len(s) - 1) * p), math.ceil((len(s) - 1) * p)
                exact = want[lo] + (want[hi] - want[lo]) * ((len(s) - 1) * p - lo) if want[lo] != want[hi] else want[lo]
                assert got[c][name] == exact, (c, name)


@pytest.mark.parametrize("bins,finish", [(2, 0), (3, 1), (16, 4), (1024, 2048)])
def test_against_pandas(spark, bins, finish):
    rng = random.Random(bins)
    cols = {"uniform": [rng.random() for _ in range(400)], "ties": [float(rng.randint(-3, 3)) for _ in range(400)] + [2.0] * 200,
            "one": [7.5] * 50, "none": [None, None], "single": [1.25], "nulls": [None if i % 3 else i / 7 for i in range(300)],
            "heavy.tail": [rng.lognormvariate(0, 4) for _ in range(300)] + [1e12, -1e12]}
    _check(spark, cols, bins=bins, finish=finish)


def test_extremes_and_neighbours(spark):
    tiny = 5e-324
    cols = {"wide": [-1.7e308, 1.7e308, 0.0, 1.0, -1.0, 1e-300], "next": [0.0, tiny, 2 * tiny, tiny], "close": [1.0, math.nextafter(1.0, 2), 1.0]}
    _check(spark, cols, bins=4, finish=0)


def test_infinite_values_count(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (float("inf"),), (float("nan"),)], "x double")
    got = selection.select_quantiles(df, {"x": {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}})["x"]
    assert (got["a"], got["b"], got["c"], got["d"], got["e"]) == (-math.inf, 1.0, 2.0, math.inf, math.inf)


def test_a_scan_shuffles_bins_not_values(spark, monkeypatch):
    sizes = []
    real = selection._place
    monkeypatch.setattr(selection, "_place", lambda r, groups: sizes.append(len(groups)) or real(r, groups))
    df = spark.range(200_000).selectExpr("cast(id * 7919 % 200003 as double) as x", "cast(id as double) as y")
    got = selection.select_quantiles(df, {"x": {"m": 0.5}, "y": {"m": 0.5}}, bins=64, finish=100)
    want = pd.Series([i * 7919 % 200003 for i in range(200_000)]).median()
    assert got["x"]["m"] == want and got["y"]["m"] == 99999.5 and max(sizes) <= 100


def test_empty_table(spark):
    got = selection.select_quantiles(spark.createDataFrame([], "x double"), {"x": {"m": 0.5}})
    assert got == {"x": {"n": 0, "m": None}}
    assert selection.quantile_rows(spark.createDataFrame([], "x double"), ["x"], {"m": 0.5}).collect() == []
