import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from haulage.operators import eda, ml
from haulage.operators.gram import fit_linear, gram


def _frame(n, k, seed, offset=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) * rng.uniform(0.1, 100, k) + offset
    y = x @ rng.normal(size=k) + 3.5 + rng.normal(size=n)
    return pd.DataFrame({**{f"x{i}": x[:, i] for i in range(k)}, "y": y})


@pytest.mark.parametrize("k,offset", [(1, 0.0), (2, 0.0), (5, 0.0), (5, 1e6)])
def test_coefficients_match_numpy(spark, k, offset):
    pdf = _frame(400, k, k, offset)
    model = fit_linear(spark.createDataFrame(pdf).repartition(5), [f"x{i}" for i in range(k)], "y")
    want, *_ = np.linalg.lstsq(np.column_stack([np.ones(400), pdf.drop(columns="y")]), pdf["y"], rcond=None)
    assert model.n_train == 400 and not model.singular
    assert np.allclose(model.coefficients, want[1:], rtol=1e-6, atol=1e-9)
    x = pdf.drop(columns="y").to_numpy()
    assert np.allclose(model.intercept + x @ model.coefficients, np.column_stack([np.ones(400), x]) @ want, rtol=1e-6, atol=1e-5)


def test_singular_matrix_gives_the_smallest_solution(spark):
    pdf = _frame(100, 2, 1)
    pdf["x2"] = 2 * pdf["x0"]
    pdf["x3"] = 4.0
    model = fit_linear(spark.createDataFrame(pdf), ["x0", "x1", "x2", "x3"], "y")
    x = pdf[["x0", "x1", "x2", "x3"]].to_numpy()
    centred, *_ = np.linalg.lstsq(x - x.mean(axis=0), pdf["y"] - pdf["y"].mean(), rcond=1e-10)
    assert model.singular and np.allclose(model.coefficients, centred, atol=1e-8)


def test_no_rows_and_nulls(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, None)], "a double, y double")
    model = fit_linear(df, ["a"], "y")
    assert (model.intercept, model.coefficients, model.n_train) == (None, [None], 0)
    assert [r.coefficient for r in ml.coefficients(spark, model).collect()] == [None, None]
    assert [r._pred for r in ml.predict(df, model).collect()] == [None, None]


def test_pairwise_correlations_match_pandas(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.normal(size=(300, 4)) + 1e5, columns=list("abcd"))
    pdf["b"] += 0.8 * pdf["a"]
    pdf.loc[::3, "a"] = np.nan
    pdf.loc[::5, "c"] = np.nan
    pdf["e"] = 7.0
    df = spark.createDataFrame(pdf).select(*[F.nanvl(c, F.lit(None)).alias(c) for c in "abcde"])
    got = {(r.var1, r.var2): r.correlation for r in eda.correlation_pairs(df, list("abcde"), keep_all=True).collect()}
    want = pdf.corr()
    assert len(got) == 10
    for (a, b), r in got.items():
        assert (r is None) == (want.loc[a, b] != want.loc[a, b]) and (r is None or math.isclose(r, want.loc[a, b], rel_tol=1e-9))


def test_empty_table(spark):
    g = gram(spark.createDataFrame([], "a double, b double"), ["a", "b"])
    assert g.n.sum() == 0 and np.isnan(g.correlation()).all()
    assert eda.correlation_pairs(spark.createDataFrame([], "a double, b double"), ["a", "b"]).collect() == []
