"""Property tests: distributed ranks and quantiles against pandas on random
data with ties, nulls and one hot value, for several partition counts."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from haulage.operators.ranking import global_row_number, grouped_quantiles, value_ranks

values = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=60)
cfg = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@cfg
@given(vals=values, hot=st.integers(0, 40), parts=st.sampled_from([1, 2, 5]))
def test_value_ranks_match_pandas(spark, vals, hot, parts):
    vals = vals + [2.0] * hot
    pdf = pd.DataFrame({"id": range(len(vals)), "x": pd.Series(vals, dtype="float64")})
    got = {r.id: r for r in value_ranks(spark.createDataFrame(pdf), "x", partitions=parts).collect()}
    s = pdf["x"]
    exp_min, exp_avg = s.rank(method="min"), s.rank(method="average")
    n = s.notna().sum()
    for i in range(len(vals)):
        r = got[i]
        if pd.isna(s[i]):
            assert r.rank is None and r.avg_rank is None
        else:
            assert r.rank == exp_min[i] and math.isclose(r.avg_rank, exp_avg[i])
            assert math.isclose(r.percent_rank, 0.0 if n == 1 else (exp_min[i] - 1) / (n - 1))


@cfg
@given(vals=st.lists(st.integers(-3, 3).map(float), min_size=1, max_size=50), parts=st.sampled_from([1, 3, 7]))
def test_row_number_is_a_permutation(spark, vals, parts):
    pdf = pd.DataFrame({"id": range(len(vals)), "x": vals})
    rows = global_row_number(spark.createDataFrame(pdf), ["x", "id"], partitions=parts).collect()
    exp = pdf.sort_values(["x", "id"]).reset_index(drop=True)
    got = sorted(rows, key=lambda r: r.row_number)
    assert [r.row_number for r in got] == list(range(1, len(vals) + 1))
    assert [r.id for r in got] == list(exp["id"])


@cfg
@given(vals=st.lists(st.floats(-100, 100, allow_nan=False).map(lambda v: round(v, 2)), min_size=1, max_size=40),
       hot=st.integers(0, 30), p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_quantiles_match_pandas(spark, vals, hot, p):
    vals = vals + [7.5] * hot
    pdf = pd.DataFrame({"g": ["a" if i % 3 else "b" for i in range(len(vals))], "v": vals})
    got = {r.g: r.q for r in grouped_quantiles(spark.createDataFrame(pdf), ["g"], "v", {"q": p}, partitions=3).collect()}
    for g, sub in pdf.groupby("g"):
        assert math.isclose(got[g], sub["v"].quantile(p), rel_tol=1e-12, abs_tol=1e-9)
