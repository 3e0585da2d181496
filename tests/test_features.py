import math

import pandas as pd

from haulage.operators import features


def test_basic_features(shipping):
    f = features.basic_features(shipping)
    for c in ("efficiency_score", "log_population", "log_rank", "rank", "state"):
        assert c in f.columns
    rows = f.collect()
    assert all(r.log_population is not None and math.isfinite(r.log_population) for r in rows)
    assert all(r.log_rank is not None and math.isfinite(r.log_rank) for r in rows)


def test_regional_features(shipping):
    f = features.regional_features(shipping, code="postal")
    assert {r.state: r.region for r in f.collect()}["CA"] == "West"
    south = [r for r in f.collect() if r.region == "South"]
    assert math.isclose(south[0].region_population_mean, (26956958.0 + 19893297.0) / 2)


def test_statistical_features_match_pandas(spark):
    vals = [5.0, 3.0, 3.0, 9.0, None, 1.0, 3.0]
    df = spark.createDataFrame([(i, v, i + 1) for i, v in enumerate(vals)], "state int, population double, rank int")
    got = {r.state: r for r in features.statistical_features(df).collect()}
    s = pd.Series(vals, dtype="float64")
    exp = s.rank(pct=True)
    z = (s - s.mean()) / s.std()
    for i in range(len(vals)):
        if vals[i] is None:
            assert got[i].population_percentile is None
        else:
            assert math.isclose(got[i].population_percentile, exp[i])
            assert math.isclose(got[i].population_zscore, z[i])


def test_all_features_chain_keeps_rows(shipping, fuel):
    f = features.all_features(shipping, fuel, code="postal")
    assert f.count() == 5
    for c in ("population_per_rank", "region_population_mean", "population_percentile",
              "logistics_index", "fuel_efficiency"):
        assert c in f.columns
    assert shipping.columns == ["rank", "state", "postal", "population", "population_per_rank"]


def test_feature_summary(spark):
    s = {r.feature_type: r.feature_count for r in features.feature_summary(spark).collect()}
    assert s["statistical_features"] == 4 and sum(s.values()) == 16


def test_describe_matches_pandas(spark, shipping):
    from haulage.operators.eda import describe
    got = {r.column: r for r in describe(shipping).collect()}
    pdf = shipping.toPandas()
    for c in ("rank", "population", "population_per_rank"):
        d = pdf[c].describe()
        assert got[c]["count"] == d["count"] and math.isclose(got[c].mean, d["mean"])
        assert math.isclose(got[c].std, d["std"]) and got[c].min == d["min"] and got[c].max == d["max"]
