import math

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from haulage.operators.ranking import global_row_number, grouped_quantiles, value_ranks


def _data(spark):
    # ties, a hot value (a third of the rows) and nulls
    vals = [float(i % 7) for i in range(60)] + [3.0] * 30 + [None] * 5
    return spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")


def test_row_number_matches_window_and_partitioning(spark):
    df = _data(spark).where(F.col("x").isNotNull())
    exp = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy("x", "id"))).collect()}
    for parts in (1, 3, 8):
        got = {r.id: r.row_number for r in global_row_number(df, ["x", "id"], partitions=parts).collect()}
        assert got == exp


def test_value_ranks_match_sql(spark):
    df = _data(spark)
    df.createOrReplaceTempView("rk")
    exp = {r.id: r for r in spark.sql(
        "SELECT id, rank() OVER (ORDER BY x NULLS LAST) AS rk, percent_rank() OVER (ORDER BY x NULLS LAST) AS pr "
        "FROM rk").collect()}
    got = {r.id: r for r in value_ranks(df, "x", count_nulls_in_n=True, partitions=4).collect()}
    for i, r in got.items():
        if r.x is None:
            assert r.rank is None
        else:
            assert r.rank == exp[i].rk and math.isclose(r.percent_rank, exp[i].pr)


def test_descending_ranks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, 1.0)], "id long, x double")
    got = {r.id: r.rank for r in value_ranks(df, "x", descending=True).collect()}
    assert got == {2: 1, 3: 1, 1: 3, 4: 4}


def test_grouped_quantiles_match_pandas(spark):
    pdf = pd.DataFrame({"g": ["a"] * 40 + ["b"] * 9 + ["c"],
                        "v": [float(i % 5) for i in range(40)] + [2.0] * 5 + [1.0, 9.0, 4.0, 7.0] + [3.0]})
    df = spark.createDataFrame(pdf)
    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.g: r for r in grouped_quantiles(df, ["g"], "v", probs, partitions=4).collect()}
    for g, sub in pdf.groupby("g"):
        for name, p in probs.items():
            assert math.isclose(getattr(got[g], name), sub["v"].quantile(p)), (g, name)
        assert got[g].n == len(sub)
    whole = grouped_quantiles(df, [], "v", {"m": 0.5}).first()
    assert math.isclose(whole.m, pdf["v"].quantile(0.5))
