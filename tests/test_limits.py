"""Limits at target scale: large values, keys, years, and the split over routes."""

from pyspark.sql import functions as F

from haulage.functions import round_half_up
from haulage.operators import freight, ml
from haulage.plans import bindings as B

SF = "/root/testdata/sf0.001"


def test_round_half_up_does_not_saturate(spark):
    cases = [(1e17, 2), (-1e17, 2), (1e13, 6), (1e9, 12), (2.675, 2), (-2.5, 0), (1.005, 2), (None, 2)]
    for x, digits in cases:
        got = spark.createDataFrame([(x,)], "x double").select(round_half_up("x", digits).alias("r")).first().r
        if x is None:
            assert got is None
        elif abs(x) >= 1e9:
            assert got == x
        else:
            import math
            assert got == math.floor(x * 10 ** digits + 0.5) / 10 ** digits


def test_years_outside_the_usual_range_are_kept(spark):
    rows = [("a", "b", 1890, 1.0, 2.0), ("a", "b", 2040, 3.0, 4.0)]
    flows = spark.createDataFrame(rows, "origin string, destination string, year int, tons double, value double")
    years = list(range(1890, 2041))
    long = freight.wide_to_long(freight.long_to_wide(flows, years, ["origin", "destination"]), years, ["origin", "destination"])
    assert {r.year: r.tons for r in long.where("tons > 0").collect()} == {1890: 1.0, 2040: 3.0}


def test_ship_years_cover_the_table(spark):
    seen = {r[0] for r in B.table(spark, SF, "lineitem").select(F.year("l_shipdate")).distinct().collect()}
    assert seen <= set(B.ship_years(spark, SF))


def test_split_uses_both_ends_and_large_keys(spark):
    pairs = [(f"N{i}", f"N{j}") for i in range(25) for j in range(25)]
    df = spark.createDataFrame(pairs, "origin string, destination string")
    train, test = ml.split(df, ["origin", "destination"])
    assert train.count() + test.count() == 625 and 90 <= test.count() <= 160
    for part, least in ((train, 25), (test, 23)):
        for c in ("origin", "destination"):
            assert part.select(c).distinct().count() >= least
    big = spark.createDataFrame([(2 ** 62,), (None,)], "k long")
    a, b = ml.split(big, ["k"])
    assert a.count() + b.count() == 2


def test_foreign_keys_of_line_items_resolve(spark):
    """flows() leaves out joins that its columns do not need; that holds only if every key resolves."""
    t = {n: B.table(spark, SF, n) for n in ("lineitem", "orders", "customer", "supplier", "part")}
    for left, right, key, other in (("lineitem", "orders", "l_orderkey", "o_orderkey"), ("orders", "customer", "o_custkey", "c_custkey"),
                                    ("lineitem", "supplier", "l_suppkey", "s_suppkey"), ("lineitem", "part", "l_partkey", "p_partkey")):
        assert t[left].join(t[right], F.col(key) == F.col(other), "left_anti").count() == 0
        assert t[right].select(other).distinct().count() == t[right].count()


def test_flows_join_only_what_the_columns_need(spark):
    plan = B.flows(spark, SF, columns=("year", "tons"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    plan = B.flows(spark, SF, columns=("origin", "year", "tons"))._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan and "o_orderkey" not in plan and "s_suppkey" in plan


def test_sums_keep_many_decimals_and_large_values(spark):
    from haulage.functions import money_sum
    rows = [(0.12345678,), (1e17,), (0.00000001,), (-1e17,)]
    df = spark.createDataFrame(rows * 3, "v double").repartition(4)
    assert df.agg(money_sum("v").alias("s")).first().s == 0.37037037


def test_clean_removes_scratch_tables(spark):
    from haulage import session
    from haulage.plans import lanes
    first = lanes.lane_quarters(spark, "/root/testdata/sf0.001")
    n = first.count()
    path = session.scratch_path(spark)
    spark.range(3).write.parquet(path)
    assert session.clean(spark)
    assert not lanes._exists(spark, path)
    assert lanes.lane_quarters(spark, "/root/testdata/sf0.001").count() == n
