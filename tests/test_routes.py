import math

from pyspark.sql import functions as F

from haulage import dims
from haulage.operators import routes


def _routes(spark):
    rows = [("CA", "CA", 0.0, 0.0), ("CA", "TX", 100.0, 110.0 / 55), ("TX", "CA", 55.0, 1.3), ("TX", "NY", 10.0, 0.3)]
    return spark.createDataFrame(rows, "origin string, destination string, driving_mi double, driving_hr double")


def test_costs_zero_mile_and_default_diesel(spark):
    diesel = spark.createDataFrame([("TX", 4.0)], "state string, diesel double")
    c = {(r.origin, r.destination): r for r in routes.route_costs(_routes(spark), diesel).collect()}
    z = c[("CA", "CA")]
    assert (z.total_cost, z.cost_per_mi, z.diesel_price, z.fuel_pct) == (0.0, 0.0, None, None)
    ca = c[("CA", "TX")]
    assert ca.diesel_price == dims.DEFAULT_DIESEL
    fuel = 100.0 / 6.5 * 3.5
    assert math.isclose(ca.fuel_cost, round(fuel, 2))
    assert math.isclose(ca.total_cost, round(fuel + 2.0 * 35 + 15.0, 2))
    assert c[("TX", "CA")].diesel_price == 4.0


def test_congestion_tiers_on_bin_edges(spark):
    c = {(r.origin, r.destination): r for r in routes.congestion(routes.route_costs(_routes(spark))).collect()}
    assert c[("CA", "TX")].congestion_ratio == 1.1 and c[("CA", "TX")].congestion_tier == "Low"
    assert c[("TX", "CA")].congestion_ratio == 1.3 and c[("TX", "CA")].congestion_tier == "Moderate"
    assert c[("TX", "NY")].congestion_tier == "High"
    assert c[("CA", "CA")].congestion_ratio == 0.0 and c[("CA", "CA")].congestion_tier is None


def test_routing_json_and_fallback(spark):
    raw = spark.createDataFrame([
        ("CA", "TX", '{"code": "Ok", "routes": [{"distance": 1609.34, "duration": 7200}]}'),
        ("CA", "NY", '{"code": "NoRoute", "routes": []}')], "origin string, destination string, payload string")
    routed = routes.parse_routing(raw)
    assert [(r.routed_mi, r.routed_hr) for r in routed.collect()] == [(1.0, 2.0)]
    pairs = spark.createDataFrame([("CA", "TX"), ("CA", "NY"), ("CA", "CA")], "origin string, destination string")
    t = {(r.origin, r.destination): r for r in routes.route_table(pairs, routed, dims.centers_dim(spark)).collect()}
    assert (t[("CA", "TX")].driving_mi, t[("CA", "CA")].driving_mi) == (1.0, 0.0)
    ny = t[("CA", "NY")]
    assert 2000 < ny.driving_mi < 2600 and math.isclose(ny.driving_hr, round(ny.driving_mi / 55 + 1e-12, 2))


def test_lane_efficiency_zero_divisor(spark):
    cong = routes.congestion(routes.route_costs(_routes(spark)))
    lanes = spark.createDataFrame([("CA", "CA", 5.0), ("CA", "TX", 2.0)], "origin string, destination string, tons_m double")
    e = {r.destination: r for r in routes.lane_efficiency(lanes, cong).collect()}
    assert e["CA"].tons_per_dollar == 0.0 and e["CA"].tons_per_mile == 0.0
    assert e["TX"].tons_per_mile == 0.02


def test_latest_snapshot_and_latest_non_null(spark):
    from haulage.operators.joins import latest_per_key
    snaps = spark.createDataFrame([
        ("CA", "2024-01-01", 5.0, 4.0), ("CA", "2024-01-02", None, 4.5), ("TX", "2024-01-02", 3.0, None)],
        "state string, scraped_at string, regular double, diesel double").withColumn("scraped_at", F.to_timestamp("scraped_at"))
    latest = {r.state: r for r in latest_per_key(snaps, value_cols=["regular", "diesel"]).collect()}
    assert (latest["CA"].regular, latest["CA"].diesel) == (5.0, 4.5)
    assert latest["TX"].diesel is None
    assert routes.latest_snapshot(snaps).count() == 2


def test_dedupe_keep_first_with_hot_key(spark):
    from haulage.operators.joins import dedupe_keep_first
    rows = [("CA", "2024-01-0%d" % (i % 9 + 1), float(i)) for i in range(300)] + [("TX", "2024-01-05", 1.0)]
    df = spark.createDataFrame(rows, "state string, period string, price double")
    got = {r.state: (r.period, r.price) for r in dedupe_keep_first(df, ["state"], ["period"]).collect()}
    assert got == {"CA": ("2024-01-01", 0.0), "TX": ("2024-01-05", 1.0)}


def test_zero_over_zero_stays_null(spark):
    from haulage.functions import inf_to_zero_div
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 0.0), (-5.0, 0.0), (6.0, 3.0)], "a double, b double")
    assert [r.x for r in df.select(inf_to_zero_div("a", "b").alias("x")).collect()] == [None, 0.0, 0.0, 2.0]


def _matrix(spark, pairs, responses):
    raw = spark.createDataFrame(responses, "origin string, destination string, payload string")
    t = routes.route_table(spark.createDataFrame(pairs, "origin string, destination string"), routes.parse_routing(raw), dims.centers_dim(spark))
    return {(r.origin, r.destination): (r.driving_mi, r.driving_hr) for r in t.collect()}


def _ok(miles, hours):
    return '{"code": "Ok", "routes": [{"distance": %f, "duration": %f}]}' % (miles * 1609.34, hours * 3600)


def test_reverse_pair_takes_the_routed_value(spark):
    both = [("CA", "TX"), ("TX", "CA")]
    assert _matrix(spark, both, [("CA", "TX", _ok(123.4, 2.5))]) == {("CA", "TX"): (123.4, 2.5), ("TX", "CA"): (123.4, 2.5)}
    assert _matrix(spark, both, [("TX", "CA", _ok(99.0, 2.0))]) == {("CA", "TX"): (99.0, 2.0), ("TX", "CA"): (99.0, 2.0)}


def test_first_direction_wins_when_both_are_routed(spark):
    answers = [("TX", "CA", _ok(99.0, 2.0)), ("CA", "TX", _ok(123.4, 2.5))]
    got = _matrix(spark, [("TX", "CA"), ("CA", "TX"), ("TX", "CA")], answers)
    assert got == {("CA", "TX"): (123.4, 2.5), ("TX", "CA"): (123.4, 2.5)}


def test_only_directions_that_were_asked_for(spark):
    got = _matrix(spark, [("TX", "CA"), ("NY", "NY"), ("NY", "CA")], [("CA", "TX", _ok(10.0, 1.0)), ("NY", "NY", _ok(5.0, 1.0))])
    assert set(got) == {("TX", "CA"), ("NY", "NY"), ("NY", "CA")}
    assert got[("TX", "CA")] == (10.0, 1.0) and got[("NY", "NY")] == (0.0, 0.0) and got[("NY", "CA")][0] > 2000


def test_route_queries_share_one_stored_lane_table(spark, tmp_path):
    import shutil

    from haulage.plans import lanes
    copy = tmp_path / "tables"
    shutil.copytree("/root/testdata/sf0.001", copy)
    first = lanes.lane_quarters(spark, str(copy))
    again = lanes.lane_quarters(spark, str(copy))
    assert first.inputFiles() == again.inputFiles()
    li = spark.read.parquet(str(copy / "lineitem.parquet"))
    li.withColumn("l_quantity", F.col("l_quantity") * 2).write.parquet(str(copy / "new.parquet"))
    (copy / "lineitem.parquet").unlink()
    (copy / "new.parquet").rename(copy / "lineitem.parquet")
    changed = lanes.lane_quarters(spark, str(copy))
    assert changed.inputFiles() != first.inputFiles()
    assert changed.agg(F.sum("t")).first()[0] == 2 * first.agg(F.sum("t")).first()[0]
