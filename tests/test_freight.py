from pyspark.sql import functions as F

from haulage import dims
from haulage.operators import freight


def _wide(spark):
    rows = [(6, 48, 1, 2, 1, 10.0, 20.0, 1.0, 2.0), (48, 6, 2, 99, 1, 5.0, 7.0, 0.5, 0.7),
            (6, 3, 1, 2, 1, 1.0, 1.0, 1.0, 1.0), (6, None, 1, 2, 1, 1.0, 1.0, 1.0, 1.0),
            (6, 48, 9, 2, 2, 4.0, 4.0, 4.0, 4.0)]
    return spark.createDataFrame(rows, "dms_origst int, dms_destst int, dms_mode int, sctg2 int, trade_type int, "
                                       "tons_2023 double, tons_2024 double, value_2023 double, value_2024 double")


def test_domestic_label_and_unpivot(spark):
    dom = freight.domestic_flows(_wide(spark), dims.fips_dim(spark))
    assert dom.count() == 2  # unknown code 3, null end and trade_type 2 removed
    lab = freight.label_flows(dom, dims.fips_dim(spark), dims.mode_dim(spark), dims.sctg_dim(spark))
    got = {(r.origin, r.destination, r.mode, r.commodity) for r in lab.collect()}
    assert got == {("CA", "TX", "Truck", "Grains"), ("TX", "CA", "Rail", "Unknown")}
    long = freight.wide_to_long(lab, [2023, 2024], ["origin", "destination", "commodity", "mode"])
    assert long.count() == 4
    y = {r.year: r.tons_m for r in freight.yearly_totals(long).collect()}
    assert y == {2023: 0.02, 2024: 0.03}


def test_trade_balance_sums_to_zero(spark):
    flows = spark.createDataFrame([("A", "B", 10.0, 2024), ("B", "A", 4.0, 2024), ("A", "C", 1.0, 2024),
                                   ("C", "C", 3.0, 2024), ("A", "B", 99.0, 2023)],
                                  "origin string, destination string, tons double, year int")
    bal = {r.state: r for r in freight.trade_balance(flows, 2024).collect()}
    assert sum(r.net_tons for r in bal.values()) == 0
    assert (bal["A"].outbound, bal["A"].inbound) == (11.0, 4.0)
    full = {r.state: r.net_tons for r in freight.trade_balance_full_join(flows, 2024).collect()}
    assert full == {k: v.net_tons for k, v in bal.items()}


def test_top_lanes_every_mode_matches_single(spark):
    rows = [(o, d, "x", m, 2024, float((i * 7) % 11), 1.0) for i, (o, d, m) in enumerate(
        [(o, d, m) for o in "ABCD" for d in "ABCD" for m in ("Truck", "Rail")])]
    flows = spark.createDataFrame(rows, "origin string, destination string, commodity string, mode string, "
                                        "year int, tons double, value double")
    allm = freight.top_lanes_every_mode(flows, 2024, 3)
    for m in ("Truck", "Rail"):
        one = [(r.origin, r.destination) for r in freight.top_lanes_by_mode(flows, 2024, m, 3).collect()]
        many = [(r.origin, r.destination) for r in allm.where(F.col("mode") == m).orderBy("lane_rank").collect()]
        assert one == many


def test_latest_year_follows_the_tables(spark, tmp_path):
    import datetime
    import shutil

    from haulage.plans import bindings as B
    copy = tmp_path / "tables"
    shutil.copytree("/root/testdata/sf0.001", copy)
    before = freight.mode_split(B.flows(spark, str(copy), latest=True), None).agg(F.sum("tons_latest")).first()[0]
    li = spark.read.parquet(str(copy / "lineitem.parquet"))
    last = li.where("l_linestatus = 'F'").agg(F.year(F.max("l_shipdate"))).first()[0]
    new = (li.where("l_linestatus = 'F'").limit(3).withColumn("l_shipdate", F.lit(datetime.datetime(last + 1, 6, 1)).cast("timestamp_ntz"))
           .withColumn("l_quantity", F.lit(7.0)))
    li.unionByName(new).write.parquet(str(copy / "new.parquet"))
    (copy / "lineitem.parquet").unlink()
    (copy / "new.parquet").rename(copy / "lineitem.parquet")
    after = freight.state_latest(B.flows(spark, str(copy), latest=True), None)
    assert {r.year for r in after.collect()} == {last + 1} and after.agg(F.sum("tons")).first()[0] == 21.0 != before
    assert spark.range(1).select(B.latest_year(spark, str(copy))).first()[0] == last + 1


def test_latest_year_reaches_the_scan(spark, tmp_path):
    from haulage.plans import bindings as B
    rows = B.flows(spark, "/root/testdata/sf0.001", latest=True, columns=("year", "tons"))
    assert len({r.year for r in rows.collect()}) == 1  # the plan is final once the subquery has run
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(l_shipdate,ScalarSubquery" in plan
    rows = [(y, float(y)) for y in range(2018, 2025) for _ in range(3)]
    path = str(tmp_path / "flows")
    spark.createDataFrame(rows, "year int, tons double").write.partitionBy("year").parquet(path)
    one = freight.latest(spark.read.parquet(path))
    assert one.agg(F.sum("tons")).first()[0] == 3 * 2024.0
    scan = [x for x in one._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in x]
    assert any("year" in x.split("PartitionFilters")[1] and "ubquery" in x for x in scan), scan
