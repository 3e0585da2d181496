import uuid

from pyspark.sql import functions as F

from haulage.operators import freight
from haulage.plans import bindings as B
from haulage.plans import layout

SF = "/root/testdata/sf0.001"


def test_bucketed_flows_join_without_shuffle(spark, tmp_path):
    db = "b" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path}/{db}'")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force sort-merge joins
    try:
        layout.write_bucketed(spark, SF, db, 8)
        fl = layout.flows_bucketed(spark, SF, db)
        plan = fl._jdf.queryExecution().executedPlan().toString()
        smj = [l for l in plan.split("\n") if "SortMergeJoin" in l]
        assert smj, plan
        # the first join (line items x orders) reads both sides without an Exchange
        assert "Exchange hashpartitioning(l_orderkey" not in plan and "Exchange hashpartitioning(o_orderkey" not in plan
        got = freight.lane_totals(freight.latest(fl), None, None).orderBy("origin", "destination", "commodity", "mode").collect()
        exp = freight.lane_totals(B.flows(spark, SF, latest=True), None, None).orderBy("origin", "destination", "commodity", "mode").collect()
        assert got == exp
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
