"""Storage layout for repeated large joins (co-location by bucketing).

The flow binding joins line items to orders on the order key every time it
runs. Writing both tables bucketed (and sorted) by that key, with the same
bucket count, lets the sort-merge join read matching buckets side by side:
no shuffle of either table. The customer side is bucketed by its key the
same way for the orders-customer join. Tables go to the session catalog
(``spark.sql.warehouse.dir``, a shared folder on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulage.plans import bindings as B


def write_bucketed(spark: SparkSession, sf_dir: str, database: str, buckets: int) -> None:
    """Copy lineitem and orders bucketed + sorted by order key, customer by
    customer key, into ``database``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    specs = [("lineitem", "l_orderkey"), ("orders", "o_orderkey"), ("customer", "c_custkey")]
    for name, key in specs:
        (B.table(spark, sf_dir, name).write.mode("overwrite")
         .bucketBy(buckets, key).sortBy(key).format("parquet")
         .saveAsTable(f"{database}.{name}"))


def flows_bucketed(spark: SparkSession, sf_dir: str, database: str, year: int | None = None) -> DataFrame:
    """``bindings.flows`` with line items, orders and customers read from the
    bucketed copies, so the join of the first two is shuffle-free."""
    def read(spark, sf_dir, name):
        return spark.table(f"{database}.{name}") if name in ("lineitem", "orders", "customer") else B.table(spark, sf_dir, name)
    return B.flows(spark, sf_dir, year=year, read=read, bucketed=True)
