"""Batch runs that write the freight and cost tables.

The flow table is the one expensive join; it is written once, partitioned by
year, and every aggregate reads it back, so later steps prune to the years
they use and never recompute the join. Outputs go under ``out_dir`` (a
shared folder on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.operators import freight, routes
from haulage.plans import bindings as B
from haulage.sources.files import read_table, write_table


def freight_summary(flows: DataFrame) -> DataFrame:
    """A9 summary row of the flows of one year: states, rows of the top-lane
    table, tons and value (thousands, 2 dp)."""
    states = freight.state_latest(flows, None).select(F.count(F.lit(1))).scalar()
    lanes = freight.lane_totals(flows, None, 100).select(F.count(F.lit(1))).scalar()
    return (freight.yearly_totals(flows)
            .select(states.alias("state_rows"), lanes.alias("lane_rows"),
                    F.col("tons_m").alias("total_tons"), F.col("value_b").alias("total_value")))


def _one_year(flows: DataFrame, year: int | None) -> DataFrame:
    return freight.latest(flows) if year is None else freight.of_year(flows, year)


def store_freight_tables(spark: SparkSession, sf_dir: str, out_dir: str,
                         year: int | None = None) -> DataFrame:
    """Write flows once, then every freight table from that copy; ``year``
    (by default the last one that has flows) is the year of the tables of one year."""
    write_table(B.flows(spark, sf_dir), f"{out_dir}/flows", partition_by=["year"])
    flows = read_table(spark, f"{out_dir}/flows")
    one = _one_year(flows, year)
    tables = {
        "freight_by_state": freight.state_latest(one, year),
        "freight_lanes": freight.lane_totals(one, year, 100),
        "freight_mode_split": freight.mode_split(one, year),
        "freight_commodities": freight.commodity_split(one, year),
        "freight_yearly": freight.yearly_totals(flows),
        "freight_trade_balance": freight.trade_balance(one, year),
        "freight_lanes_by_mode": freight.top_lanes_every_mode(one, year, 20),
    }
    for name, df in tables.items():
        write_table(df, f"{out_dir}/{name}")
    return freight_summary(one)


def store_cost_tables(spark: SparkSession, sf_dir: str, out_dir: str,
                      year: int | None = None) -> DataFrame:
    """Route table -> costs -> congestion -> lane efficiency, each written;
    later steps read the written tables (one lineage cut per stage)."""
    flows = read_table(spark, f"{out_dir}/flows")
    seen = flows.select("origin", "destination").distinct()
    routed = routes.parse_routing(routes.routing_payload(B.landed_routes(spark, sf_dir, seen)))
    write_table(routes.route_table(seen, routed, B.nation_coords(spark, sf_dir)), f"{out_dir}/state_routes")
    fuel = routes.latest_snapshot(B.nation_fuel_snapshots(spark, sf_dir)).select("state", "diesel")
    write_table(routes.route_costs(read_table(spark, f"{out_dir}/state_routes"), fuel), f"{out_dir}/route_costs")
    costs = read_table(spark, f"{out_dir}/route_costs")
    write_table(routes.congestion(costs), f"{out_dir}/route_congestion")
    cong = read_table(spark, f"{out_dir}/route_congestion")
    lanes = freight.lane_totals(_one_year(flows, year), year, None)
    write_table(routes.lane_efficiency(lanes, cong), f"{out_dir}/lane_efficiency")
    return routes.cost_summary(costs, cong)
