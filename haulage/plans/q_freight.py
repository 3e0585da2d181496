"""Freight-flow queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from haulage.functions import exact, round_half_up
from haulage.operators import freight
from haulage.plans import bindings as B
from haulage.plans.catalog import ORACLE, query
from haulage.plans.incremental import LaneStates
from haulage.plans.sqlparts import FLOWS, LATEST_YEAR as Y, msum, rhu, with_
from haulage.session import materialize, scratch_path

# Flow columns that a query reads; sides of other columns are not joined.
LANES = ("origin", "destination", "commodity", "mode", "year", "tons")
PAIRS = ("origin", "destination", "year", "tons")
TOTALS = ("year", "tons", "value")


@query("a03_lane_totals", with_(FLOWS) + f"""
SELECT origin, destination, commodity, mode, SUM(tons) AS tons_latest,
       {rhu(f'SUM(tons) / 1000.0', 2)} AS tons_m
FROM flows WHERE year = {Y}
GROUP BY origin, destination, commodity, mode
ORDER BY tons_latest DESC, origin, destination, commodity, mode
LIMIT 100""")
def a03_lane_totals(spark, sf):
    """Top 100 lanes by latest-year tons (sort + limit)."""
    return freight.lane_totals(B.flows(spark, sf, latest=True, columns=LANES), None, 100)


@query("a01_yearly_totals", with_(FLOWS) + f"""
SELECT year, {rhu('SUM(tons) / 1000.0', 2)} AS tons_m, {rhu(msum('value') + ' / 1000.0', 2)} AS value_b
FROM flows GROUP BY year""")
def a01_yearly_totals(spark, sf):
    return freight.yearly_totals(B.flows(spark, sf, columns=TOTALS))


@query("u01_wide_to_long_yearly", with_(FLOWS) + f"""
SELECT year, {rhu('SUM(tons) / 1000.0', 2)} AS tons_m, {rhu(msum('value') + ' / 1000.0', 2)} AS value_b
FROM flows GROUP BY year""")
def u01_wide_to_long_yearly(spark, sf):
    """Land flows in the wide file layout (tons_Y / value_Y), unpivot them back
    with one stack and total by year. The years are the data's; a year without
    flows would show as a row of zeros and is dropped."""
    years = B.ship_years(spark, sf)
    wide = freight.long_to_wide(B.flows(spark, sf, columns=("origin", "destination", *TOTALS)), years, ["origin", "destination"])
    long = freight.wide_to_long(wide, years, ["origin", "destination"])
    total = freight.yearly_totals(long.withColumn("year", F.col("year").cast("int")))
    return total.where("tons_m <> 0 OR value_b <> 0")


@query("a02_state_year_totals", with_(FLOWS) + f"""
SELECT origin AS state, year, SUM(tons) AS tons, {msum('value')} AS value
FROM flows GROUP BY origin, year""")
def a02_state_year_totals(spark, sf):
    return freight.state_year_totals(B.flows(spark, sf, columns=("origin", *TOTALS)))


@query("a02_state_latest", with_(FLOWS) + f"""
SELECT origin AS state, year, SUM(tons) AS tons, {msum('value')} AS value,
       {rhu('SUM(tons) / 1000.0', 2)} AS tons_m, {rhu(msum('value') + ' / 1000.0', 2)} AS value_b
FROM flows WHERE year = {Y} GROUP BY origin, year""")
def a02_state_latest(spark, sf):
    """Latest-year totals per origin, scaled to thousands (2 dp)."""
    return freight.state_latest(B.flows(spark, sf, latest=True, columns=("origin", *TOTALS)), None)


@query("a04_mode_split", with_(FLOWS) + f"""
SELECT mode, SUM(tons) AS tons_latest FROM flows WHERE year = {Y} GROUP BY mode""")
def a04_mode_split(spark, sf):
    return freight.mode_split(B.flows(spark, sf, latest=True, columns=("mode", "year", "tons")), None)


@query("a05_commodity_split", with_(FLOWS) + f"""
SELECT commodity, SUM(tons) AS tons_latest FROM flows WHERE year = {Y} GROUP BY commodity""")
def a05_commodity_split(spark, sf):
    return freight.commodity_split(B.flows(spark, sf, latest=True, columns=("commodity", "year", "tons")), None)


_BAL_SQL = with_(FLOWS, f"""o AS (SELECT origin AS state, SUM(tons) AS outbound FROM flows WHERE year = {Y} GROUP BY origin)""",
                 f"""i AS (SELECT destination AS state, SUM(tons) AS inbound FROM flows WHERE year = {Y} GROUP BY destination)""") + f"""
SELECT coalesce(o.state, i.state) AS state, coalesce(outbound, 0.0) AS outbound,
       coalesce(inbound, 0.0) AS inbound,
       coalesce(outbound, 0.0) - coalesce(inbound, 0.0) AS net_tons,
       {rhu('(coalesce(outbound, 0.0) - coalesce(inbound, 0.0)) / 1000.0', 2)} AS net_tons_m
FROM o FULL OUTER JOIN i ON o.state = i.state"""


@query("a06_trade_balance", _BAL_SQL)
def a06_trade_balance(spark, sf):
    return freight.trade_balance(B.flows(spark, sf, latest=True, columns=PAIRS), None)


@query("j07_trade_balance_full_join", _BAL_SQL)
def j07_trade_balance_full_join(spark, sf):
    return freight.trade_balance_full_join(B.flows(spark, sf, latest=True, columns=PAIRS), None)


@query("a08_top_lanes_truck_mode", with_(FLOWS) + f"""
SELECT origin, destination, SUM(tons) AS tons_latest, {rhu('SUM(tons) / 1000.0', 2)} AS tons_m
FROM flows WHERE year = {Y} AND mode = '1-URGENT'
GROUP BY origin, destination ORDER BY tons_latest DESC, origin, destination LIMIT 20""")
def a08_top_lanes_truck_mode(spark, sf):
    return freight.top_lanes_by_mode(B.flows(spark, sf, latest=True, columns=("mode", *PAIRS)), None, "1-URGENT", 20)


@query("a08_top_lanes_every_mode", with_(FLOWS, f"""l AS (SELECT mode, origin, destination, SUM(tons) AS tons_latest
  FROM flows WHERE year = {Y} GROUP BY mode, origin, destination)""") + f"""
SELECT * FROM (
  SELECT mode, origin, destination, tons_latest,
         CAST(row_number() OVER (PARTITION BY mode ORDER BY tons_latest DESC, origin, destination) AS INTEGER) AS lane_rank,
         {rhu('tons_latest / 1000.0', 2)} AS tons_m
  FROM l) WHERE lane_rank <= 20""")
def a08_top_lanes_every_mode(spark, sf):
    return freight.top_lanes_every_mode(B.flows(spark, sf, latest=True, columns=("mode", *PAIRS)), None, 20)


_LANES_ALL = f"""lanes AS (SELECT origin, destination, commodity, mode, SUM(tons) AS tons_latest,
  {rhu('SUM(tons) / 1000.0', 2)} AS tons_m FROM flows WHERE year = {Y}
  GROUP BY origin, destination, commodity, mode)"""


@query("t05_top8_outbound_per_state", with_(FLOWS, _LANES_ALL) + f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY origin ORDER BY tons_latest DESC,
  origin, destination, commodity, mode) AS INTEGER) AS lane_rank FROM lanes) WHERE lane_rank <= 8""")
def t05_top8_outbound_per_state(spark, sf):
    lanes = freight.lane_totals(B.flows(spark, sf, latest=True, columns=LANES), None, None)
    return freight.top_lanes_per_state(lanes, "origin", "tons_latest", 8)


@query("t06_top12_inbound_per_state", with_(FLOWS, _LANES_ALL) + f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY destination ORDER BY tons_latest DESC,
  origin, destination, commodity, mode) AS INTEGER) AS lane_rank FROM lanes) WHERE lane_rank <= 12""")
def t06_top12_inbound_per_state(spark, sf):
    lanes = freight.lane_totals(B.flows(spark, sf, latest=True, columns=LANES), None, None)
    return freight.top_lanes_per_state(lanes, "destination", "tons_latest", 12)


@query("w08_year_over_year", with_(FLOWS, f"""y AS (SELECT year, {rhu('SUM(tons) / 1000.0', 2)} AS tons_m,
  {rhu(msum('value') + ' / 1000.0', 2)} AS value_b FROM flows GROUP BY year)""") + f"""
SELECT year, tons_m, value_b,
       {rhu('(tons_m - lag(tons_m) OVER (ORDER BY year)) / nullif(lag(tons_m) OVER (ORDER BY year), 0) * 100', 1)} AS yoy_pct
FROM y""")
def w08_year_over_year(spark, sf):
    return freight.year_over_year(freight.yearly_totals(B.flows(spark, sf, columns=TOTALS)))


@query("a42_top10_commodity_share", with_(FLOWS, f"""c AS (SELECT commodity, SUM(tons) AS tons_latest
  FROM flows WHERE year = {Y} GROUP BY commodity ORDER BY tons_latest DESC, commodity LIMIT 10)""",
                                           f"""t AS (SELECT SUM(tons) AS total FROM flows WHERE year = {Y})""") + f"""
SELECT commodity, tons_latest,
       CAST(row_number() OVER (ORDER BY tons_latest DESC, commodity) AS INTEGER) AS display_rank,
       {rhu('tons_latest / SUM(tons_latest) OVER () * 100', 1)} AS share_of_top_pct,
       {rhu('tons_latest / (SELECT total FROM t) * 100', 1)} AS share_of_total_pct
FROM c""")
def a42_top10_commodity_share(spark, sf):
    """Top 10 commodities with a 1-based display index, each one's
    share of the top-10 sum and of the grand total (both named)."""
    t = "tons_latest"
    # one pass over the flows: the (small) commodity table is materialised and
    # both the top 10 and the grand total read it
    comm = materialize(freight.commodity_split(B.flows(spark, sf, latest=True, columns=("commodity", "year", "tons")), None))
    top = comm.orderBy(F.desc(t), "commodity").limit(10)
    total = comm.select(F.sum(t)).scalar()
    top_sum = top.select(F.sum(t)).scalar()
    w = Window.orderBy(F.desc(t), "commodity")  # over the 10-row result only
    return top.select(
        "commodity", t, F.row_number().over(w).cast("int").alias("display_rank"),
        round_half_up(F.col(t) / top_sum * 100, 1).alias("share_of_top_pct"),
        round_half_up(F.col(t) / total * 100, 1).alias("share_of_total_pct"))


@query("a43_mode_summary", with_(FLOWS, f"""l AS (SELECT origin, destination, SUM(tons) AS t FROM flows
  WHERE year = {Y} AND mode = '2-HIGH' GROUP BY origin, destination)""") + f"""
SELECT {rhu('SUM(t) / 1000.0', 2)} AS total_tons_m, COUNT(*) AS lanes FROM l""")
def a43_mode_summary(spark, sf):
    return freight.mode_summary(B.flows(spark, sf, latest=True, columns=("mode", *PAIRS)), None, "2-HIGH")


@query("a09_freight_summary", with_(FLOWS) + f"""
SELECT (SELECT COUNT(DISTINCT origin) FROM flows WHERE year = {Y}) AS state_rows,
  (SELECT COUNT(*) FROM (SELECT 1 FROM flows WHERE year = {Y} GROUP BY origin, destination, commodity, mode LIMIT 100)) AS lane_rows,
  {rhu('SUM(tons) / 1000.0', 2)} AS total_tons, {rhu(msum('value') + ' / 1000.0', 2)} AS total_value
FROM flows WHERE year = {Y}""")
def a09_freight_summary(spark, sf):
    """The summary row of the freight table run (state rows, lane rows,
    latest-year totals)."""
    from haulage.plans.batch import freight_summary
    # the three summaries read the year's lanes, aggregated and stored once
    rows = B.flows(spark, sf, latest=True, columns=(*LANES, "value"))
    lanes = rows.groupBy(*freight.LANE_KEYS, "year").agg(
        F.sum("tons").alias("tons"), F.sum(exact("value")).alias("value"))
    return freight_summary(materialize(lanes))


def lane_states(spark, sf):
    """Flows landed in two loads, the states of their files refreshed after each."""
    path = scratch_path(spark, "flow-files")
    states = LaneStates(spark, path, scratch_path(spark, "lane-states"))
    rows = materialize(B.flows(spark, sf))
    for load in (F.col("quarter") < 4, F.col("quarter") == 4):
        rows.where(load).write.mode("append").parquet(path)
        states.refresh()
    return states.table()


@query("a01_yearly_totals_by_file", ORACLE["a01_yearly_totals"])
def a01_yearly_totals_by_file(spark, sf):
    """A1 from the stored states of the input files."""
    return freight.yearly_totals(lane_states(spark, sf))


@query("a09_freight_summary_by_file", ORACLE["a09_freight_summary"])
def a09_freight_summary_by_file(spark, sf):
    """A9 from the stored states: the second load read its own files only."""
    from haulage.plans.batch import freight_summary
    return freight_summary(materialize(freight.latest(lane_states(spark, sf))))
