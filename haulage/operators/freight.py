"""Freight-flow aggregates.

Input is the long flow table (origin, destination, commodity, mode, year,
tons, value). Every aggregate is a ``groupBy`` with map-side partial
aggregation, so a hot lane or state is combined inside each task before the
shuffle; top-k is ``orderBy().limit()`` (TakeOrderedAndProject, k rows per
task) or a ``row_number`` over already-aggregated lanes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage import dims
from haulage.functions import exact, money_sum, round_half_up, safe_div

LANE_KEYS = ["origin", "destination", "commodity", "mode"]


# ---- ingest-side: wide file rows -> labelled long flows -------------------

def domestic_flows(wide: DataFrame, known_codes: DataFrame) -> DataFrame:
    """Keep trade_type 1, drop null ends, cast to int, keep known codes
    (``known_codes`` has one int column ``fips``; semi joins, no columns added)."""
    f = (wide.where(F.col("trade_type") == 1)
         .dropna(subset=["dms_origst", "dms_destst"])
         .withColumn("dms_origst", F.col("dms_origst").cast("int"))
         .withColumn("dms_destst", F.col("dms_destst").cast("int")))
    codes = known_codes.select("fips")
    return (f.join(codes.withColumnRenamed("fips", "dms_origst"), "dms_origst", "left_semi")
            .join(codes.withColumnRenamed("fips", "dms_destst"), "dms_destst", "left_semi"))


def label_flows(f: DataFrame, fips: DataFrame, modes: DataFrame, sctg: DataFrame) -> DataFrame:
    """Codes to labels via broadcast dimension joins; unknown mode ->
    'Other', unknown commodity -> 'Unknown'."""
    o = fips.select(F.col("fips").alias("dms_origst"), F.col("code").alias("origin"))
    d = fips.select(F.col("fips").alias("dms_destst"), F.col("code").alias("destination"))
    return (f.join(o, "dms_origst", "left").join(d, "dms_destst", "left")
            .join(modes, "dms_mode", "left")
            .join(sctg, "sctg2", "left")
            .withColumn("mode", F.coalesce("mode", F.lit("Other")))
            .withColumn("commodity", F.coalesce("commodity", F.lit("Unknown"))))


def wide_to_long(wide: DataFrame, years: list[int], keys: list[str]) -> DataFrame:
    """tons_Y / value_Y columns -> rows (year, tons, value) with one
    ``stack`` (no per-year union). float32 measures are widened to double."""
    pairs = ", ".join(f"{y}, cast(tons_{y} as double), cast(value_{y} as double)" for y in years)
    return wide.select(*keys, F.expr(f"stack({len(years)}, {pairs}) as (year, tons, value)"))


def long_to_wide(flows: DataFrame, years: list[int], keys: list[str]) -> DataFrame:
    """Per-key tons_Y / value_Y columns (the landed file layout) from long flows."""
    aggs = []
    for y in years:
        aggs.append(F.sum(F.when(F.col("year") == y, F.col("tons")).otherwise(0.0)).alias(f"tons_{y}"))
        aggs.append(F.sum(F.when(F.col("year") == y, exact("value"))
                          .otherwise(0)).cast("double").alias(f"value_{y}"))
    return flows.groupBy(*keys).agg(*aggs)


# ---- aggregates ------------------------------------------------------------
#
# The aggregates of one year take its number. With None the rows are those of
# the wanted year already (``latest`` gives them), so nothing is filtered. Their
# tonnage column is ``tons_<year>`` or ``tons_latest``.

def latest_year(flows: DataFrame) -> Column:
    """The last year that has flows, as a scalar subquery."""
    return flows.select(F.max("year")).scalar()


def latest(flows: DataFrame) -> DataFrame:
    """Flows of the last year. On a stored table with a folder per year the
    subquery runs first, and the scan opens that folder only."""
    return flows.where(F.col("year") == latest_year(flows))


def of_year(flows: DataFrame, year: int | None) -> DataFrame:
    return flows if year is None else flows.where(F.col("year") == year)


def tons_column(year: int | None) -> str:
    return "tons_latest" if year is None else f"tons_{year}"


def yearly_totals(flows: DataFrame) -> DataFrame:
    """A1: per year total tons and value, in thousands, 2 dp."""
    return (flows.groupBy("year")
            .agg(F.sum("tons").alias("_t"), money_sum("value").alias("_v"))
            .select("year", round_half_up(F.col("_t") / 1e3, 2).alias("tons_m"),
                    round_half_up(F.col("_v") / 1e3, 2).alias("value_b")))


def state_year_totals(flows: DataFrame) -> DataFrame:
    """A2: origin state x year totals (state, year, tons, value)."""
    return (flows.groupBy(F.col("origin").alias("state"), "year")
            .agg(F.sum("tons").alias("tons"), money_sum("value").alias("value")))


def state_latest(flows: DataFrame, year: int | None) -> DataFrame:
    """A2 latest-year slice with tons_m / value_b (filter pushed below the aggregate)."""
    return (state_year_totals(of_year(flows, year))
            .withColumn("tons_m", round_half_up(F.col("tons") / 1e3, 2))
            .withColumn("value_b", round_half_up(F.col("value") / 1e3, 2)))


def lane_totals(flows: DataFrame, year: int | None, k: int | None = 100) -> DataFrame:
    """Tons by (origin, destination, commodity, mode) in ``year``,
    top ``k`` (largest first, ties by key), or all lanes in no order; tons_m in
    thousands, 2 dp."""
    t = tons_column(year)
    lanes = (of_year(flows, year)
             .groupBy(*LANE_KEYS).agg(F.sum("tons").alias(t))
             .withColumn("tons_m", round_half_up(F.col(t) / 1e3, 2)))
    return lanes.orderBy(F.desc(t), *LANE_KEYS).limit(k) if k else lanes


def mode_split(flows: DataFrame, year: int | None) -> DataFrame:
    """A4: tons by mode, largest first."""
    t = tons_column(year)
    return (of_year(flows, year).groupBy("mode").agg(F.sum("tons").alias(t))
            .orderBy(F.desc(t), "mode"))


def commodity_split(flows: DataFrame, year: int | None) -> DataFrame:
    """A5: tons by commodity, largest first."""
    t = tons_column(year)
    return (of_year(flows, year).groupBy("commodity").agg(F.sum("tons").alias(t))
            .orderBy(F.desc(t), "commodity"))


def trade_balance(flows: DataFrame, year: int | None) -> DataFrame:
    """Outbound, inbound, net and net in thousands per state.

    Lanes are pre-aggregated (origin, destination) first, then each lane is
    exploded into a +outbound row for its origin and a +inbound row for its
    destination, and one groupBy sums them: no full outer join, and states
    with only one direction get 0 for the other.
    """
    t = tons_column(year)
    lanes = (of_year(flows, year)
             .groupBy("origin", "destination").agg(F.sum("tons").alias("_t")))
    sides = lanes.select(F.explode(F.array(
        F.struct(F.col("origin").alias("state"), F.col("_t").alias("o"), F.lit(0.0).alias("i")),
        F.struct(F.col("destination").alias("state"), F.lit(0.0).alias("o"), F.col("_t").alias("i")),
    )).alias("s")).select("s.*")
    bal = sides.groupBy("state").agg(F.sum("o").alias("outbound"), F.sum("i").alias("inbound"))
    return (bal.withColumn("net_tons", F.col("outbound") - F.col("inbound"))
            .withColumn("net_tons_m", round_half_up(F.col("net_tons") / 1e3, 2)))


def trade_balance_full_join(flows: DataFrame, year: int | None) -> DataFrame:
    """The same balance written as outbound FULL OUTER JOIN inbound, fill 0."""
    f = of_year(flows, year)
    out = f.groupBy(F.col("origin").alias("state")).agg(F.sum("tons").alias("outbound"))
    inn = f.groupBy(F.col("destination").alias("state")).agg(F.sum("tons").alias("inbound"))
    bal = out.join(inn, "state", "full").na.fill(0.0, ["outbound", "inbound"])
    return (bal.withColumn("net_tons", F.col("outbound") - F.col("inbound"))
            .withColumn("net_tons_m", round_half_up(F.col("net_tons") / 1e3, 2)))


def avg_haul(flows: DataFrame, routes: DataFrame, year: int | None) -> DataFrame:
    """Ton-miles / tons by origin, 1 dp. Ton-miles = tons x route miles
    (routes: origin, destination, driving_mi). Lanes are aggregated before
    the route join, so the join sees one row per lane."""
    lanes = (of_year(flows, year)
             .groupBy("origin", "destination").agg(F.sum("tons").alias("_t")))
    r = routes.select("origin", "destination", "driving_mi")
    haul = (lanes.join(r, ["origin", "destination"])
            .groupBy(F.col("origin").alias("state"))
            .agg(F.sum("_t").alias("_t"), F.sum(F.col("_t") * F.col("driving_mi")).alias("_tm")))
    return haul.select("state", round_half_up(safe_div("_tm", "_t"), 1).alias("avg_miles"))


def top_lanes_by_mode(flows: DataFrame, year: int | None, mode: str, k: int = 20) -> DataFrame:
    """Top ``k`` (origin, destination) lanes of one mode."""
    t = tons_column(year)
    return (of_year(flows, year).where(F.col("mode") == mode)
            .groupBy("origin", "destination").agg(F.sum("tons").alias(t))
            .withColumn("tons_m", round_half_up(F.col(t) / 1e3, 2))
            .orderBy(F.desc(t), "origin", "destination").limit(k))


def top_lanes_every_mode(flows: DataFrame, year: int | None, k: int = 20) -> DataFrame:
    """A8 for all modes at once: row_number per mode over the aggregated
    lanes (at most origins x destinations rows per mode)."""
    t = tons_column(year)
    lanes = (of_year(flows, year)
             .groupBy("mode", "origin", "destination").agg(F.sum("tons").alias(t)))
    w = Window.partitionBy("mode").orderBy(F.desc(t), "origin", "destination")
    return (lanes.withColumn("lane_rank", F.row_number().over(w))
            .where(F.col("lane_rank") <= k)
            .withColumn("tons_m", round_half_up(F.col(t) / 1e3, 2)))


def top_lanes_per_state(lanes: DataFrame, key: str, metric: str, k: int) -> DataFrame:
    """Top ``k`` rows per ``key`` value (outbound: key=origin,
    inbound: key=destination) of an aggregated lane table."""
    w = Window.partitionBy(key).orderBy(F.desc(metric), *[c for c in LANE_KEYS if c in lanes.columns])
    return lanes.withColumn("lane_rank", F.row_number().over(w)).where(F.col("lane_rank") <= k)


def year_over_year(yearly: DataFrame, metric: str = "tons_m") -> DataFrame:
    """Percent change against the previous year on the (small) yearly table."""
    w = Window.orderBy("year")
    prev = F.lag(metric).over(w)
    return yearly.withColumn("yoy_pct", round_half_up(safe_div(F.col(metric) - prev, prev) * 100, 1))


def mode_summary(flows: DataFrame, year: int | None, mode: str) -> DataFrame:
    """Total tons (thousands) and lane count for one mode."""
    t = tons_column(year)
    lanes = (of_year(flows, year).where(F.col("mode") == mode)
             .groupBy("origin", "destination").agg(F.sum("tons").alias(t)))
    return lanes.agg(round_half_up(F.sum(t) / 1e3, 2).alias("total_tons_m"),
                     F.count(F.lit(1)).alias("lanes"))

