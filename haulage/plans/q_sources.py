"""Landed-source queries.

Responses are derived from the driver tables (as a service would return them),
written to the landing folder as JSON files, some of them a second time cut off
or with an error in place of data, and read from there by the engine's readers.
The oracle computes the expected rows straight from the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from haulage import dims
from haulage.functions import round_half_up
from haulage.operators import cleaning, freight, joins, routes
from haulage.plans import bindings as B
from haulage.plans.lanes import lane_quarters, observed_pairs
from haulage.plans.catalog import query
from haulage.plans.q_entities import plain
from haulage.plans.q_routes import CONG_BASE, route_costs, routing_landed
from haulage.plans.sqlparts import COORDS, ENTITIES, FLOWS, LANDED, LATEST_YEAR as Y, msum, rhu, with_
from haulage.session import scratch_path
from haulage.sources import apis, files, landed, zipfiles

# Event type -> price product code (binding), area index -> area code.
EVENT_PRODUCT = {"view": "EPM0R", "click": "EPM0M", "purchase": "EPM0P", "signup": "EPD2D"}
AREA_CODES = list(dims.EIA_STATE_AREAS.values())  # user_id % 5 picks one


def eia_payloads(spark, sf):
    """One landed response per (product, area): the 10 latest daily
    readings (max of the day), national area 'NUS' over all users and five
    state areas over users by key % 5."""
    ev = B.table(spark, sf, "events").where(F.col("event_type").isin(list(EVENT_PRODUCT)))
    prod = F.create_map(*[x for k, v in EVENT_PRODUCT.items() for x in (F.lit(k), F.lit(v))])
    area = F.create_map(*[x for i, a in enumerate(AREA_CODES) for x in (F.lit(i), F.lit(a))])
    ev = ev.select(prod[F.col("event_type")].alias("product_code"),
                   area[(F.col("user_id") % 5).cast("int")].alias("area_code"),
                   F.date_format("ts", "yyyy-MM-dd").alias("period"), "value")
    nat = ev.groupBy("product_code", F.lit("NUS").alias("area_code"), "period").agg(F.max("value").alias("v"))
    sta = ev.groupBy("product_code", "area_code", "period").agg(F.max("value").alias("v"))
    daily = apis.latest_periods(nat.unionByName(sta), ["product_code", "area_code"], "period", 10)
    item = F.struct(F.col("v").cast("string").alias("value"), F.col("period"),
                    F.when(F.col("area_code") == "NUS", F.lit("U.S.")).alias("area-name"))
    resp = (daily.groupBy("product_code", "area_code")  # at most 10 rows per group
            .agg(F.sort_array(F.collect_list(F.struct(F.col("period"), item.alias("it"))), asc=False).alias("d")))
    body = F.struct(F.struct(F.transform("d", lambda x: x["it"]).alias("data")).alias("response"))
    return resp.select("product_code", "area_code", F.to_json(body, {"pretty": "true"}).alias("payload"))


def cut_off(payload="payload"):
    """The first half of a response body."""
    return F.substring(F.col(payload), F.lit(1), (F.length(payload) / 2).cast("int"))


def deliveries(raw, **again):
    """``raw`` with each response delivered once as it is, and once more as the
    given body where that is not null: column ``delivery`` names which one."""
    sent = [F.struct(F.lit("first").alias("delivery"), F.col("payload"))]
    sent += [F.when(body.isNotNull(), F.struct(F.lit(name).alias("delivery"), body.alias("payload"))) for name, body in again.items()]
    rest = [c for c in raw.columns if c != "payload"]
    return raw.select(*rest, F.explode(F.array_compact(F.array(*sent))).alias("d")).select(*rest, "d.delivery", "d.payload")


def eia_landed(spark, sf):
    """S3: responses of one product arrive cut off too, those of another with an error."""
    error = F.when(F.col("product_code") == "EPD2D", F.lit('{"error": {"code": 429}}'))
    sent = deliveries(eia_payloads(spark, sf), cut=F.when(F.col("product_code") == "EPM0R", cut_off()), error=error)
    path = scratch_path(spark, "landing")
    landed.land(sent, path, ["product_code", "area_code", "delivery"])
    return apis.eia_landed(spark, path, scratch_path(spark, "responses"))


_EV = """ev AS (SELECT CASE event_type WHEN 'view' THEN 'EPM0R' WHEN 'click' THEN 'EPM0M'
    WHEN 'purchase' THEN 'EPM0P' ELSE 'EPD2D' END AS product_code,
  CASE user_id % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'CO' WHEN 2 THEN 'MA' WHEN 3 THEN 'NY' ELSE 'TX' END AS state,
  strftime(ts, '%Y-%m-%d') AS period, value FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')),
u AS (SELECT product_code, 'US' AS state, period, max(value) AS price, 'U.S.' AS area_name FROM ev GROUP BY product_code, period
      UNION ALL SELECT product_code, state, period, max(value), state FROM ev GROUP BY product_code, state, period),
top AS (SELECT *, row_number() OVER (PARTITION BY product_code, state ORDER BY period DESC) AS rn FROM u)"""


@query("s03_eia_fuel_prices", with_(_EV) + """
SELECT state, CASE product_code WHEN 'EPM0R' THEN 'regular' WHEN 'EPM0M' THEN 'mid_grade'
  WHEN 'EPM0P' THEN 'premium' ELSE 'diesel' END AS fuel_type, price, period, product_code, area_name,
  'EIA' AS data_source FROM top WHERE rn <= 10""")
def s03_eia_fuel_prices(spark, sf):
    """Read the landed responses, map product and area
    codes, keep one row per (state, fuel type, period)."""
    rows = apis.eia_flat(eia_landed(spark, sf).rows)
    return rows.dropDuplicates(["state", "fuel_type", "period"])


def rate_pages(spark, sf):
    """Truck-rate responses, an array of records (all fields as text) per year
    and quarter: one record per origin and destination nation; the origin's rate
    region is picked by nation key % 10 from the region list; quarter 4 records
    omit the quarter field, and quarter 3 pages end with a record without region.
    A page holds at most one record per pair of nations."""
    nk = B.table(spark, sf, "nation").select(F.col("n_name").alias("origin"), "n_nationkey")
    regions = list(dims.RATE_REGIONS)
    reg = F.create_map(*[x for i, r in enumerate(regions) for x in (F.lit(i), F.lit(r))])
    agg = lane_quarters(spark, sf).withColumn("v", F.col("v_dec").cast("double")).join(F.broadcast(nk), "origin")
    rec = F.struct(F.col("year").cast("string").alias("year"),
                   F.when(F.col("quarter") != 4, F.col("quarter").cast("string")).alias("quarter"),
                   reg[(F.col("n_nationkey") % 10).cast("int")].alias("region"),
                   F.concat(F.lit(" "), F.lower("destination"), F.lit(" ")).alias("destination"),
                   (F.col("v") / F.col("t") / 1000.0).cast("string").alias("rate_per_mile"),
                   (F.col("v") / F.col("n")).cast("string").alias("rate_per_truckload"))
    page = agg.groupBy("year", "quarter").agg(F.collect_list(F.to_json(rec)).alias("records"))
    records = F.when(F.col("quarter") == 3, F.array_append("records", F.lit('{"destination": "nowhere"}'))).otherwise(F.col("records"))
    return page.select(F.concat(F.lit("y"), "year", F.lit("q"), "quarter").alias("page"), "quarter",
                       F.concat(F.lit("["), F.concat_ws(",\n", records), F.lit("]")).alias("payload"))


def rates_landed(spark, sf):
    """Pages of quarter 2 arrive cut off too."""
    sent = deliveries(rate_pages(spark, sf), cut=F.when(F.col("quarter") == 2, cut_off()))
    path = scratch_path(spark, "landing")
    landed.land(sent, path, ["page", "delivery"])
    return apis.rates_landed(spark, path, scratch_path(spark, "responses"))


_REG_SQL = "CASE n_nationkey % 10 " + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(dims.RATE_REGIONS)) + " END"
_MAP_SQL = "CASE region " + " ".join(f"WHEN '{k}' THEN {('NULL' if v is None else repr(v))}" for k, v in dims.RATE_REGIONS.items()) + " ELSE region END"
_RATES = f"""ra AS (SELECT year, quarter, origin, destination, SUM(tons) AS t, {msum('value')} AS v, COUNT(*) AS n
  FROM flows GROUP BY year, quarter, origin, destination),
rates AS (SELECT year, CASE WHEN quarter = 4 THEN 1 ELSE quarter END AS quarter, {_MAP_SQL.replace('region', 'rg')} AS origin_state,
  upper(destination) AS destination, {rhu('v / t / 1000.0', 4)} AS rate_per_mile, {rhu('v / n', 2)} AS rate_per_truckload
  FROM (SELECT ra.*, {_REG_SQL} AS rg FROM ra JOIN nation ON nation.n_name = ra.origin) WHERE year = {Y})"""


def _latest_rates(spark, sf):
    """Rate rows of the latest year, from the landed pages."""
    return apis.typed_rates(rates_landed(spark, sf).rows, freight.latest_year(lane_quarters(spark, sf)))


@query("s04_truck_rates", with_(FLOWS, _RATES) + "SELECT * FROM rates")
def s04_truck_rates(spark, sf):
    """Typed rate rows with defaults, region -> state codes, year filter."""
    return _latest_rates(spark, sf).drop("_region")


@query("p24_rates_by_state", with_(FLOWS, _RATES) + """
SELECT year, quarter, unnest(string_split(origin_state, ',')) AS origin_state, destination, rate_per_mile,
  rate_per_truckload FROM rates WHERE origin_state IS NOT NULL""")
def p24_rates_by_state(spark, sf):
    """P24 exploded view: one row per state of a multi-state rate region."""
    return apis.rates_by_state(_latest_rates(spark, sf).drop("_region"))


@query("t10_sorted_rates", with_(FLOWS, _RATES.replace(f"SELECT year, CASE WHEN quarter = 4", f"SELECT rg, year, CASE WHEN quarter = 4")) + """
SELECT year, quarter, origin_state, destination, rate_per_mile, rate_per_truckload FROM rates
ORDER BY quarter, rg, destination, origin_state NULLS LAST, rate_per_mile NULLS LAST, rate_per_truckload NULLS LAST LIMIT 10000""")
def t10_sorted_rates(spark, sf):
    """Ordered by quarter, region, destination; first 10,000 rows."""
    return apis.sorted_rates(_latest_rates(spark, sf)).drop("_region")


def weather_payloads(spark, sf):
    """Landed weather responses per user: temp = highest 'view' reading,
    humidity = lowest reading (some exceed 100), wind = spread of 'click'
    readings, feels like = temp - 1.5, description from the latest event."""
    ev = B.table(spark, sf, "events")
    w = ev.groupBy(F.col("user_id").alias("state")).agg(
        F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("temp"),
        F.min("value").alias("humidity"),
        (F.max(F.when(F.col("event_type") == "click", F.col("value")))
         - F.min(F.when(F.col("event_type") == "click", F.col("value")))).alias("speed"),
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last"))
    body = F.struct(F.struct("temp", "humidity", (F.col("temp") - 1.5).alias("feels_like")).alias("main"),
                    F.struct("speed").alias("wind"),
                    F.array(F.struct(F.concat(F.lit("light "), F.col("last")).alias("description"))).alias("weather"))
    return w.select("state", F.to_json(F.struct("state", body.alias("response"))).alias("payload"))


def weather_landed(spark, sf):
    """Lines of every seventh state arrive cut off too, of every eleventh with an error."""
    error = F.concat(F.lit('{"state": '), F.col("state"), F.lit(', "response": {"cod": 401}}'))
    sent = deliveries(weather_payloads(spark, sf), cut=F.when(F.col("state") % 7 == 0, cut_off()), error=F.when(F.col("state") % 11 == 0, error))
    path = scratch_path(spark, "landing")
    landed.land(sent, path, [])
    return apis.weather_landed(spark, path, scratch_path(spark, "responses"))


_WX = """wx AS (SELECT user_id AS state, max(CASE WHEN event_type = 'view' THEN value END) AS temperature,
  min(value) AS humidity, max(CASE WHEN event_type = 'click' THEN value END) - min(CASE WHEN event_type = 'click' THEN value END) AS wind_speed,
  max(CASE WHEN event_type = 'view' THEN value END) - 1.5 AS feels_like,
  'Light ' || upper(substr(arg_max(event_type, (ts, event_id)), 1, 1)) || substr(arg_max(event_type, (ts, event_id)), 2) AS condition
  FROM events GROUP BY user_id)"""


@query("s05_weather_valid", with_(_WX) + """
SELECT state, temperature, condition, humidity, wind_speed, feels_like, 'OpenWeatherMap' AS data_source FROM wx
WHERE humidity BETWEEN 0 AND 100 AND wind_speed >= 0 AND length(coalesce(condition, '')) >= 1""")
def s05_weather_valid(spark, sf):
    """Flatten the landed responses and apply the weather contract."""
    valid, _ = cleaning.apply_contract(apis.weather_flat(weather_landed(spark, sf).rows), cleaning.weather_contract())
    return valid


@query("j16_states_without_weather", with_(ENTITIES, _WX) + """
SELECT state FROM ent WHERE state NOT IN (SELECT state FROM wx
  WHERE humidity BETWEEN 0 AND 100 AND wind_speed >= 0 AND length(coalesce(condition, '')) >= 1)""")
def j16_states_without_weather(spark, sf):
    """Entities with no valid weather row (anti join)."""
    valid, _ = cleaning.apply_contract(apis.weather_flat(weather_landed(spark, sf).rows), cleaning.weather_contract())
    return joins.anti(plain(spark, sf).select("state"), valid, "state")


@query("s03_s06_landed_rejects", with_(FLOWS, COORDS, LANDED, _EV) + """
SELECT 'fuel' AS source, CASE product_code WHEN 'EPM0R' THEN 'malformed' ELSE 'no_data' END AS reason, COUNT(DISTINCT state) AS rejects
  FROM u WHERE product_code IN ('EPM0R', 'EPD2D') GROUP BY product_code
UNION ALL SELECT 'rates', CASE quarter WHEN 2 THEN 'malformed' ELSE 'no_region' END, COUNT(DISTINCT year) FROM flows WHERE quarter IN (2, 3) GROUP BY quarter
UNION ALL SELECT 'weather', 'malformed', COUNT(DISTINCT user_id) FROM events WHERE user_id % 7 = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'weather', 'no_data', COUNT(DISTINCT user_id) FROM events WHERE user_id % 11 = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'routing', 'no_route', (SELECT COUNT(*) FROM lanes_seen) - (SELECT COUNT(*) FROM landed)
UNION ALL SELECT 'routing', 'malformed', COUNT(*) FROM lanes_seen WHERE origin > destination""")
def s03_s06_landed_rejects(spark, sf):
    """Records of each landing that could not be used, by reason, from
    the quarantine of its load."""
    loads = {"fuel": eia_landed(spark, sf), "rates": rates_landed(spark, sf), "weather": weather_landed(spark, sf),
             "routing": routing_landed(spark, sf)}
    counts = [x.reject_counts().select(F.lit(name).alias("source"), "reason", "rejects") for name, x in loads.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


def coded_flow_rows(spark, sf, years):
    """Freight-flow file rows in the coded wide layout: origin / destination
    codes from the supplier / customer nation keys (2k and 2k+1, so some are
    not state codes), mode from the order priority digit, commodity code
    from the part size, trade type 1 for status 'F' else 2; tons_Y/value_Y."""
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                                               "l_extendedprice", "l_linestatus", "l_shipdate")
    o = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = B.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = B.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    p = B.table(spark, sf, "part").select("p_partkey", "p_size")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey")))
    long = j.select((F.col("s_nationkey") * 2).alias("dms_origst"), (F.col("c_nationkey") * 2 + 1).alias("dms_destst"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("dms_mode"), F.col("p_size").alias("sctg2"),
                    F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("trade_type"),
                    F.year("l_shipdate").alias("year"), F.col("l_quantity").alias("tons"),
                    F.col("l_extendedprice").alias("value"))
    return freight.long_to_wide(long, years, ["dms_origst", "dms_destst", "dms_mode", "sctg2", "trade_type"])


def _latest_lane_tons(spark, sf, wide, years):
    """P15 (domestic, known codes) -> P16 (labels) -> U1 (stack) -> lane totals of the latest year."""
    dom = freight.domestic_flows(wide, dims.fips_dim(spark))
    lab = freight.label_flows(dom, dims.fips_dim(spark), dims.mode_dim(spark), dims.sctg_dim(spark))
    long = freight.wide_to_long(lab, years, ["origin", "destination", "commodity", "mode"])
    return (long.where(F.col("year") == B.latest_year(spark, sf)).groupBy("origin", "destination", "commodity", "mode")
            .agg(F.sum("tons").alias("tons_latest")))


def _values(name, cols, items):
    vals = ", ".join("(" + ", ".join(repr(x) for x in it) + ")" for it in items)
    return f"{name} AS (SELECT * FROM (VALUES {vals}) AS t({cols}))"


_DIMS = [_values("fips", "fips, code", dims.STATE_FIPS.items()),
         _values("modes", "dms_mode, mode", dims.MODE_NAMES.items()),
         _values("sctg", "sctg2, commodity", dims.SCTG_NAMES.items())]


_CF = f"""cf AS (SELECT s.s_nationkey * 2 AS o, c.c_nationkey * 2 + 1 AS d,
    CAST(substr(ord.o_orderpriority, 1, 1) AS INTEGER) AS m, p.p_size AS k,
    CASE WHEN year(l.l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem WHERE l_linestatus = 'F') THEN l.l_quantity ELSE 0.0 END AS tons
  FROM lineitem l JOIN orders ord ON l.l_orderkey = ord.o_orderkey
  JOIN customer c ON ord.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_linestatus = 'F')"""


_CODED_SQL = with_(*_DIMS, _CF) + """
SELECT fo.code AS origin, fd.code AS destination, coalesce(sc.commodity, 'Unknown') AS commodity,
  coalesce(md.mode, 'Other') AS mode, SUM(tons) AS tons_latest
FROM cf JOIN fips fo ON cf.o = fo.fips JOIN fips fd ON cf.d = fd.fips
LEFT JOIN modes md ON cf.m = md.dms_mode LEFT JOIN sctg sc ON cf.k = sc.sctg2
GROUP BY 1, 2, 3, 4"""


def _landed_flow_rows(spark, sf, years):
    return coded_flow_rows(spark, sf, years).select(
        *files.FLOW_KEYS, *[f"tons_{y}" for y in years], *[f"value_{y}" for y in years])


@query("s02_p15_p16_coded_lanes", _CODED_SQL)
def s02_p15_p16_coded_lanes(spark, sf):
    """Coded wide rows landed as gzip CSV in the shared scratch folder, read
    back with the file schema (float32 measures, pruned columns), then totalled."""
    path = scratch_path(spark)
    years = B.ship_years(spark, sf)
    # gzip files cannot be split, so each holds a bounded number of rows
    (_landed_flow_rows(spark, sf, years).write.option("header", True).option("compression", "gzip")
     .option("maxRecordsPerFile", 500_000).csv(path))
    return _latest_lane_tons(spark, sf, files.read_flow_csv(spark, path, years), years)


@query("s02_zip_members", _CODED_SQL)
def s02_zip_members(spark, sf):
    """The same rows landed as zip archives of several CSV members each, and
    read from there by the zip source, one partition per member."""
    path = scratch_path(spark)
    years = B.ship_years(spark, sf)
    zipfiles.write_zip_csv(_landed_flow_rows(spark, sf, years), path, 50_000)
    return _latest_lane_tons(spark, sf, zipfiles.read_flow_zip(spark, path, years), years)


@query("a37_headline_metrics", with_(*CONG_BASE, _RATES, f"""y AS (SELECT year, {rhu('SUM(tons) / 1000.0', 2)} AS tons_m,
  {rhu(msum('value') + ' / 1000.0', 2)} AS value_b FROM flows GROUP BY year)""") + f"""
SELECT tons_m, value_b,
  (SELECT CAST(SUM(CAST(rate_per_mile AS DECIMAL(18,4))) AS DOUBLE) / COUNT(rate_per_mile) FROM rates) AS avg_rate_per_mile,
  (SELECT CAST(SUM(CAST(cost_per_mi AS DECIMAL(18,4))) AS DOUBLE) / COUNT(cost_per_mi) FROM costs WHERE cost_per_mi > 0) AS avg_cost_per_mi,
  (SELECT COUNT(*) FROM cong WHERE congestion_tier = 'High') AS high_congestion
FROM y WHERE year = {Y}""")
def a37_headline_metrics(spark, sf):
    """Latest-year totals, mean truck rate, mean cost per mile and
    count of highly congested routes, side by side."""
    # the stored lane table feeds the yearly totals, the rate records and the route pairs
    lq = lane_quarters(spark, sf)
    yearly = (lq.groupBy("year").agg(F.sum("t").alias("_t"), F.sum("v_dec").cast("double").alias("_v"))
              .select("year", round_half_up(F.col("_t") / 1e3, 2).alias("tons_m"),
                      round_half_up(F.col("_v") / 1e3, 2).alias("value_b")))
    rates = _latest_rates(spark, sf)
    c = route_costs(spark, sf)
    return routes.headline_metrics(freight.latest(yearly), rates, c, routes.congestion(c))
