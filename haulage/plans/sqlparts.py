"""SQL text shared by the oracle queries (DuckDB dialect, ANSI where possible).

The oracle re-derives every binding from the raw tables with plain SQL, so
a query checks the whole Spark path, bindings included.
"""

from __future__ import annotations

from haulage import dims

# The last year that has flows.
LATEST_YEAR = "(SELECT max(year) FROM flows)"


def rhu(expr: str, digits: int) -> str:
    """Round half up on the binary value (same bits as functions.round_half_up)."""
    s = float(10 ** digits)
    return f"(floor(({expr}) * {s} + 0.5) / {s})"


def msum(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


FLOWS = """flows AS (
  SELECT sn.n_name AS origin, cn.n_name AS destination, p.p_type AS commodity,
         o.o_orderpriority AS mode, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(quarter(l.l_shipdate) AS INTEGER) AS quarter,
         l.l_quantity AS tons, l.l_extendedprice AS value
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_linestatus = 'F')"""

COORDS = """coords AS (
  SELECT n_name AS code, CAST(25 + (n_nationkey * 7) % 25 AS DOUBLE) AS lat,
         CAST(-120 + (n_nationkey * 11) % 50 AS DOUBLE) AS lon, n_nationkey AS nation_key
  FROM nation)"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"({dims.EARTH_RADIUS_MI} * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


# Landed routing results with code 'Ok' (see bindings.landed_routes).
LANDED = f"""lanes_seen AS (SELECT DISTINCT origin, destination FROM flows),
landed AS (
  SELECT l.origin, l.destination, 'Ok' AS code,
         {haversine('o.lat', 'o.lon', 'd.lat', 'd.lon')} * 1.18 * 1609.34 AS distance,
         {haversine('o.lat', 'o.lon', 'd.lat', 'd.lon')} * 1.18 / 55.0
           * (1.05 + 0.1 * ((o.nation_key * 2 + d.nation_key) % 4)) * 3600.0 AS duration
  FROM lanes_seen l JOIN coords o ON l.origin = o.code JOIN coords d ON l.destination = d.code
  WHERE l.origin <> l.destination AND (o.nation_key + d.nation_key * 2) % 5 <> 0)"""

# Route table: routed miles/hours of the direction whose origin sorts first, else
# of the other one, else great circle and miles/55.
ROUTES = f"""routes AS (
  SELECT l.origin, l.destination,
         CASE WHEN l.origin = l.destination THEN 0.0
              WHEN coalesce(f.code, b.code) = 'Ok' THEN {rhu('coalesce(f.distance, b.distance) / 1609.34', 1)}
              ELSE {rhu(haversine('o.lat', 'o.lon', 'd.lat', 'd.lon'), 1)} END AS driving_mi,
         CASE WHEN l.origin = l.destination THEN 0.0
              WHEN coalesce(f.code, b.code) = 'Ok' THEN {rhu('coalesce(f.duration, b.duration) / 3600.0', 2)}
              ELSE {rhu(rhu(haversine('o.lat', 'o.lon', 'd.lat', 'd.lon'), 1) + ' / 55.0', 2)} END AS driving_hr
  FROM lanes_seen l
  JOIN coords o ON l.origin = o.code JOIN coords d ON l.destination = d.code
  LEFT JOIN landed f ON f.origin = least(l.origin, l.destination) AND f.destination = greatest(l.origin, l.destination)
  LEFT JOIN landed b ON b.origin = greatest(l.origin, l.destination) AND b.destination = least(l.origin, l.destination))"""

# Entities (customers with orders) and their rank by population.
ENTITIES = f"""pop AS (
  SELECT o_custkey AS state, {msum('o_totalprice')} AS population FROM orders GROUP BY o_custkey),
ent0 AS (
  SELECT c.c_custkey AS state, n.n_name AS nation, r.r_name AS region, c.c_mktsegment AS segment,
         p.population
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN pop p ON p.state = c.c_custkey),
ent AS (
  SELECT *, CAST(row_number() OVER (ORDER BY population DESC, state) AS INTEGER) AS rank,
         population / row_number() OVER (ORDER BY population DESC, state) AS population_per_rank
  FROM ent0)"""

SNAPS = """snaps AS (
  SELECT user_id AS state, date_trunc('day', ts) AS scraped_at,
         max(CASE WHEN event_type = 'view' THEN value END) AS regular,
         max(CASE WHEN event_type = 'click' THEN value END) AS mid_grade,
         max(CASE WHEN event_type = 'purchase' THEN value END) AS premium,
         max(CASE WHEN event_type = 'signup' THEN value END) AS diesel
  FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup')
  GROUP BY user_id, date_trunc('day', ts))"""

# Latest non-null reading per state and price.
LATEST_FUEL = """fuel AS (
  SELECT state,
         arg_max(regular, scraped_at) FILTER (WHERE regular IS NOT NULL) AS regular,
         arg_max(mid_grade, scraped_at) FILTER (WHERE mid_grade IS NOT NULL) AS mid_grade,
         arg_max(premium, scraped_at) FILTER (WHERE premium IS NOT NULL) AS premium,
         arg_max(diesel, scraped_at) FILTER (WHERE diesel IS NOT NULL) AS diesel,
         max(scraped_at) AS scraped_at
  FROM snaps GROUP BY state)"""

NATION_SNAPS = """nsnaps AS (
  SELECT n.n_name AS state, s.scraped_at, max(s.regular) AS regular, max(s.mid_grade) AS mid_grade,
         max(s.premium) AS premium, max(s.diesel) AS diesel
  FROM snaps s JOIN customer c ON s.state = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY n.n_name, s.scraped_at)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
