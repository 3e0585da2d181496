"""Cleaning, contracts and scraped-table queries.

Dirty inputs are derived from the driver tables inside the query (text
padding, mixed case, full state names, currency text, footnotes, rows that
break a rule), cleaned with the engine, and checked against the truth the
SQL oracle computes straight from the same tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage import dims
from haulage.operators import cleaning, freight, marts
from haulage.plans import bindings as B
from haulage.plans.catalog import ORACLE, query
from haulage.plans.q_entities import ent, latest_fuel, plain
from haulage.plans.sqlparts import ENTITIES, FLOWS, LATEST_FUEL, LATEST_YEAR as Y, SNAPS, with_
from haulage.session import scratch_path
from haulage.sources import files, html
from haulage.sources.master import MasterTable

ST = dims.state_index_sql()


def dirty_shipping(spark, sf):
    """Raw shipping text from customers: 'Rank'/'State'/'Postal'/'Population'
    headers, padded text, state as lower-case code or full name in mixed
    case; rank 0 on every 7th key, a 3-letter postal on every 11th."""
    c = B.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    st = F.broadcast(dims.state_index_dim(spark))
    j = c.withColumn("k", (F.col("c_custkey") % 50).cast("int")).join(st, "k")
    rank = F.when(F.col("c_custkey") % 7 == 0, F.lit(0)).otherwise(F.col("c_custkey") + 1)
    state = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("  "), F.lower("name"), F.lit(" ")))\
             .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit(" "), F.upper("name")))\
             .otherwise(F.concat(F.lit(" "), F.lower("code"), F.lit("  ")))
    postal = F.when(F.col("c_custkey") % 11 == 0, F.concat("code", F.lit("X"))).otherwise(F.col("code"))
    return j.select(F.col("c_custkey").alias("Id"), F.concat(F.lit(" "), rank.cast("string")).alias("Rank"), state.alias("State"),
                    postal.alias("Postal"), F.concat(F.col("c_acctbal").cast("string"), F.lit(" ")).alias("Population"))


_TRUTH = f"""truth AS (SELECT CAST(CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey + 1 END AS INTEGER) AS rank, st.code AS state,
  CASE WHEN c_custkey % 11 = 0 THEN st.code || 'X' ELSE st.code END AS postal, c_acctbal AS population, c_custkey
  FROM customer JOIN st ON st.k = c_custkey % 50)"""


@query("p33_clean_shipping", with_(ST, _TRUTH) + """
SELECT DISTINCT rank, state, postal, population, population / rank AS population_per_rank FROM truth
WHERE rank >= 1 AND length(postal) = 2 AND population > 0""")
def p33_clean_shipping(spark, sf):
    """Full cleaning step on derived dirty text."""
    clean, _ = cleaning.clean_shipping(dirty_shipping(spark, sf))
    return clean


@query("p09_reject_counts", with_(ST, _TRUTH) + """
SELECT reason, COUNT(*) AS rejected FROM (
  SELECT CASE WHEN rank < 1 THEN 'rank' WHEN length(postal) <> 2 THEN 'postal'
              WHEN population <= 0 THEN 'population' END AS reason FROM truth)
WHERE reason IS NOT NULL GROUP BY reason""")
def p09_reject_counts(spark, sf):
    """Rejected rows per first failed rule."""
    _, rejects = cleaning.clean_shipping(dirty_shipping(spark, sf))
    return cleaning.reject_counts(rejects)


@query("p09_counts_while_writing", ORACLE["p09_reject_counts"])
def p09_counts_while_writing(spark, sf):
    """The valid shipping rows are written, and the rejected ones counted
    by reason in the same pass."""
    typed = cleaning.typed_shipping(dirty_shipping(spark, sf))
    _, counts = cleaning.write_valid(typed, cleaning.shipping_contract(spark), scratch_path(spark))
    return counts


def fuel_pages(spark, sf):
    """Landed price pages built from the latest fuel readings: one page per 25
    states (bounded group), header row, state full names, '$' prices,
    'n/a' for a missing price."""
    f = latest_fuel(spark, sf).withColumn("k", (F.col("state") % 50).cast("int"))
    f = f.join(F.broadcast(dims.state_index_dim(spark)), "k")

    def cell(c):
        return F.concat(F.lit("<td>"), F.when(F.col(c).isNull(), F.lit("n/a"))
                        .otherwise(F.format_string("$%.2f", F.col(c))), F.lit("</td>"))

    tr = F.concat(F.lit("<tr><td> "), F.col("name"), F.lit(" </td>"), cell("regular"), cell("mid_grade"),
                  cell("premium"), cell("diesel"), F.lit("</tr>"))
    pages = (f.groupBy((F.col("state") / 25).cast("long").alias("page_id"))
             .agg(F.sort_array(F.collect_list(F.struct(F.col("state"), tr.alias("tr")))).alias("rows")))
    head = ("<html><body><h1>Prices</h1><table class='p'><tr><th>State</th><th>Regular</th>"
            "<th>Mid-Grade</th><th>Premium</th><th>Diesel</th></tr>")
    body = F.array_join(F.transform("rows", lambda r: r["tr"]), "\n")
    return pages.select("page_id", F.concat(F.lit(head), body, F.lit("</table></body></html>")).alias("html"))


_FUEL_TRUTH = f"""ft AS (SELECT st.code AS state, regular, mid_grade, premium, diesel FROM fuel JOIN st ON st.k = fuel.state % 50)"""


@query("s07_html_fuel_table_valid", with_(ST, SNAPS, LATEST_FUEL, _FUEL_TRUTH) + """
SELECT state, regular, mid_grade, premium, diesel FROM ft
WHERE regular > 0 AND mid_grade > 0 AND premium > 0 AND diesel > 0""")
def s07_html_fuel_table_valid(spark, sf):
    """Parse the price tables, normalise state names, keep rows
    meeting the fuel contract."""
    rows = html.fuel_price_table(fuel_pages(spark, sf))
    rows = cleaning.normalize_state(rows, "state_raw", "state")
    valid, _ = cleaning.apply_contract(rows, cleaning.fuel_contract(spark))
    return valid.select("state", "regular", "mid_grade", "premium", "diesel")


@query("s07_html_fuel_rejects", with_(ST, SNAPS, LATEST_FUEL, _FUEL_TRUTH) + """
SELECT reason, COUNT(*) AS rejected FROM (SELECT CASE
  WHEN NOT coalesce(regular > 0, false) THEN 'regular' WHEN NOT coalesce(mid_grade > 0, false) THEN 'mid_grade'
  WHEN NOT coalesce(premium > 0, false) THEN 'premium' WHEN NOT coalesce(diesel > 0, false) THEN 'diesel' END AS reason FROM ft)
WHERE reason IS NOT NULL GROUP BY reason""")
def s07_html_fuel_rejects(spark, sf):
    rows = cleaning.normalize_state(html.fuel_price_table(fuel_pages(spark, sf)), "state_raw", "state")
    _, rejects = cleaning.apply_contract(rows, cleaning.fuel_contract(spark))
    return cleaning.reject_counts(rejects)


def population_pages(spark, sf, without=None):
    """Landed population pages from the entity table (less one segment, if
    named): 50 rows per page,
    header 'Rank / State / Population', names with bracketed footnotes,
    comma-grouped numbers."""
    e = ent(spark, sf)
    if without is not None:
        e = e.where(F.col("segment") != without)
    tr = F.concat(F.lit("<tr><td>"), F.col("rank").cast("string"), F.lit("</td><td>Customer "),
                  F.col("state").cast("string"), F.lit("<sup>[" ), F.lower(F.substring("segment", 1, 1)),
                  F.lit("]</sup></td><td>"), F.format_number("population", 2), F.lit("</td></tr>"))
    pages = (e.groupBy((F.col("state") / 50).cast("long").alias("page_id"))
             .agg(F.sort_array(F.collect_list(F.struct(F.col("state"), tr.alias("tr")))).alias("rows")))
    head = "<table><tr><th>Rank</th><th>State or territory</th><th>Census population</th></tr>"
    return pages.select("page_id", F.concat(F.lit(head), F.array_join(F.transform("rows", lambda r: r["tr"]), ""),
                                            F.lit("</table>")).alias("html"))


@query("s08_html_population_table", with_(ENTITIES) + """
SELECT upper('Customer ' || CAST(state AS VARCHAR)) AS state, population AS new_population FROM ent""")
def s08_html_population_table(spark, sf):
    """Header-sniffed population table parsed back from the pages."""
    return html.population_table(population_pages(spark, sf)).select("state", "new_population")


@query("k06_population_update", with_(ENTITIES, SNAPS, LATEST_FUEL) + """
SELECT e.state, e.population AS population, f.diesel,
  CASE WHEN f.diesel IS NOT NULL AND f.diesel <> 0 THEN e.population / f.diesel END AS pop_per_dollar,
  'run-1' AS pipeline_run_id
FROM (SELECT state, CASE WHEN segment = 'MACHINERY' THEN population * 0.9 ELSE population END AS population FROM ent0) e
LEFT JOIN fuel f ON e.state = f.state""")
def k06_population_update(spark, sf):
    """Master rows (older population), new population
    from the parsed pages (coalesce new over old), diesel joined,
    pop_per_dollar guarded, lineage stamped."""
    named = lambda c: F.upper(F.concat(F.lit("Customer "), F.col(c).cast("string")))
    master = plain(spark, sf).select(named("state").alias("name"), "state", (F.col("population") * 0.9).alias("population"))
    master = master.withColumnsRenamed({"state": "key", "name": "state"})
    # entities of one segment are not on the pages and keep their older population
    parsed = html.population_table(population_pages(spark, sf, without="MACHINERY"))
    diesel = latest_fuel(spark, sf).select(named("state").alias("state"), "diesel")
    out = marts.population_update(master, parsed, diesel, "run-1")
    return out.select(F.col("key").alias("state"), "population", "diesel", "pop_per_dollar", "pipeline_run_id")


def _named(c):
    return F.upper(F.concat(F.lit("Customer "), F.col(c).cast("string")))


@query("k06_master_merge", with_(ENTITIES, SNAPS, LATEST_FUEL) + """
SELECT e.state, e.population AS population, f.diesel,
  CASE WHEN f.diesel IS NOT NULL AND f.diesel <> 0 THEN e.population / f.diesel END AS pop_per_dollar,
  CASE WHEN f.state IS NOT NULL THEN 'run-2' WHEN segment <> 'MACHINERY' THEN 'run-1' ELSE 'run-0' END AS pipeline_run_id
FROM (SELECT state, segment, CASE WHEN segment = 'MACHINERY' THEN population * 0.9 ELSE population END AS population FROM ent0) e
LEFT JOIN fuel f ON e.state = f.state""")
def k06_master_merge(spark, sf):
    """A stored master table updated in place, first with the parsed
    populations, then with the diesel prices; each merge rewrites the buckets of its
    keys and stamps the rows that it met."""
    rows = plain(spark, sf).select(
        _named("state").alias("name"), "state", (F.col("population") * 0.9).alias("population"), F.lit(None).cast("double").alias("diesel"),
        F.lit(None).cast("double").alias("pop_per_dollar"), F.lit("run-0").alias("pipeline_run_id"))
    master = MasterTable(spark, scratch_path(spark, "master"))
    master.create(rows, "name", 16)

    def derive(run):
        ok = F.col("diesel").isNotNull() & (F.col("diesel") != 0) & F.col("population").isNotNull()
        return lambda df: df.withColumns({"pop_per_dollar": F.when(ok, F.col("population") / F.col("diesel")), "pipeline_run_id": F.lit(run)})

    parsed = html.population_table(population_pages(spark, sf, without="MACHINERY"))
    master.merge(parsed.select(F.col("state").alias("name"), F.col("new_population").alias("population")), derive("run-1"))
    master.merge(latest_fuel(spark, sf).select(_named("state").alias("name"), "diesel"), derive("run-2"))
    return master.read().select("state", "population", "diesel", "pop_per_dollar", "pipeline_run_id")


_SNAP_FIELDS = T.StructType([T.StructField("state", T.LongType()), T.StructField("scraped_at", T.TimestampNTZType()),
                             *[T.StructField(c, T.DoubleType()) for c in ("regular", "mid_grade", "premium", "diesel", "visibility")]])


@query("p14_snapshots_with_other_columns", with_(SNAPS) + """
SELECT state, scraped_at, regular, CASE WHEN state % 3 = 0 THEN NULL ELSE mid_grade END AS mid_grade,
  CASE WHEN state % 3 = 2 THEN premium END AS premium, CASE WHEN state % 3 = 0 THEN NULL ELSE diesel END AS diesel,
  CAST(NULL AS DOUBLE) AS visibility FROM snaps""")
def p14_snapshots_with_other_columns(spark, sf):
    """Three loads of snapshots, each with more columns than the one
    before, the last with one beyond the schema, read as one table of fixed columns."""
    path, snaps = scratch_path(spark, "snapshots"), B.fuel_snapshots(spark, sf)
    loads = [["state", "scraped_at", "regular"], ["scraped_at", "state", "diesel", "mid_grade", "regular"],
             ["state", "scraped_at", "regular", "mid_grade", "premium", "diesel", F.lit("x").alias("note")]]
    for i, cols in enumerate(loads):
        snaps.where(F.col("state") % 3 == i).select(*cols).write.mode("append").parquet(path)
    return files.read_snapshots(spark, path, _SNAP_FIELDS)


@query("p28_price_spread", with_(SNAPS, LATEST_FUEL) + """
SELECT state, premium - regular AS price_spread FROM fuel""")
def p28_price_spread(spark, sf):
    return cleaning.price_spread(latest_fuel(spark, sf)).select("state", "price_spread")


@query("p32_trade_balance_labels", with_(FLOWS, f"""o AS (SELECT origin AS state, SUM(tons) AS outbound FROM flows WHERE year = {Y} GROUP BY origin)""",
                                         f"""i AS (SELECT destination AS state, SUM(tons) AS inbound FROM flows WHERE year = {Y} GROUP BY destination)""") + """
SELECT state, net_tons, CASE WHEN net_tons >= 0 THEN 'Surplus' ELSE 'Deficit' END AS balance_label,
  CASE WHEN net_tons >= 0 THEN 'Net Exporter' ELSE 'Net Importer' END AS trade_role, abs(net_tons) AS abs_net
FROM (SELECT coalesce(o.state, i.state) AS state, coalesce(outbound, 0.0) - coalesce(inbound, 0.0) AS net_tons
      FROM o FULL OUTER JOIN i ON o.state = i.state)""")
def p32_trade_balance_labels(spark, sf):
    """Surplus/Deficit and Net Exporter/Importer labels on the balance."""
    b = freight.trade_balance(B.flows(spark, sf, latest=True, columns=("origin", "destination", "year", "tons")), None)
    return cleaning.surplus_labels(b).select("state", "net_tons", "balance_label", "trade_role", "abs_net")


@query("p14_p30_select_present_rename", with_(ENTITIES) + """
SELECT state AS state_id, population, rank FROM ent""")
def p14_p30_select_present_rename(spark, sf):
    """Fixed column order keeping only present columns, then rename."""
    e = ent(spark, sf)
    return cleaning.select_present(e, ["state", "postal", "population", "rank", "diesel"]).withColumnRenamed(
        "state", "state_id")


@query("a45_first_snapshot_per_state", with_(SNAPS) + """
SELECT state, scraped_at, regular, mid_grade, premium, diesel FROM (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY scraped_at) AS rn FROM snaps) WHERE rn = 1""")
def a45_first_snapshot_per_state(spark, sf):
    """One row per key with an explicit kept row (the first snapshot of
    each state), as an aggregate so a hot key is reduced map-side."""
    from haulage.operators.joins import dedupe_keep_first
    return dedupe_keep_first(B.fuel_snapshots(spark, sf), ["state"], ["scraped_at"])
