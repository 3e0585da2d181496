"""Profiling / EDA queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulage.functions import money_sum, round_half_up
from haulage.operators import eda
from haulage.plans import bindings as B
from haulage.plans.catalog import query
from haulage.plans.q_entities import ent, latest_fuel, plain
from haulage.plans.sqlparts import ENTITIES, LATEST_FUEL, SNAPS, rhu, with_
from haulage.session import materialize

LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# Column lists of the driver tables (for the SQL form of the profile).
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _li(spark, sf):
    return B.table(spark, sf, "lineitem").select(*LI_COLS)


def _r(df, digits=6):
    return eda.rounded_stats(df, digits)


# Names of column types that both engines' names map to.
_KINDS = {"integer": ("bigint", "int"), "floating": ("double", "float"), "text": ("string",),
          "timestamp": ("timestamp", "timestamp_ntz"), "array": ("array<float>",)}
_KIND_SQL = ("CASE typeof(any_value({c})) WHEN 'BIGINT' THEN 'integer' WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'floating' "
             "WHEN 'FLOAT' THEN 'floating' WHEN 'VARCHAR' THEN 'text' WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'FLOAT[]' THEN 'array' END")


@query("s15_table_profile", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {_KIND_SQL.format(c=c)} AS kind, COUNT(*) AS rows, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    f"CASE WHEN COUNT(*) > 0 THEN COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) * 100 ELSE 0.0 END AS null_pct FROM {t}"
    for t, cols in TABLE_COLUMNS.items() for c in cols))
def s15_table_profile(spark, sf):
    """Kind, rows, null counts and null % per column of every driver
    table (one aggregate per table)."""
    tables = {t: B.table(spark, sf, t) for t in TABLE_COLUMNS}
    kind = None
    for name, types in _KINDS.items():
        kind = F.when(F.col("dtype").isin(*types), name) if kind is None else kind.when(F.col("dtype").isin(*types), name)
    p = eda.table_profile(tables).withColumn("kind", kind)
    return p.select("table_name", "column_name", "kind", "rows", "nulls", "null_pct")


_MOM = lambda c: f"""SELECT '{c}' AS "column", COUNT({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
  var_samp({c}) AS var, min({c}) AS min, max({c}) AS max,
  quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.75) AS q75,
  (SELECT avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5) FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)) AS skewness,
  (SELECT avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3 FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)) AS kurtosis
  FROM lineitem"""

_A18_COLS = ["count", "mean", "std", "var", "min", "max", "median", "q25", "q75", "skewness", "kurtosis", "iqr", "cv"]


@query("a18_descriptive_statistics", "WITH m AS (" + " UNION ALL ".join(_MOM(c) for c in LI_COLS) + ")\n"
       + 'SELECT "column", count, ' + ", ".join(f"{rhu(c, 6)} AS {c}" for c in _A18_COLS[1:11]) + ", "
       + rhu("q75 - q25", 6) + " AS iqr, " + rhu("CASE WHEN mean <> 0 THEN std / mean ELSE 0.0 END", 6) + " AS cv FROM m")
def a18_descriptive_statistics(spark, sf):
    """A18 over the numeric line-item columns."""
    return _r(eda.descriptive_statistics(_li(spark, sf), LI_COLS))


_PAIRS = [(a, b) for i, a in enumerate(LI_COLS) for b in LI_COLS[i + 1:]]
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS correlation FROM lineitem" for a, b in _PAIRS)


@query("a19_correlation_matrix", f"""SELECT var1, var2, {rhu('correlation', 9)} AS correlation,
  CASE WHEN abs(correlation) > 0.7 THEN 'Strong' ELSE 'Moderate' END AS strength FROM ({_CORR_SQL})""")
def a19_correlation_matrix(spark, sf):
    """Every pair of numeric line-item columns, one aggregate."""
    c = eda.correlation_pairs(_li(spark, sf), LI_COLS, keep_all=True)
    return c.withColumn("correlation", round_half_up("correlation", 9))


@query("a19_strong_correlations", f"""SELECT var1, var2, {rhu('correlation', 9)} AS correlation,
  CASE WHEN abs(correlation) > 0.7 THEN 'Strong' ELSE 'Moderate' END AS strength FROM ({_CORR_SQL})
  WHERE abs(correlation) > 0.5""")
def a19_strong_correlations(spark, sf):
    c = eda.correlation_pairs(_li(spark, sf), LI_COLS)
    return c.withColumn("correlation", round_half_up("correlation", 9))


_OUT = lambda c: f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers_count
  FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem) WHERE {c} IS NOT NULL"""


@query("a21_distribution_analysis", "WITH m AS (" + " UNION ALL ".join(_MOM(c) for c in LI_COLS) + "),\n"
       + "o AS (" + " UNION ALL ".join(_OUT(c) for c in LI_COLS) + ")\n" + f"""
SELECT m."column", m.count AS n,
  {rhu('CASE WHEN m.count <= 3 THEN NULL ELSE exp(-(m.count / 6.0 * (pow(skewness, 2) + pow(kurtosis, 2) / 4.0)) / 2.0) END', 9)} AS jb_p_value,
  CASE WHEN m.count <= 3 THEN 'Insufficient data'
       WHEN exp(-(m.count / 6.0 * (pow(skewness, 2) + pow(kurtosis, 2) / 4.0)) / 2.0) > 0.05 THEN 'Normal'
       ELSE 'Not Normal' END AS distribution_type,
  o.outliers_count, {rhu('o.outliers_count / m.count * 100', 6)} AS outlier_percentage
FROM m JOIN o ON m."column" = o."column\"""")
def a21_distribution_analysis(spark, sf):
    """A21 (re-aimed to Jarque-Bera) with IQR outlier counts."""
    d = eda.distribution_analysis(_li(spark, sf), LI_COLS)
    return d.withColumn("jb_p_value", round_half_up("jb_p_value", 9)).withColumn(
        "outlier_percentage", round_half_up("outlier_percentage", 6))


@query("a22_regional_analysis", with_(ENTITIES) + f"""
SELECT region, COUNT(*) AS count, {rhu('avg(population)', 4)} AS avg_population, {rhu('avg(rank)', 6)} AS avg_rank,
  CAST(SUM(CAST(population AS DECIMAL(30,2))) AS DOUBLE) AS total_population,
  {rhu('stddev_samp(population)', 4)} AS population_std, min(rank) AS best_rank, max(rank) AS worst_rank
FROM ent GROUP BY region""")
def a22_regional_analysis(spark, sf):
    a = eda.regional_analysis(ent(spark, sf))
    return a.withColumn("avg_population", round_half_up("avg_population", 4)).withColumn(
        "avg_rank", round_half_up("avg_rank", 6)).withColumn("population_std", round_half_up("population_std", 4))


@query("a23_regional_comparison", with_(ENTITIES) + f"""
SELECT region, {rhu('CAST(SUM(CAST(population AS DECIMAL(30,2))) AS DOUBLE)', 2)} AS population_sum,
  {rhu('avg(population)', 2)} AS population_mean, {rhu('stddev_samp(population)', 2)} AS population_std,
  {rhu('avg(rank)', 2)} AS rank_mean, min(rank) AS rank_min,
  {rhu('CAST(SUM(CAST(population AS DECIMAL(30,2))) AS DOUBLE) / (SELECT CAST(SUM(CAST(population AS DECIMAL(30,2))) AS DOUBLE) FROM ent) * 100', 2)} AS population_share_pct
FROM ent GROUP BY region""")
def a23_regional_comparison(spark, sf):
    """Regional comparison table, 2 dp, with share of the total."""
    e = ent(spark, sf)
    total = e.select(money_sum("population")).scalar()
    s = money_sum("population")
    return e.groupBy("region").agg(
        round_half_up(s, 2).alias("population_sum"), round_half_up(F.avg("population"), 2).alias("population_mean"),
        round_half_up(F.stddev_samp("population"), 2).alias("population_std"),
        round_half_up(F.avg("rank"), 2).alias("rank_mean"), F.min("rank").alias("rank_min"),
        round_half_up(s / total * 100, 2).alias("population_share_pct"))


_BOX_FUEL = " UNION ALL ".join(f"SELECT '{c}' AS fuel_type, {c} AS price FROM fuel" for c in
                               ("regular", "mid_grade", "premium", "diesel"))


@query("a24_fuel_box_stats", with_(SNAPS, LATEST_FUEL, f"lf AS ({_BOX_FUEL})") + """
SELECT fuel_type, COUNT(price) AS n, """ + ", ".join(f"{rhu(f'quantile_cont(price, {p})', 9)} AS {n}" for n, p in
  [("q0", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("q4", 1.0)]) + """,
  COUNT(*) FILTER (WHERE price < q1x - 1.5 * (q3x - q1x) OR price > q3x + 1.5 * (q3x - q1x)) AS outliers
FROM (SELECT lf.*, quantile_cont(price, 0.25) OVER (PARTITION BY fuel_type) AS q1x,
             quantile_cont(price, 0.75) OVER (PARTITION BY fuel_type) AS q3x FROM lf WHERE price IS NOT NULL)
GROUP BY fuel_type""")
def a24_fuel_box_stats(spark, sf):
    """Box statistics per fuel type (latest prices, unpivoted)."""
    long = eda.to_long(latest_fuel(spark, sf), ["regular", "mid_grade", "premium", "diesel"], "fuel_type", "price")
    return _r(eda.box_stats(long, ["fuel_type"], "price"), 9)


@query("a24_fuel_price_correlations", with_(SNAPS, LATEST_FUEL) + " UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, {rhu(f'corr({a}, {b})', 9)} AS correlation FROM fuel"
    for i, a in enumerate(["regular", "mid_grade", "premium", "diesel"])
    for b in ["regular", "mid_grade", "premium", "diesel"][i + 1:]))
def a24_fuel_price_correlations(spark, sf):
    c = eda.correlation_pairs(latest_fuel(spark, sf), ["regular", "mid_grade", "premium", "diesel"], keep_all=True)
    return c.select("var1", "var2", round_half_up("correlation", 9).alias("correlation"))


@query("a25_population_box_by_region", with_(ENTITIES) + """
SELECT region, COUNT(population) AS n, """ + ", ".join(f"{rhu(f'quantile_cont(population, {p})', 6)} AS {n}" for n, p in
  [("q0", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("q4", 1.0)]) + """,
  COUNT(*) FILTER (WHERE population < q1x - 1.5 * (q3x - q1x) OR population > q3x + 1.5 * (q3x - q1x)) AS outliers
FROM (SELECT ent.*, quantile_cont(population, 0.25) OVER (PARTITION BY region) AS q1x,
             quantile_cont(population, 0.75) OVER (PARTITION BY region) AS q3x FROM ent)
GROUP BY region""")
def a25_population_box_by_region(spark, sf):
    """Box statistics of population per region (distributed quantiles)."""
    return _r(eda.box_stats(plain(spark, sf).select("region", "population"), ["region"], "population"), 6)


def _hist_sql(bins: int) -> str:
    b = f"CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((l_extendedprice - lo) / (hi - lo) * {bins}) + 1, {bins}) END AS INTEGER)"
    return f"""WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
h AS (SELECT {b} AS bin, COUNT(*) AS count FROM lineitem, mm WHERE l_extendedprice IS NOT NULL GROUP BY 1)
SELECT bin, count, {rhu(f'lo + (bin - 1) * ((hi - lo) / {bins})', 6)} AS bin_start, {rhu(f'lo + bin * ((hi - lo) / {bins})', 6)} AS bin_end,
  (SELECT {rhu('avg(l_extendedprice)', 4)} FROM lineitem) AS mean,
  (SELECT {rhu('quantile_cont(l_extendedprice, 0.5)', 6)} FROM lineitem) AS median FROM h, mm"""


def _hist(spark, sf, bins):
    h = eda.histogram(B.table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice", bins)
    return h.withColumns({"bin_start": round_half_up("bin_start", 6), "bin_end": round_half_up("bin_end", 6),
                          "mean": round_half_up("mean", 4), "median": round_half_up("median", 6)})


@query("a26_price_histogram", _hist_sql(30))
def a26_price_histogram(spark, sf):
    """30 equal-width bins of the line price, mean and median beside them."""
    return _hist(spark, sf, 30)


@query("a26_price_histogram_15", _hist_sql(15))
def a26_price_histogram_15(spark, sf):
    """The report's form with 15 bins."""
    return _hist(spark, sf, 15)


@query("a27_describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT({c}) AS count, {rhu(f'avg({c})', 6)} AS mean, {rhu(f'stddev_samp({c})', 6)} AS std,
  {rhu(f'min({c})', 6)} AS min, {rhu(f'quantile_cont({c}, 0.25)', 6)} AS q25, {rhu(f'quantile_cont({c}, 0.5)', 6)} AS median,
  {rhu(f'quantile_cont({c}, 0.75)', 6)} AS q75, {rhu(f'max({c})', 6)} AS max FROM lineitem""" for c in LI_COLS))
def a27_describe(spark, sf):
    """Count, mean, std, min, quartiles and max per numeric column."""
    return _r(eda.describe(_li(spark, sf), LI_COLS))


_I1_NUM = ["population", "rank", "population_per_rank"]
_I1_CORR = " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, {rhu(f'corr({a}, {b})', 9)} AS r FROM ent"
                              for i, a in enumerate(_I1_NUM) for b in _I1_NUM[i + 1:])


@query("i01_insights", with_(ENTITIES, f"""reg AS (SELECT region, CAST(SUM(CAST(population AS DECIMAL(30,2))) AS DOUBLE) AS t, avg(population) AS m
  FROM ent GROUP BY region),
pc AS ({_I1_CORR}),
st AS (SELECT min(population) AS lo, max(population) AS hi, avg(population) AS m, stddev_samp(population) / avg(population) AS cv,
  avg(population_per_rank) AS eff, quantile_cont(population, 0.9) / quantile_cont(population, 0.1) AS ratio FROM ent)""") + f"""
SELECT 'population_range' AS insight_key, printf('Population ranges from %.2f to %.2f', {rhu('lo', 2)}, {rhu('hi', 2)}) AS text FROM st
UNION ALL SELECT 'population_mean', printf('Average population is %.2f with CV of %.4f', {rhu('m', 2)}, {rhu('cv', 4)}) FROM st
UNION ALL SELECT 'strong_pairs', printf('Found %d strong correlations between variables', (SELECT COUNT(*) FROM pc WHERE abs(r) > 0.5))
  FROM st WHERE (SELECT COUNT(*) FROM pc WHERE abs(r) > 0.5) > 0
UNION ALL SELECT 'pair_' || var1 || '~' || var2, printf('Strong correlation: %s vs %s (%.4f)', var1, var2, {rhu('r', 4)}) FROM pc WHERE abs(r) > 0.5
UNION ALL SELECT 'highest_average_region', 'Region with highest average population: ' || arg_max(region, m) FROM reg
UNION ALL SELECT 'average_efficiency', printf('Average efficiency score: %.4f', {rhu('eff', 4)}) FROM st
UNION ALL SELECT 'population_ratio_90_10', printf('Population disparity: Top 10%% have %.4fx more population than bottom 10%%', {rhu('ratio', 4)}) FROM st
UNION ALL SELECT 'largest_region', 'Largest region by population: ' || arg_max(region, t) FROM reg""")
def i01_insights(spark, sf):
    """The findings of the profile and of the KPI summary as rows: range
    and variation of population, strong correlations (they exist: population,
    rank and their ratio), best regions, mean efficiency and the 90/10 ratio."""
    e = materialize(ent(spark, sf).select("state", "region", *_I1_NUM))
    return eda.insights(e, _I1_NUM)


def _i2_sql() -> str:
    from haulage.plans.catalog import ORACLE
    stats = ORACLE["a18_descriptive_statistics"]
    dist = ORACLE["a21_distribution_analysis"]
    corr = ORACLE["a19_correlation_matrix"]
    s_cols = ["count"] + _A18_COLS[1:]
    d_cols = ["n", "jb_p_value", "outliers_count", "outlier_percentage"]
    parts = [f"SELECT 'descriptive' AS section, \"column\" AS item, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM s"
             for c in s_cols]
    parts += [f"SELECT 'distribution', \"column\", '{c}', CAST({c} AS DOUBLE) FROM d" for c in d_cols]
    parts += ["SELECT 'correlation', var1 || '~' || var2, 'correlation', CAST(correlation AS DOUBLE) FROM c"]
    parts += [f"SELECT 'profile', 'lineitem.{c}', 'nulls', CAST((SELECT COUNT(*) FROM lineitem WHERE {c} IS NULL) AS DOUBLE)"
              for c in TABLE_COLUMNS["lineitem"]]
    parts += ["SELECT 'shape', 'lineitem', 'rows', CAST(COUNT(*) AS DOUBLE) FROM lineitem",
              f"SELECT 'shape', 'lineitem', 'columns', {float(len(TABLE_COLUMNS['lineitem']))}"]
    text = {"l_returnflag", "l_linestatus", "l_shipdate"}
    parts += [f"SELECT 'column', '{c}', '{'categorical' if c in text else 'numeric'}', 1.0" for c in TABLE_COLUMNS["lineitem"]]
    reg = ORACLE["a22_regional_analysis"]
    r_cols = ["count", "avg_population", "avg_rank", "total_population", "population_std", "best_rank", "worst_rank"]
    parts += [f"SELECT 'regional', region, '{c}', CAST({c} AS DOUBLE) FROM (SELECT * FROM r)" for c in r_cols]
    return (f"WITH r AS ({reg}), s AS ({stats}), d AS ({dist}), c AS ({corr})\n" + "\nUNION ALL\n".join(parts))


@query("i02_eda_summary", _i2_sql())
def i02_eda_summary(spark, sf):
    """Shape, columns, null profile, descriptive statistics, distribution
    tests and correlations of the line-item table, and the regional table of
    the entities, in one long table (the findings in words are I1)."""
    whole = B.table(spark, sf, "lineitem")
    li = _li(spark, sf)
    stats = _r(eda.descriptive_statistics(li, LI_COLS))
    dist = eda.distribution_analysis(li, LI_COLS).withColumn("jb_p_value", round_half_up("jb_p_value", 9)).withColumn(
        "outlier_percentage", round_half_up("outlier_percentage", 6))
    corr = eda.correlation_pairs(li, LI_COLS, keep_all=True).withColumn("correlation", round_half_up("correlation", 9))
    prof = eda.table_profile({"lineitem": whole})
    return (eda.eda_summary(stats, dist, corr, prof).unionByName(eda.shape_rows(whole, "lineitem"))
            .unionByName(eda.regional_rows(a22_regional_analysis(spark, sf))))
