import math

import pandas as pd
from pyspark.sql import functions as F

from haulage.operators import features, kpis, marts


def test_basic_kpis(shipping):
    r = kpis.basic_kpis(shipping).first()
    assert r.total_states == 5
    assert r.total_population == sum([38802500.0, 26956958.0, 19893297.0, 19746227.0, 12880580.0])
    assert r.median_population == 19893297.0
    assert r.avg_rank == 3.0


def test_empty_input_gives_no_row(spark, shipping):
    assert kpis.basic_kpis(shipping.limit(0)).count() == 0


def test_efficiency_and_distribution(shipping):
    e = kpis.efficiency_kpis(shipping).first()
    assert e.avg_efficiency > 0 and e.max_efficiency == 38802500.0
    d = kpis.distribution_kpis(shipping).first()
    pdf = pd.Series([38802500.0, 26956958.0, 19893297.0, 19746227.0, 12880580.0])
    assert math.isclose(d.population_90th_percentile, round(pdf.quantile(0.9), 4))
    assert math.isclose(d.population_10th_percentile, round(pdf.quantile(0.1), 4))


def test_fuel_and_regional_and_composite(spark, shipping, fuel):
    f = kpis.fuel_kpis(fuel).first()
    assert math.isclose(f.avg_diesel_price, round(sum([6.209, 4.567, 5.074, 4.993, 4.773]) / 5, 6))
    reg = features.assign_region(shipping, "postal")
    r = {x.region: x for x in kpis.regional_kpis(reg).collect()}
    assert r["West"].best_state_rank == "CA" and r["South"].state_count == 2
    c = kpis.composite_kpis(shipping).first()
    assert c.top_logistics_performer == "CA" and c.bottom_logistics_performer == "IL"


def test_quality_kpis_with_duplicate(spark, shipping):
    dup = shipping.unionByName(shipping.where(F.col("state") == "CA"))
    q = kpis.quality_kpis(dup).first()
    assert q.duplicate_states == 1 and q.unique_states == 5 and q.data_consistency_score == 90
    assert q.data_completeness == 100.0


def test_published_efficiency_and_burden(shipping, fuel):
    # CA: 38,802,500 / (6.209 x 100) = 62,493.96; burden = pop / max pop x diesel = 6.209
    fa = marts.freight_analysis(shipping, fuel).where(F.col("state") == "CA").first()
    assert round(fa.efficiency_score, 2) == 62493.96
    assert math.isclose(fa.fuel_burden_index, 6.209)


def test_scores_constant_column_and_zero_diesel(spark):
    df = spark.createDataFrame([("A", 10.0, 3.0), ("B", 10.0, 3.0), ("C", 10.0, 0.0)],
                               "state string, population double, diesel double")
    k = kpis.cost_efficiency(df).orderBy("state").collect()
    assert k[2].cost_efficiency_index is None  # zero diesel -> null
    o = kpis.freight_opportunity(df).orderBy("state").collect()
    # constant population: x / max = 1 -> 0.4 + 0.3; diesel spread: (3-3)/3 = 0 for A
    assert math.isclose(o[0].freight_opportunity_score, 70.0)
    assert math.isclose(o[2].freight_opportunity_score, 100.0)


def test_kpi_long_form(shipping, fuel):
    long = kpis.all_kpis({"basic": kpis.basic_kpis(shipping), "fuel": kpis.fuel_kpis(fuel)})
    cats = {r.category: r.n for r in long.groupBy("category").agg(F.count("*").alias("n")).collect()}
    assert cats == {"basic": 8, "fuel": 10}
