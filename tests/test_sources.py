from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.sources import apis, files, html

PAGE = """<html><body><table><tr><th>Rank</th><th>State or territory</th><th>Census population [1]</th></tr>
<tr><td>1</td><td><a href='x'>California</a><sup>[a]</sup></td><td>39,538,223</td></tr>
<tr><td>2</td><td>Texas</td><td>29,145,505</td></tr>
<tr><td>3</td><td>Nowhere</td><td>n/a</td></tr></table><table><tr><td>ignored</td></tr></table></body></html>"""

NO_HEADER_MATCH = """<table><tr><th>a</th><th>b</th><th>c</th></tr><tr><td>x</td><td>Ohio[c]</td><td>11,799,448</td></tr></table>"""

PRICES = """<table><tr><th>State</th><th>Regular</th><th>Mid</th><th>Premium</th><th>Diesel</th></tr>
<tr><td> Alaska </td><td>$3.913</td><td>$4.118</td><td>$4.286</td><td>$4.213</td></tr>
<tr><td>Iowa</td><td>$2.950</td><td>bad</td><td>$3.7</td><td>$3.6</td></tr></table>"""


def test_population_table_header_sniffing(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, NO_HEADER_MATCH)], "page_id long, html string")
    got = {(r.page_id, r.state): r.new_population for r in html.population_table(pages).collect()}
    assert got == {(1, "CALIFORNIA"): 39538223.0, (1, "TEXAS"): 29145505.0, (1, "NOWHERE"): None,
                   (2, "OHIO"): 11799448.0}


def test_fuel_price_table(spark):
    pages = spark.createDataFrame([(7, PRICES)], "page_id long, html string")
    rows = {r.state_raw: r for r in html.fuel_price_table(pages).collect()}
    assert rows["ALASKA"].regular == 3.913 and rows["ALASKA"].diesel == 4.213
    assert rows["IOWA"].mid_grade is None


def test_eia_rows(spark):
    payload = '{"response": {"data": [{"value": "3.1", "period": "2024-01-01", "area-name": "U.S."}, {"value": "x", "period": "2024-01-08"}]}}'
    raw = spark.createDataFrame([("EPD2D", "NUS", payload), ("EPM0R", "SCA", payload)], "product_code string, area_code string, payload string")
    rows = apis.eia_rows(raw).orderBy("state", "period").collect()
    assert [(r.state, r.fuel_type, r.price) for r in rows] == [
        ("CA", "regular", 3.1), ("CA", "regular", None), ("US", "diesel", 3.1), ("US", "diesel", None)]
    assert rows[1].area_name == "CA"


def test_truck_rates_defaults_and_regions(spark):
    recs = ['{"year": "2025", "quarter": "2", "region": "GREAT LAKES", "destination": " boston ", "rate_per_mile": "2.123456"}',
            '{"year": "2025", "region": "OTHER", "destination": "x", "rate_per_mile": "bad", "rate_per_truckload": "100.555"}',
            '{"year": "2024", "region": "TEXAS"}', '{"region": "SOMEWHERE"}']
    raw = spark.createDataFrame([(p,) for p in recs], "payload string")
    r = apis.truck_rates(raw, 2025).orderBy("_region").collect()
    assert [(x.origin_state, x.quarter, x.destination, x.rate_per_mile) for x in r] == [
        ("IL,IN,MI,OH,WI", 2, "BOSTON", 2.1235), (None, 1, "X", 0.0), ("SOMEWHERE", 1, "", 0.0)]
    assert r[1].rate_per_truckload == 100.56
    exploded = apis.rates_by_state(apis.truck_rates(raw, 2025))
    assert exploded.count() == 6


def test_weather_rows(spark):
    p = '{"main": {"temp": 71.5, "humidity": 40, "feels_like": 70}, "wind": {"speed": 3.2}, "weather": [{"description": "light rain"}]}'
    r = apis.weather_rows(spark.createDataFrame([("WA", p)], "state string, payload string")).first()
    assert (r.temperature, r.condition, r.humidity, r.wind_speed) == (71.5, "Light Rain", 40.0, 3.2)


def test_table_sinks_and_optional(spark, tmp_path):
    df = spark.createDataFrame([(2024, 1.0), (2023, 2.0)], "year int, tons double")
    path = str(tmp_path / "t")
    files.write_table(df, path, partition_by=["year"])
    files.write_table(df.where(F.col("year") == 2024), path, mode="append", partition_by=["year"])
    back = files.read_table(spark, path)
    assert back.count() == 3 and back.where(F.col("year") == 2023).count() == 1
    schema = T.StructType([T.StructField("x", T.IntegerType())])
    assert files.optional_table(spark, str(tmp_path / "missing"), schema).count() == 0
    assert files.optional_table(spark, "no_such_table", schema).columns == ["x"]
    files.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    stamped = files.stamp(df, "run-7", "AAA", "scraped_at")
    assert set(stamped.columns) == {"year", "tons", "pipeline_run_id", "scraped_at", "data_source"}


def test_flow_csv_pruned(spark, tmp_path):
    p = tmp_path / "faf.csv"
    head = ["fr_orig"] + files.FLOW_KEYS + [f"tons_{y}" for y in files.FLOW_YEARS] + [f"value_{y}" for y in files.FLOW_YEARS]
    p.write_text(",".join(head) + "\n" + ",".join(["x", "6", "48", "1", "2", "1"] + ["1.5"] * 14) + "\n")
    df = files.read_flow_csv(spark, str(p), schema=files.flow_file_schema(extra_leading=["fr_orig"]))
    assert "fr_orig" not in df.columns and df.first().tons_2024 == 1.5


def test_fuel_ingest_stamps_and_fails_when_empty(spark):
    import pytest

    from haulage.operators.cleaning import ingest_fuel_pages
    pages = spark.createDataFrame([(7, PRICES)], "page_id long, html string")
    valid, rejects = ingest_fuel_pages(pages, "run-9")
    rows = valid.collect()
    assert [(r.state, r.pipeline_run_id, r.data_source) for r in rows] == [("AK", "run-9", "AAA")]
    assert rejects.count() == 1
    bad = spark.createDataFrame([(1, "<table><tr><td>Atlantis</td><td>$1</td></tr></table>")], "page_id long, html string")
    with pytest.raises(ValueError):
        ingest_fuel_pages(bad, "run-9")
