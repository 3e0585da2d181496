import json

from pyspark.sql import functions as F

from haulage.operators import routes
from haulage.sources import apis

GOOD = {"response": {"data": [{"value": "3.5", "period": "2024-01-01", "area-name": "U.S."}, {"value": "x", "period": "2024-01-08"}]}}


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_multi_line_responses_with_broken_ones(spark, tmp_path):
    at = tmp_path / "fuel"
    _write(at / "product_code=EPM0R" / "area_code=NUS" / "a.json", json.dumps(GOOD, indent=2))
    _write(at / "product_code=EPM0R" / "area_code=NUS" / "b.json", json.dumps(GOOD, indent=2)[:60])
    _write(at / "product_code=EPD2D" / "area_code=SCA" / "c.json", json.dumps({"error": "limit"}))
    _write(at / "product_code=EPD2D" / "area_code=SCA" / "d.json", "<html>busy</html>")
    load = apis.eia_landed(spark, str(at), str(tmp_path / "out"))
    rows = apis.eia_flat(load.rows).collect()
    assert [(r.state, r.fuel_type, r.price, r.period, r.area_name) for r in rows] == [
        ("US", "regular", 3.5, "2024-01-01", "U.S."), ("US", "regular", None, "2024-01-08", "US")]
    assert {r.reason: r.rejects for r in load.reject_counts().collect()} == {"malformed": 2, "no_data": 1}
    raw = {r.file.rsplit("/", 1)[1]: r.raw for r in load.rejects.collect()}
    assert raw["b.json"].startswith('{\n  "response"') and raw["d.json"] == "<html>busy</html>"


def test_array_pages(spark, tmp_path):
    recs = [{"year": "2024", "quarter": "2", "region": "CALIFORNIA", "destination": " boston "}, {"destination": "x"}]
    _write(tmp_path / "in" / "page=p1" / "a.json", json.dumps(recs, indent=1))
    _write(tmp_path / "in" / "page=p2" / "a.json", json.dumps(recs)[:-5])
    load = apis.rates_landed(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [r.destination for r in apis.typed_rates(load.rows, 2024).collect()] == ["BOSTON"]
    counts = {r.reason: r.rejects for r in load.reject_counts().collect()}
    assert counts["no_region"] >= 1 and counts["malformed"] == 1


def test_lines_and_empty_folder(spark, tmp_path):
    line = {"origin": "A", "destination": "B", "response": {"code": "Ok", "routes": [{"distance": 1609.34, "duration": 3600.0}]}}
    none = {"origin": "A", "destination": "C", "response": {"code": "NoRoute", "routes": []}}
    _write(tmp_path / "in" / "a.json", "\n".join([json.dumps(line), json.dumps(none), json.dumps(line)[:25], "", "null"]))
    load = routes.routing_landed(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [tuple(r) for r in routes.routed_legs(load.rows).collect()] == [("A", "B", 1.0, 1.0)]
    assert {r.reason: r.rejects for r in load.reject_counts().collect()} == {"malformed": 2, "no_route": 1}
    empty = spark.createDataFrame([], "value string")
    empty.write.text(str(tmp_path / "none"))
    load = apis.weather_landed(spark, str(tmp_path / "none"), str(tmp_path / "out2"))
    assert load.rows.count() == 0 and load.rejects.agg(F.count("*")).first()[0] == 0
