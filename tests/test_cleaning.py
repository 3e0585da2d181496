from pyspark.sql import functions as F

from haulage.functions import currency_to_double, number_text_to_double, strip_footnotes
from haulage.operators import cleaning
from haulage.sources import files


def test_clean_data_removes_invalid_rows(spark):
    raw = spark.createDataFrame(
        [("1", "California", "CA", "100"), ("0", "", "XX", "-1"), ("2", " Texas ", "TX", "200"),
         ("3", "NY", "NYX", "300")], "Rank string, State string, Postal string, Population string")
    clean, rejects = cleaning.clean_shipping(raw)
    rows = clean.collect()
    assert len(rows) == 2
    assert {r.state for r in rows} == {"CA", "TX"}
    assert "population_per_rank" in clean.columns
    assert [r.state for r in rows] == ["TX", "CA"]  # sorted by population desc
    reasons = {tuple(r.reasons) for r in rejects.collect()}
    assert ("rank", "state", "population") in reasons
    assert ("postal",) in reasons
    counts = {r.reason: r.rejected for r in cleaning.reject_counts(rejects).collect()}
    assert counts == {"rank": 1, "postal": 1}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "CA", "CA", 100.0)], "rank int, state string, postal string, population double")
    out = str(tmp_path / "clean")
    files.write_csv(df, out)
    back = files.read_csv(spark, out, "rank int, state string, postal string, population double")
    assert back.collect() == df.collect()


def test_state_normalisation_modes(spark):
    df = spark.createDataFrame([(" new york ",), ("tx",), ("Atlantis",), (None,)], "state string")
    got = [r.state for r in cleaning.normalize_state(df).orderBy(F.asc_nulls_last("state")).collect()]
    assert sorted([g for g in got if g]) == ["NY", "TX"] and got.count(None) == 2
    up = [r.state for r in cleaning.normalize_state(df, mode="upper").collect()]
    assert "ATLANTIS" in up


def test_text_to_numbers(spark):
    df = spark.createDataFrame([("$1,234.50", "Texas[b]", "29,145,505"), ("n/a", " Ohio ", "x")], "a string, b string, c string")
    r = df.select(currency_to_double("a").alias("a"), strip_footnotes("b").alias("b"),
                  number_text_to_double("c").alias("c")).collect()
    assert (r[0].a, r[0].b, r[0].c) == (1234.5, "TEXAS", 29145505.0)
    assert (r[1].a, r[1].b, r[1].c) == (None, "OHIO", None)


def test_weather_contract(spark):
    df = spark.createDataFrame([("CA", 101.0, 1.0, "Rain"), ("TX", 50.0, -1.0, "Sun"), ("NY", 50.0, 2.0, ""),
                                ("IL", 40.0, 0.0, "Clear")], "state string, humidity double, wind_speed double, condition string")
    valid, rejects = cleaning.apply_contract(df, cleaning.weather_contract())
    assert [r.state for r in valid.collect()] == ["IL"]
    assert sorted(r.reasons[0] for r in rejects.collect()) == ["condition", "humidity", "wind_speed"]


def test_names_and_present_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`Land Area` int, Rank int")
    n = cleaning.normalize_names(df)
    assert n.columns == ["land_area", "rank"]
    assert cleaning.select_present(n, ["rank", "missing", "land_area"]).columns == ["rank", "land_area"]
