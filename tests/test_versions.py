"""Merges and refreshes that touch only what changed, and survive a failed run."""

import os

import pytest
from pyspark.sql import functions as F

from haulage.operators import cleaning, freight
from haulage.plans.incremental import LaneStates
from haulage.sources import files
from haulage.sources.master import MasterTable
from haulage.sources.versions import Versions


def _master(spark, path, n=200):
    rows = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").cast("double").alias("v"), F.lit(None).cast("string").alias("run"))
    t = MasterTable(spark, str(path))
    t.create(rows, "key", 8)
    return t


def _stamp(df):
    return df.withColumn("run", F.lit("r"))


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    t = _master(spark, tmp_path / "m")
    before = t.versions.current().folders
    up = spark.createDataFrame([("k3", 1000.0), ("k7", None), ("gone", 5.0)], "key string, v double")
    touched = t.merge(up, _stamp)
    after = t.versions.current().folders
    assert set(after) == set(before) and 1 <= len(touched) <= 3
    assert {b for b in before if before[b] != after[b]} <= {str(b) for b in touched}
    got = {r.key: (r.v, r.run) for r in t.read().collect()}
    assert len(got) == 200 and got["k3"] == (1000.0, "r") and got["k7"] == (7.0, "r") and got["k5"] == (5.0, None)
    t.merge(spark.createDataFrame([("gone", 5.0)], "key string, v double"), _stamp, insert=True)
    assert {r.key: (r.v, r.run) for r in t.read().collect()}["gone"] == (5.0, "r") and t.read().count() == 201
    assert t.merge(spark.createDataFrame([], "key string, v double")) == []


def test_failed_merge_leaves_the_old_version(spark, tmp_path):
    t = _master(spark, tmp_path / "m")
    version = t.versions.current().version
    up = spark.createDataFrame([(f"k{i}", -1.0) for i in range(50)], "key string, v double")
    with pytest.raises(Exception):
        t.merge(up, lambda df: df.withColumn("v", F.when(F.col("key") == "k9", F.raise_error(F.lit("stop"))).otherwise(F.col("v"))))
    assert t.versions.current().version == version and t.read().agg(F.min("v")).first()[0] == 0.0
    t.merge(up)
    assert t.read().where("v = -1").count() == 50
    rows = sorted(map(tuple, t.read().collect()))
    assert t.versions.vacuum() >= 1 and sorted(map(tuple, t.read().collect())) == rows


def test_second_writer_of_a_version_fails(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "v"))
    start = v.current()
    v.commit(start, {"a": "data/x"}, {"n": 1})
    with pytest.raises(RuntimeError):
        v.commit(start, {"a": "data/y"}, {})
    assert v.current().folders == {"a": "data/x"} and v.current().info == {"n": 1}
    with pytest.raises(FileNotFoundError):
        MasterTable(spark, str(tmp_path / "none")).read()


FLOW = "origin string, destination string, commodity string, mode string, year int, tons double, value double"


def _totals(df):
    return {r.year: (r.tons_m, r.value_b) for r in freight.yearly_totals(df).collect()}


def test_states_read_only_new_files(spark, tmp_path):
    at = tmp_path / "flows"
    first = spark.createDataFrame([("A", "B", "x", "Truck", 2020, 1500.0 * i, 10.25) for i in range(20)], FLOW)
    first.coalesce(1).write.parquet(str(at))
    states = LaneStates(spark, str(at), str(tmp_path / "states"))
    assert len(states.refresh()) == 1 and states.refresh() == []
    old, = [p for p in at.iterdir() if p.suffix == ".parquet"]
    keep, stat = old.read_bytes(), old.stat()
    old.write_bytes(b"\0" * len(keep))  # it would fail if it were read again
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    second = spark.createDataFrame([("A", "B", "x", "Truck", 2021, 10.0, 1.0), ("A", "C", "y", "Rail", 2020, 5000.0, 2000.5)], FLOW)
    second.coalesce(1).write.mode("append").parquet(str(at))
    read = states.refresh()
    assert len(read) == 1 and old.name not in read[0]
    assert _totals(states.table()) == _totals(first.unionByName(second))
    old.write_bytes(keep)
    os.utime(old, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    old.unlink()
    assert states.refresh() == [] and _totals(states.table()) == _totals(second)


def test_contract_counts_come_from_the_write(spark, tmp_path):
    rows = [(i, float(i % 5) - 1, "x" if i % 3 else "") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, p double, s string").repartition(4)
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b
    contract = [("p", F.col("p") > 0), ("s", F.length("s") > 0)]
    valid, counts = cleaning.write_valid(df.mapInArrow(count, df.schema), contract, str(tmp_path / "ok"))
    assert calls.value == 300  # every row went by once
    want = cleaning.apply_contract(df, contract)
    assert sorted(map(tuple, valid.collect())) == sorted(map(tuple, want[0].collect()))
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in cleaning.reject_counts(want[1]).collect()}
    assert calls.value == 300


def test_snapshots_with_other_columns(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([(1, 2.5)], "state long, Regular double").write.parquet(path)
    spark.createDataFrame([(4.5, 2, "n")], "diesel double, state long, note string").write.mode("append").parquet(path)
    spark.createDataFrame([(3, 1.0, 2.0)], "state long, Regular double, diesel double").write.mode("append").parquet(path)
    schema = spark.createDataFrame([], "state int, regular double, diesel double, premium float").schema
    df = files.read_snapshots(spark, path, schema)
    assert df.schema == schema
    assert sorted(map(tuple, df.collect())) == [(1, 2.5, None, None), (2, None, 4.5, None), (3, 1.0, 2.0, None)]
