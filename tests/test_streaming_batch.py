import json

from pyspark.sql import functions as F

from haulage.plans import batch
from haulage.streaming import snapshots

SF = "/root/testdata/sf0.001"


def _land(path, rows):
    path.mkdir(parents=True, exist_ok=True)
    with open(path / f"part-{len(list(path.iterdir()))}.json", "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def test_snapshot_stream_append_and_latest(spark, tmp_path):
    land = tmp_path / "landing"
    a = {"state": "CA", "regular": 5.0, "mid_grade": 5.1, "premium": 5.2, "diesel": 6.0,
         "pipeline_run_id": "r1", "scraped_at": "2024-01-01T10:00:00", "data_source": "AAA"}
    b = dict(a, regular=None, diesel=6.5, pipeline_run_id="r2", scraped_at="2024-01-02T10:00:00")
    _land(land, [a, dict(a, state="TX", diesel=4.0)])
    _land(land, [b, b])  # re-delivered row
    table, latest = str(tmp_path / "snapshots"), str(tmp_path / "latest")
    q = snapshots.append_to_table(snapshots.deduplicated(snapshots.read_snapshots(spark, str(land))),
                                  table, name=f"append-{tmp_path.name}")
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 3
    q2 = snapshots.publish_latest(snapshots.read_snapshots(spark, str(land)), latest, name=f"latest-{tmp_path.name}")
    q2.awaitTermination(120)
    got = {r.state: r for r in snapshots.read_published(spark, latest).collect()}
    assert (got["CA"].regular, got["CA"].diesel) == (5.0, 6.5)
    batch_view = {r.state: r for r in snapshots.latest_from_table(spark, table).collect()}
    assert batch_view["CA"].diesel == 6.5 and batch_view["TX"].diesel == 4.0


def test_batch_tables(spark, tmp_path):
    out = str(tmp_path / "out")
    summary = batch.store_freight_tables(spark, SF, out).first()
    assert summary.state_rows > 0 and summary.lane_rows <= 100
    lanes = spark.read.parquet(f"{out}/freight_lanes")
    assert lanes.count() == summary.lane_rows
    flows = spark.read.parquet(f"{out}/flows")
    assert "year" in flows.columns
    bal = spark.read.parquet(f"{out}/freight_trade_balance")
    assert abs(bal.agg(F.sum("net_tons")).first()[0]) < 1e-6
    cs = batch.store_cost_tables(spark, SF, out).first()
    assert cs.routes == spark.read.parquet(f"{out}/route_costs").count()
    assert spark.read.parquet(f"{out}/lane_efficiency").count() > 0
