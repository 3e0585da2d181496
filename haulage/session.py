"""SparkSession configuration and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and partition counts at
# runtime from real shuffle statistics; skew-join splitting is on so one hot
# key cannot pin a single task. Dimension broadcasts are explicit only for
# tables of fixed size; everything else goes through the size-checked
# autoBroadcastJoinThreshold (static estimate and AQE runtime size).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "haulage", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    On a cluster call it without ``master``; the launcher decides. In tests
    pass ``master="local[*]"`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    is used as is. Only a local session with no setting (tests, laptop runs)
    gets a fresh temporary folder. A cluster without the setting is an error:
    a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set at all
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        base = os.environ.get("TMPDIR", "/tmp")
        path = tempfile.mkdtemp(prefix="haulage-ckpt-", dir=base)
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")


def clean(spark: SparkSession) -> bool:
    """Remove this application's checkpoint folder: scratch tables, stored lane and
    routing tables, checkpoints of batches and streams. For the end of a job, once
    its results are written; DataFrames that read scratch tables can't be used
    afterwards. Returns whether there was anything to remove."""
    path = spark.sparkContext.getCheckpointDir()
    if not path:
        return False
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.exists(at) and fs.delete(at, True)
    fs.mkdirs(at)
    return bool(found)


def scratch_path(spark: SparkSession, kind: str = "tables") -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster) for intermediate tables and round trips."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def small_side(df, limit: int = 100_000):
    """``df`` stored once, and marked for broadcast if it is counted to have at
    most ``limit`` rows; else the join is left to the size-checked threshold."""
    from pyspark.sql import functions as F
    stored = materialize(df)
    return F.broadcast(stored) if stored.count() <= limit else stored


def materialize(df):
    """Eager reliable checkpoint: computes ``df`` once, stores it in the shared
    checkpoint folder and cuts its lineage, so several consumers (and a
    recomputation after executor loss) read the stored copy instead of
    re-running the plan. Meant for aggregated, reused intermediates."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
