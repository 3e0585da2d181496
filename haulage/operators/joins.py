"""Join-shaped operators.

Dimension-sized sides are broadcast explicitly only when their size is fixed
(state or region dimensions); entity-sized sides are left to the planner so
the size-checked broadcast threshold / AQE decides, with sort-merge join and
skew splitting beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.session import small_side

PRICE_COLS = ["regular", "mid_grade", "premium", "diesel"]


def latest_per_key(snapshots: DataFrame, key: str = "state", ts: str = "scraped_at",
                   value_cols: list[str] | None = None) -> DataFrame:
    """For each key, the latest non-null value of every column by ``ts``
    (``max_by`` ignores rows whose ordering value is null, so the ordering is
    nulled where the value is null), plus the latest ``ts``. One groupBy with
    partial aggregation; a hot key is combined map-side."""
    cols = value_cols or PRICE_COLS
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ts))).alias(c) for c in cols]
    return snapshots.groupBy(key).agg(*aggs, F.max(ts).alias(ts))


def enrich_left(base: DataFrame, other: DataFrame | None, key: str = "state",
                columns: list[str] | None = None) -> DataFrame:
    """Left join on ``key``; a missing optional table
    (None) adds the columns as typed nulls instead (S14 semantics)."""
    if other is None:
        out = base
        for c in columns or []:
            out = out.withColumn(c, F.lit(None).cast("double"))
        return out
    right = other.select(key, *(columns or [c for c in other.columns if c != key]))
    return base.join(right, key, "left")


def full_outer_coalesce(left: DataFrame, right: DataFrame, key: str,
                        coalesce_cols: list[str]) -> DataFrame:
    """Full outer join, coalesced key and coalesced shared columns (left
    value first)."""
    l = left.alias("l")
    r = right.alias("r")
    j = l.join(r, F.col(f"l.{key}") == F.col(f"r.{key}"), "full")
    keep_l = [c for c in left.columns if c != key and c not in coalesce_cols]
    keep_r = [c for c in right.columns if c != key and c not in coalesce_cols and c not in keep_l]
    return j.select(F.coalesce(F.col(f"l.{key}"), F.col(f"r.{key}")).alias(key),
                    *[F.col(f"l.{c}") for c in keep_l],
                    *[F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c) for c in coalesce_cols],
                    *[F.col(f"r.{c}") for c in keep_r])


def group_stats_to_rows(df: DataFrame, group: str, value: str, prefix: str) -> DataFrame:
    """Per-group mean and sample std of ``value`` mapped back to rows. The
    stats have one row per group and are broadcast if counted to be few, so
    the rows are not shuffled to a handful of group keys."""
    stats = df.groupBy(group).agg(F.avg(value).alias(f"{prefix}_mean"),
                                  F.stddev_samp(value).alias(f"{prefix}_std"))
    return df.join(small_side(stats), group, "left")


def semi(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in ``keys`` (no columns added, no duplicates)."""
    return df.join(keys.select(on), on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not in ``keys``."""
    return df.join(keys.select(on), on, "left_anti")


def dedupe_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key subset, keeping the first row by ``order``
    (ascending; ties broken by the remaining columns). Written as an
    aggregate (``min_by`` over the row) so a hot key is reduced map-side
    instead of being gathered in one window partition."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    return (df.groupBy(*keys).agg(F.min_by(row, rank).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]))


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str, defaults: dict) -> DataFrame:
    """Left lookup against a small dimension with default values for
    misses (``coalesce``)."""
    j = df.join(dim, key, "left")
    for c, v in defaults.items():
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return j
