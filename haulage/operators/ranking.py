"""Global ranks without a single-partition window (W1, W2, W7, entity rank).

``Window.orderBy(x)`` with no partition key sends every row to one task. The
helpers here rank over the whole table while keeping the work spread out:

1. range-partition the (unique) ordering keys into P slices, sort each, and add
   the running sum inside the slice in the same task, batch by batch; checkpoint
   the rows, so the slice a row lands in is fixed even if a stage is recomputed;
2. total the weight of each slice (P rows) and turn the totals into offsets
   with a window over those P rows only;
3. add a slice's offset (P rows, broadcast). The rows are shuffled once.

Ties are handled on the distinct values: ``groupBy(value).count()`` first
(a hot value collapses to one row during the map-side partial aggregate),
then the cumulative counts of smaller values give rank, average rank,
percent rank and cumulative distribution; the result is joined back on the
value, where AQE's skew-join split or a size-checked broadcast applies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.operators.selection import select_quantiles
from haulage.session import materialize


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _running_sums(batches):
    """The rows of a sorted slice with its number and the weight before each row."""
    part, before = TaskContext.get().partitionId(), 0
    for b in batches:
        w = np.asarray(b.column(b.num_columns - 1), np.int64)
        sums = np.cumsum(w)
        cols = [*b.columns[:-1], pa.array(w), pa.array(np.full(len(w), part, np.int32)), pa.array(before + sums - w)]
        yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:-1], "_w", "_slice", "_inside"])
        before += int(sums[-1]) if len(sums) else 0


def global_cumsum(df: DataFrame, order_cols: list, weight: str | None,
                  out: str = "cum_before", partitions: int | None = None) -> DataFrame:
    """Add ``out`` = total ``weight`` (1 per row if None) of all rows strictly
    before each row in ``order_cols`` order. The order must be unique."""
    n_parts = _partitions(df, partitions)
    w = F.col(weight) if weight else F.lit(1)
    ranged = (df.withColumn("_w", w.cast("long"))
              .repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols))
    schema = T.StructType([*ranged.schema.fields, T.StructField("_slice", T.IntegerType()), T.StructField("_inside", T.LongType())])
    placed = materialize(ranged.mapInArrow(_running_sums, schema))
    totals = placed.groupBy("_slice").agg(F.sum("_w").alias("_tot"))
    # At most n_parts rows: a window over them in one task is bounded.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_slice", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))
    return (placed.join(F.broadcast(offsets), "_slice")
            .withColumn(out, F.col("_off") + F.col("_inside"))
            .drop("_slice", "_off", "_w", "_inside"))


def global_row_number(df: DataFrame, order_cols: list, out: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """1-based position in a total order (``order_cols`` must make rows unique;
    pass a tie key last)."""
    return (global_cumsum(df, order_cols, None, out="_before", partitions=partitions)
            .withColumn(out, (F.col("_before") + 1).cast("long"))
            .drop("_before"))


def value_ranks(df: DataFrame, value: str, prefix: str = "", descending: bool = False,
                count_nulls_in_n: bool = False, partitions: int | None = None) -> DataFrame:
    """Attach tie-aware ranks of ``value`` to every row.

    Adds ``{prefix}n`` (the n used), ``{prefix}rank`` (min rank, as SQL RANK), ``{prefix}avg_rank``
    (average of tied positions, as pandas ``rank()``), ``{prefix}percent_rank``
    ((rank-1)/(n-1), 0 when n = 1) and ``{prefix}cume_dist`` (share of rows
    <= value). Null values get null ranks. ``n`` counts non-null rows, or all
    rows when ``count_nulls_in_n`` (SQL ``percent_rank`` with nulls last).
    """
    v = F.col(value)
    key = (-v) if descending else v
    counts = (df.where(v.isNotNull())
              .groupBy(key.alias("_key"))
              .agg(F.count(F.lit(1)).alias("_n")))
    cum = global_cumsum(counts, ["_key"], "_n", out="_before", partitions=partitions)
    # n is a scalar subquery: computed once, inlined as a value (no join).
    # Non-null n comes from the (checkpointed) distinct-value counts.
    n_col = (df.select(F.count(F.lit(1))) if count_nulls_in_n else cum.select(F.sum("_n"))).scalar()
    ranks = (cum
             .select(
                 "_key",
                 (F.col("_before") + 1).cast("long").alias(prefix + "rank"),
                 (F.col("_before") + (F.col("_n") + 1) / 2.0).alias(prefix + "avg_rank"),
                 F.when(n_col <= 1, F.lit(0.0))
                  .otherwise(F.col("_before") / (n_col - 1)).alias(prefix + "percent_rank"),
                 ((F.col("_before") + F.col("_n")) / n_col).alias(prefix + "cume_dist"),
                 n_col.cast("long").alias(prefix + "n"),
             ))
    return (df.withColumn("_key", key)
            .join(ranks, "_key", "left")
            .drop("_key"))


def pct_ranks(df: DataFrame, outs: dict[str, str], partitions: int | None = None) -> DataFrame:
    """pandas ``rank(pct=True)`` (average rank of ties / number of non-null
    values) of several numeric columns: column -> name of its rank. The distinct
    values of all columns are ranked together, in one pass."""
    cols = list(outs)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "_column", "_value")
    counts = long.where("_value is not null").groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    cum = global_cumsum(counts, ["_column", "_value"], "_n", out="_before", partitions=partitions)
    starts = F.broadcast(cum.groupBy("_column").agg(F.min("_before").alias("_g0"), F.sum("_n").alias("_gn")))  # a row per column
    place = (F.col("_before") - F.col("_g0") + (F.col("_n") + 1) / 2.0) / F.col("_gn")
    ranks = cum.join(starts, "_column").select("_column", "_value", place.alias("_rank"))
    out = df
    for c in cols:
        mine = ranks.where(F.col("_column") == c).select(F.col("_value").alias("_key"), F.col("_rank").alias(outs[c]))
        out = out.withColumn("_key", F.col(c).cast("double")).join(mine, "_key", "left").drop("_key")
    return out


def grouped_quantiles(df: DataFrame, group_cols: list[str], value: str,
                      probs: dict[str, float], partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas ``quantile``, SQL
    ``percentile_cont``) per group, without holding a group in one task.

    Distinct (group, value) counts are prefix-summed globally (range
    partitioned), each group's start offset is subtracted, and one
    conditional aggregate picks the values at positions floor/ceil of
    (n - 1) * p. Returns one row per group with a column per name in
    ``probs`` (plus ``n``). Nulls are ignored; an all-null group gives null.
    With ``weight`` a row stands for that many equal values.
    """
    v = F.col(value)
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.where(v.isNotNull()).groupBy(*group_cols, v.alias("_v")).agg(size.alias("_n"))
    cum = global_cumsum(counts, [*group_cols, "_v"], "_n", out="_before", partitions=partitions)
    if group_cols:
        starts = cum.groupBy(*group_cols).agg(F.min("_before").alias("_g0"), F.sum("_n").alias("_gn"))
        local = cum.join(starts, group_cols)
    else:  # one group starting at 0; its size is a scalar subquery
        local = cum.withColumns({"_g0": F.lit(0).cast("long"), "_gn": counts.select(F.sum("_n")).scalar()})
    local = local.withColumn("_lb", F.col("_before") - F.col("_g0"))
    aggs, finals = [], []
    for name, p in probs.items():
        pos = (F.col("_gn") - 1) * float(p)
        lo, hi = F.floor(pos), F.ceil(pos)
        at_lo = (F.col("_lb") <= lo) & (lo < F.col("_lb") + F.col("_n"))
        at_hi = (F.col("_lb") <= hi) & (hi < F.col("_lb") + F.col("_n"))
        aggs += [F.max(F.when(at_lo, F.col("_v"))).alias(f"_lo_{name}"),
                 F.max(F.when(at_hi, F.col("_v"))).alias(f"_hi_{name}"),
                 F.first(pos).alias(f"_pos_{name}")]
        pcol = F.col(f"_pos_{name}")
        frac = pcol - F.floor(pcol)
        finals.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * frac).alias(name))
    picked = local.groupBy(*group_cols).agg(F.first("_gn").alias("n"), *aggs)
    return picked.select(*group_cols, "n", *finals)


def column_quantiles(df: DataFrame, probs: dict[str, dict[str, float]]) -> dict[str, dict]:
    """Exact whole-table quantiles of several columns as literal Columns, all
    from the same scans (``selection``). ``probs``: column -> name -> probability."""
    found = select_quantiles(df, probs)
    return {c: {n: F.lit(found[c][n]).cast("double") for n in probs[c]} for c in probs}


def quantile_scalars(df: DataFrame, value: str, probs: dict[str, float]) -> dict:
    """Exact quantiles of one column as literal Columns."""
    return column_quantiles(df, {value: probs})[value]
