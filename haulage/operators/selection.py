"""Exact quantiles of whole columns by repeated histogram refinement.

The position of a quantile is known from the count. A scan counts the values of
each column in equal-width bins over its range; the bin that holds a wanted
position becomes the next range. A bin also reports its smallest and largest
value, so ranges shrink to the values that occur, and a bin of one value is
done. Once few rows are left in the ranges, their distinct values are counted
and the positions read off. Nothing is sorted, and no value is shuffled but
those few: a scan sends at most bins x ranges x columns rows, whatever the table.
All columns share the scans, three as a rule.

Only bounded results reach the driver: the bins of a scan, and at the end at most
``finish`` values of each range.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.session import materialize

BINS = 1024     # bins of a range in one scan
FINISH = 2048   # rows left in a range that end its refinement


@dataclass
class _Range:
    """Values from ``low`` to ``high``: ``n`` rows after ``before`` smaller ones, and the wanted positions among them."""
    low: float
    high: float
    before: int
    n: int
    wanted: set[int] = field(default_factory=set)


def _bin(v: Column, r: _Range, bins: int) -> Column:
    """Bin of a value in a range: never falls as the value rises; the ends are in different bins."""
    half = r.high * 0.5 - r.low * 0.5  # halves, as the difference itself can overflow
    if half == 0 or not math.isfinite(1.0 / half):  # neighbours too close to divide by
        return (v > r.low).cast("int")
    at = F.floor((v * 0.5 - F.lit(r.low * 0.5)) / F.lit(half) * bins)
    return F.least(at, F.lit(bins - 1)).cast("int")


def _rows(narrow: DataFrame, ranges: dict[str, list[_Range]], label) -> DataFrame:
    """(column, label, value) of the values inside the ranges."""
    parts = []
    for c, rs in ranges.items():
        v, mark = F.col(f"`{c}`"), None
        for i, r in enumerate(rs):
            inside = (v >= r.low) & (v <= r.high)
            mark = F.when(inside, label(v, i, r)) if mark is None else mark.when(inside, label(v, i, r))
        if mark is not None:
            parts.append(F.struct(F.lit(c).alias("column"), mark.alias("label"), v.alias("value")))
    return narrow.select(F.explode(F.array(*parts)).alias("x")).select("x.*").where("label is not null")


def _place(r: _Range, groups: list[tuple[float, float, int]]) -> list[_Range]:
    """The groups (low, high, rows; ascending) of a range that hold wanted positions."""
    out, before = [], r.before
    for low, high, n in groups:
        wanted = {p for p in r.wanted if before <= p < before + n}
        if wanted:
            out.append(_Range(low, high, before, n, wanted))
        before += n
    return out


def select_positions(narrow: DataFrame, wanted: dict[str, set[int]], sizes: dict[str, tuple], bins: int, finish: int) -> dict:
    """(column, position) -> value for 0-based positions in ascending order."""
    found: dict[tuple[str, int], float] = {}
    ranges: dict[str, list[_Range]] = {}
    for c, positions in wanted.items():
        below, finite, low, high = sizes[c]
        for p in positions:
            if p < below:
                found[c, p] = -math.inf
            elif p >= below + finite:
                found[c, p] = math.inf
        inside = {p for p in positions if below <= p < below + finite}
        ranges[c] = [_Range(low, high, below, finite, inside)] if inside else []
    while True:
        for c, rs in ranges.items():
            for r in rs:
                if r.low == r.high:
                    found |= {(c, p): r.low for p in r.wanted}
            ranges[c] = [r for r in rs if r.low != r.high]
        ranges = {c: rs for c, rs in ranges.items() if rs}
        if not ranges:
            return found
        few = all(r.n <= finish for rs in ranges.values() for r in rs)
        if few:  # each distinct value is its own group
            rows = _rows(narrow, ranges, lambda v, i, r: F.lit(i)).groupBy("column", "label", "value")
            counted = rows.agg(F.count(F.lit(1)).alias("n")).select("column", "label", F.col("value").alias("low"), F.col("value").alias("high"), "n")
        else:
            rows = _rows(narrow, ranges, lambda v, i, r: _bin(v, r, bins) + i * bins).groupBy("column", "label")
            counted = rows.agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n"))
        groups: dict[tuple[str, int], list] = {}
        for x in counted.collect():  # bounded, see above
            groups.setdefault((x.column, x.label if few else x.label // bins), []).append((x.low, x.high, x.n))
        ranges = {c: [s for i, r in enumerate(rs) for s in _place(r, sorted(groups[c, i]))] for c, rs in ranges.items()}


def select_quantiles(df: DataFrame, probs: dict[str, dict[str, float]], bins: int = BINS, finish: int = FINISH) -> dict[str, dict]:
    """Exact quantiles with linear interpolation (pandas ``quantile``, SQL ``percentile_cont``).

    ``probs``: column -> name -> probability. Returns column -> name -> value, plus
    ``n``, the number of values. Nulls are skipped; a column without values gives
    nulls. Infinite values count as such, and NaN as larger than any number.
    """
    cols = list(probs)
    narrow = materialize(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]))
    inf = float("inf")
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        finite = F.when((v > -inf) & (v < inf), v)
        aggs += [F.count(v).alias(f"n{i}"), F.count_if(v == -inf).alias(f"b{i}"), F.count(finite).alias(f"f{i}"),
                 F.min(finite).alias(f"l{i}"), F.max(finite).alias(f"h{i}")]
    one = narrow.agg(*aggs).first()
    sizes = {c: (one[f"b{i}"], one[f"f{i}"], one[f"l{i}"], one[f"h{i}"]) for i, c in enumerate(cols)}
    count = {c: one[f"n{i}"] for i, c in enumerate(cols)}
    wanted = {c: {f((count[c] - 1) * float(p)) for p in probs[c].values() for f in (math.floor, math.ceil)} if count[c] else set() for c in cols}
    found = select_positions(narrow, wanted, sizes, bins, finish)
    out: dict[str, dict] = {}
    for c in cols:
        out[c] = {"n": count[c]} | dict.fromkeys(probs[c])
        for name, p in probs[c].items() if count[c] else ():
            at = (count[c] - 1) * float(p)
            low, high = found[c, math.floor(at)], found[c, math.ceil(at)]
            out[c][name] = low if low == high else low + (high - low) * (at - math.floor(at))
    return out


def quantile_rows(df: DataFrame, cols: list[str], probs: dict[str, float]) -> DataFrame:
    """(column, n, a column per name in ``probs``), one row per column of ``cols``."""
    found = select_quantiles(df, {c: probs for c in cols})
    rows = [(c, found[c]["n"], *[found[c][name] for name in probs]) for c in cols if found[c]["n"]]
    return df.sparkSession.createDataFrame(rows, "column string, n long, " + ", ".join(f"{name} double" for name in probs))
