"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so
it stays inside whole-stage codegen. No Python runs per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulage import dims


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """Division that yields null when the divisor is null or zero (ANSI-safe)."""
    return F.try_divide(col(num), col(den))


def inf_to_zero_div(num, den) -> Column:
    """Division where x / 0 yields 0 instead of +-inf (pandas ``replace(inf, 0)``);
    0 / 0 stays null (NaN there)."""
    n, d = col(num), col(den)
    return (F.when(d == 0, F.when(n == 0, F.lit(None).cast("double")).otherwise(F.lit(0.0)))
            .otherwise(F.try_divide(n, d)))


def round_half_up(c, digits: int) -> Column:
    """Round half up on the binary value: floor(x * 10^d + 0.5) / 10^d.

    Written as plain arithmetic so every engine gives the same bits; Spark's
    ``round`` rounds the decimal text (1.005 -> 1.01) and others do not.
    ``floor`` gives a 64-bit integer and would saturate; from 2^53 on every
    double is an integer already and stays as it is.
    """
    scale = float(10 ** digits)
    shifted = col(c).cast("double") * F.lit(scale) + F.lit(0.5)
    whole = F.when(F.abs(shifted) < F.lit(2.0 ** 53), F.floor(shifted).cast("double")).otherwise(shifted)
    return whole / F.lit(scale)


# Sums are taken in this type: 28 digits before the point and 10 after it.
EXACT = "decimal(38,10)"


def exact(c) -> Column:
    """A number as an exact decimal, so that sums do not depend on partitioning
    or summation order, which double sums do."""
    return col(c).cast(EXACT)


def money_sum(c) -> Column:
    """Exact sum, returned as double. Values keep up to 10 decimals; a total
    beyond 28 digits is an error."""
    return F.sum(exact(c)).cast("double")


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in miles between two points given in degrees."""
    dlat = F.radians(col(lat2) - col(lat1))
    dlon = F.radians(col(lon2) - col(lon1))
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(col(lat1))) * F.cos(F.radians(col(lat2))) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(dims.EARTH_RADIUS_MI) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def congestion_tier(ratio) -> Column:
    """Right-closed bins (0,1.1] Low, (1.1,1.3] Moderate, (1.3,inf) High; else null."""
    r = col(ratio)
    return (F.when((r > 0) & (r <= 1.1), "Low")
            .when((r > 1.1) & (r <= 1.3), "Moderate")
            .when(r > 1.3, "High"))


def percentile_tier(p, top: str = "Top Tier", mid: str = "Mid Tier",
                    low: str = "Low Tier", bottom: str = "Bottom Tier",
                    scale: float = 100.0) -> Column:
    """Tier from a percentile: >= 75 / 50 / 25 (of ``scale``); null stays null."""
    v = col(p)
    return (F.when(v.isNull(), F.lit(None).cast("string"))
            .when(v >= 0.75 * scale, top)
            .when(v >= 0.50 * scale, mid)
            .when(v >= 0.25 * scale, low)
            .otherwise(bottom))


def currency_to_double(c) -> Column:
    """'$1,234.50' -> 1234.5; anything unparsable -> null."""
    cleaned = F.regexp_replace(F.trim(col(c).cast("string")), r"[$,]", "")
    return cleaned.try_cast("double")


def strip_footnotes(c) -> Column:
    """Remove bracketed footnotes ('Texas[b]' -> 'Texas'), trim, upper-case."""
    return F.upper(F.trim(F.regexp_replace(col(c).cast("string"), r"\[.*\]", "")))


def number_text_to_double(c) -> Column:
    """'29,145,505' -> 29145505.0; bad text -> null."""
    return F.regexp_replace(F.trim(col(c).cast("string")), ",", "").try_cast("double")


def region_case(code, unknown: str = "Unknown", include_dc: bool = False) -> Column:
    """Region from a state code as a CASE expression (mart form).

    The mart form leaves DC out (it becomes ``unknown``); the feature form
    counts DC in the South (``include_dc=True``).
    """
    c = col(code)
    expr = None
    for region in ("Northeast", "South", "Midwest", "West"):
        codes = [s for s in dims.REGIONS[region] if include_dc or s != "DC"]
        expr = F.when(c.isin(codes), region) if expr is None else expr.when(c.isin(codes), region)
    return expr.otherwise(unknown)


def log_positive(c) -> Column:
    """Natural log for positive values, null otherwise (log(0) is -inf elsewhere)."""
    v = col(c)
    return F.when(v > 0, F.log(v))


def jarque_bera_p(n, skew, kurt_excess) -> Column:
    """p-value of the Jarque-Bera normality statistic (chi-square, 2 df)."""
    jb = col(n) / 6.0 * (F.pow(col(skew), 2) + F.pow(col(kurt_excess), 2) / 4.0)
    return F.exp(-jb / 2.0)


__all__ = [name for name in dir() if not name.startswith("_") and name not in {"annotations", "math"}]
