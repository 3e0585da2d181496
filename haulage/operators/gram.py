"""One mergeable Gram matrix for correlations and least squares.

For every pair of columns: the number of rows where both are present, their
sums, and their sums of squares and products, all taken about fixed centres near
the means, so that nothing is lost to cancellation. Such sums add up, so each
task sends one row per pair, whatever its number of rows, and one aggregate
merges them. What the driver gets is columns x columns numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.session import materialize

_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
_PART = "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS)
SINGULAR = 1e-12  # share of a column's own variance that must be its own


@dataclass
class Gram:
    """Matrices by pair (i, j) of ``columns``: rows with both, centred sums of i, of i squared and of i times j."""
    columns: list[str]
    centre: np.ndarray
    n: np.ndarray
    sx: np.ndarray
    sxx: np.ndarray
    sxy: np.ndarray

    def mean(self) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return self.centre + np.diag(self.sx) / np.diag(self.n)

    def co_moments(self) -> np.ndarray:
        """Sums of products of deviations from the means, over the rows that have both columns."""
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.sxy - self.sx * self.sx.T / self.n

    def correlation(self) -> np.ndarray:
        """Pearson correlation per pair; NaN for fewer than two rows or a constant column."""
        with np.errstate(invalid="ignore", divide="ignore"):
            spread = self.sxx - self.sx * self.sx / self.n
            return np.where(self.n > 1, self.co_moments() / np.sqrt(spread * spread.T), np.nan)


def gram(df: DataFrame, cols: list[str]) -> Gram:
    """The Gram matrix of numeric columns; nulls (and NaN) of one column leave the others' rows alone."""
    k = len(cols)
    narrow = materialize(df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(cols)]))
    centre = np.array([x or 0.0 for x in narrow.agg(*[F.avg(f"c{i}") for i in range(k)]).first()], np.float64)

    def partial(batches):
        total = {s: np.zeros((k, k)) for s in ("n", "sx", "sxx", "sxy")}
        for b in batches:
            x = np.column_stack([np.asarray(b.column(i).fill_null(np.nan), np.float64) for i in range(k)])
            here = ~np.isnan(x)
            x = np.where(here, x - centre, 0.0)
            here = here.astype(np.float64)
            for s, m in (("n", here.T @ here), ("sx", x.T @ here), ("sxx", (x * x).T @ here), ("sxy", x.T @ x)):
                total[s] += m
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "n": total["n"][i, j], "sx": total["sx"][i, j],
            "sy": total["sx"][j, i], "sxx": total["sxx"][i, j], "syy": total["sxx"][j, i], "sxy": total["sxy"][i, j]})

    merged = narrow.mapInArrow(partial, _PART).groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])
    out = {s: np.zeros((k, k)) for s in ("n", "sx", "sxx", "sxy")}
    for r in merged.collect():  # one row per pair of columns
        out["n"][r.i, r.j] = out["n"][r.j, r.i] = r.n
        out["sxy"][r.i, r.j] = out["sxy"][r.j, r.i] = r.sxy
        out["sx"][r.i, r.j], out["sx"][r.j, r.i] = r.sx, r.sy
        out["sxx"][r.i, r.j], out["sxx"][r.j, r.i] = r.sxx, r.syy
    return Gram(cols, centre, out["n"], out["sx"], out["sxx"], out["sxy"])


@dataclass
class Model:
    """A fitted linear model; all numbers are None without rows."""
    features: list[str]
    intercept: float | None
    coefficients: list[float | None]
    n_train: int
    singular: bool


def _cholesky(a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """x with a x = b for a positive definite ``a``; None if a column depends on those before it."""
    k = len(a)
    low = np.zeros((k, k))
    for j in range(k):
        rest = a[j, j] - low[j, :j] @ low[j, :j]
        if not rest > SINGULAR * a[j, j]:
            return None
        low[j, j] = np.sqrt(rest)
        low[j + 1:, j] = (a[j + 1:, j] - low[j + 1:, :j] @ low[j, :j]) / low[j, j]
    y = np.zeros(k)
    for i in range(k):
        y[i] = (b[i] - low[i, :i] @ y[:i]) / low[i, i]
    x = np.zeros(k)
    for i in reversed(range(k)):
        x[i] = (y[i] - low[i + 1:, i] @ x[i + 1:]) / low[i, i]
    return x


def fit_linear(train: DataFrame, features: list[str], target: str) -> Model:
    """Least squares with an intercept for any number of features, from one Gram
    matrix over the rows that have all of them.

    The normal equations are solved by Cholesky. If a feature is a combination of
    others (or constant), the coefficients are those of the smallest norm, as a
    least-squares solver gives them.
    """
    cols = [*features, target]
    g = gram(train.dropna(subset=cols), cols)
    n = int(g.n[-1, -1])
    if n == 0:
        return Model(features, None, [None] * len(features), 0, True)
    s, mean = g.co_moments(), g.mean()
    a, b = s[:-1, :-1], s[:-1, -1]
    solved = _cholesky(a, b)
    coef = solved if solved is not None else np.linalg.pinv(a, rcond=1e-10, hermitian=True) @ b
    return Model(features, float(mean[-1] - coef @ mean[:-1]), [float(c) for c in coef], n, solved is None)
