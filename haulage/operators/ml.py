"""Linear cost model (M1-M5).

``split`` is a deterministic hash split on the row keys (the same rows land in
train/test whatever the partitioning). The model is fitted for any number of
features from one Gram matrix (``gram.fit_linear``) and applied as literals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.functions import round_half_up
from haulage.operators.gram import Model


def split(df: DataFrame, keys: list[str], train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """M1: (train, test) by a bucket of 100 from the first 8 hex digits of
    md5(key1 ~ key2 ...), so all keys take part and no key can overflow."""
    digest = F.md5(F.concat_ws("~", *[F.col(k).cast("string") for k in keys]).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return df.where(bucket < train_pct), df.where(bucket >= train_pct)


def predict(test: DataFrame, model: Model) -> DataFrame:
    """``test`` with the model's prediction; null where a feature is null or the model has no rows."""
    terms = [F.lit(c).cast("double") * F.col(x) for x, c in zip(model.features, model.coefficients)]
    return test.withColumn("_pred", reduce(lambda a, b: a + b, terms, F.lit(model.intercept).cast("double")))


def coefficients(spark: SparkSession, model: Model) -> DataFrame:
    """M4: (feature, coefficient): intercept 2 dp, slopes 6 dp."""
    rows = [("intercept", model.intercept, 2), *[(x, c, 6) for x, c in zip(model.features, model.coefficients)]]
    df = spark.createDataFrame(rows, "feature string, coefficient double, digits int")
    return df.select("feature", F.when(F.col("digits") == 2, round_half_up("coefficient", 2))
                     .otherwise(round_half_up("coefficient", 6)).alias("coefficient"))


def metrics(pred: DataFrame, y: str, model: Model) -> DataFrame:
    """M3: R^2 (4 dp), MAE and RMSE (2 dp) on the test rows, and sizes.
    The test mean is a scalar subquery; sums of squares one aggregate."""
    ybar = pred.select(F.avg(y)).scalar()
    err = F.col("_pred") - F.col(y)
    return pred.agg(
        round_half_up(1 - F.sum(err * err) / F.sum((F.col(y) - ybar) * (F.col(y) - ybar)), 4).alias("r2"),
        round_half_up(F.avg(F.abs(err)), 2).alias("mae"),
        round_half_up(F.sqrt(F.avg(err * err)), 2).alias("rmse"),
        F.lit(model.n_train).cast("long").alias("n_train"), F.count(F.lit(1)).alias("n_test"))


def prediction_table(pred: DataFrame, x1: str, x2: str, y: str) -> DataFrame:
    """M5: features, actual, predicted (2 dp), error, error % (1 dp)."""
    p = round_half_up("_pred", 2)
    return pred.select(x1, x2, F.col(y).alias("actual_cost"), p.alias("predicted_cost"),
                       (p - F.col(y)).alias("error"),
                       round_half_up(F.try_divide(p - F.col(y), F.col(y)) * 100, 1).alias("error_pct"))


def enough_rows(df: DataFrame, minimum: int = 50) -> DataFrame:
    """Gate: rows only if the table has at least ``minimum`` rows (scalar)."""
    return df.where(df.select(F.count(F.lit(1))).scalar() >= minimum)
