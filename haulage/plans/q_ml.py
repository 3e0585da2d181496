"""Cost model queries (M1-M5) on the route cost table."""

from __future__ import annotations

from haulage.operators import ml
from haulage.operators.gram import fit_linear
from haulage.plans.catalog import query
from haulage.plans.q_routes import COST_BASE, route_costs
from haulage.plans.sqlparts import rhu, with_
from haulage.session import materialize

X1, X2, Y_ = "driving_mi", "driving_hr", "total_cost"


def _costs(spark, sf):
    """Route costs, stored once: the model, its metrics and its predictions read them."""
    return ml.enough_rows(materialize(route_costs(spark, sf)))


def _model(spark, sf):
    train, test = ml.split(_costs(spark, sf), ["origin", "destination"])
    model = fit_linear(train, [X1, X2], Y_)
    return model, ml.predict(test, model)


_BUCKET = "CAST('0x' || substr(md5(origin || '~' || destination), 1, 8) AS BIGINT) % 100"
_SPLIT = f"""tr AS (SELECT * FROM costs WHERE {_BUCKET} < 80),
te AS (SELECT * FROM costs WHERE {_BUCKET} >= 80),
mom AS (SELECT var_samp(driving_mi) AS s11, var_samp(driving_hr) AS s22, covar_samp(driving_mi, driving_hr) AS s12,
  covar_samp(driving_mi, total_cost) AS s1y, covar_samp(driving_hr, total_cost) AS s2y,
  avg(driving_mi) AS m1, avg(driving_hr) AS m2, avg(total_cost) AS my, COUNT(*) AS n_train FROM tr),
mdl AS (SELECT *, my - b1 * m1 - b2 * m2 AS intercept FROM (
  SELECT *, (s22 * s1y - s12 * s2y) / nullif(s11 * s22 - s12 * s12, 0) AS b1,
            (s11 * s2y - s12 * s1y) / nullif(s11 * s22 - s12 * s12, 0) AS b2 FROM mom)),
pr AS (SELECT te.*, mdl.intercept + mdl.b1 * te.driving_mi + mdl.b2 * te.driving_hr AS pred FROM te, mdl)"""


@query("m04_model_coefficients", with_(*COST_BASE, _SPLIT) + f"""
SELECT 'intercept' AS feature, {rhu('intercept', 2)} AS coefficient FROM mdl
UNION ALL SELECT 'driving_mi', {rhu('b1', 6)} FROM mdl UNION ALL SELECT 'driving_hr', {rhu('b2', 6)} FROM mdl""")
def m04_model_coefficients(spark, sf):
    """M1/M2/M4: hash split, least squares on miles and hours, coefficients."""
    model, _ = _model(spark, sf)
    return ml.coefficients(spark, model)


@query("m03_model_metrics", with_(*COST_BASE, _SPLIT) + f"""
SELECT {rhu('1 - SUM((pred - total_cost) * (pred - total_cost)) / SUM((total_cost - (SELECT avg(total_cost) FROM te)) * (total_cost - (SELECT avg(total_cost) FROM te)))', 4)} AS r2,
  {rhu('avg(abs(pred - total_cost))', 2)} AS mae, {rhu('sqrt(avg((pred - total_cost) * (pred - total_cost)))', 2)} AS rmse,
  (SELECT n_train FROM mom) AS n_train, COUNT(*) AS n_test FROM pr""")
def m03_model_metrics(spark, sf):
    """M3: R^2, MAE, RMSE on the held-out routes."""
    model, pred = _model(spark, sf)
    return ml.metrics(pred, Y_, model)


@query("m05_predictions", with_(*COST_BASE, _SPLIT) + f"""
SELECT driving_mi, driving_hr, total_cost AS actual_cost, {rhu('pred', 2)} AS predicted_cost,
  {rhu('pred', 2)} - total_cost AS error, {rhu(f"({rhu('pred', 2)} - total_cost) / nullif(total_cost, 0) * 100", 1)} AS error_pct
FROM pr""")
def m05_predictions(spark, sf):
    """M5: prediction table for the test routes."""
    _, pred = _model(spark, sf)
    return ml.prediction_table(pred, X1, X2, Y_)
