"""Forecasting queries. Those a solver decides have no SQL twin; the autoregression and the trend do."""

import datetime as dt
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrid.catalog import FEATURE_COLUMNS
from monthgrid.functions.scalars import round_half_up
from monthgrid.operators.calendar import densify, with_fills
from monthgrid.operators.evaluate import best_config, best_flags, error_metrics, ranked, variant_gap
from monthgrid.plans.features import HENRY_HUB_FEATURES, WTI_FEATURES, engineered_wide, strict_wide
from monthgrid.plans.forecasting import (MODELS, Order, backtest, fit_seasonal_ar, fitted_seasonal_ar, forecast_seasonal_ar,
                                         forecast_with_exog, load_model, model_from_weights, order_search, predict_seasonal_ar,
                                         run_both, save_model, to_results, validate, window_experiment, window_rows)
from monthgrid.plans.models import ModelRegistry
from monthgrid.plans.preprocess import preprocess
from monthgrid.plans.reports import FEATURE_GROUPS, importance_groups
from monthgrid.plans.trend import Trend, forecast_trend_seasonal, trend_component
from monthgrid.plans.trees import (FEATURES, SWEEP, TreeConfig, between, fit_trees, importances, predict_trees, sweep,
                                   training_rows, wide_rows)
from monthgrid.registry.core import ORACLES, feature_cells_sql, query, r4
from monthgrid.registry.evaluate import fcells
from monthgrid.registry.features import STRICT, eng_long, strict_long
from monthgrid.session import new_path, stage
from monthgrid.sinks.tables import VersionedTable

WINDOWS = [("1999 calm year", "1995-01-01", "1998-12-01", "1999-01-01", "1999-12-01"),
           ("2000 spike window", "1995-01-01", "1999-12-01", "2000-01-01", "2000-12-01")]
# Orders and settings are chosen on the year before each window's test year.
VALIDATION = [("1999 calm year", "1995-01-01", "1997-12-01", "1998-01-01", "1998-12-01"),
              ("2000 spike window", "1995-01-01", "1998-12-01", "1999-01-01", "1999-12-01")]

GRID17 = f"""{feature_cells_sql()},
span AS (SELECT series, min(period) AS lo, max(period) AS hi FROM fcells GROUP BY 1),
cal AS (SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS period FROM span),
gx AS (SELECT series, period, last_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY period) AS value FROM cal LEFT JOIN fcells USING (series, period))"""


def targets(spark, sf):
    """Gapless monthly targets of the 17 series, filled forward."""
    return with_fills(densify(fcells(spark, sf))).select("series", "period", F.col("filled").alias("value"))


query("forecast_seasonal_ar")(lambda spark, sf: forecast_seasonal_ar(targets(spark, sf), ["series"]))
query("forecast_trend_seasonal")(lambda spark, sf: forecast_trend_seasonal(targets(spark, sf), ["series"]))

query("trend_component", f"""WITH {GRID17}, t AS (SELECT series, ln(value) AS z, row_number() OVER (PARTITION BY series ORDER BY period) - 1 AS i FROM gx)
SELECT series, {r4('regr_slope(z, i)')} AS growth, {r4('regr_intercept(z, i)')} AS level FROM t GROUP BY 1""")(
    lambda spark, sf: trend_component(targets(spark, sf), ["series"]))

# ARIMA (1,1,0)(0,1,0,12): one regression and a recursion, both of which SQL can repeat.
AR1 = Order(1, 1, 0, 0, 1, 0, 12)
_AR1 = f"""{GRID17}, d AS (SELECT series, period, value, value - lag(value, 1) OVER s - lag(value, 12) OVER s + lag(value, 13) OVER s AS w FROM gx WINDOW s AS (PARTITION BY series ORDER BY period)),
l AS (SELECT *, lag(w) OVER (PARTITION BY series ORDER BY period) AS w1 FROM d),
m AS (SELECT series, regr_slope(w, w1) AS phi, regr_intercept(w, w1) AS c, regr_count(w, w1) AS n FROM l GROUP BY 1)"""


@query("ar_coefficients", f"""WITH {_AR1} SELECT series, {r4('c', 2)} AS intercept, {r4('phi')} AS phi, CAST(n AS BIGINT) AS n_used,
  {r4('sqrt((SELECT sum((w - c - phi * w1) ** 2) FROM l WHERE l.series = m.series AND w1 IS NOT NULL) / (n - 2))', 2)} AS sigma FROM m""")
def ar_coefficients(spark, sf):
    m = fit_seasonal_ar(targets(spark, sf), ["series"], AR1)
    return m.select("series", round_half_up(F.col("beta")[0], 2).alias("intercept"), round_half_up(F.col("beta")[1]).alias("phi"),
                    (F.col("n_train") - 14).alias("n_used"), round_half_up("sigma", 2).alias("sigma"))


@query("forecast_ar_exact", f"""WITH RECURSIVE {_AR1},
st AS (SELECT series, max(period) AS last_period, list(value ORDER BY period)[-13:] AS ys, arg_max(w, period) AS w FROM d GROUP BY 1),
r AS (SELECT st.series, last_period, 0 AS step, ys, w FROM st UNION ALL
  SELECT r.series, last_period, step + 1, list_append(ys[2:], c + phi * w + ys[13] + ys[2] - ys[1]), c + phi * w FROM r JOIN m ON m.series = r.series WHERE step < 12)
SELECT series, CAST(last_period + to_months(step) AS DATE) AS period, step, {r4(r4('ys[13]'), 2)} AS forecast FROM r WHERE step > 0""")
def forecast_ar_exact(spark, sf):
    f = forecast_seasonal_ar(targets(spark, sf), ["series"], AR1)
    return f.select("series", "period", "step", round_half_up("forecast", 2).alias("forecast"))


@query("fitted_ar_exact", f"""WITH {_AR1} SELECT l.series, period, {r4(r4('value - w + c + phi * w1'), 2)} AS fitted FROM l JOIN m ON m.series = l.series WHERE w1 IS NOT NULL""")
def fitted_ar_exact(spark, sf):
    t = targets(spark, sf)
    out = fitted_seasonal_ar(t, fit_seasonal_ar(t, ["series"], AR1), ["series"], AR1)
    return out.filter(F.col("fitted").isNotNull()).select("series", "period", round_half_up("fitted", 2).alias("fitted"))


# ARIMA (0,1,1)(0,1,1,12) with given weights: the residual filter, the moving-average path and its bounds can all be repeated in SQL.
MA1 = Order(0, 1, 1, 0, 1, 1, 12)
_MA_BETA, _MA_SIGMA = (0.0, -0.4, -0.5, 0.2), 1000.0
_MA1 = f"""{GRID17}, d AS (SELECT series, period, value, row_number() OVER s AS i, value - lag(value, 1) OVER s - lag(value, 12) OVER s + lag(value, 13) OVER s AS w
  FROM gx WINDOW s AS (PARTITION BY series ORDER BY period)),
f AS (SELECT series, 13::BIGINT AS i, list_transform(range(13), lambda x: 0.0::DOUBLE) AS es FROM (SELECT DISTINCT series FROM d)
  UNION ALL SELECT f.series, d.i, list_append(es[2:], w - ({_MA_BETA[0]} + {_MA_BETA[1]} * es[13] + {_MA_BETA[2]} * es[2] + {_MA_BETA[3]} * es[1]))
  FROM f JOIN d ON d.series = f.series AND d.i = f.i + 1)"""


@query("fitted_ma_exact", f"WITH RECURSIVE {_MA1} SELECT d.series, period, {r4(r4('value - es[13]'), 2)} AS fitted FROM d JOIN f ON f.series = d.series AND f.i = d.i WHERE d.i > 13")
def fitted_ma_exact(spark, sf):
    """One-step values of a model with moving-average terms, shock by shock."""
    t = targets(spark, sf)
    out = fitted_seasonal_ar(t, model_from_weights(t, ["series"], MA1, _MA_BETA, _MA_SIGMA), ["series"], MA1)
    return out.filter(F.col("fitted").isNotNull()).select("series", "period", round_half_up("fitted", 2).alias("fitted"))


@query("forecast_ma_exact", f"""WITH RECURSIVE {_MA1},
st AS (SELECT series, max(period) AS last_period, max(i) AS n, list(value ORDER BY period)[-13:] AS ys FROM d GROUP BY 1),
r AS (SELECT st.series, last_period, 0 AS step, ys, es FROM st JOIN f ON f.series = st.series AND f.i = n
  UNION ALL SELECT series, last_period, step + 1,
    list_append(ys[2:], {_MA_BETA[0]} + {_MA_BETA[1]} * es[13] + {_MA_BETA[2]} * es[2] + {_MA_BETA[3]} * es[1] + ys[13] + ys[2] - ys[1]), list_append(es[2:], 0.0::DOUBLE)
  FROM r WHERE step < 12)
SELECT series, CAST(last_period + to_months(step) AS DATE) AS period, step, {r4(r4('ys[13]'), 2)} AS forecast,
  {r4(r4(f'ys[13] - 1.959963984540054::DOUBLE * {_MA_SIGMA}::DOUBLE * sqrt(1 + {(1 + _MA_BETA[1]) ** 2}::DOUBLE * (step - 1))'), 2)} AS lower FROM r WHERE step > 0""")
def forecast_ma_exact(spark, sf):
    model = model_from_weights(targets(spark, sf), ["series"], MA1, _MA_BETA, _MA_SIGMA)
    f = predict_seasonal_ar(model, ["series"], MA1)
    return f.select("series", "period", "step", *[round_half_up(c, 2).alias(c) for c in ("forecast", "lower")])


# A straight trend with one yearly pair: ordinary least squares, which SQL can repeat by taking out one term after the other.
@query("trend_fourier_exact", f"""WITH {GRID17},
x AS (SELECT series, period, ln(value) AS z, datediff('month', min(period) OVER (PARTITION BY series), period) AS t, max(period) OVER (PARTITION BY series) AS last_period,
  sin(2 * pi() * (month(period) - 1) / 12) AS s, cos(2 * pi() * (month(period) - 1) / 12) AS c FROM gx),
p1 AS (SELECT series, regr_slope(s, t) AS ss, regr_intercept(s, t) AS si, regr_slope(c, t) AS cs, regr_intercept(c, t) AS ci, regr_slope(z, t) AS zs, regr_intercept(z, t) AS zi FROM x GROUP BY 1),
x1 AS (SELECT x.*, s - ss * t - si AS s1, c - cs * t - ci AS c1, z - zs * t - zi AS z1 FROM x JOIN p1 USING (series)),
p2 AS (SELECT series, regr_slope(c1, s1) AS g FROM x1 GROUP BY 1),
p3 AS (SELECT series, regr_slope(z1, c1 - g * s1) AS b FROM x1 JOIN p2 USING (series) GROUP BY 1),
p4 AS (SELECT series, regr_slope(z1 - b * c1, s1) AS a, any_value(b) AS b FROM x1 JOIN p3 USING (series) GROUP BY 1),
p5 AS (SELECT series, regr_slope(z - a * s - b * c, t) AS k, regr_intercept(z - a * s - b * c, t) AS m, any_value(a) AS a, any_value(b) AS b, max(t) AS last_t, any_value(last_period) AS last_period
  FROM x JOIN p4 USING (series) GROUP BY 1),
h AS (SELECT *, unnest(range(1, 13)) AS step FROM p5), f AS (SELECT *, CAST(last_period + to_months(step) AS DATE) AS period FROM h)
SELECT series, period, step, {r4(r4("exp(m + k * (last_t + step) + a * sin(2 * pi() * (month(period) - 1) / 12) + b * cos(2 * pi() * (month(period) - 1) / 12))"), 2)} AS forecast,
  'multiplicative' AS mode FROM f""")
def trend_fourier_exact(spark, sf):
    kind = Trend(changepoints=0, fourier=1, seasonality_prior=float("inf"))
    f = forecast_trend_seasonal(targets(spark, sf), ["series"], kind=kind)
    return f.select("series", "period", F.col("step").cast("long").alias("step"), round_half_up("forecast", 2).alias("forecast"), "mode")


EXOG = ["industrial_production", "opec_spare", "dollar_index"]


def exog_table(t):
    """(period, *EXOG): three series, each lagged by the horizon so that it is known that far ahead."""
    x = t.filter(F.col("series").isin(EXOG)).select(F.add_months("period", 12).alias("period"), "series", "value")
    return x.groupBy("period").pivot("series", EXOG).agg(F.first("value"))


@query("forecast_exog")
def forecast_exog(spark, sf):
    """All series with three others as regressors."""
    t = stage(targets(spark, sf), "targets")
    return forecast_with_exog(t, ["series"], exog_table(t), EXOG)


def order_scores(spark, sf, windows, exog=()):
    t = stage(targets(spark, sf), "targets")
    rows = stage(window_rows(t, windows), "search-rows")  # read by every order
    train, test = (rows.filter(F.col("role") == r).drop("role") for r in ("train", "test"))
    return order_search(train, test, ["series", "window"], table=stage(exog_table(t), "exog") if exog else None, exog=exog)


query("order_search")(lambda spark, sf: order_scores(spark, sf, VALIDATION))
query("order_search_exog")(lambda spark, sf: order_scores(spark, sf, VALIDATION, EXOG))


@query("order_search_best")
def order_search_best(spark, sf):
    """The order each series is best forecast with in the validation year, and its error in the test year after it."""
    best = best_config(order_scores(spark, sf, VALIDATION), ["series", "window"])
    test = order_scores(spark, sf, WINDOWS).select("series", "window", "config", F.col("mape").alias("test_mape"))
    return best.join(test, ["series", "window", "config"], "left")


query("backtest")(lambda spark, sf: backtest(targets(spark, sf), "prophet"))
query("backtest_ar")(lambda spark, sf: backtest(targets(spark, sf), "sarima"))


def _ar1(rows, by, horizon):
    return forecast_seasonal_ar(rows, by, AR1, horizon)


def _ar1_metrics(b):
    """SQL: errors of the AR1 recursion by (series, part). ``b`` is the text of rows (series, part, period, value, train)."""
    return f"""WITH RECURSIVE {GRID17}, b AS ({b}),
d AS (SELECT *, value - lag(value, 1) OVER s - lag(value, 12) OVER s + lag(value, 13) OVER s AS w FROM b WHERE train WINDOW s AS (PARTITION BY series, part ORDER BY period)),
l AS (SELECT *, lag(w) OVER (PARTITION BY series, part ORDER BY period) AS w1 FROM d),
m AS (SELECT series, part, regr_slope(w, w1) AS phi, regr_intercept(w, w1) AS c FROM l GROUP BY 1, 2),
st AS (SELECT series, part, max(period) AS train_end, count(*) AS n_train, list(value ORDER BY period)[-13:] AS ys, arg_max(w, period) AS w FROM d GROUP BY 1, 2),
r AS (SELECT series, part, train_end, n_train, 0 AS step, ys, w FROM st UNION ALL
  SELECT r.series, r.part, train_end, n_train, step + 1, list_append(ys[2:], c + phi * w + ys[13] + ys[2] - ys[1]), c + phi * w FROM r JOIN m ON m.series = r.series AND m.part = r.part WHERE step < 12),
f AS (SELECT r.series, r.part, train_end, n_train, b.period, {r4('ys[13]')} AS p, b.value AS a FROM r
  JOIN b ON b.series = r.series AND b.part = r.part AND NOT b.train AND b.period = CAST(train_end + to_months(step) AS DATE) WHERE step > 0),
e AS (SELECT series, part, train_end, n_train, min(period) AS test_start, max(period) AS test_end, {r4(r4('sqrt(avg((a - p) * (a - p)))'), 2)} AS rmse,
  {r4(r4('avg(abs(a - p))'), 2)} AS mae, {r4(r4('avg(abs((a - p) / a)) * 100'), 2)} AS mape, count(*) AS n_periods FROM f GROUP BY 1, 2, 3, 4)"""


def _two_places(df, *columns):
    return df.select(*columns, *[round_half_up(c, 2).alias(c) for c in ("rmse", "mae", "mape")], "n_periods")


@query("backtest_ar_exact", _ar1_metrics("""SELECT series, period, value, part, i < n - 36 + (part - 1) * 12 AS train
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY period) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM gx)
  CROSS JOIN (VALUES (1), (2), (3)) s(part) WHERE i < n - 36 + part * 12""")
  + " SELECT series, part AS split, train_end, test_start, test_end, rmse, mae, mape, n_periods FROM e")
def backtest_ar_exact(spark, sf):
    return _two_places(backtest(targets(spark, sf), _ar1), "series", "split", "train_end", "test_start", "test_end")


_SPANS = ", ".join(f"('{w[0]}', " + ", ".join(f"DATE '{x}'" for x in w[1:]) + ")" for w in WINDOWS)


@query("window_experiment_ar_exact", _ar1_metrics(f"""SELECT series, period, value, part, period <= b AS train
  FROM gx CROSS JOIN (VALUES {_SPANS}) v(part, a, b, c, d) WHERE period BETWEEN a AND b OR period BETWEEN c AND d""")
  + """ SELECT series, part AS "window", n_train, rmse, mae, mape, n_periods FROM e""")
def window_experiment_ar_exact(spark, sf):
    return _two_places(window_experiment(targets(spark, sf), WINDOWS, models={"ar1": _ar1}), "series", "window", "n_train")


@query("validation_ar_exact", _ar1_metrics("""SELECT series, period, value, 1 AS part, i <= floor(n * 0.8) AS train
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY period) AS i, count(*) OVER (PARTITION BY series) AS n FROM gx)""")
  + " SELECT series, rmse, mae, mape, n_periods FROM e")
def validation_ar_exact(spark, sf):
    return _two_places(validate(targets(spark, sf), models={"ar1": _ar1}), "series")


@query("model_round_trip_ar_exact", ORACLES["forecast_ar_exact"])
def model_round_trip_ar_exact(spark, sf):
    """The autoregression written as a table, loaded again and used: the forecasts of ``forecast_ar_exact``."""
    path = new_path(spark, "model-ar")
    save_model(fit_seasonal_ar(targets(spark, sf), ["series"], AR1), path)
    f = predict_seasonal_ar(load_model(spark, path), ["series"], AR1)
    return f.select("series", "period", "step", round_half_up("forecast", 2).alias("forecast"))


@query("future_forecast")
def future_forecast(spark, sf):
    """Both models on all data of both price targets, next twelve months, replacing earlier results by key in the results table."""
    t = targets(spark, sf).filter(F.col("series").isin("wti_price", "henry_hub_price"))
    clean = stage(preprocess(t).select("series", "period", "value"), "clean")
    results, key = VersionedTable(spark, new_path(spark, "forecast-results")), ["target", "model_name", "forecast_period"]
    older = clean.filter(F.col("period") <= F.add_months(F.lit("2001-08-01").cast("date"), -6))
    results.replace(to_results(run_both(older, ["series"]), "half a year before"), key)  # six of its months are forecast anew
    results.replace(to_results(run_both(clean, ["series"]), "future"), key)
    return results.read()


query("validation_run")(lambda spark, sf: validate(preprocess(targets(spark, sf)).select("series", "period", "value")))


def all_models(spark, sf):
    """Every model family on both windows of every series: two without and two with other columns."""
    t = stage(targets(spark, sf), "targets")
    table = stage(exog_table(t), "exog")
    models = {**MODELS, "seasonal_arima_exog": lambda rows, by, h: forecast_with_exog(rows, by, table, EXOG, horizon=h)}
    trees = tree_forecasts(tree_rows(spark, sf), "pooled").select("series", "window", "period", "forecast")
    return window_experiment(t, WINDOWS, models=models, ready={"pooled_trees": trees})


@query("window_experiment")
def window_experiment_q(spark, sf):
    """Results by series, window and model, replaced by that key in their table and read back."""
    results = VersionedTable(spark, new_path(spark, "window-results"))
    results.replace(all_models(spark, sf), ["series", "window", "model_name"])
    return results.read()


@query("model_comparison")
def model_comparison(spark, sf):
    return best_flags(window_experiment(targets(spark, sf), WINDOWS), ["series", "window"])


@query("leaderboard_fitted")
def leaderboard_fitted(spark, sf):
    """Every fitted model of every target, placed by its error in each window; models that could not be fitted come last."""
    return ranked(all_models(spark, sf), ["series", "window"])


@query("leaderboard_ar_exact", _ar1_metrics(f"""SELECT series, period, value, part, period <= b AS train
  FROM gx CROSS JOIN (VALUES {_SPANS}) v(part, a, b, c, d) WHERE period BETWEEN a AND b OR period BETWEEN c AND d""")
  + """, n AS (SELECT t.series, t.part, {r4a} AS mape FROM (SELECT b.series, b.part, avg(abs((b.value - l.value) / b.value)) * 100 AS m FROM b
    JOIN b l ON l.series = b.series AND l.part = b.part AND l.period = CAST(b.period - INTERVAL 12 MONTH AS DATE) WHERE NOT b.train GROUP BY 1, 2) t),
  every AS (SELECT series, part, 'ar1' AS model_name, mape FROM e UNION ALL SELECT series, part, 'seasonal_naive', mape FROM n)
  SELECT series, part AS "window", model_name, mape, CAST(rank() OVER (PARTITION BY series, part ORDER BY mape ASC NULLS LAST) AS INT) AS place FROM every""".replace("{r4a}", r4(r4("m"), 2)))
def leaderboard_ar_exact(spark, sf):
    """Two models whose errors SQL can repeat: the autoregression, and the value of a year before."""
    t = targets(spark, sf)
    before = t.select("series", F.add_months("period", 12).alias("period"), F.col("value").alias("forecast"))
    tested = window_rows(t, WINDOWS).filter("role = 'test'").select("series", "window", "period")
    naive = tested.join(before, ["series", "period"]).select("series", "window", "period", "forecast")
    scores = window_experiment(t, WINDOWS, models={"ar1": _ar1}, ready={"seasonal_naive": naive})
    return ranked(scores.withColumn("mape", round_half_up("mape", 2)), ["series", "window"]).select("series", "window", "model_name", "mape", "place")


@query("model_round_trip")
def model_round_trip(spark, sf):
    """A fitted model written as a table, loaded again and used."""
    path = new_path(spark, "model-sarima")
    save_model(fit_seasonal_ar(targets(spark, sf), ["series"]), path)
    return predict_seasonal_ar(load_model(spark, path), ["series"])


# ---- trees ----

def tree_rows(spark, sf):
    return stage(training_rows(strict_long(spark, sf)), "tree-rows")


def by_window(rows, tested=None):
    """(window, model, test rows) of the full booster for every window; the windows are few, so their fits are submitted together."""
    tested = rows if tested is None else tested
    with ThreadPool(len(WINDOWS)) as pool:
        models = pool.map(lambda w: fit_trees(between(rows, w[1], w[2])), WINDOWS)
    return [(w[0], m, between(tested, w[3], w[4])) for w, m in zip(WINDOWS, models)]


def tree_forecasts(rows, name, tested=None):
    return reduce(DataFrame.unionByName, [predict_trees(m, test, name).withColumn("window", F.lit(label)) for label, m, test in by_window(rows, tested)])


query("forecast_gbt")(lambda spark, sf: tree_forecasts(tree_rows(spark, sf), "pooled"))


_WHOLE = " AND ".join(f"{c} IS NOT NULL" for c in ("lag_1", "lag_3", "lag_6", "lag_12", "roll3_mean", "roll6_mean", "mom_pct", "vs_12mo_avg"))


@query("tree_training_rows", f"""WITH {STRICT} SELECT series, period, {r4('value / roll12_mean')} AS label, {r4('lag_1 / roll12_mean')} AS lag_1,
  {r4('lag_12 / roll12_mean')} AS lag_12 FROM strict WHERE roll12_mean <> 0 AND {_WHOLE}""")
def tree_training_rows(spark, sf):
    """What the pooled trees learn from: label and two of the features, on the series' own scale."""
    at = vector_to_array("features")
    return tree_rows(spark, sf).select("series", "period", round_half_up("label").alias("label"), round_half_up(at[FEATURES.index("lag_1")]).alias("lag_1"),
                                       round_half_up(at[FEATURES.index("lag_12")]).alias("lag_12"))


@query("gbt_importance_groups")
def gbt_importance_groups(spark, sf):
    """Importances of the pooled model of each window, summed by the kind of feature."""
    kinds = {f: "Seasonality" if f.startswith("month") else "Rolling" if "roll" in f or "12mo" in f else "Momentum" if "mom" in f else "Lag"
             for f in FEATURES}
    found = [importances(m, spark).withColumn("target", F.lit(label)) for label, m, _ in by_window(tree_rows(spark, sf))]
    return importance_groups(reduce(DataFrame.unionByName, found), kinds)


@query("gbt_importance_economic")
def gbt_importance_economic(spark, sf):
    """Importances of both price targets' trees over all other series' measures, summed by the economic group of the series a feature comes from."""
    wide = stage(engineered_wide(eng_long(spark, sf)), "engineered")
    base = sorted(FEATURE_COLUMNS, key=len, reverse=True)
    found = []
    for target in ("wti_price", "henry_hub_price"):
        features = [c for c in wide.columns if c not in ("period", "month", "quarter", *FEATURE_COLUMNS) and not c.startswith(target)]
        source = {f: next((FEATURE_GROUPS[b] for b in base if f.startswith(b)), "Seasonality") for f in features}
        _, start, end, _, _ = WINDOWS[-1]
        model = fit_trees(between(wide_rows(wide, target, features), start, end), TreeConfig(trees=100, depth=3))
        named = importances(model, spark, features).withColumn("target", F.lit(target))
        found.append(importance_groups(named, source))
    return reduce(DataFrame.unionByName, found)


def _curated(spark, sf, target, picks):
    wide = stage(strict_wide(strict_long(spark, sf), target, picks), "curated")
    return tree_forecasts(wide_rows(wide, target, [*picks, "month_sin", "month_cos"]), "curated")


query("forecast_gbt_curated_gas")(lambda spark, sf: _curated(spark, sf, "henry_hub_price", HENRY_HUB_FEATURES))
query("forecast_gbt_curated_oil")(lambda spark, sf: _curated(spark, sf, "wti_price", WTI_FEATURES))


@query("forecast_gbt_192")
def forecast_gbt_192(spark, sf):
    """One target on every engineered column. Some of them use the current month, so this is no honest forecast."""
    wide = stage(engineered_wide(eng_long(spark, sf)), "engineered")
    features = [c for c in wide.columns if c not in ("period", "month", "quarter", *FEATURE_COLUMNS)]
    return tree_forecasts(wide_rows(wide, "wti_price", features), "192 features")


@query("tree_variant_gap")
def tree_variant_gap(spark, sf):
    """One model of the engineered features, tested on engineered and on strict rows: what the current month's leakage flatters."""
    target, names = "henry_hub_price", [*HENRY_HUB_FEATURES, "month_sin", "month_cos"]
    leaky = wide_rows(stage(engineered_wide(eng_long(spark, sf)).select("period", target, *names), "leaky"), target, names)
    strict = wide_rows(stage(strict_wide(strict_long(spark, sf), target, HENRY_HUB_FEATURES), "strict"), target, names)
    both = leaky.withColumn("rows", F.lit("engineered")).unionByName(strict.withColumn("rows", F.lit("strict")))
    scored = reduce(DataFrame.unionByName, [m.transform(test).withColumn("window", F.lit(label)) for label, m, test in by_window(leaky, both)])
    metrics = error_metrics(scored, ["series", "window", "rows"], "value", "prediction")
    a, b = (metrics.filter(F.col("rows") == kind).drop("rows") for kind in ("engineered", "strict"))
    return variant_gap(a, b, ["series", "window"])


@query("gbt_sweep")
def gbt_sweep(spark, sf):
    """The eight settings in full, judged on 1998 after training through 1997."""
    rows = tree_rows(spark, sf)
    return sweep(between(rows, "1995-01-01", "1997-12-01"), between(rows, "1998-01-01", "1998-12-01"), SWEEP, parallel=8)


@query("model_round_trip_trees")
def model_round_trip_trees(spark, sf):
    """Trees kept in the registry by name, target and date, loaded again and used beside the ones in memory; a small booster, as what matters is the way back."""
    rows = tree_rows(spark, sf)
    _, start, end, test_start, test_end = WINDOWS[0]
    model, registry = fit_trees(between(rows, start, end), TreeConfig(trees=20, depth=2)), ModelRegistry(spark, new_path(spark, "models"))
    registry.save(model, "pooled_trees", "all", dt.date.fromisoformat(end))
    test = between(rows, test_start, test_end)
    kept = predict_trees(registry.load("pooled_trees", "all"), test, "loaded").select("series", "period", F.col("forecast").alias("loaded"))
    both = predict_trees(model, test, "fitted").join(kept, ["series", "period"], "full")
    return both.select("series", "period", "forecast", "loaded", F.col("forecast").eqNullSafe(F.col("loaded")).alias("same"))
