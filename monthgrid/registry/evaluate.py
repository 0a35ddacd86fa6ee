"""Scoring and reporting queries, on forecasts that SQL can repeat exactly."""

from pyspark.sql import functions as F

from monthgrid.functions.scalars import map_label, round_half_up, window_label
from monthgrid.operators.calendar import densify
from monthgrid.operators.evaluate import (align, backtest_frame, best_config, best_flags, error_metrics, leaderboard,
                                          variant_gap)
from monthgrid.operators.stats import (correlate_with_targets, latest_and_delta, percent_rank_of_latest, profile,
                                       provider_counts, seasonal_means, year_overlay)
from monthgrid.plans.features import feature_cells
from monthgrid.plans.reports import (FEATURE_GROUPS, forecast_pivot, forecast_view, importance_groups,
                                     latest_per_feature, layer_row, reindex, run_success_rate, seasonal_naive_forecasts)
from monthgrid.registry.core import OIL, all_obs_sql, feature_cells_sql, query, r4
from monthgrid.registry.features import ENG, SPARSE, eng_long, sparse_cells
from monthgrid.registry.medallion import GOLD, gold_df, silver_gas_df, silver_oil_df
from monthgrid.session import new_path
from monthgrid.sinks.tables import VersionedTable, replace_by_key, update_by_key
from monthgrid.sources.tables import (all_observations, feature_observations, oil_observations, table)

WINDOWS = [(1999, 48), (2000, 60)]  # (test year, training months)
WINDOW_LABELS = {48: "1999 calm year", 60: "2000 spike window"}
# Forecasts without a model, which SQL can repeat, under their own names.
MODEL_LABELS = {"seasonal_naive": "Same month last year", "last_value": "Last month", "trailing_mean": "Mean of last year"}

FC = f"""{ENG},
fc AS (SELECT series AS target, m AS model_name, period AS forecast_period,
  CASE m WHEN 'seasonal_naive' THEN lag_12 WHEN 'trailing_mean' THEN roll12_mean ELSE lag_1 END AS forecast_value,
  CASE year(period) WHEN 1999 THEN 48 ELSE 60 END AS trained_on_periods, value AS actual
  FROM eng CROSS JOIN (VALUES ('seasonal_naive'), ('trailing_mean'), ('last_value')) v(m) WHERE year(period) IN (1999, 2000))"""


def forecasts(spark, sf):
    return seasonal_naive_forecasts(eng_long(spark, sf), WINDOWS)


def metrics_sql(by, src="fc", out="met"):
    return f"""{out} AS (SELECT {by}, {r4('sqrt(avg((actual - forecast_value) * (actual - forecast_value)))')} AS rmse, {r4('avg(abs(actual - forecast_value))')} AS mae,
  {r4("coalesce(avg(CASE WHEN actual <> 0 THEN abs((actual - forecast_value) / actual) END) * 100, 0)")} AS mape,
  {r4("CASE WHEN var_pop(actual) > 0 THEN 1 - sum((actual - forecast_value) * (actual - forecast_value)) / (var_pop(actual) * count(*)) ELSE 0 END")} AS r2,
  count(*) AS n_periods FROM {src} WHERE actual IS NOT NULL AND forecast_value IS NOT NULL GROUP BY ALL)"""


_BY = ["target", "model_name", "trained_on_periods"]
MET = f"{FC}, {metrics_sql('target, model_name, trained_on_periods')}"


def metrics(spark, sf):
    return error_metrics(forecasts(spark, sf), _BY)


query("error_metrics", f"WITH {MET} SELECT * FROM met")(metrics)
query("error_metrics_overall", f"WITH {FC}, {metrics_sql('model_name')} SELECT * FROM met")(
    lambda spark, sf: error_metrics(forecasts(spark, sf), ["model_name"]))

_W = "OVER (PARTITION BY target, trained_on_periods)"
query("best_model_flags", f"""WITH {MET} SELECT *, rmse = min(rmse) {_W} AS best_rmse, mape = min(mape) {_W} AS best_mape, r2 = max(r2) {_W} AS best_r2 FROM met""")(
    lambda spark, sf: best_flags(metrics(spark, sf), ["target", "trained_on_periods"]))


@query("compare_two_models", f"""WITH {MET}, two AS (SELECT * FROM met WHERE model_name IN ('seasonal_naive', 'trailing_mean'))
SELECT *, rmse = min(rmse) {_W} AS best_rmse, mape = min(mape) {_W} AS best_mape, r2 = max(r2) {_W} AS best_r2 FROM two""")
def compare_two_models(spark, sf):
    two = forecasts(spark, sf).filter(F.col("model_name").isin("seasonal_naive", "trailing_mean"))
    return best_flags(error_metrics(two, _BY), ["target", "trained_on_periods"])


@query("best_config", f"""WITH {MET} SELECT target, trained_on_periods, model_name AS config, mape FROM (
  SELECT *, row_number() OVER (PARTITION BY target, trained_on_periods ORDER BY mape, model_name) AS rn FROM met) WHERE rn = 1""")
def best_config_q(spark, sf):
    return best_config(metrics(spark, sf).withColumn("config", F.col("model_name")), ["target", "trained_on_periods"])


SCORED = f"""{MET}, scored AS (SELECT fc.*, met.rmse, met.mape, met.mae FROM fc LEFT JOIN met USING (target, model_name, trained_on_periods))"""


def scored(spark, sf):
    """Forecast rows carrying their group's metrics, as the results table stores them."""
    return align(metrics(spark, sf).select(*_BY, "rmse", "mape", "mae"), forecasts(spark, sf), _BY, "left")


@query("leaderboard", f"""WITH {SCORED}, lab AS (SELECT target, CASE trained_on_periods WHEN 48 THEN '1999 calm year' WHEN 60 THEN '2000 spike window' END AS "window",
  CASE model_name {' '.join(f"WHEN '{m}' THEN '{label}'" for m, label in MODEL_LABELS.items())} END AS model_label, rmse, mape, forecast_period FROM scored),
g AS (SELECT target, "window", model_label, arg_min(rmse, forecast_period) AS rmse, arg_min(mape, forecast_period) AS mape, count(forecast_period) AS n_months FROM lab GROUP BY 1, 2, 3)
SELECT *, CAST(rank() OVER (PARTITION BY target, "window" ORDER BY mape ASC NULLS LAST) AS INT) AS place FROM g""")
def leaderboard_q(spark, sf):
    """Every target; of fitted models, see ``leaderboard_fitted``."""
    labelled = scored(spark, sf).withColumn("window", window_label("trained_on_periods", WINDOW_LABELS)).withColumn(
        "model_label", map_label("model_name", MODEL_LABELS))
    return leaderboard(labelled, ["target", "window"])


@query("window_labels", f"""WITH {FC} SELECT DISTINCT trained_on_periods, CASE trained_on_periods WHEN 48 THEN '1999 calm year' ELSE trained_on_periods || '-month train' END AS "window",
  target FROM fc""")
def window_labels(spark, sf):
    return forecasts(spark, sf).select(
        "trained_on_periods", window_label("trained_on_periods", {48: "1999 calm year"}).alias("window"), "target").distinct()


_P = ("seasonal_naive", "last_value", "trailing_mean")


@query("forecast_vs_actual_pivot", f"""WITH {FC}, p AS (SELECT target, forecast_period, max(actual) AS actual,
  {', '.join(f"avg(CASE WHEN model_name = '{m}' THEN forecast_value END) AS {m}" for m in _P)} FROM fc GROUP BY 1, 2)
SELECT target, forecast_period, {r4('actual', 2)} AS actual, {', '.join(f'{r4(m, 2)} AS {m}' for m in _P)},
  {', '.join(f'{r4(f"{m} - actual", 2)} AS error_{m}' for m in _P)} FROM p""")
def forecast_vs_actual_pivot(spark, sf):
    return forecast_pivot(forecasts(spark, sf), _P)


# Actuals known through June 2000: later forecasts are the future.
@query("forecast_left_actuals", f"""WITH {FC} SELECT target, model_name, forecast_period, {r4('forecast_value')} AS forecast_value,
  CASE WHEN forecast_period <= DATE '2000-06-01' THEN actual END AS known_actual FROM fc""")
def forecast_left_actuals(spark, sf):
    known = eng_long(spark, sf).filter(F.col("period") <= F.lit("2000-06-01").cast("date")).select(
        F.col("series").alias("target"), F.col("period").alias("forecast_period"), F.col("value").alias("known_actual"))
    return align(known, forecasts(spark, sf).select("target", "model_name", "forecast_period", "forecast_value"),
                 ["target", "forecast_period"], "left").select("target", "model_name", "forecast_period", round_half_up("forecast_value").alias("forecast_value"), "known_actual")


@query("align_actual_predicted", f"""WITH {FC} SELECT target, model_name, count(*) AS n FROM fc
  WHERE forecast_period <= DATE '2000-06-01' AND actual IS NOT NULL AND forecast_value IS NOT NULL GROUP BY 1, 2""")
def align_actual_predicted(spark, sf):
    known = eng_long(spark, sf).filter(F.col("period") <= F.lit("2000-06-01").cast("date")).select(
        F.col("series").alias("target"), F.col("period").alias("forecast_period"), F.col("value").alias("known_actual"))
    return (align(known, forecasts(spark, sf), ["target", "forecast_period"]).dropna(subset=["known_actual", "forecast_value"])
            .groupBy("target", "model_name").agg(F.count(F.lit(1)).alias("n")))


@query("forecast_view", f"""WITH {FC}, v AS (SELECT *, CASE WHEN forecast_period > DATE '2000-06-01' THEN 'Future' WHEN year(forecast_period) = 1999 THEN 'Validation' END AS view FROM fc)
SELECT target, model_name, view, count(*) AS n_months, {r4('arg_min(forecast_value, forecast_period)')} AS first_value,
  {r4('arg_max(forecast_value, forecast_period)')} AS last_value, {r4('avg(forecast_value)')} AS avg_value FROM v
  WHERE view IS NOT NULL AND forecast_value IS NOT NULL GROUP BY 1, 2, 3""")
def forecast_view_q(spark, sf):
    until = eng_long(spark, sf).filter((F.col("period") <= F.lit("2000-06-01").cast("date"))).groupBy(
        F.col("series").alias("target")).agg(F.max("period").alias("last_actual"))
    return forecast_view(forecasts(spark, sf).dropna(subset=["forecast_value"]), until, 1999)


@query("variant_gap", f"""WITH {MET} SELECT a.target, a.trained_on_periods, a.mape AS mape_a, b.mape AS mape_b, {r4('b.mape - a.mape')} AS gap_pp,
  CASE WHEN b.mape - a.mape < 2 THEN 'small' WHEN b.mape - a.mape < 6 THEN 'moderate' ELSE 'large' END AS verdict
  FROM met a JOIN met b ON a.target = b.target AND a.trained_on_periods = b.trained_on_periods WHERE a.model_name = 'trailing_mean' AND b.model_name = 'seasonal_naive'""")
def variant_gap_q(spark, sf):
    m = metrics(spark, sf)
    return variant_gap(m.filter("model_name = 'trailing_mean'"), m.filter("model_name = 'seasonal_naive'"), ["target", "trained_on_periods"])


_REPLACED = f"""WITH {FC} SELECT target, model_name, forecast_period, {r4('forecast_value')} AS forecast_value, 'old' AS run FROM fc
  WHERE NOT (model_name = 'seasonal_naive' AND year(forecast_period) = 2000)
UNION ALL SELECT target, model_name, forecast_period, actual AS forecast_value, 'new' AS run FROM fc WHERE model_name = 'seasonal_naive' AND year(forecast_period) = 2000"""
_RESULT_KEYS = ["target", "model_name", "forecast_period"]


def old_and_new(spark, sf):
    fc = forecasts(spark, sf)
    old = fc.select(*_RESULT_KEYS, round_half_up("forecast_value").alias("forecast_value"), F.lit("old").alias("run"))
    new = fc.filter((F.col("model_name") == "seasonal_naive") & (F.year("forecast_period") == 2000)).select(
        *_RESULT_KEYS, F.col("actual").alias("forecast_value"), F.lit("new").alias("run"))
    return old, new


@query("replace_by_key", _REPLACED)
def replace_by_key_q(spark, sf):
    return replace_by_key(*old_and_new(spark, sf), _RESULT_KEYS)


@query("replace_by_key_table", _REPLACED)
def replace_by_key_table(spark, sf):
    """The same as a write: a second version of the results table, swapped in when it is complete."""
    old, new = old_and_new(spark, sf)
    results = VersionedTable(spark, new_path(spark, "results"))
    results.swap(old)
    results.replace(new, _RESULT_KEYS)
    return results.read()


@query("metrics_update", f"""WITH {MET} SELECT fc.target, fc.model_name, fc.forecast_period,
  CASE WHEN year(forecast_period) = 1999 THEN met.rmse END AS rmse, CASE WHEN year(forecast_period) = 1999 THEN met.mape END AS mape
  FROM fc JOIN met USING (target, model_name, trained_on_periods)""")
def metrics_update(spark, sf):
    rows = forecasts(spark, sf).select("target", "model_name", "forecast_period", "trained_on_periods",
                                       F.lit(None).cast("double").alias("rmse"), F.lit(None).cast("double").alias("mape"))
    return update_by_key(rows, metrics(spark, sf), _BY, ["rmse", "mape"], F.year("forecast_period") == 1999).drop("trained_on_periods")


@query("backtest_splits", f"""WITH {SPARSE}, n AS (SELECT series, period, value, row_number() OVER (PARTITION BY series ORDER BY period) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM dense),
s(split) AS (VALUES (1), (2), (3)),
j AS (SELECT series, period, value, split, i, n, n - 36 + (split - 1) * 12 AS train_end FROM n CROSS JOIN s WHERE n - 36 >= 24)
SELECT series, period, value, split, CASE WHEN i < train_end THEN 'train' ELSE 'test' END AS role FROM j WHERE i < train_end + 12
UNION ALL SELECT series, period, value, 0, 'too_short' FROM n WHERE n - 36 < 24""")
def backtest_splits(spark, sf):
    return backtest_frame(densify(sparse_cells(spark, sf)), "series")


# ---- reports over the month cells ----

CELLS = feature_cells_sql()


def fcells(spark, sf):
    return feature_cells(feature_observations(spark, sf))


query("series_profile", f"""WITH {CELLS} SELECT series, count(value) AS n, min(value) AS min_value, max(value) AS max_value, {r4('avg(value)')} AS mean_value,
  {r4('stddev_samp(value)')} AS std_value, arg_max(value, period) AS latest_value, max(period) AS latest_period FROM fcells GROUP BY 1""")(
    lambda spark, sf: profile(fcells(spark, sf)))

_CORR = f"""{CELLS}, corr AS (SELECT f.series AS feature, t.series AS target, count(*) AS n_pairs, corr(f.value, t.value) AS r
  FROM fcells f JOIN fcells t ON f.period = t.period AND t.series IN ('wti_price', 'henry_hub_price') GROUP BY 1, 2)"""
query("correlation_targets", f"""WITH {_CORR} SELECT feature, target, n_pairs, {r4('r')} AS corr,
  CASE WHEN abs(r) > 0.5 THEN 'strong' ELSE 'weak' END AS strength, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction FROM corr""")(
    lambda spark, sf: correlate_with_targets(fcells(spark, sf), ["wti_price", "henry_hub_price"]))

_GROUP_CASE = "CASE feature " + " ".join(f"WHEN '{f}' THEN '{g}'" for f, g in FEATURE_GROUPS.items()) + " ELSE 'Other' END"


@query("importance_groups", f"""WITH {_CORR}, cc AS (SELECT feature, target, {r4('r')} AS c FROM corr)
SELECT target, {_GROUP_CASE} AS feature_group, {r4('sum(abs(c))')} AS importance FROM cc WHERE feature <> target GROUP BY 1, 2""")
def importance_groups_q(spark, sf):
    """Group sums, here of absolute correlations; fitted importances come from the tree jobs."""
    c = correlate_with_targets(fcells(spark, sf), ["wti_price", "henry_hub_price"])
    return importance_groups(c.filter(F.col("feature") != F.col("target")).withColumn("importance", F.abs("corr")))


@query("top_importances", f"""WITH {_CORR}, cc AS (SELECT feature, target, abs({r4('r')}) AS importance FROM corr WHERE feature <> target)
SELECT feature, target, importance FROM cc WHERE target = 'wti_price' ORDER BY importance DESC, feature LIMIT 10""")
def top_importances(spark, sf):
    c = correlate_with_targets(fcells(spark, sf), ["wti_price"])
    return (c.filter(F.col("feature") != F.col("target")).select("feature", "target", F.abs("corr").alias("importance"))
            .orderBy(F.col("importance").desc(), "feature").limit(10))


query("percent_rank_latest", f"""WITH {CELLS}, l AS (SELECT series, arg_max(value, period) AS latest_value FROM fcells GROUP BY 1),
p AS (SELECT series, latest_value, avg(CASE WHEN value < latest_value THEN 1.0 ELSE 0.0 END) * 100 AS p FROM fcells JOIN l USING (series) GROUP BY 1, 2)
SELECT series, latest_value, {r4('p')} AS pct_rank, CASE WHEN p > 90 THEN 'top' WHEN p < 10 THEN 'bottom' ELSE 'normal' END AS band FROM p""")(
    lambda spark, sf: percent_rank_of_latest(fcells(spark, sf)))
query("latest_and_delta", f"""WITH {CELLS}, p AS (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY period) AS prev, row_number() OVER (PARTITION BY series ORDER BY period DESC) AS rn FROM fcells)
SELECT series, period AS latest_period, value AS latest_value, {r4('value - prev')} AS delta, {r4('(value - prev) / nullif(prev, 0) * 100')} AS delta_pct FROM p WHERE rn = 1""")(
    lambda spark, sf: latest_and_delta(fcells(spark, sf)))
query("seasonal_means", f"WITH {CELLS} SELECT series, CAST(month(period) AS INT) AS month, {r4('avg(value)')} AS mean_value FROM fcells GROUP BY 1, 2")(
    lambda spark, sf: seasonal_means(fcells(spark, sf)))
query("year_overlay", f"""WITH {SPARSE}, y AS (SELECT series, CAST(year(period) AS INT) AS year, CAST(month(period) AS INT) AS month, value, count(*) OVER (PARTITION BY series, year(period)) AS n FROM sparse)
SELECT series, year, month, value FROM y WHERE n >= 6""")(lambda spark, sf: year_overlay(sparse_cells(spark, sf)))
query("latest_per_feature", f"""WITH {CELLS} SELECT series, max(period) AS latest_period, arg_max(value, period) AS latest_value, {_GROUP_CASE.replace('feature', 'series', 1)} AS feature_group FROM fcells GROUP BY 1""")(
    lambda spark, sf: latest_per_feature(fcells(spark, sf)))


@query("provider_counts", f"""WITH {all_obs_sql()} SELECT provider, count(*) AS n_rows, count(DISTINCT series_id) AS n_series, count(DISTINCT period) AS n_days FROM obs GROUP BY 1""")
def provider_counts_q(spark, sf):
    return provider_counts(all_observations(spark, sf))


@query("model_minimums", f"""WITH {MET} SELECT target, model_name, min(round(rmse, 2)) AS rmse, min(round(mape, 2)) AS mape FROM met GROUP BY 1, 2""")
def model_minimums(spark, sf):
    return metrics(spark, sf).groupBy("target", "model_name").agg(
        F.min(F.round("rmse", 2)).alias("rmse"), F.min(F.round("mape", 2)).alias("mape"))


@query("layer_counts_union", f"""WITH {GOLD} SELECT 'bronze_petroleum' AS layer, max(period) AS latest_period, count(*) AS n_rows FROM oil
UNION ALL SELECT 'bronze_natural_gas', max(period), count(*) FROM gas UNION ALL SELECT 'silver_petroleum', max(period), count(*) FROM so
UNION ALL SELECT 'silver_natural_gas', max(period), count(*) FROM sg UNION ALL SELECT 'gold_energy_prices', max(period), count(*) FROM gold""")
def layer_counts_union(spark, sf):
    from monthgrid.sources.tables import gas_observations

    parts = [("bronze_petroleum", oil_observations(spark, sf)), ("bronze_natural_gas", gas_observations(spark, sf)),
             ("silver_petroleum", silver_oil_df(spark, sf)), ("silver_natural_gas", silver_gas_df(spark, sf)),
             ("gold_energy_prices", gold_df(spark, sf))]
    out = layer_row(parts[0][1], parts[0][0])
    for name, df in parts[1:]:
        out = out.unionByName(layer_row(df, name))
    return out


@query("run_success_rate", """SELECT count(*) AS n_runs, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_success,
  round(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS success_rate FROM (
  SELECT o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50)""")
def run_success_rate_q(spark, sf):
    runs = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") == "O", "success").otherwise("failed").alias("status"))
    return run_success_rate(runs, 50, F.col("o_orderdate").desc(), F.col("o_orderkey").desc())


@query("latest_per_suite", """SELECT event_type AS suite, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_suite(spark, sf):
    newest = F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("suite")).agg(newest.alias("m")).select("suite", "m.*")


@query("latest_n_rows", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5000""")
def latest_n_rows(spark, sf):
    return (table(spark, sf, "orders").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(5000)
            .select("o_orderkey", "o_totalprice"))


@query("recent_six_months", f"""WITH {CELLS} SELECT series, strftime(period, '%b %Y') AS month, value FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY period DESC) AS rn FROM fcells) WHERE rn <= 6""")
def recent_six_months(spark, sf):
    from pyspark.sql import Window as W

    rn = F.row_number().over(W.partitionBy("series").orderBy(F.col("period").desc()))
    return fcells(spark, sf).withColumn("rn", rn).filter("rn <= 6").select(
        "series", F.date_format("period", "MMM yyyy").alias("month"), "value")


@query("series_with_forecasts_semi", f"""WITH {FC} SELECT series, count(*) AS n FROM fcells WHERE series IN (SELECT target FROM fc) GROUP BY 1""")
def series_with_forecasts_semi(spark, sf):
    known = forecasts(spark, sf).select(F.col("target").alias("series")).distinct()
    return fcells(spark, sf).join(known, "series", "left_semi").groupBy("series").agg(F.count(F.lit(1)).alias("n"))


@query("unknown_series_anti", f"""WITH {OIL} SELECT series_id, count(*) AS n FROM oil WHERE series_id NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""")
def unknown_series_anti(spark, sf):
    known = spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",)], "series_id string")
    per_id = oil_observations(spark, sf).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.join(F.broadcast(known), "series_id", "left_anti")


@query("distinct_keys", """SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders""")
def distinct_keys(spark, sf):
    return table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus").distinct()


@query("column_overwrite", f"""WITH {ENG}, z AS (SELECT period, series, value, avg(value) OVER (PARTITION BY series) AS m FROM eng)
SELECT period, CASE WHEN series = 'wti_price' THEN value ELSE {r4('value - m')} END AS value, series FROM z""")
def column_overwrite(spark, sf):
    """The raw target takes the place of its centred values."""
    from monthgrid.functions.windows import whole
    from monthgrid.sinks.tables import overwrite_column

    long = eng_long(spark, sf).select("period", "series", "value")
    centred = long.withColumn("value", round_half_up(F.col("value") - F.avg("value").over(whole("series"))))
    target = overwrite_column(centred.filter("series = 'wti_price'"), long.filter("series = 'wti_price'"), "period", "value")
    return target.unionByName(centred.filter("series <> 'wti_price'"))


@query("reindex_to_keys", f"""WITH {CELLS} SELECT k.period, c.value FROM (SELECT DISTINCT period FROM fcells) k LEFT JOIN (
  SELECT period, value FROM fcells WHERE series = 'wti_price') c USING (period)""")
def reindex_to_keys(spark, sf):
    c = fcells(spark, sf)
    return reindex(c.filter("series = 'wti_price'").select("period", "value"), c.select("period").distinct(), ["period"])


@query("target_model_grid", f"""WITH {CELLS} SELECT series AS target, m AS model_name, c AS config, min(period) AS first_period FROM fcells
  CROSS JOIN (VALUES ('seasonal_naive'), ('trailing_mean')) v(m) CROSS JOIN (VALUES ('base'), ('deep')) w(c) GROUP BY 1, 2, 3""")
def target_model_grid(spark, sf):
    """Targets x models x configurations: the lists are constants, exploded per target."""
    per = fcells(spark, sf).groupBy(F.col("series").alias("target")).agg(F.min("period").alias("first_period"))
    models, configs = F.array(F.lit("seasonal_naive"), F.lit("trailing_mean")), F.array(F.lit("base"), F.lit("deep"))
    return per.withColumn("model_name", F.explode(models)).withColumn("config", F.explode(configs))
