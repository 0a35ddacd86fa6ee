import numpy as np
import pytest

from monthgrid.operators.evaluate import (align, backtest_frame, best_config, best_flags, error_metrics, leaderboard, variant_gap)
from monthgrid.plans.reports import forecast_pivot, forecast_view, importance_groups, run_success_rate
from pyspark.sql import functions as F

S = "g string, actual double, forecast_value double"


def metrics(spark, rows):
    return {r["g"]: r for r in error_metrics(spark.createDataFrame(rows, S), ["g"]).collect()}


def test_perfect_forecast(spark):
    m = metrics(spark, [("a", float(v), float(v)) for v in range(1, 13)])["a"]
    assert (m["rmse"], m["mae"], m["mape"], m["r2"], m["n_periods"]) == (0.0, 0.0, 0.0, 1.0, 12)


def test_metrics_equal_numpy(spark):
    rng = np.random.default_rng(1)
    a, p = rng.normal(50, 9, 40), rng.normal(50, 9, 40)
    m = metrics(spark, [("a", float(x), float(y)) for x, y in zip(a, p)])["a"]
    assert m["rmse"] == round(float(np.sqrt(np.mean((a - p) ** 2))), 4)
    assert m["mae"] == round(float(np.mean(np.abs(a - p))), 4)
    assert m["mape"] == round(float(np.mean(np.abs((a - p) / a)) * 100), 4)
    assert m["r2"] == round(float(1 - np.sum((a - p) ** 2) / np.sum((a - a.mean()) ** 2)), 4)


def test_zero_actuals_constant_actuals_and_missing_pairs(spark):
    m = metrics(spark, [("z", 0.0, 1.0), ("z", 2.0, 1.0), ("all0", 0.0, 1.0), ("c", 5.0, 4.0), ("c", 5.0, 6.0), ("n", None, 1.0), ("n", 1.0, None)])
    assert m["z"]["mape"] == 50.0 and m["all0"]["mape"] == 0.0 and m["c"]["r2"] == 0.0
    assert "n" not in m


def test_flags_mark_ties_and_best_config_breaks_them(spark):
    m = spark.createDataFrame([("t", "a", 1.0, 5.0, 0.5), ("t", "b", 1.0, 6.0, 0.9), ("t", "c", 2.0, 5.0, 0.1)],
                              "target string, config string, rmse double, mape double, r2 double")
    f = {r["config"]: (r["best_rmse"], r["best_mape"], r["best_r2"]) for r in best_flags(m, ["target"]).collect()}
    assert f == {"a": (True, True, False), "b": (True, False, True), "c": (False, True, False)}
    assert best_config(m, ["target"]).first()["config"] == "a"


def test_leaderboard_puts_unknown_metrics_last(spark):
    rows = [("w", "a", "2024-01", 1.0, None), ("w", "b", "2024-01", 2.0, 7.0), ("w", "b", "2024-02", 9.0, 9.0), ("w", "c", "2024-01", 3.0, 6.0)]
    lb = leaderboard(spark.createDataFrame(rows, "window string, model_label string, forecast_period string, rmse double, mape double"))
    assert {r["model_label"]: (r["place"], r["rmse"], r["n_months"]) for r in lb.collect()} == {"c": (1, 3.0, 1), "b": (2, 2.0, 2), "a": (3, 1.0, 1)}


def test_backtest_splits_expand_and_short_series_are_marked(monthly):
    rows = backtest_frame(monthly({"a": list(range(72)), "s": list(range(59))}), "series").groupBy("series", "split", "role").count().collect()
    got = {(r["series"], r["split"], r["role"]): r["count"] for r in rows}
    assert got == {("a", 1, "train"): 36, ("a", 1, "test"): 12, ("a", 2, "train"): 48, ("a", 2, "test"): 12, ("a", 3, "train"): 60,
                   ("a", 3, "test"): 12, ("s", 0, "too_short"): 59}


@pytest.mark.parametrize("gap,verdict", [(1.99, "small"), (2.0, "moderate"), (5.99, "moderate"), (6.0, "large"), (-3.0, "small")])
def test_variant_gap(spark, gap, verdict):
    a = spark.createDataFrame([("t", 5.0)], "target string, mape double")
    b = spark.createDataFrame([("t", 5.0 + gap)], "target string, mape double")
    assert variant_gap(a, b, ["target"]).first()["verdict"] == verdict


def test_no_overlap_gives_no_metrics(spark):
    a = spark.createDataFrame([("t", "2024-01", 1.0)], "target string, month string, actual double")
    f = spark.createDataFrame([("t", "2025-01", 1.0)], "target string, month string, forecast_value double")
    assert error_metrics(align(a, f, ["target", "month"]), ["target"]).count() == 0
    assert align(a, f, ["target", "month"], "left").first()["actual"] is None


def test_reports(spark):
    f = spark.createDataFrame([("w", "m1", "2024-01", 1.234, 1.0), ("w", "m2", "2024-01", 2.0, 1.0)],
                              "target string, model_name string, forecast_period string, forecast_value double, actual double")
    r = forecast_pivot(f, ["m1", "m2"]).first()
    assert (r["actual"], r["m1"], r["error_m1"], r["error_m2"]) == (1.0, 1.23, 0.23, 1.0)
    fv = f.withColumn("forecast_period", F.to_date(F.concat("forecast_period", F.lit("-01"))))
    until = spark.createDataFrame([("w",)], "target string").withColumn("last_actual", F.to_date(F.lit("2023-12-01")))
    assert {x["view"] for x in forecast_view(fv, until, 2024).collect()} == {"Future"}
    imp = spark.createDataFrame([("t", "hdd", 0.2), ("t", "cdd", 0.1), ("t", "zzz", 0.7)], "target string, feature string, importance double")
    assert {x["feature_group"]: x["importance"] for x in importance_groups(imp).collect()} == {"Weather": 0.3, "Other": 0.7}
    runs = spark.createDataFrame([(i, "success" if i % 2 else "failed") for i in range(10)], "i int, status string")
    assert run_success_rate(runs, 3, F.col("i").desc()).first()["success_rate"] == 66.67
    assert run_success_rate(runs.filter("false"), 3, F.col("i")).first()["success_rate"] is None
