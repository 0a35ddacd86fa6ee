"""Calendar, preprocessing and features against pandas and hand-made cases."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from conftest import by_period
from monthgrid.catalog import FEATURE_COLUMNS
from monthgrid.functions import windows as X
from monthgrid.operators.calendar import densify, with_fills, with_interpolated
from monthgrid.operators.evaluate import chronological_split
from monthgrid.operators.stats import (correlate_with_targets, iqr_bounds, latest_and_delta, percent_rank_of_latest, profile,
                                       year_overlay)
from monthgrid.plans.features import (MEASURES, engineered_long, engineered_wide, feature_wide, feature_wide_by_joins, scaled,
                                      scaler, strict_measures, unscaled)
from monthgrid.plans.preprocess import preprocess
from pyspark.sql import functions as F

RNG = np.random.default_rng(7)


def d(text):
    return dt.date.fromisoformat(text)


def ordered(df, col, series="a"):
    rows = [r for r in df.collect() if r["series"] == series]
    return [r[col] for r in sorted(rows, key=lambda r: r["period"])]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        if w is None or np.isnan(w):
            assert g is None
        else:
            assert g == pytest.approx(w, rel=1e-9, abs=1e-9)


def test_densify_makes_every_month(monthly):
    out = densify(monthly({"a": [1, "gap", "gap", 4], "b": [7]}))
    assert by_period(out.filter("series = 'a'"), "value") == {d("2018-01-01"): 1.0, d("2018-02-01"): None, d("2018-03-01"): None, d("2018-04-01"): 4.0}
    assert out.filter("series = 'b'").count() == 1
    values = [float(v) for v in range(60)]
    values[10] = values[25] = "gap"
    assert densify(monthly({"a": values})).count() == 60


def test_fills(monthly):
    out = with_fills(monthly({"a": [None, 1, None, 3, None]}))
    same(ordered(out, "ffill"), [np.nan, 1, 1, 3, 3])
    same(ordered(out, "bfill"), [1, 1, 3, 3, np.nan])
    same(ordered(out, "filled"), [1, 1, 1, 3, 3])


def test_interpolation_equals_pandas(monthly):
    values = [None, 1, None, None, 7, None, 5, None, None]
    out = with_interpolated(monthly({"a": values, "b": [None, None]}))
    same(ordered(out, "interpolated"), pd.Series(values, dtype=float).interpolate(method="linear").tolist())
    assert ordered(out, "interpolated", "b") == [None, None]


def pandas_preprocess(values):
    s = pd.Series([np.nan if v in (None, "gap") else v for v in values], dtype=float).ffill().bfill().interpolate()
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    s[(s < q1 - 3 * (q3 - q1)) | (s > q3 + 3 * (q3 - q1))] = np.nan
    return s.interpolate()


def test_preprocess_equals_pandas(monthly):
    values = list(50 + np.arange(60) * 0.3 + RNG.normal(0, 1, 60))
    values[5] = values[20] = None
    values[15], values[30], values[40] = 5000.0, -200.0, "gap"
    out = preprocess(monthly({"a": values})).cache()
    s = pandas_preprocess(values)
    same(ordered(out, "value"), s.tolist())
    same(ordered(out, "lag_12"), s.shift(12).tolist())
    same(ordered(out, "rolling_6_mean"), s.rolling(6, min_periods=1).mean().tolist())
    same(ordered(out, "rolling_3_std"), s.rolling(3, min_periods=1).std().tolist())
    same(ordered(out, "mom_pct"), (s.pct_change() * 100).tolist())
    z = preprocess(monthly({"a": values, "c": [4.0] * 5, "one": [3.0]}), normalize=True)
    assert ordered(z, "value", "one") == []
    same(ordered(z, "value"), ((s - s.mean()) / s.std()).tolist())
    assert ordered(z, "value", "c") == [4.0] * 5


@pytest.mark.parametrize("n,train", [(60, 48), (1, 0), (7, 5), (10, 8)])
def test_split_is_chronological(monthly, n, train):
    out = chronological_split(monthly({"a": list(range(n))}), "series")
    assert ordered(out, "split") == ["train"] * train + ["test"] * (n - train)


@pytest.fixture(scope="module")
def wide_cells(monthly):
    rng = np.random.default_rng(3)
    data = {c: list(100 + rng.normal(0, 5, 60).cumsum()) for c in FEATURE_COLUMNS}
    data["henry_hub_price"][-2:] = ["gap", "gap"]
    data["crude_imports"][-1] = "gap"
    return monthly(data), data


def test_feature_table_spine_and_join_form_agree(wide_cells):
    cells, _ = wide_cells
    a, b = feature_wide(cells).collect(), feature_wide_by_joins(cells).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 60


def test_months_without_spine_series_are_left_out(monthly):
    cells = monthly({"wti_price": [1, "gap", 3], "hdd": [5, 6, 7]})
    assert sorted(by_period(feature_wide(cells), "hdd").values()) == [5.0, 7.0]


def test_engineered_features_equal_pandas(wide_cells):
    cells, data = wide_cells
    long = engineered_long(feature_wide(cells)).cache()
    for name in ("wti_price", "henry_hub_price", "gas_storage"):
        s = pd.Series([np.nan if v == "gap" else v for v in data[name]]).ffill()
        for k in (1, 3, 6, 12):
            same(ordered(long, f"lag_{k}", name), s.shift(k).tolist())
        for w in (3, 6, 12):
            r = s.shift(1).rolling(w, min_periods=max(2, w // 2))
            same(ordered(long, f"roll{w}_mean", name), r.mean().tolist())
            same(ordered(long, f"roll{w}_std", name), r.std().tolist())
        same(ordered(long, "mom_pct", name), (s.pct_change() * 100).tolist())
        same(ordered(long, "vs_12mo_avg", name), (s - s.shift(1).rolling(12, min_periods=6).mean()).tolist())


def test_engineered_table_has_192_new_columns(wide_cells):
    wide = engineered_wide(engineered_long(feature_wide(wide_cells[0])))
    assert len(wide.columns) - 1 - 17 == 192 and len(set(wide.columns)) == len(wide.columns)
    assert len(MEASURES) == 11
    row = wide.filter("month = 12").first()
    assert row["quarter"] == 4 and abs(row["month_sin"]) < 1e-12 and row["month_cos"] == pytest.approx(1)


def test_first_twelve_lag_12_are_null_and_rolling_excludes_now(wide_cells):
    long = engineered_long(feature_wide(wide_cells[0]))
    data = wide_cells[1]["wti_price"]
    lag12 = ordered(long, "lag_12", "wti_price")
    assert lag12[:12] == [None] * 12 and None not in lag12[12:]
    assert ordered(long, "roll3_mean", "wti_price")[20] == pytest.approx(np.mean(data[17:20]))


def test_scaling_and_its_inverse(monthly):
    rows = monthly({"a": [1, 2, 3, 10], "b": [5, 5, 5, 5], "c": [1]}).cache()
    z = scaled(rows, ["value"])
    s = pd.Series([1, 2, 3, 10.0])
    same(ordered(z, "value"), ((s - s.mean()) / s.std()).tolist())
    assert ordered(z, "value", "b") == [0.0] * 4
    back = unscaled(z, scaler(rows, ["value"]), "value")
    same(ordered(back, "value"), [1, 2, 3, 10])
    fit = scaled(rows, ["value"], "period < DATE'2018-04-01'")
    same(ordered(fit, "value"), [-1, 0, 1, 8])


def strict_reference(s, t):
    """Features of row t from the rows before it."""
    past = s.iloc[:t].dropna()
    out = {f"lag_{k}": past.iloc[-k] if len(past) >= k else None for k in (1, 3, 6, 12)}
    out |= {f"roll{w}_mean": past.iloc[-w:].mean() if len(past) >= w else None for w in (3, 6, 12)}
    out["mom_pct"] = (past.iloc[-1] - past.iloc[-2]) / past.iloc[-2] * 100 if len(past) >= 2 else None
    out["vs_12mo_avg"] = past.iloc[-1] - past.iloc[-12:].mean() if len(past) >= 12 else None
    return out


def test_strict_features_use_only_the_past(monthly):
    values = list(RNG.uniform(10, 20, 30))
    values[4] = values[17] = values[18] = None
    rows = sorted(strict_measures(monthly({"a": values})).collect(), key=lambda r: r["period"])
    s = pd.Series(values, dtype=float)
    for t, r in enumerate(rows):
        for k, v in strict_reference(s, t).items():
            same([r[k]], [np.nan if v is None else v])


def test_window_helpers_keep_series_apart(monthly):
    out = monthly({"a": [1, 2], "b": [10, 20]}).select("series", "period", X.lag("value", 1, "series").alias("l"),
                                                      X.trailing(F.avg, "value", 3, "series").alias("t"))
    assert ordered(out, "l", "b") == [None, 10.0] and ordered(out, "t", "b") == [10.0, 15.0]


def test_statistics(monthly):
    cells = monthly({"x": [1, 2, 3, 4, None], "y": [2, 4, 6, 8, 9], "z": [4, 3, 2, 1, 0]}).cache()
    c = {r["feature"]: r for r in correlate_with_targets(cells, ["y"]).collect()}
    assert (c["x"]["corr"], c["x"]["n_pairs"], c["x"]["strength"], c["x"]["direction"]) == (1.0, 4, "strong", "positive")
    assert c["z"]["direction"] == "negative"
    p = {r["series"]: r for r in profile(cells).collect()}
    assert (p["x"]["latest_value"], p["x"]["n"], p["y"]["std_value"]) == (4.0, 4, 2.8636)
    r = {r["series"]: (r["pct_rank"], r["band"]) for r in percent_rank_of_latest(cells).collect()}
    assert r == {"x": (75.0, "normal"), "y": (80.0, "normal"), "z": (0.0, "bottom")}
    dl = {r["series"]: (r["delta"], r["delta_pct"]) for r in latest_and_delta(cells).collect()}
    assert dl["x"] == (1.0, 33.3333) and dl["z"] == (-1.0, -100.0)
    q = {r["series"]: (r["q1"], r["q3"]) for r in iqr_bounds(cells).collect()}
    assert q["y"] == (4.0, 8.0)
    assert year_overlay(monthly({"a": [1] * 12 + [2] * 5})).count() == 12
