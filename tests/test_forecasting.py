"""Forecast jobs: estimation against numpy, and properties any forecast must have."""

import numpy as np
import pytest

from monthgrid.operators.regress import fit_ols
from monthgrid.plans.forecasting import (Order, SEARCH_ORDERS, backtest, converged_only, filtered_seasonal_ar, fit_predict, fit_seasonal_ar,
                                         fitted_seasonal_ar, forecast_with_exog, model_from_weights, forecast_seasonal_ar, load_model, order_search,
                                         predict_seasonal_ar, run_both, save_model, to_results, validate, window_experiment)
from monthgrid.plans.trend import Trend, fit_trend_seasonal, forecast_trend_seasonal, predict_trend_seasonal
from monthgrid.session import new_path
from pyspark.sql import functions as F

RNG = np.random.default_rng(11)
N = 96
T = np.arange(N)
SERIES = 60 + 0.3 * T + 8 * np.sin(2 * np.pi * T / 12) + RNG.normal(0, 1, N)


@pytest.fixture(scope="module")
def rows(monthly):
    return monthly({"a": list(SERIES), "b": list(3 * SERIES + RNG.normal(0, 2, N))}).cache()


def test_ols_equals_numpy_for_every_group(spark):
    data = [(g, float(y), *map(float, x)) for g in range(40) for x in RNG.normal(size=(30, 2)) for y in [x @ [2.0, -1.0] + g + RNG.normal()]]
    df = spark.createDataFrame(data, "g int, y double, x1 double, x2 double")
    got = {r["g"]: r for r in fit_ols(df, ["g"], "y", ["x1", "x2"]).collect()}
    arr = np.array(data)
    for g in range(40):
        m = arr[arr[:, 0] == g]
        x = np.c_[np.ones(30), m[:, 2:]]
        beta, rss, *_ = np.linalg.lstsq(x, m[:, 1], rcond=None)
        assert got[g]["beta"] == pytest.approx(list(beta), rel=1e-6)
        assert got[g]["sigma"] == pytest.approx(np.sqrt(rss[0] / 27), rel=1e-6)


def test_ols_reports_collinear_columns_and_few_rows(spark):
    df = spark.createDataFrame([("c", float(i), float(i), 2.0 * i) for i in range(9)] + [("few", 1.0, 1.0, 1.0), ("nul", 1.0, None, 1.0)]
                               + [("flat", 3.0 * i, float(i), 5.0) for i in range(9)], "g string, y double, x1 double, x2 double")
    r = {x["g"]: x for x in fit_ols(df, ["g"], "y", ["x1", "x2"]).collect()}
    assert r["c"]["beta"] is None and r["c"]["error"] == "collinear columns"
    assert r["few"]["beta"] is None and r["few"]["error"] == "not enough months to fit" and "nul" not in r
    assert r["flat"]["beta"] == pytest.approx([0, 3, 0], abs=1e-9) and r["flat"]["error"] is None


def test_ols_keeps_its_digits_far_from_zero(spark):
    df = spark.createDataFrame([(2 * (1e8 + i) + i % 3, 1e8 + i) for i in range(99)], "y double, x double").withColumn("g", F.lit(1))
    r = fit_ols(df, ["g"], "y", ["x"]).first()
    x = np.arange(99.0)
    slope, level = np.polyfit(x, 2 * x + x % 3, 1)
    assert r["beta"][1] == pytest.approx(slope, abs=1e-6)
    assert r["sigma"] == pytest.approx(np.sqrt(((2 * x + x % 3 - slope * x - level) ** 2).sum() / 97), rel=1e-4)


def test_a_missing_month_gives_an_error_not_a_forecast(monthly):
    broken = monthly({"a": list(SERIES)}).filter("period <> '2020-03-01'")
    model = fit_seasonal_ar(broken, ["series"], Order(1, 1, 0, 0, 1, 0, 12))
    assert model.first()["error"] == "months are missing"
    assert [(r["forecast"], r["error"]) for r in predict_seasonal_ar(model, ["series"], Order(1, 1, 0, 0, 1, 0, 12), alpha=0.03).collect()] == [(None, "months are missing")]


def test_orders():
    o = Order()
    assert (o.ar, o.ma, o.name) == ([1, 12, 13], [1, 12, 13], "(1,1,1)(1,1,1,12)")
    assert [i for i, v in enumerate(o.difference) if v] == [0, 1, 12, 13]
    assert Order(P=0).ar == [1] and Order(p=2, q=0, Q=0).ma == []
    assert len({o.name for o in SEARCH_ORDERS}) == 6


@pytest.mark.parametrize("model", ["sarima", "prophet"])
def test_forecast_properties(rows, model):
    f = fit_predict(rows, ["series"], model, 12).orderBy("series", "step").collect()
    assert len(f) == 24
    for r in f:
        assert r["lower"] <= r["forecast"] <= r["upper"] and r["n_train"] == N
    a = [r for r in f if r["series"] == "a"]
    assert [str(r["period"]) for r in a][:2] == ["2026-01-01", "2026-02-01"]
    width = [r["upper"] - r["lower"] for r in a]
    assert width[-1] > width[0]
    t = np.arange(N, N + 12)
    truth = 60 + 0.3 * t + 8 * np.sin(2 * np.pi * t / 12)
    assert np.mean(np.abs(np.array([r["forecast"] for r in a]) - truth)) < 3


def reference_path(y, phi, theta, c, es, diff, horizon):
    """Step-by-step forecast of one series in plain Python."""
    w = np.convolve(y, diff)[len(diff) - 1:len(y)].tolist()
    y, es = list(y), list(es)
    for _ in range(horizon):
        nw = c + sum(v * w[-k] for k, v in phi.items()) + sum(v * es[-k] for k, v in theta.items())
        y.append(nw - sum(diff[k] * y[-k] for k in range(1, len(diff))))
        w.append(nw)
        es.append(0.0)
    return y[-horizon:]


def test_recursion_and_bounds_equal_a_plain_loop(spark, rows):
    order = Order()
    m = fit_seasonal_ar(rows, ["series"], order).cache()
    model = m.filter("series = 'a'").first()
    beta = model["beta"]
    phi, theta = dict(zip(order.ar, beta[1:4])), dict(zip(order.ma, beta[4:7]))
    got = [r for r in predict_seasonal_ar(m, ["series"], order).orderBy("step").collect() if r["series"] == "a"]
    diff = np.array(order.difference)
    base = np.array(reference_path(SERIES, phi, theta, beta[0], model["es"], diff, 12))
    assert [r["forecast"] for r in got] == pytest.approx(list(base), abs=2e-4)
    # a unit shock in the first future month moves the path by the weights that widen the bounds
    es = np.zeros(40)
    shocked = list(SERIES * 0)
    w = [0.0] * 60
    y, e, psi = [0.0] * 60, [0.0] * 60, []
    for h in range(12):
        e_now = 1.0 if h == 0 else 0.0
        nw = sum(v * w[-k] for k, v in phi.items()) + sum(v * e[-k] for k, v in theta.items()) + e_now
        y.append(nw - sum(diff[k] * y[-k] for k in range(1, len(diff))))
        w.append(nw)
        e.append(e_now)
        psi.append(y[-1])
    half = 1.959963984540054 * model["sigma"] * np.sqrt(np.cumsum(np.square(psi)))
    assert [(r["upper"] - r["lower"]) / 2 for r in got] == pytest.approx(list(half), rel=1e-3)


def test_short_and_constant_series(monthly):
    rows = monthly({"short": [1, 2, 3], "flat": [5.0] * 60, "ok": list(SERIES)})
    m = {r["series"]: r for r in fit_seasonal_ar(rows, ["series"]).collect()}
    assert m["short"]["error"] == "not enough months to fit" and m["ok"]["error"] is None
    f = forecast_seasonal_ar(rows, ["series"]).filter("series = 'flat'").collect()
    assert all(r["forecast"] == 5.0 for r in f)
    t = {r["series"]: r["error"] for r in fit_trend_seasonal(rows, ["series"]).collect()}
    assert t["short"] and not t["flat"]


def test_fitted_values(rows):
    o = Order(1, 1, 0, 0, 1, 0)
    f = fitted_seasonal_ar(rows, fit_seasonal_ar(rows, ["series"], o), ["series"], o).filter("series = 'a'").orderBy("period").collect()
    assert [r["fitted"] is None for r in f] == [True] * 14 + [False] * (N - 14)


@pytest.mark.parametrize("order", [Order(), Order(0, 1, 1, 0, 1, 1), Order(2, 1, 0, 0, 1, 1)])
def test_fitted_values_with_moving_average_terms_equal_a_plain_loop(rows, order):
    m = fit_seasonal_ar(rows, ["series"], order).cache()
    got = {(r["series"], r["period"]): r["fitted"] for r in filtered_seasonal_ar(rows, m, ["series"], order).collect()}
    shown = {(r["series"], r["period"]): r["fitted"] for r in fitted_seasonal_ar(rows, m, ["series"], order).collect()}
    for model in m.collect():
        data = sorted((r["period"], r["value"]) for r in rows.filter(F.col("series") == model["series"]).collect())
        diff, beta = order.difference, model["beta"]
        phi, theta = dict(zip(order.ar, beta[1:])), dict(zip(order.ma, beta[1 + len(order.ar):]))
        y, begin = [v for _, v in data], len(diff) - 1 + max([*order.ar, 0])
        w = [sum(c * y[t - k] for k, c in enumerate(diff)) if t >= len(diff) - 1 else None for t in range(len(y))]
        e = [0.0] * len(y)
        for t, (period, value) in enumerate(data):
            if t < begin:
                assert got[model["series"], period] is None
                continue
            step = beta[0] + sum(v * w[t - k] for k, v in phi.items()) + sum(v * e[t - k] for k, v in theta.items() if t >= k)
            e[t] = w[t] - step
            assert got[model["series"], period] == pytest.approx(value - w[t] + step, abs=1e-8)
            assert shown[model["series"], period] == pytest.approx(value - w[t] + step, abs=1e-4)


def test_given_weights_and_groups_without_a_model(monthly):
    rows = monthly({"a": list(SERIES), "short": [1, 2, 3]})
    order = Order(0, 1, 1, 0, 1, 1)
    m = model_from_weights(rows, ["series"], order, [0.0, -0.4, -0.5, 0.2], 1.0)
    f = predict_seasonal_ar(m, ["series"], order).collect()
    assert sum(r["error"] is None for r in f) == 12 and [r["error"] for r in f if r["series"] == "short"] == ["too few months to go on from"]
    with pytest.raises(ValueError):
        model_from_weights(rows, ["series"], order, [0.0], 1.0)
    none = fit_seasonal_ar(rows, ["series"], order)
    assert filtered_seasonal_ar(rows, none, ["series"], order).filter("series = 'short' AND fitted IS NULL").count() == 3


def test_unit_roots_are_marked(spark, rows):
    order = Order(2, 0, 1, 0, 0, 0)
    m = fit_seasonal_ar(rows, ["series"], order)
    cases = {"fine": [0.0, 0.5, 0.2, 0.3], "unit root": [0.0, 0.7, 0.3, 0.1], "explosive": [0.0, 1.5, 0.2, 0.1], "not invertible": [0.0, 0.5, 0.2, -1.0], "edge": [0.0, 0.5, 0.2, 1.2]}
    made = [m.filter("series = 'a'").withColumn("series", F.lit(k)).withColumn("beta", F.array(*map(F.lit, b))) for k, b in cases.items()]
    got = {r["series"]: r for r in converged_only(__import__("functools").reduce(lambda a, b: a.unionByName(b), made), order).collect()}
    assert {k: r["error"] for k, r in got.items()} == {"fine": None, "unit root": "not stationary", "explosive": "not stationary", "not invertible": "not invertible", "edge": "not invertible"}
    assert all((r["beta"] is None) == (r["error"] is not None) for r in got.values())
    for name, b in cases.items():
        roots = 1 / np.abs(np.roots([-b[2], -b[1], 1.0]))
        assert got[name]["ar_root"] == pytest.approx(roots.max(), rel=1e-9) and got[name]["ma_root"] == pytest.approx(abs(b[3]))


def test_search_reports_orders_that_do_not_converge(spark, monthly):
    rng = np.random.default_rng(2)
    rows = monthly({"w": list(100 + rng.normal(0, 1, N).cumsum()), "x": list(50 + np.exp(0.06 * T))})
    train, test = rows.filter("period < '2025-01-01'"), rows.filter("period >= '2025-01-01'")
    out = {(r["series"], r["config"]): r for r in order_search(train, test, ["series"], [Order(1, 0, 0, 0, 0, 0), Order(1, 1, 0, 0, 0, 0)]).collect()}
    explosive = out["x", Order(1, 0, 0, 0, 0, 0).name]
    assert explosive["error"] == "not stationary" and explosive["mape"] is None and len(out) == 4
    assert out["w", Order(1, 1, 0, 0, 0, 0).name]["error"] is None


def test_search_and_windows_with_exogenous_columns(spark, rows, monthly):
    train, future, _ = exog_rows(spark, rows)
    table = future.drop("series")
    past, ahead = train.filter("period < '2025-01-01'").select("series", "period", "value"), train.filter("period >= '2025-01-01'").select("series", "period", "value")
    out = order_search(past, ahead, ["series"], SEARCH_ORDERS[:2], table=table, exog=["x1", "x2"]).collect()
    plain = {r["config"]: r["mape"] for r in order_search(past, ahead, ["series"], SEARCH_ORDERS[:2]).collect()}
    assert all(r["error"] is None and r["mape"] < plain[r["config"]] for r in out)
    short = forecast_with_exog(past, ["series"], table.filter("period < '2025-06-01'"), ["x1", "x2"]).collect()
    assert [r["error"] for r in short] == ["the exogenous columns do not cover the horizon"]
    windows = [("late", "2018-01-01", "2024-12-01", "2025-01-01", "2025-12-01")]
    naive = ahead.select("series", F.lit("late").alias("window"), "period", F.lit(60.0).alias("forecast"))
    w = window_experiment(train.select("series", "period", "value"), windows, models={"exog": lambda r, by, h: forecast_with_exog(r, by, table, ["x1", "x2"], horizon=h)},
                          ready={"sixty": naive}).collect()
    assert {r["model_name"]: r["n_periods"] for r in w} == {"exog": 12, "sixty": 12}


@pytest.mark.parametrize("kind", [Trend(), Trend(3, 2, changepoint_prior=0.5), Trend(0, 1, seasonality_prior=float("inf")), Trend(mode="additive")])
def test_trend_equals_numpy(monthly, kind):
    rows = monthly({"a": list(SERIES)})
    model = fit_trend_seasonal(rows, ["series"], kind).first()
    z = SERIES if kind.mode == "additive" else np.log(SERIES)
    month, t = T % 12 + 1, T / (N - 1)

    def design(t, month):
        cols = [np.ones(len(t)), t, *[np.clip(t - kind.share * (j + 1) / (kind.changepoints + 1), 0, None) for j in range(kind.changepoints)]]
        for k in range(1, kind.fourier + 1):
            cols += [np.sin(2 * np.pi * k * (month - 1) / 12), np.cos(2 * np.pi * k * (month - 1) / 12)]
        return np.stack(cols, 1)

    x = design(t, month)
    stacked = np.vstack([x, np.diag(np.sqrt(kind.penalty))])  # ridge as least squares on added rows
    beta = np.linalg.lstsq(stacked, np.concatenate([z, np.zeros(x.shape[1])]), rcond=None)[0]
    assert model["beta"] == pytest.approx(list(beta), abs=1e-6) and model["mode"] == ("additive" if kind.mode == "additive" else "multiplicative")
    f = predict_trend_seasonal(fit_trend_seasonal(rows, ["series"], kind), ["series"], kind=kind).orderBy("step").collect()
    ahead = design((N - 1 + np.arange(1, 13)) / (N - 1), np.arange(12) + 1)
    want = ahead @ beta if kind.mode == "additive" else np.exp(ahead @ beta)
    assert [r["forecast"] for r in f] == pytest.approx(list(want), abs=2e-4) and {r["mode"] for r in f} == {model["mode"]}


def test_trend_errors_are_rows(monthly):
    rows = monthly({"short": [1, 2, 3], "n": list(SERIES - 70), "ok": list(SERIES)})
    f = forecast_trend_seasonal(rows, ["series"], kind=Trend(mode="multiplicative")).collect()
    assert {r["series"]: r["error"] for r in f} == {"short": "not enough months to fit", "n": "a multiplicative trend needs positive values", "ok": None}
    assert len(f) == 14
    with pytest.raises(ValueError):
        Trend(fourier=6)


def test_trend_with_negative_values_is_additive(monthly):
    m = fit_trend_seasonal(monthly({"n": list(SERIES - 70), "p": list(SERIES)}), ["series"])
    assert {r["series"]: r["is_log"] for r in m.collect()} == {"n": False, "p": True}


def exog_rows(spark, rows):
    x = RNG.normal(size=(N + 12, 2)).cumsum(axis=0)
    months = [(p.date(), float(a), float(b)) for p, (a, b) in zip(__import__("pandas").date_range("2018-01-01", periods=N + 12, freq="MS"), x)]
    xs = spark.createDataFrame(months, "period date, x1 double, x2 double")
    train = rows.filter("series = 'a'").join(xs, "period").withColumn("value", F.col("value") + 5 * F.col("x1") - 2 * F.col("x2"))
    return train, xs.withColumn("series", F.lit("a")), x


def test_exogenous_columns(spark, rows):
    train, future, x = exog_rows(spark, rows)
    m = fit_seasonal_ar(train, ["series"], Order(), ["x1", "x2"]).cache()
    assert m.first()["beta"][-2:] == pytest.approx([5, -2], abs=0.6)
    f = predict_seasonal_ar(m, ["series"], Order(), exog=["x1", "x2"], future=future).orderBy("step").collect()
    t = np.arange(N, N + 12)
    truth = 60 + 0.3 * t + 8 * np.sin(2 * np.pi * t / 12) + x[N:] @ [5, -2]
    assert len(f) == 12 and np.mean(np.abs(np.array([r["forecast"] for r in f]) - truth)) < 4
    with pytest.raises(ValueError, match="future values"):
        predict_seasonal_ar(m, ["series"], exog=["x1", "x2"])
    with pytest.raises(ValueError, match="lacks"):
        predict_seasonal_ar(m, ["series"], exog=["x1", "x2"], future=future.drop("x2"))
    few = future.filter(F.col("period") < "2026-06-01")
    lost = predict_seasonal_ar(m, ["series"], Order(), exog=["x1", "x2"], future=few).collect()
    assert [(r["step"], r["forecast"], r["error"]) for r in lost] == [(None, None, "the exogenous columns do not cover the horizon")]


def test_dispatch(rows):
    with pytest.raises(ValueError, match="unknown model"):
        fit_predict(rows, ["series"], "oracle")
    with pytest.raises(NotImplementedError):
        fit_predict(rows, ["series"], "sarimax")
    r = to_results(run_both(rows, ["series"], 3), "run-1")
    assert r.count() == 12 and r.filter("rmse IS NOT NULL OR run_id <> 'run-1'").count() == 0
    assert {x["model_name"] for x in r.collect()} == {"seasonal_arima", "trend_seasonal"}


def test_saved_model_forecasts_the_same(spark, rows):
    path = new_path(spark, "model")
    m = fit_seasonal_ar(rows, ["series"])
    save_model(m, path)
    key = lambda df: sorted((r["series"], r["step"], r["forecast"]) for r in df.collect())
    assert key(predict_seasonal_ar(load_model(spark, path), ["series"])) == key(predict_seasonal_ar(m, ["series"]))


def test_backtest_reports_errors_as_rows(monthly):
    out = {(r["series"], r["split"]): r for r in backtest(monthly({"a": list(SERIES), "s": list(range(40))}), "prophet").collect()}
    assert len(out) == 4 and out[("s", 0)]["error"] == "too short to split"
    assert all(out[("a", i)]["n_periods"] == 12 and out[("a", i)]["error"] is None for i in (1, 2, 3))
    assert str(out[("a", 3)]["train_end"]) == "2024-12-01"


def test_validation_windows_and_search(monthly, rows):
    v = validate(monthly({"a": list(SERIES)})).collect()
    assert {r["model_name"] for r in v} == {"seasonal_arima", "trend_seasonal"} and all(r["n_periods"] == 12 for r in v)
    windows = [("calm", "2018-01-01", "2023-12-01", "2024-01-01", "2024-12-01"), ("late", "2018-01-01", "2024-12-01", "2025-01-01", "2026-06-01")]
    w = window_experiment(rows, windows).collect()
    assert len(w) == 8 and {r["n_train"] for r in w if r["window"] == "calm"} == {72}
    train, test = rows.filter("period < '2025-01-01'"), rows.filter("period >= '2025-01-01'")
    assert order_search(train, test, ["series"], SEARCH_ORDERS[:2]).count() == 4
