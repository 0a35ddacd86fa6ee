"""Forecast jobs: many series, configurations and windows fitted in one Spark job each.

``forecast_seasonal_ar`` is a seasonal ARIMA estimated in two least-squares passes: a long
autoregression gives the residuals, then the differenced series is regressed on its own lags and
lagged residuals. There is no likelihood optimiser, so numbers differ from one.
The changepoint trend with yearly Fourier terms is in ``trend``.

Models are plain tables (one row per series and configuration), so saving one is writing it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monthgrid.functions.scalars import round_half_up
from monthgrid.functions.windows import lag
from monthgrid.operators.evaluate import backtest_frame, chronological_split, error_metrics
from monthgrid.operators.regress import dot, fit_ols
from monthgrid.plans.trend import forecast_trend_seasonal
from monthgrid.session import stage

HORIZON = 12


@dataclass(frozen=True)
class Order:
    """(p, d, q)(P, D, Q, s)."""

    p: int = 1
    d: int = 1
    q: int = 1
    P: int = 1
    D: int = 1
    Q: int = 1
    s: int = 12

    @property
    def name(self) -> str:
        return f"({self.p},{self.d},{self.q})({self.P},{self.D},{self.Q},{self.s})"

    def _lags(self, n: int, seasonal: int) -> list[int]:
        return sorted({i + self.s * j for i in range(n + 1) for j in range(seasonal + 1)} - {0})

    @property
    def ar(self) -> list[int]:
        return self._lags(self.p, self.P)

    @property
    def ma(self) -> list[int]:
        return self._lags(self.q, self.Q)

    @property
    def long_ar(self) -> list[int]:
        """Lags of the first pass."""
        return sorted({1, 2, 3, self.s, self.s + 1}) if self.P or self.Q else [1, 2, 3]

    @property
    def difference(self) -> list[float]:
        """Coefficients of (1 - B)^d (1 - B^s)^D, by lag."""
        poly = np.array([1.0])
        for _ in range(self.d):
            poly = np.convolve(poly, [1.0, -1.0])
        for _ in range(self.D):
            poly = np.convolve(poly, [1.0, *[0.0] * (self.s - 1), -1.0])
        return [float(c) for c in poly]

    @property
    def memory(self) -> int:
        """How many past months a forecast needs."""
        return max([*self.ar, *self.ma, len(self.difference)], default=1) + 1


# The orders tried by the order search.
SEARCH_ORDERS = [Order(), Order(q=0), Order(Q=0), Order(P=0), Order(p=2, q=0, Q=0), Order(q=0, P=0)]


def _differenced(c: str, order: Order, by: Sequence[str]) -> Column:
    terms = [lag(c, k, by) * F.lit(v) if k else F.col(c) * F.lit(v) for k, v in enumerate(order.difference) if v]
    return reduce(lambda a, b: a + b, terms)


def fit_seasonal_ar(rows: DataFrame, by: Sequence[str], order: Order = Order(), exog: Sequence[str] = ()) -> DataFrame:
    """One model row per group of ``(*by, period, value, *exog)``, on a gapless month grid.

    Groups too short to estimate, with missing months or collinear columns get a NULL ``beta`` and an ``error`` instead of
    failing the job.
    """
    by = list(by)
    dx = [f"_d_{c}" for c in exog]
    d = rows.select(*by, "period", "value", _differenced("value", order, by).alias("_w"),
                    *[_differenced(c, order, by).alias(n) for c, n in zip(exog, dx)])
    wl = sorted({*order.ar, *(order.long_ar if order.ma else [])})
    d = d.select("*", *[lag("_w", k, by).alias(f"_w{k}") for k in wl])
    if order.ma:
        first = fit_ols(d, by, "_w", [f"_w{k}" for k in order.long_ar])
        d = d.join(first.select(*by, F.col("beta").alias("_b1")), by, "left")
        d = d.withColumn("_e", F.col("_w") - dot("_b1", [f"_w{k}" for k in order.long_ar])).drop("_b1")
        d = d.select("*", *[lag("_e", k, by).alias(f"_e{k}") for k in order.ma])
    else:
        d = d.withColumn("_e", F.lit(0.0))
    xs = [*[f"_w{k}" for k in order.ar], *[f"_e{k}" for k in order.ma], *dx]
    fitted = fit_ols(d, by, "_w", xs)
    # the last months of each group are all a forecast needs: a bounded array
    back = F.row_number().over(W.partitionBy(*by).orderBy(F.col("period").desc()))
    recent = d.withColumn("_back", back)
    near = F.when(F.col("_back") <= order.memory, F.struct(
        "period", F.col("value").alias("y"), F.coalesce("_w", F.lit(0.0)).alias("w"), F.coalesce("_e", F.lit(0.0)).alias("e")))
    state = recent.groupBy(*by).agg(
        F.max("period").alias("last_period"), F.count(F.lit(1)).alias("n_train"), F.sort_array(F.collect_list(near)).alias("_h"),
        (F.months_between(F.max("period"), F.min("period")) + 1 - F.count_distinct("period")).alias("_gaps"))
    out = state.join(fitted, by, "left")
    return out.select(  # lags count rows, so a missing month would mix months up: no model then
        *by, F.lit(order.name).alias("config"), "last_period", "n_train", F.when(F.col("_gaps") == 0, F.col("beta")).alias("beta"), "sigma",
        F.transform("_h", lambda h: h["y"]).alias("ys"), F.transform("_h", lambda h: h["w"]).alias("ws"),
        F.transform("_h", lambda h: h["e"]).alias("es"),
        F.when(F.col("_gaps") > 0, F.lit("months are missing")).when(F.col("beta").isNull(), F.coalesce("error", F.lit("not enough months to fit"))).alias("error"))


def _recursion(order: Order, horizon: int, z: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Vectorised over all model rows of a batch: forecast step by step, then undo the differencing."""
    diff = np.array(order.difference)
    ar, ma = order.ar, order.ma

    def run(batches):
        for whole in batches:
            good = whole["why"].isna()
            if not good.all():
                yield pd.DataFrame({"id": whole["id"][~good], "forecast": None, "lower": None, "upper": None, "error": whole["why"][~good]})
            if not good.any():
                continue
            b = whole[good]
            beta = np.stack(b.beta.to_numpy())
            y, w, e = (np.stack(b[c].to_numpy()) for c in ("ys", "ws", "es"))
            push = np.stack(b["push"].to_numpy())
            phi, theta = beta[:, 1:1 + len(ar)], beta[:, 1 + len(ar):1 + len(ar) + len(ma)]
            steps = []
            for h in range(horizon):
                nw = beta[:, 0] + push[:, h]
                nw = nw + sum(phi[:, i] * w[:, -k] for i, k in enumerate(ar)) + sum(theta[:, i] * e[:, -k] for i, k in enumerate(ma))
                ny = nw - sum(diff[k] * y[:, -k] for k in range(1, len(diff)))
                w, e, y = np.c_[w, nw], np.c_[e, np.zeros(len(b))], np.c_[y, ny]
                steps.append(ny)
            # weights of past shocks in the undifferenced series give the error growth
            full = np.zeros((len(b), max([*ar, 0]) + 1))
            full[:, 0] = 1
            for i, k in enumerate(ar):
                full[:, k] = -phi[:, i]
            lags = np.zeros((len(b), full.shape[1] + len(diff) - 1))
            for k, v in enumerate(diff):
                lags[:, k:k + full.shape[1]] += v * full
            psi = np.zeros((len(b), horizon))
            for h in range(horizon):
                psi[:, h] = 1.0 if h == 0 else sum((theta[:, i] for i, k in enumerate(ma) if k == h), np.zeros(len(b)))
                for k in range(1, min(h, lags.shape[1] - 1) + 1):
                    psi[:, h] -= lags[:, k] * psi[:, h - k]
            sd = b.sigma.to_numpy()[:, None] * np.sqrt(np.cumsum(psi ** 2, axis=1))
            f = np.stack(steps, axis=1)
            yield pd.DataFrame({"id": b["id"], "forecast": list(f), "lower": list(f - z * sd), "upper": list(f + z * sd), "error": None})

    return run


def normal_quantile(alpha: float) -> float:
    """Two-sided normal quantile of a confidence level of ``1 - alpha``."""
    return NormalDist().inv_cdf(1 - alpha / 2)


def predict_seasonal_ar(model: DataFrame, by: Sequence[str], order: Order = Order(), horizon: int = HORIZON,
                        alpha: float = 0.05, exog: Sequence[str] = (), future: DataFrame | None = None) -> DataFrame:
    """``(*by, config, period, step, forecast, lower, upper, n_train, mode, error)`` from model rows.

    With ``exog``, ``future`` has ``(*by, period, *exog)`` for the train months and the horizon. A group without a model, with too
    short a memory, or whose future lacks a month of the horizon, has one row with an ``error`` instead of steps.
    """
    by = list(by)
    why = F.coalesce("error", F.when(F.col("beta").isNull(), "not fitted").when(F.size("ys") < order.memory, "too few months to go on from"))
    if exog:
        if future is None:
            raise ValueError("exogenous columns need their future values")
        gone = [c for c in exog if c not in future.columns]
        if gone:
            raise ValueError(f"future lacks the columns {gone}")
        at = 1 + len(order.ar) + len(order.ma)
        dx = future.select(*by, "period", *[_differenced(c, order, by).alias(c) for c in exog])
        j = dx.join(model.filter(F.col("beta").isNotNull()).select(*by, "last_period", "beta"), by)
        step = F.months_between("period", "last_period").cast("int")
        term = reduce(lambda a, b: a + b, [F.col("beta")[at + i] * F.col(c) for i, c in enumerate(exog)])
        inside = j.select(*by, step.alias("step"), term.alias("t")).filter(F.col("step").between(1, horizon) & F.col("t").isNotNull())
        push = inside.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("step", "t"))), lambda s: s["t"]).alias("push"))
        model = model.join(push, by, "left")
        why = F.coalesce(why, F.when(F.coalesce(F.size("push"), F.lit(0)) != horizon, "the exogenous columns do not cover the horizon"))
    else:
        model = model.withColumn("push", F.array_repeat(F.lit(0.0), horizon))
    key = F.struct(*by, "config", "last_period", "n_train")
    path = model.select(F.to_json(key).alias("id"), "beta", "sigma", "ys", "ws", "es", "push", why.alias("why")).mapInPandas(
        _recursion(order, horizon, normal_quantile(alpha)), "id string, forecast array<double>, lower array<double>, upper array<double>, error string")
    shape = model.select(key.alias("k")).schema["k"].dataType
    steps = path.select(F.from_json("id", shape).alias("k"), "error", F.posexplode_outer(F.arrays_zip("forecast", "lower", "upper")).alias("at", "v"))
    return steps.select("k.*", "error", (F.col("at") + 1).alias("step"), "v.*").select(
        *by, "config", F.add_months("last_period", F.col("step")).alias("period"), "step",
        *[round_half_up(c).alias(c) for c in ("forecast", "lower", "upper")], "n_train", F.lit("additive").alias("mode"), "error")


#: Largest modulus of a root at which a fitted order still counts as converged.
UNIT = 1 - 1e-6


def _largest_root(weights: np.ndarray, lags: Sequence[int]) -> float:
    """Largest modulus among the eigenvalues of the companion matrix of a lag polynomial."""
    if not len(lags):
        return 0.0
    m = np.zeros((max(lags), max(lags)))
    m[0, np.array(lags) - 1] = weights
    m[np.arange(1, len(m)), np.arange(len(m) - 1)] = 1.0
    return float(np.abs(np.linalg.eigvals(m)).max())


def converged_only(model: DataFrame, order: Order) -> DataFrame:
    """Model rows with ``ar_root`` and ``ma_root``; an order that is not stationary or not invertible becomes an error row without a model."""
    ar, ma = order.ar, order.ma

    @F.pandas_udf("struct<ar: double, ma: double>")
    def roots(beta: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if b is None else (_largest_root(b[1:1 + len(ar)], ar), _largest_root(-b[1 + len(ar):1 + len(ar) + len(ma)], ma)) for b in beta]
        return pd.DataFrame(rows, columns=["ar", "ma"])

    rooted = model.withColumn("_r", roots("beta")).withColumn("ar_root", F.col("_r.ar")).withColumn("ma_root", F.col("_r.ma")).drop("_r")
    why = F.coalesce("error", F.when(F.col("ar_root") >= UNIT, "not stationary").when(F.col("ma_root") >= UNIT, "not invertible"))
    return rooted.withColumn("error", why).withColumn("beta", F.when(F.col("error").isNull(), F.col("beta")))


def forecast_seasonal_ar(rows: DataFrame, by: Sequence[str], order: Order = Order(), horizon: int = HORIZON, converged: bool = False) -> DataFrame:
    model = fit_seasonal_ar(rows, by, order)
    return predict_seasonal_ar(converged_only(model, order) if converged else model, by, order, horizon)


def forecast_with_exog(rows: DataFrame, by: Sequence[str], table: DataFrame, exog: Sequence[str], order: Order = Order(), horizon: int = HORIZON,
                       converged: bool = False) -> DataFrame:
    """Forecasts with exogenous columns from ``table`` (period, *exog), which reaches beyond the rows of a group as far as the columns are known.

    Months of a group without all columns are left out, so they must lie at its beginning.
    """
    by, known = list(by), table.dropna(subset=list(exog))
    model = fit_seasonal_ar(rows.join(known, "period"), by, order, exog)
    # one array of months, bounded by the calendar, goes to every group
    months = known.agg(F.collect_list(F.struct("period", *exog)).alias("_m")).withColumn("_all", F.lit(1))
    future = (rows.select(*by).distinct().withColumn("_all", F.lit(1)).join(F.broadcast(months), "_all")
              .select(*by, F.explode("_m").alias("_m")).select(*by, "_m.*"))
    return predict_seasonal_ar(converged_only(model, order) if converged else model, by, order, horizon, exog=exog, future=future)


def _residual_filter(order: Order):
    """One-step values over whole series: shocks before the first usable month are 0, later ones follow from the data."""
    first, ar, ma = len(order.difference) - 1, order.ar, order.ma
    begin = first + max([*ar, 0])

    def run(batches):
        for b in batches:
            n = b["w"].map(len).to_numpy()
            w = np.full((len(b), max(n.max(), 1)), np.nan)
            for i, row in enumerate(b["w"]):
                w[i, :n[i]] = row
            beta = np.stack(b["beta"].to_numpy())
            phi, theta = beta[:, 1:1 + len(ar)], beta[:, 1 + len(ar):1 + len(ar) + len(ma)]
            e, step = np.zeros_like(w), np.full_like(w, np.nan)
            for t in range(begin, w.shape[1]):  # all series of the batch go one month on together
                at = beta[:, 0].copy()
                for i, k in enumerate(ar):
                    at += phi[:, i] * w[:, t - k]
                for i, k in enumerate(ma):
                    if t - k >= begin:
                        at += theta[:, i] * e[:, t - k]
                step[:, t], e[:, t] = at, w[:, t] - at
            yield pd.DataFrame({"id": b["id"], "step": [[None if np.isnan(v) else v for v in r[:k]] for r, k in zip(step, n)],
                                "shock": [list(r[:k]) for r, k in zip(e, n)]})

    return run


def filtered_seasonal_ar(rows: DataFrame, model: DataFrame, by: Sequence[str], order: Order) -> DataFrame:
    """``(*by, period, value, w, fitted, shock)``: the one-step values of a model on the months of its groups, moving-average terms included.

    A group's months are one array, bounded by the calendar; groups without a model keep their rows with NULL ``fitted``.
    """
    by = list(by)
    d = rows.select(*by, "period", "value", F.coalesce(_differenced("value", order, by), F.lit(float("nan"))).alias("w"))
    arrays = d.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("period", "value", "w"))).alias("h"))
    j = arrays.join(model.select(*by, "beta"), by, "left").withColumn("id", F.to_json(F.struct(*by)))
    got = j.filter(F.col("beta").isNotNull()).select("id", F.transform("h", lambda h: h["w"]).alias("w"), "beta").mapInPandas(
        _residual_filter(order), "id string, step array<double>, shock array<double>")
    none = F.transform("h", lambda h: F.lit(None).cast("double"))
    each = (j.join(got, "id", "left").withColumn("step", F.coalesce("step", none)).withColumn("shock", F.coalesce("shock", none))
            .select(*by, F.explode(F.arrays_zip("h", "step", "shock")).alias("m")))
    w = F.nanvl("m.h.w", F.lit(None).cast("double"))
    return each.select(*by, F.col("m.h.period").alias("period"), F.col("m.h.value").alias("value"), w.alias("w"),
                       (F.col("m.h.value") - w + F.col("m.step")).alias("fitted"), F.when(F.col("m.step").isNotNull(), F.col("m.shock")).alias("shock"))


def fitted_seasonal_ar(rows: DataFrame, model: DataFrame, by: Sequence[str], order: Order) -> DataFrame:
    """In-sample one-step values: ``(*by, period, value, fitted)``."""
    by = list(by)
    if order.ma:
        return filtered_seasonal_ar(rows, model, by, order).select(*by, "period", "value", round_half_up("fitted").alias("fitted"))
    d = rows.select(*by, "period", "value", _differenced("value", order, by).alias("_w"))
    d = d.select("*", *[lag("_w", k, by).alias(f"_w{k}") for k in order.ar])
    j = d.join(model.select(*by, "beta"), by, "left")
    fitted = F.col("value") - F.col("_w") + dot("beta", [f"_w{k}" for k in order.ar])
    return j.select(*by, "period", "value", round_half_up(fitted).alias("fitted"))


def model_from_weights(rows: DataFrame, by: Sequence[str], order: Order, beta: Sequence[float], sigma: float) -> DataFrame:
    """Model rows of given weights (constant, autoregressive, moving average): the state follows from the residual filter."""
    by, beta = list(by), [float(v) for v in beta]
    if len(beta) != 1 + len(order.ar) + len(order.ma):
        raise ValueError(f"{order.name} takes {1 + len(order.ar) + len(order.ma)} weights")
    given = rows.select(*by).distinct().withColumn("beta", F.array(*map(F.lit, beta)))
    d = filtered_seasonal_ar(rows, given, by, order).withColumn("_back", F.row_number().over(W.partitionBy(*by).orderBy(F.col("period").desc())))
    near = F.when(F.col("_back") <= order.memory, F.struct("period", F.col("value").alias("y"), F.coalesce("w", F.lit(0.0)).alias("w"), F.coalesce("shock", F.lit(0.0)).alias("e")))
    state = d.groupBy(*by).agg(F.max("period").alias("last_period"), F.count(F.lit(1)).alias("n_train"), F.sort_array(F.collect_list(near)).alias("_h"))
    return state.select(*by, F.lit(order.name).alias("config"), "last_period", "n_train", F.array(*map(F.lit, beta)).alias("beta"), F.lit(float(sigma)).alias("sigma"),
                        *[F.col(f"_h.{c}").alias(f"{c}s") for c in "ywe"], F.lit(None).cast("string").alias("error"))


# ---- dispatch ----

MODELS: dict[str, Callable[[DataFrame, Sequence[str], int], DataFrame]] = {
    "seasonal_arima": lambda rows, by, h: forecast_seasonal_ar(rows, by, Order(), h),
    "trend_seasonal": lambda rows, by, h: forecast_trend_seasonal(rows, by, h),
}
#: Names of the solvers these models stand in for; results carry the names above.
ALIASES = {"sarima": "seasonal_arima", "prophet": "trend_seasonal"}


def fit_predict(rows: DataFrame, by: Sequence[str], model: str = "trend_seasonal", horizon: int = HORIZON) -> DataFrame:
    """Forecast with a named model."""
    if model == "sarimax":
        raise NotImplementedError("sarimax needs exogenous columns: use forecast_with_exog")
    name = ALIASES.get(model, model)
    if name not in MODELS:
        raise ValueError(f"unknown model {model!r}, use one of {sorted([*MODELS, *ALIASES])}")
    return MODELS[name](rows, by, horizon).withColumn("model_name", F.lit(name))


def run_both(rows: DataFrame, by: Sequence[str], horizon: int = HORIZON, models: Mapping[str, Callable] | None = None) -> DataFrame:
    """Every model on every group, long. ``models`` maps names to functions ``(rows, by, horizon) -> forecasts``."""
    return reduce(DataFrame.unionByName, [fit(rows, by, horizon).withColumn("model_name", F.lit(name)) for name, fit in (models or MODELS).items()])


def to_results(forecasts: DataFrame, run_id: str, target: str = "series") -> DataFrame:
    """Forecast rows in the columns of the results table; metrics are unknown for the future."""
    none = F.lit(None).cast("double")
    return forecasts.filter(F.col("forecast").isNotNull()).select(
        F.lit(run_id).alias("run_id"), F.col(target).alias("target"), "model_name", F.col("period").alias("forecast_period"),
        F.col("forecast").alias("forecast_value"), F.col("lower").alias("lower_bound"), F.col("upper").alias("upper_bound"),
        none.alias("rmse"), none.alias("mape"), none.alias("mae"), F.col("n_train").alias("trained_on_periods"))


# ---- evaluation jobs ----

def score(forecasts: DataFrame, actuals: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Metrics of forecasts against ``(*keys, value)``, grouped by ``by``."""
    j = forecasts.join(actuals.select(*keys, F.col("value").alias("actual")), list(keys))
    return error_metrics(j, by, "actual", "forecast")


def _with_failures(metrics: DataFrame, train: DataFrame, by: Sequence[str], choice: str, choices: Sequence[str], forecasts: DataFrame | None = None) -> DataFrame:
    """A row for every group and choice: ``metrics`` where there are any, otherwise NULL metrics and an ``error``, that of ``forecasts`` if it has one."""
    asked = train.select(*by).distinct().withColumn(choice, F.explode(F.array(*[F.lit(c) for c in choices])))
    out, why = asked.join(metrics, [*by, choice], "left"), F.lit(None).cast("string")
    if forecasts is not None:
        out, why = out.join(forecasts.filter("error IS NOT NULL").groupBy(*by, choice).agg(F.min("error").alias("_why")), [*by, choice], "left"), F.col("_why")
    error = F.when(F.col("rmse").isNull(), F.coalesce(why, F.lit("not fitted, or nothing to compare with")))
    return out.withColumn("error", error).drop("_why")


def backtest(rows: DataFrame, model: str | Callable = "prophet", n_splits: int = 3, horizon: int = HORIZON, by: str = "series") -> DataFrame:
    """Walk-forward metrics per (series, split); all splits of all series are fitted together.

    ``model`` is a name or a function ``(rows, by, horizon) -> forecasts``.

    A split that cannot be fitted, or a series too short to be split, is reported in ``error``.
    """
    frame = backtest_frame(rows, by, n_splits, horizon)
    train = frame.filter("role = 'train'").drop("role")
    fc = model(train, [by, "split"], horizon) if callable(model) else fit_predict(train, [by, "split"], model, horizon)
    m = score(fc, frame.filter("role = 'test'"), [by, "split", "period"], [by, "split"])
    ends = frame.groupBy(by, "split").agg(
        F.max(F.when(F.col("role") == "train", F.col("period"))).alias("train_end"),
        F.min(F.when(F.col("role") == "test", F.col("period"))).alias("test_start"),
        F.max(F.when(F.col("role") == "test", F.col("period"))).alias("test_end"))
    error = F.when(F.col("split") == 0, F.lit("too short to split")).when(F.col("rmse").isNull(), F.lit("not fitted"))
    return ends.join(m, [by, "split"], "left").withColumn("error", error)


def validate(rows: DataFrame, by: str = "series", test_size: float = 0.2, horizon: int = HORIZON, models: Mapping[str, Callable] | None = None) -> DataFrame:
    """Chronological split, both models on the train part, forecasts scored on the test part."""
    parts = chronological_split(rows, by, test_size)
    train = parts.filter("split = 'train'").drop("split")
    m = score(run_both(train, [by], horizon, models), parts.filter("split = 'test'"), [by, "period"], [by, "model_name"])
    return _with_failures(m, train, [by], "model_name", list(models or MODELS))


def order_search(train: DataFrame, test: DataFrame, by: Sequence[str], orders: Sequence[Order] = tuple(SEARCH_ORDERS),
                 horizon: int = HORIZON, table: DataFrame | None = None, exog: Sequence[str] = ()) -> DataFrame:
    """Metrics of every order on every group; an order that does not converge has an ``error`` and no metrics.

    With ``exog``, every order is searched with these columns of ``table`` (period, *exog). Choose by the metrics on a validation
    stretch, not on the test months.
    """
    def one(o: Order) -> DataFrame:
        if exog:
            return forecast_with_exog(train, by, table, exog, o, horizon, converged=True)
        return forecast_seasonal_ar(train, by, o, horizon, converged=True)

    fc = stage(reduce(DataFrame.unionByName, [one(o) for o in orders]), "search")  # scored, and read for its errors
    return _with_failures(score(fc, test, [*by, "period"], [*by, "config"]), train, list(by), "config", [o.name for o in orders], fc)


def window_rows(rows: DataFrame, windows: Sequence[tuple[str, str, str, str, str]], by: str = "series") -> DataFrame:
    """Rows of each experiment window with role ``train`` or ``test``; months without a value drop out.

    ``windows`` lists (label, train start, train end, test start, test end). The short list is
    exploded per row rather than joined.
    """
    def part(w):
        label, a, b, c, d = w
        p = F.col("period")
        role = (F.when(p.between(F.to_date(F.lit(a)), F.to_date(F.lit(b))), "train")
                .when(p.between(F.to_date(F.lit(c)), F.to_date(F.lit(d))), "test"))
        return F.struct(F.lit(label).alias("window"), role.alias("role"))

    parts = F.filter(F.array(*[part(w) for w in windows]), lambda p: p["role"].isNotNull())
    return rows.filter(F.col("value").isNotNull()).withColumn("_w", F.explode(parts)).select(by, "period", "value", "_w.window", "_w.role")


def window_experiment(rows: DataFrame, windows, by: str = "series", horizon: int = HORIZON, models: Mapping[str, Callable] | None = None,
                      ready: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Every model on each window of each series, with metrics and training length.

    ``ready`` holds forecasts made elsewhere, by model name: ``(by, window, period, forecast)``.
    """
    marked = window_rows(rows, windows, by)
    train, models, ready = marked.filter("role = 'train'"), models or MODELS, ready or {}
    columns = [by, "window", "period", "forecast", "error"]
    fc = [run_both(train.drop("role"), [by, "window"], horizon, models).select(*columns, "model_name")]
    fc += [f.withColumn("error", F.lit(None).cast("string")).select(*columns).withColumn("model_name", F.lit(name)) for name, f in ready.items()]
    fc = stage(reduce(DataFrame.unionByName, fc), "window-forecasts")
    m = score(fc, marked.filter("role = 'test'"), [by, "window", "period"], [by, "window", "model_name"])
    n = train.groupBy(by, "window").agg(F.count(F.lit(1)).alias("n_train"))
    return _with_failures(m, train, [by, "window"], "model_name", [*models, *ready], fc).join(n, [by, "window"])


def save_model(model: DataFrame, path: str) -> None:
    """Models are rows; a model is found again by its path (name, target and date are the caller's)."""
    model.write.mode("errorifexists").parquet(path)


def load_model(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
