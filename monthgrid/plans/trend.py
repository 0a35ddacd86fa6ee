"""A trend with changepoints and yearly Fourier terms, fitted per group by ridge regression.

A group's months are one short array, bounded by the calendar, so fitting needs one aggregate and no window. The design (constant,
time, hinges, sine and cosine pairs) depends on the months alone; the solver adds the priors to the diagonal of its normal equations.
Forecasts are column expressions over the same terms.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrid.functions.scalars import round_half_up
from monthgrid.functions.windows import ordered


@dataclass(frozen=True)
class Trend:
    """What a trend model is made of.

    ``changepoints`` lie evenly in the first ``share`` of the history; ``fourier`` counts yearly sine and cosine pairs, up to 5 on
    monthly data. Small priors pull slope changes and seasonal weights to zero; an infinite one leaves them free. ``mode`` is
    ``multiplicative`` (the logarithm is fitted), ``additive``, or ``auto``: multiplicative where all values are positive.
    """

    changepoints: int = 25
    fourier: int = 5
    share: float = 0.8
    changepoint_prior: float = 0.05
    seasonality_prior: float = 10.0
    mode: str = "auto"

    def __post_init__(self):
        if not 0 <= self.fourier <= 5:
            raise ValueError("monthly data tell at most 5 yearly pairs apart")
        if self.mode not in ("auto", "additive", "multiplicative"):
            raise ValueError(f"unknown mode {self.mode!r}")

    @property
    def name(self) -> str:
        return f"trend({self.changepoints}) fourier({self.fourier})"

    @property
    def hinges(self) -> list[float]:
        return [self.share * (j + 1) / (self.changepoints + 1) for j in range(self.changepoints)]

    @property
    def penalty(self) -> list[float]:
        """Added to the diagonal; constant and slope are free."""
        return [0.0, 0.0, *[1 / self.changepoint_prior] * self.changepoints, *[1 / self.seasonality_prior] * (2 * self.fourier)]

    def design(self, t: np.ndarray, month: np.ndarray) -> np.ndarray:
        """A row of terms per month; ``t`` runs from 0 to 1 over the history, ``month`` is 1 to 12."""
        angle = 2 * math.pi * (month - 1) / 12
        waves = [f(k * angle) for k in range(1, self.fourier + 1) for f in (np.sin, np.cos)]
        return np.stack([np.ones_like(t), t, *[np.maximum(t - c, 0) for c in self.hinges], *waves], axis=1)

    def terms(self, t: Column, month: Column) -> Column:
        """The same as an array column."""
        angle = F.lit(2 * math.pi) * (month - 1) / 12
        waves = [f(angle * k) for k in range(1, self.fourier + 1) for f in (F.sin, F.cos)]
        return F.array(F.lit(1.0), t, *[F.greatest(t - F.lit(c), F.lit(0.0)) for c in self.hinges], *waves)


_FITTED = T.StructType([T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType()),
                        T.StructField("mode", T.StringType()), T.StructField("error", T.StringType())])


def _solver(kind: Trend):
    prior = np.diag(kind.penalty)

    def one(values, offset, month):
        z, offset = np.asarray(values, float), np.asarray(offset, float)
        positive = z.min() > 0
        mode = kind.mode if kind.mode != "auto" else "multiplicative" if positive else "additive"
        if len(z) <= 2 * kind.fourier + 2:
            return None, None, mode, "not enough months to fit"
        if mode == "multiplicative":
            if not positive:
                return None, None, mode, "a multiplicative trend needs positive values"
            z = np.log(z)
        x = kind.design(offset / max(offset[-1], 1.0), np.asarray(month))
        normal = x.T @ x
        try:
            inverse = np.linalg.inv(normal + prior)
        except np.linalg.LinAlgError:
            return None, None, mode, "collinear terms"
        beta = inverse @ (x.T @ z)
        used = np.trace(inverse @ normal)  # degrees of freedom that the priors leave
        return beta.tolist(), float(np.sqrt(np.sum((z - x @ beta) ** 2) / max(len(z) - used, 1.0))), mode, None

    @F.pandas_udf(_FITTED)
    def solve(values: pd.Series, offset: pd.Series, month: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(*x) for x in zip(values, offset, month)], columns=["beta", "sigma", "mode", "error"])

    return solve


def fit_trend_seasonal(rows: DataFrame, by: Sequence[str], kind: Trend = Trend()) -> DataFrame:
    """One model row per group of ``(*by, period, value)``; NULL values are left out. Groups that cannot be fitted have an ``error``."""
    by = list(by)
    months = rows.filter(F.col("value").isNotNull()).groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("period", "value"))).alias("h"), F.max("period").alias("last_period"), F.min("period").alias("first_period"))
    offset = F.transform("h", lambda h: F.months_between(h["period"], F.col("first_period")).cast("int"))
    fit = _solver(kind)(F.transform("h", lambda h: h["value"].cast("double")), offset, F.transform("h", lambda h: F.month(h["period"])))
    model = months.withColumn("f", fit)
    return model.select(*by, F.lit(kind.name).alias("config"), "first_period", "last_period", F.size("h").alias("n_train"), "f.mode",
                        (F.col("f.mode") == "multiplicative").alias("is_log"), "f.beta", "f.sigma", "f.error")


def predict_trend_seasonal(model: DataFrame, by: Sequence[str], horizon: int = 12, alpha: float = 0.05, kind: Trend = Trend()) -> DataFrame:
    """``(*by, config, period, step, forecast, lower, upper, n_train, mode, error)``; a group without a model has one row, its error."""
    by = list(by)
    ahead = F.when(F.col("beta").isNotNull(), F.sequence(F.lit(1), F.lit(horizon)))
    steps = model.select("*", F.explode_outer(ahead).alias("step")).withColumn("period", F.add_months("last_period", F.col("step")))
    span = F.greatest(F.months_between("last_period", "first_period"), F.lit(1.0))
    terms = kind.terms(F.months_between("period", "first_period") / span, F.month("period"))
    z = F.aggregate(F.zip_with("beta", terms, lambda b, x: b * x), F.lit(0.0), lambda total, x: total + x)
    # the trend's own uncertainty grows with the distance from the data
    quantile = NormalDist().inv_cdf(1 - alpha / 2)
    d = steps.withColumn("z", z).withColumn("width", F.lit(quantile) * F.col("sigma") * F.sqrt(1 + F.col("step") / F.col("n_train")))

    def back(c: Column) -> Column:
        return round_half_up(F.when(F.col("is_log"), F.exp(c)).otherwise(c))

    low, high = F.col("z") - F.col("width"), F.col("z") + F.col("width")
    return d.select(*by, "config", "period", "step", back(F.col("z")).alias("forecast"), back(low).alias("lower"), back(high).alias("upper"),
                    "n_train", "mode", "error")


def trend_component(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Straight-line trend of the logarithm: monthly growth and level, by mergeable sums."""
    by = list(by)
    d = rows.filter(F.col("value") > 0).withColumn("_i", F.row_number().over(ordered(by)) - 1)
    return d.groupBy(*by).agg(round_half_up(F.regr_slope(F.ln("value"), "_i")).alias("growth"),
                              round_half_up(F.regr_intercept(F.ln("value"), F.col("_i"))).alias("level"))


def forecast_trend_seasonal(rows: DataFrame, by: Sequence[str], horizon: int = 12, kind: Trend = Trend()) -> DataFrame:
    return predict_trend_seasonal(fit_trend_seasonal(rows, by, kind), by, horizon, kind=kind)
