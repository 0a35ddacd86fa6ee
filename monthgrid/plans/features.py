"""Wide feature table, the 192 engineered features, scaling and leak-free feature rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.catalog import FEATURE_COLUMNS
from monthgrid.functions.scalars import month_cos, month_sin, pct_change, rounding
from monthgrid.functions.windows import forward_fill, lag, lag_present, trailing_past
from monthgrid.operators.cells import mean_cells, pivot_cells, pivot_measures, unpivot
from monthgrid.session import stage

# Lags and rolling windows, in months.
LAGS = (1, 3, 6, 12)
ROLLS = (3, 6, 12)
MEASURES = [*[f"lag_{k}" for k in LAGS],
            *[f"roll{w}_{s}" for w in ROLLS for s in ("mean", "std")], "mom_pct"]
SPINE = ("wti_price", "brent_price", "oil_production")


def feature_cells(obs: DataFrame) -> DataFrame:
    """Mean value per (series, month)."""
    return mean_cells(obs, ["series"])


def feature_wide(cells: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, spine: Sequence[str] = SPINE) -> DataFrame:
    """One row per month of the spine series, one column per series, gaps NULL.

    Equals the spine left-joined to each series in turn, but is a single grouped pivot: a month
    belongs to the spine when any spine series has a value in it.
    """
    wide = pivot_cells(cells, list(columns), "series")
    return wide.filter(F.coalesce(*[F.col(c) for c in spine]).isNotNull())


def feature_wide_by_joins(cells: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, spine: Sequence[str] = SPINE) -> DataFrame:
    """The same table as a chain of left joins; kept to check ``feature_wide`` against.

    The cells are made once and staged: each of the joins would make them again from all observations.
    """
    cells = stage(cells, "feature-cells")
    out = cells.filter(F.col("series").isin(list(spine))).select("period").distinct()
    for c in columns:
        one = cells.filter(F.col("series") == c).select("period", F.col("value").alias(c))
        out = out.join(one, "period", "left")
    return out


def engineered_long(wide: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """``(period, series, value, <11 measures>, vs_12mo_avg)``, one row per series and month.

    Edge gaps are filled forward first. All measures share one partitioning and one sort.
    """
    filled = unpivot(wide.select("period", *columns), columns).withColumn("value", forward_fill("value", "series"))
    m: dict[str, Column] = {f"lag_{k}": lag("value", k, "series") for k in LAGS}
    for w in ROLLS:
        m[f"roll{w}_mean"] = trailing_past(F.avg, "value", w, "series")
        m[f"roll{w}_std"] = trailing_past(F.stddev_samp, "value", w, "series")
    m["mom_pct"] = pct_change("value", lag("value", 1, "series"))
    m["vs_12mo_avg"] = F.col("value") - trailing_past(F.avg, "value", 12, "series", min_periods=6)
    return filled.select("period", "series", "value", *[e.alias(n) for n, e in m.items()])


def with_seasonality(df: DataFrame) -> DataFrame:
    return (df.withColumn("month", F.month("period")).withColumn("quarter", F.quarter("period"))
            .withColumn("month_sin", month_sin("period")).withColumn("month_cos", month_cos("period")))


def engineered_wide(long: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, storage: str = "gas_storage") -> DataFrame:
    """All features as columns: base, 11 per series, seasonality and storage against its yearly mean."""
    wide = pivot_measures(long, columns, ["value", *MEASURES, "vs_12mo_avg"])
    picked = [f"`{c}_value` AS `{c}`" for c in columns] + [f"`{c}_{m}`" for c in columns for m in MEASURES]
    return with_seasonality(wide).selectExpr("period", *picked, "month", "quarter", "month_sin", "month_cos",
                                             f"`{storage}_vs_12mo_avg` AS storage_vs_12mo_avg")


def scaler(long: DataFrame, measures: Sequence[str], fit: Column | None = None, by: str = "series") -> DataFrame:
    """Mean and sample deviation of each measure of each series over the fit rows; deviation 0 becomes 1."""
    rows = long if fit is None else long.filter(fit)
    return rows.groupBy(by).agg(*[e for m in measures for e in (
        F.avg(m).alias(f"{m}_mean"),
        F.when(F.stddev_samp(m) == 0, 1.0).otherwise(F.stddev_samp(m)).alias(f"{m}_std"))])


def scaled(long: DataFrame, measures: Sequence[str], fit: str | None = None, by: str = "series") -> DataFrame:
    """Z-scores per series, fitted on the rows the condition ``fit`` selects (all, by default).

    The parameters are window aggregates over the series partition the features already have,
    so scaling adds no shuffle and no broadcast, however many series there are.
    """
    over = f"OVER (PARTITION BY `{by}`)"
    rows = "true" if fit is None else fit

    def z(m: str) -> Column:
        x = f"CASE WHEN {rows} THEN `{m}` END"
        dev = f"stddev_samp({x}) {over}"
        return F.expr(f"(`{m}` - avg({x}) {over}) / CASE WHEN {dev} = 0 THEN 1D ELSE {dev} END")

    return long.select(*[z(c).alias(c) if c in measures else F.col(c) for c in long.columns])


def unscaled(df: DataFrame, params: DataFrame, column: str, measure: str = "value", by: str = "series") -> DataFrame:
    """Undo the z-score with stored parameters."""
    p = params.select(by, F.col(f"{measure}_mean").alias("_mean"), F.col(f"{measure}_std").alias("_std"))
    return df.join(p, by).withColumn(column, F.col(column) * F.col("_std") + F.col("_mean")).drop("_mean", "_std")


def strict_measures(long: DataFrame) -> DataFrame:
    """Features of a month from earlier months only: ``(period, series, value, …)``.

    Lags, means and momentum count back over values present; a mean needs its full window.
    ``prev`` is the previous month whether present or not.
    """
    back = {k: lag_present("value", k, "series") for k in range(1, 13)}
    stepped = long.select("period", "series", "value", lag("value", 1, "series").alias("prev"),
                          *[e.alias(f"_b{k}") for k, e in back.items()])

    def mean(w: int) -> Column:
        total = F.col("_b1")
        for k in range(2, w + 1):
            total = total + F.col(f"_b{k}")
        return total / F.lit(float(w))

    return stepped.select(
        "period", "series", "value", "prev",
        *[F.col(f"_b{k}").alias(f"lag_{k}") for k in LAGS],
        *[mean(w).alias(f"roll{w}_mean") for w in ROLLS],
        pct_change("_b1", F.col("_b2")).alias("mom_pct"),
        (F.col("_b1") - mean(12)).alias("vs_12mo_avg"),
        trailing_past(F.stddev_samp, "value", 3, "series").alias("roll3_std"))


def strict_wide(strict: DataFrame, target: str, picks: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Feature rows of one target: ``picks`` maps output column to (series, measure)."""
    out = strict.groupBy("period").agg(
        F.max(F.when(F.col("series") == target, F.col("value"))).alias(target),
        *[F.max(F.when(F.col("series") == s, F.col(m))).alias(name) for name, (s, m) in picks.items()])
    return out.withColumn("month_sin", month_sin("period")).withColumn("month_cos", month_cos("period"))


# The curated gas-price features, each with its (series, measure).
HENRY_HUB_FEATURES = {
    "henry_hub_price_lag_1": ("henry_hub_price", "lag_1"),
    "henry_hub_price_lag_3": ("henry_hub_price", "lag_3"),
    "henry_hub_price_roll3_mean": ("henry_hub_price", "roll3_mean"),
    "henry_hub_price_roll6_mean": ("henry_hub_price", "roll6_mean"),
    "henry_hub_price_mom_pct": ("henry_hub_price", "mom_pct"),
    "hdd_lag_1": ("hdd", "prev"),
    "hdd_roll3_mean": ("hdd", "roll3_mean"),
    "cdd_lag_1": ("cdd", "prev"),
    "gas_storage_lag_1": ("gas_storage", "prev"),
    "storage_vs_12mo_avg": ("gas_storage", "vs_12mo_avg"),
    "gas_production_lag_1": ("gas_production", "prev"),
    "wti_price_lag_1": ("wti_price", "prev"),
    "industrial_production_lag_1": ("industrial_production", "prev"),
}

# The curated oil-price features.
WTI_FEATURES = {
    "wti_price_lag_1": ("wti_price", "lag_1"),
    "wti_price_lag_3": ("wti_price", "lag_3"),
    "wti_price_roll3_mean": ("wti_price", "roll3_mean"),
    "wti_price_roll6_mean": ("wti_price", "roll6_mean"),
    "wti_price_mom_pct": ("wti_price", "mom_pct"),
    "brent_price_lag_1": ("brent_price", "prev"),
    "henry_hub_price_lag_1": ("henry_hub_price", "prev"),
    "crude_imports_lag_1": ("crude_imports", "prev"),
    "refinery_util_lag_1": ("refinery_util", "prev"),
    "opec_spare_lag_1": ("opec_spare", "prev"),
    "global_inv_lag_1": ("global_inv", "prev"),
    "gasoline_stocks_lag_1": ("gasoline_stocks", "prev"),
    "distillate_stocks_lag_1": ("distillate_stocks", "prev"),
    "industrial_production_lag_1": ("industrial_production", "prev"),
    "dollar_index_lag_1": ("dollar_index", "prev"),
    "treasury_10y_lag_1": ("treasury_10y", "prev"),
    "opec_spare_roll3_std": ("opec_spare", "roll3_std"),
}


def rounded(df: DataFrame, keep: Sequence[str], digits: int = 4) -> DataFrame:
    """Round every column but ``keep``."""
    return df.selectExpr(*[f"`{c}`" if c in keep else f"{rounding(c, digits)} AS `{c}`" for c in df.columns])
