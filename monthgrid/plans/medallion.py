"""Bronze to silver to gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.catalog import Domain
from monthgrid.functions.scalars import round_half_up, safe_divide
from monthgrid.functions.windows import change_over, mom_pct, three_sigma, trailing
from monthgrid.operators.cells import clean, grid, latest_cells, mean_cells, pivot_cells, pivot_measures, unpivot

GOLD_COLUMNS = ["period", "wti_price", "brent_price", "price_spread", "us_oil_production", "wti_mom_change",
                "wti_3m_avg", "wti_yoy_change", "henry_hub_price", "us_gas_storage_bcf", "us_gas_production",
                "gas_mom_change", "henry_hub_3m_avg", "oil_gas_ratio", "has_outlier"]


def with_series_windows(wide: DataFrame, columns: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """A monthly table with window measures of some of its columns added, as ``<column>_<measure>``.

    The columns go to long form, so each series is its own window partition, and come back as
    columns. A window over the wide table would put every row into one task.
    """
    rest = [c for c in wide.columns if c not in columns and c != "period"]
    long = unpivot(wide, columns, ["period", *rest])
    measured = long.select("period", *rest, "series", "value", *[c.alias(m) for m, c in measures.items()])
    back = pivot_measures(measured, columns, ["value", *measures], carry=rest)
    return back.withColumnsRenamed({f"{c}_value": c for c in columns})


def silver(obs: DataFrame, domain: Domain, dedupe: str = "latest") -> DataFrame:
    """Clean monthly table of one domain: one column per series, change, spread and outlier flag.

    ``dedupe="mean"`` averages repeated observations instead of keeping the latest.
    """
    return silver_from_cells((latest_cells if dedupe == "latest" else mean_cells)(clean(obs, domain.min_value), ["series_id"]), domain)


def silver_from_cells(cells: DataFrame, domain: Domain) -> DataFrame:
    """The silver table from month cells ``(series_id, period, value)``; series without a column still make their months rows of it."""
    names = list(domain.columns)
    long = grid(cells, list(domain.columns.values()), "series_id")
    price = F.col("series_id") == F.lit(domain.columns[domain.price])
    measured = long.select(
        "period", "series_id", "value",
        F.when(price, round_half_up(mom_pct("value", "series_id"))).alias("mom"),
        F.when(price, three_sigma("value", "series_id")).alias("flag"))
    ids = list(domain.columns.values())
    wide = pivot_measures(measured, ids, ["value", "mom", "flag"], "series_id")
    pid = domain.columns[domain.price]
    out = [F.col(f"`{domain.columns[n]}_value`").alias(n) for n in names]
    if domain.spread:
        a, b = (F.col(f"`{domain.columns[c]}_value`") for c in domain.spread)
        out.append(round_half_up(a - b).alias("price_spread"))
    out += [F.col(f"`{pid}_mom`").alias(domain.change), F.coalesce(F.col(f"`{pid}_flag`"), F.lit(False)).alias("is_outlier")]
    return wide.select("period", *out)


def gold(oil: DataFrame, gas: DataFrame) -> DataFrame:
    """Both domains month by month (full outer), with ratio, rolling means and yearly change."""
    p = oil.select("period", "wti_price", "brent_price", F.col("us_production").alias("us_oil_production"),
                   "price_spread", "wti_mom_change", F.col("is_outlier").alias("_oil_outlier"))
    g = gas.select("period", "henry_hub_price", F.col("us_storage_bcf").alias("us_gas_storage_bcf"),
                   F.col("us_production").alias("us_gas_production"),
                   F.col("price_mom_change").alias("gas_mom_change"), F.col("is_outlier").alias("_gas_outlier"))
    joined = p.join(g, "period", "full").filter(F.col("period").isNotNull())
    wide = with_series_windows(joined, ["wti_price", "henry_hub_price"], {
        "avg3": round_half_up(trailing(F.avg, "value", 3, "series")),
        "yoy": round_half_up(change_over("value", 12, "series"))})
    out = wide.select(
        "*", round_half_up(safe_divide("wti_price", "henry_hub_price")).alias("oil_gas_ratio"),
        F.col("wti_price_avg3").alias("wti_3m_avg"), F.col("henry_hub_price_avg3").alias("henry_hub_3m_avg"),
        F.col("wti_price_yoy").alias("wti_yoy_change"),
        (F.coalesce("_oil_outlier", F.lit(False)) | F.coalesce("_gas_outlier", F.lit(False))).alias("has_outlier"))
    return out.select(*GOLD_COLUMNS)


def gold_from_means(oil_obs: DataFrame, gas_obs: DataFrame, oil: Domain, gas: Domain) -> DataFrame:
    """The averaging variant: mean of repeated values, outer merge, change on the merged months."""
    o = pivot_cells(mean_cells(oil_obs, ["series_id"]), oil.columns, "series_id").withColumnRenamed("us_production", "us_oil_production")
    g = pivot_cells(mean_cells(gas_obs, ["series_id"]), gas.columns, "series_id").withColumnRenamed(
        "us_production", "us_gas_production").withColumnRenamed("us_storage_bcf", "us_gas_storage_bcf")
    joined = o.join(g, "period", "full")
    wide = with_series_windows(joined, ["wti_price", "henry_hub_price"], {"mom": round_half_up(mom_pct("value", "series"))})
    return wide.select(
        "period", "wti_price", "brent_price", "us_oil_production",
        round_half_up(F.col("brent_price") - F.col("wti_price")).alias("price_spread"),
        F.col("wti_price_mom").alias("wti_mom_change"), "henry_hub_price", "us_gas_storage_bcf", "us_gas_production",
        F.col("henry_hub_price_mom").alias("gas_mom_change"),
        round_half_up(safe_divide("wti_price", "henry_hub_price")).alias("oil_gas_ratio"))
