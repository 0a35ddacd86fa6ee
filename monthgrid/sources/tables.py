"""Long observations ``(provider, series_id, period, value, ingested_at)`` from star-schema tables.

The star schema holds no energy data; each domain takes a fact table's category as series id,
its date as period and its amount as value. ``DRIVER_*`` name which category plays which role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrid.catalog import Domain

DRIVER_OIL = Domain(
    columns={"wti_price": "1-URGENT", "brent_price": "2-HIGH", "us_production": "3-MEDIUM"},
    price="wti_price", change="wti_mom_change", spread=("brent_price", "wti_price"))
DRIVER_GAS = Domain(
    columns={"henry_hub_price": "A", "us_storage_bcf": "N", "us_production": "R"},
    price="henry_hub_price", change="price_mom_change")

# provider -> {series_id: feature column}; 3 + 3 + 5 + 6 = 17
DRIVER_FEATURES = {
    "oil": {"1-URGENT": "wti_price", "2-HIGH": "brent_price", "3-MEDIUM": "oil_production"},
    "gas": {"A": "henry_hub_price", "N": "gas_storage", "R": "gas_production"},
    "segment": {"AUTOMOBILE": "crude_imports", "BUILDING": "refinery_util", "FURNITURE": "gasoline_stocks",
                "HOUSEHOLD": "distillate_stocks", "MACHINERY": "hdd"},
    "part_type": {"ECONOMY": "cdd", "LARGE": "opec_spare", "MEDIUM": "global_inv", "PROMO": "dollar_index",
                  "SMALL": "industrial_production", "STANDARD": "treasury_10y"},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table, with the columns its files have now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _observations(df: DataFrame, provider: str, series: str, date: str, amount: str) -> DataFrame:
    return df.select(
        F.lit(provider).alias("provider"),
        F.col(series).alias("series_id"),
        F.col(date).cast("date").alias("period"),
        F.col(amount).cast("double").alias("value"),
        F.col(date).cast("timestamp").alias("ingested_at"),
    )


def _dated(df: DataFrame, date: str, start: str | None, end: str | None) -> DataFrame:
    """Rows of an inclusive date range, compared on the stored column so that file statistics prune."""
    kind = df.schema[date].dataType
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start).cast(kind))
    if end is not None:
        after = F.date_add(F.lit(end).cast("date"), 1)
        df = df.filter(F.col(date) < after.cast(kind))
    return df


def oil_observations(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    orders = _dated(table(spark, sf_dir, "orders"), "o_orderdate", start, end)
    return _observations(orders, "oil", "o_orderpriority", "o_orderdate", "o_totalprice")


def gas_observations(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    items = _dated(table(spark, sf_dir, "lineitem"), "l_shipdate", start, end)
    return _observations(items, "gas", "l_returnflag", "l_shipdate", "l_extendedprice")


def _joined(facts: DataFrame, key: str, kinds: DataFrame, kind_key: str, date: str, amount: str, own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
    """Observations of a fact table under its own category and under that of a joined table, from one scan of it.

    No broadcast hint: the joined tables grow with the data. Spark broadcasts below its size threshold and otherwise sort-merges,
    where AQE splits a hot key's partition.
    """
    both = facts.join(kinds, facts[key] == kinds[kind_key], "left")
    pairs = F.array(F.struct(F.lit(own[0]).alias("provider"), F.col(own[1]).alias("series_id")),
                    F.struct(F.lit(other[0]).alias("provider"), F.col(other[1]).alias("series_id")))
    known = F.filter(pairs, lambda p: (p["provider"] == own[0]) | F.col(kind_key).isNotNull())
    return both.select(F.explode(known).alias("p"), date, amount).select(
        "p.provider", "p.series_id", F.col(date).cast("date").alias("period"), F.col(amount).cast("double").alias("value"),
        F.col(date).cast("timestamp").alias("ingested_at"))


def all_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four providers in one long frame; orders and line items are each read once."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_shipdate", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return _joined(orders, "o_custkey", customer, "c_custkey", "o_orderdate", "o_totalprice", ("oil", "o_orderpriority"), ("segment", "c_mktsegment")).unionByName(
        _joined(items, "l_partkey", part, "p_partkey", "l_shipdate", "l_extendedprice", ("gas", "l_returnflag"), ("part_type", "p_type")))


def feature_name() -> Column:
    """Feature column of a (provider, series_id) row; NULL for series the catalog does not know."""
    hits = " ".join(f"WHEN provider = '{p}' AND series_id = '{sid}' THEN '{name}'"
                    for p, series in DRIVER_FEATURES.items() for sid, name in series.items())
    return F.expr(f"CASE {hits} END")


def feature_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(series, period, value, ingested_at)`` of the 17 known series."""
    obs = all_observations(spark, sf_dir)
    return (obs.withColumn("series", feature_name())
            .filter(F.col("series").isNotNull()))
