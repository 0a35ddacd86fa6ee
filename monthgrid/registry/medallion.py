"""Bronze, silver and gold queries."""

from pyspark.sql import functions as F

from monthgrid.functions.scalars import round_half_up
from monthgrid.functions.windows import change_over, lag, mom_pct, three_sigma, trailing
from monthgrid.operators.cells import clean, grid, keep_latest, latest_cells, mean_cells, pivot_cells
from monthgrid.plans.medallion import gold, gold_from_means, silver
from monthgrid.registry.core import (GAS, OIL, all_obs_sql, latest_cells_sql, mean_cells_sql, month, query, r4)
from monthgrid.sources.tables import (DRIVER_GAS, DRIVER_OIL, all_observations, gas_observations, oil_observations,
                                      table)


def silver_sql(src, cells, out, cols, price, change, spread=None, cells_fn=latest_cells_sql):
    """CTEs of a domain's silver table."""
    pivots = ", ".join(f"max(CASE WHEN series_id = '{sid}' THEN value END) AS {c}" for c, sid in cols.items())
    sp = f", {r4(f'{spread[0]} - {spread[1]}')} AS price_spread" if spread else ""
    mom = f"({price} - lag({price}) OVER (ORDER BY period)) / nullif(lag({price}) OVER (ORDER BY period), 0) * 100"
    return f"""{cells_fn(src, cells)},
{out}_p AS (SELECT period, {pivots} FROM {cells} GROUP BY 1),
{out} AS (SELECT period, {', '.join(cols)}{sp}, {r4(mom)} AS {change},
  coalesce(abs({price} - avg({price}) OVER ()) > 3 * stddev_samp({price}) OVER (), false) AS is_outlier FROM {out}_p)"""


SILVER_OIL = f"{OIL}, " + silver_sql("oil", "oil_c", "so", DRIVER_OIL.columns, "wti_price", "wti_mom_change", DRIVER_OIL.spread)
SILVER_GAS = f"{GAS}, " + silver_sql("gas", "gas_c", "sg", DRIVER_GAS.columns, "henry_hub_price", "price_mom_change")
GOLD = f"""{SILVER_OIL}, {SILVER_GAS},
gj AS (SELECT coalesce(so.period, sg.period) AS period, wti_price, brent_price, price_spread,
  so.us_production AS us_oil_production, wti_mom_change, so.is_outlier AS oo, henry_hub_price,
  us_storage_bcf AS us_gas_storage_bcf, sg.us_production AS us_gas_production,
  price_mom_change AS gas_mom_change, sg.is_outlier AS go FROM so FULL JOIN sg ON so.period = sg.period),
gold AS (SELECT period, wti_price, brent_price, price_spread, us_oil_production, wti_mom_change,
  {r4('avg(wti_price) OVER (ORDER BY period ROWS 2 PRECEDING)')} AS wti_3m_avg,
  {r4('wti_price - lag(wti_price, 12) OVER (ORDER BY period)')} AS wti_yoy_change,
  henry_hub_price, us_gas_storage_bcf, us_gas_production, gas_mom_change,
  {r4('avg(henry_hub_price) OVER (ORDER BY period ROWS 2 PRECEDING)')} AS henry_hub_3m_avg,
  {r4('wti_price / nullif(henry_hub_price, 0)')} AS oil_gas_ratio,
  (coalesce(oo, false) OR coalesce(go, false)) AS has_outlier FROM gj)"""


def silver_oil_df(spark, sf):
    return silver(oil_observations(spark, sf), DRIVER_OIL)


def silver_gas_df(spark, sf):
    return silver(gas_observations(spark, sf), DRIVER_GAS)


def gold_df(spark, sf):
    return gold(silver_oil_df(spark, sf), silver_gas_df(spark, sf))


query("silver_oil", f"WITH {SILVER_OIL} SELECT * FROM so")(silver_oil_df)
query("silver_gas", f"WITH {SILVER_GAS} SELECT * FROM sg")(silver_gas_df)
query("gold_mart", f"WITH {GOLD} SELECT * FROM gold")(gold_df)


@query("bronze_orders", f"""WITH {all_obs_sql()} SELECT provider, series_id, {month('period')} AS period,
  count(*) AS n, min(value) AS min_value, max(value) AS max_value, CAST(max(ingested_at) AS DATE) AS last_ingested
  FROM obs GROUP BY 1, 2, 3""")
def bronze_orders(spark, sf):
    return (all_observations(spark, sf).groupBy("provider", "series_id", F.trunc("period", "month").alias("period"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("min_value"), F.max("value").alias("max_value"),
                 F.max("ingested_at").cast("date").alias("last_ingested")))


@query("clean_filter", """SELECT c_mktsegment AS series_id, count(*) AS n_kept, min(c_acctbal) AS least
  FROM customer WHERE c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL AND c_acctbal >= 0 GROUP BY 1""")
def clean_filter(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("series_id"),
                                               F.col("c_mktsegment").alias("period"), F.col("c_acctbal").alias("value"))
    return clean(rows).groupBy("series_id").agg(F.count(F.lit(1)).alias("n_kept"), F.min("value").alias("least"))


@query("clean_filter_threshold", """SELECT c_mktsegment AS series_id, count(*) AS n_kept, min(c_acctbal) AS least
  FROM customer WHERE c_acctbal >= CASE WHEN c_mktsegment = 'MACHINERY' THEN -500 ELSE 0 END GROUP BY 1""")
def clean_filter_threshold(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("series_id"),
                                               F.col("c_mktsegment").alias("period"), F.col("c_acctbal").alias("value"))
    low = F.when(F.col("series_id") == "MACHINERY", -500.0).otherwise(0.0)
    return clean(rows, low).groupBy("series_id").agg(F.count(F.lit(1)).alias("n_kept"), F.min("value").alias("least"))


@query("dedupe_latest", f"""WITH {OIL} SELECT series_id, period, value, CAST(ingested_at AS DATE) AS ingested_on FROM (
  SELECT series_id, {month('period')} AS period, value, ingested_at, row_number() OVER (
    PARTITION BY series_id, {month('period')} ORDER BY ingested_at DESC, value DESC) AS rn FROM oil) WHERE rn = 1""")
def dedupe_latest(spark, sf):
    obs = oil_observations(spark, sf).withColumn("period", F.trunc("period", "month"))
    return keep_latest(obs, ["series_id", "period"], ["value", "ingested_at"]).select(
        "series_id", "period", "value", F.col("ingested_at").cast("date").alias("ingested_on"))


@query("pivot_max", f"""WITH {OIL}, {latest_cells_sql('oil', 'c')} SELECT period,
  max(CASE WHEN series_id = '1-URGENT' THEN value END) AS wti_price,
  max(CASE WHEN series_id = '2-HIGH' THEN value END) AS brent_price,
  max(CASE WHEN series_id = '3-MEDIUM' THEN value END) AS us_production FROM c GROUP BY 1""")
def pivot_max(spark, sf):
    return pivot_cells(latest_cells(oil_observations(spark, sf), ["series_id"]), DRIVER_OIL.columns, "series_id")


@query("pivot_mean", f"""WITH {OIL}, {mean_cells_sql('oil', 'c')} SELECT period,
  max(CASE WHEN series_id = '1-URGENT' THEN value END) AS wti_price,
  max(CASE WHEN series_id = '2-HIGH' THEN value END) AS brent_price,
  max(CASE WHEN series_id = '3-MEDIUM' THEN value END) AS us_production FROM c GROUP BY 1""")
def pivot_mean(spark, sf):
    return pivot_cells(mean_cells(oil_observations(spark, sf), ["series_id"]), DRIVER_OIL.columns, "series_id")


@query("gold_mean_variant", f"""WITH {OIL}, {GAS}, {mean_cells_sql('oil', 'oc')}, {mean_cells_sql('gas', 'gc')},
o AS (SELECT period, max(CASE WHEN series_id = '1-URGENT' THEN value END) AS wti_price,
  max(CASE WHEN series_id = '2-HIGH' THEN value END) AS brent_price,
  max(CASE WHEN series_id = '3-MEDIUM' THEN value END) AS us_oil_production FROM oc GROUP BY 1),
g AS (SELECT period, max(CASE WHEN series_id = 'A' THEN value END) AS henry_hub_price,
  max(CASE WHEN series_id = 'N' THEN value END) AS us_gas_storage_bcf,
  max(CASE WHEN series_id = 'R' THEN value END) AS us_gas_production FROM gc GROUP BY 1),
j AS (SELECT * FROM o FULL JOIN g USING (period))
SELECT period, wti_price, brent_price, us_oil_production, {r4('brent_price - wti_price')} AS price_spread,
  {r4('(wti_price - lag(wti_price) OVER (ORDER BY period)) / nullif(lag(wti_price) OVER (ORDER BY period), 0) * 100')} AS wti_mom_change,
  henry_hub_price, us_gas_storage_bcf, us_gas_production,
  {r4('(henry_hub_price - lag(henry_hub_price) OVER (ORDER BY period)) / nullif(lag(henry_hub_price) OVER (ORDER BY period), 0) * 100')} AS gas_mom_change,
  {r4('wti_price / nullif(henry_hub_price, 0)')} AS oil_gas_ratio FROM j""")
def gold_mean_variant(spark, sf):
    return gold_from_means(oil_observations(spark, sf), gas_observations(spark, sf), DRIVER_OIL, DRIVER_GAS)


# ---- single window operators, on the complete grid of the four-category oil domain ----

_GRID_IDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
GRID = f"""{OIL}, {latest_cells_sql('oil', 'c')},
g AS (SELECT p.period, s.series_id, c.value FROM (SELECT DISTINCT period FROM c) p
  CROSS JOIN (SELECT DISTINCT series_id FROM c) s LEFT JOIN c ON c.period = p.period AND c.series_id = s.series_id)"""
_W = "PARTITION BY series_id ORDER BY period"


def oil_grid(spark, sf):
    return grid(latest_cells(oil_observations(spark, sf), ["series_id"]), _GRID_IDS, "series_id")


@query("mom_change", f"""WITH {GRID} SELECT series_id, period, {r4(f'(value - lag(value) OVER ({_W})) / nullif(lag(value) OVER ({_W}), 0) * 100')} AS mom
  FROM g""")
def mom_change(spark, sf):
    return oil_grid(spark, sf).select("series_id", "period", round_half_up(mom_pct("value", "series_id")).alias("mom"))


@query("yoy_change", f"""WITH {GRID} SELECT series_id, period, {r4(f'value - lag(value, 12) OVER ({_W})')} AS yoy FROM g""")
def yoy_change(spark, sf):
    return oil_grid(spark, sf).select("series_id", "period", round_half_up(change_over("value", 12, "series_id")).alias("yoy"))


@query("rolling_3m", f"""WITH {GRID} SELECT series_id, period, {r4(f'avg(value) OVER ({_W} ROWS 2 PRECEDING)')} AS avg_3m FROM g""")
def rolling_3m(spark, sf):
    return oil_grid(spark, sf).select("series_id", "period", round_half_up(trailing(F.avg, "value", 3, "series_id")).alias("avg_3m"))


@query("rolling_with_current", f"""WITH {GRID} SELECT series_id, period,
  {', '.join(f"{r4(f'avg(value) OVER ({_W} ROWS {w - 1} PRECEDING)')} AS mean_{w}" for w in (3, 6, 12))},
  {r4(f'stddev_samp(value) OVER ({_W} ROWS 2 PRECEDING)')} AS std_3 FROM g""")
def rolling_with_current(spark, sf):
    return oil_grid(spark, sf).select(
        "series_id", "period", *[round_half_up(trailing(F.avg, "value", w, "series_id")).alias(f"mean_{w}") for w in (3, 6, 12)],
        round_half_up(trailing(F.stddev_samp, "value", 3, "series_id")).alias("std_3"))


@query("outlier_3sigma", f"""WITH {GRID} SELECT series_id, period, value, coalesce(abs(value - avg(value) OVER (PARTITION BY series_id))
  > 3 * stddev_samp(value) OVER (PARTITION BY series_id), false) AS is_outlier FROM g""")
def outlier_3sigma(spark, sf):
    return oil_grid(spark, sf).select("series_id", "period", "value", three_sigma("value", "series_id").alias("is_outlier"))


@query("lag_steps", f"""WITH {GRID} SELECT series_id, period, {', '.join(f'lag(value, {k}) OVER ({_W}) AS lag_{k}' for k in (1, 3, 6, 12))} FROM g""")
def lag_steps(spark, sf):
    return oil_grid(spark, sf).select("series_id", "period", *[lag("value", k, "series_id").alias(f"lag_{k}") for k in (1, 3, 6, 12)])


@query("full_outer_domains", f"""WITH {OIL}, {GAS}, {latest_cells_sql('oil', 'oc')}, {latest_cells_sql('gas', 'gc')},
o AS (SELECT period, count(*) AS n_oil FROM oc GROUP BY 1), g AS (SELECT period, count(*) AS n_gas FROM gc GROUP BY 1)
SELECT coalesce(o.period, g.period) AS period, n_oil, n_gas FROM o FULL JOIN g ON o.period = g.period""")
def full_outer_domains(spark, sf):
    o = latest_cells(oil_observations(spark, sf), ["series_id"]).groupBy("period").agg(F.count(F.lit(1)).alias("n_oil"))
    g = latest_cells(gas_observations(spark, sf), ["series_id"]).groupBy("period").agg(F.count(F.lit(1)).alias("n_gas"))
    return o.join(g, "period", "full")
