"""Calendar, filling, feature and preprocessing queries."""

from pyspark.sql import functions as F

from monthgrid.catalog import FEATURE_COLUMNS
from monthgrid.functions.scalars import pct_change, round_half_up
from monthgrid.functions.windows import forward_fill, lag, trailing_past
from monthgrid.operators.calendar import densify, with_fills, with_interpolated
from monthgrid.operators.cells import latest_cells, null_counts, unpivot
from monthgrid.operators.evaluate import chronological_split
from monthgrid.operators.stats import flag_iqr_outliers, iqr_bounds
from monthgrid.plans.features import (HENRY_HUB_FEATURES, LAGS, MEASURES, ROLLS, engineered_long, engineered_wide,
                                      feature_cells, feature_wide, feature_wide_by_joins, rounded, scaled, scaler,
                                      strict_measures, strict_wide, unscaled, with_seasonality)
from monthgrid.plans.preprocess import preprocess
from monthgrid.registry.core import feature_cells_sql, latest_cells_sql, query, r4, wide17_sql
from monthgrid.sources.tables import feature_observations, table

# ---- sparse cells: the segments' latest cells, with months taken out by a rule on the key alone ----
GAPS = "(year(period) * 5 + month(period) * 7 + length(series)) % 6 <> 0"
SPARSE = f"""so AS (SELECT c_mktsegment AS series, CAST(o_orderdate AS DATE) AS period, o_totalprice AS value,
  o_orderdate AS ingested_at FROM orders JOIN customer ON o_custkey = c_custkey),
{latest_cells_sql('so', 'lc', 'series')},
sparse AS (SELECT series, period, value FROM lc WHERE {GAPS}),
span AS (SELECT series, min(period) AS lo, max(period) AS hi FROM sparse GROUP BY 1),
cal AS (SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS period FROM span),
dense AS (SELECT cal.series, cal.period, sparse.value FROM cal LEFT JOIN sparse USING (series, period))"""
_S = "PARTITION BY series ORDER BY period"


def sparse_cells(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    obs = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("c_mktsegment").alias("series"), F.col("o_orderdate").cast("date").alias("period"),
        F.col("o_totalprice").alias("value"), F.col("o_orderdate").alias("ingested_at"))
    return latest_cells(obs, ["series"]).filter(GAPS)


query("calendar_densify", f"WITH {SPARSE} SELECT series, period, value FROM dense")(
    lambda spark, sf: densify(sparse_cells(spark, sf)))

FILLS = f"""{SPARSE},
fills AS (SELECT series, period, value, last_value(value IGNORE NULLS) OVER ({_S} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ffill,
  first_value(value IGNORE NULLS) OVER ({_S} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bfill FROM dense)"""


@query("ffill_bfill", f"WITH {FILLS} SELECT series, period, value, ffill, bfill, coalesce(ffill, bfill) AS filled FROM fills")
def ffill_bfill(spark, sf):
    return with_fills(densify(sparse_cells(spark, sf)))


def interpolate_sql(src, out):
    """CTE of linear interpolation by position over (series, period, value)."""
    return f"""{out}_n AS (SELECT *, row_number() OVER ({_S}) AS n FROM {src}),
{out}_s AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN n END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ln,
  last_value(value IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv,
  first_value(CASE WHEN value IS NOT NULL THEN n END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rn,
  first_value(value IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rv
  FROM {out}_n WINDOW w AS ({_S})),
{out} AS (SELECT * EXCLUDE (n, ln, lv, rn, rv), CASE WHEN value IS NOT NULL THEN value WHEN rn IS NULL THEN lv
  ELSE lv + (rv - lv) / (rn - ln) * (n - ln) END AS interpolated FROM {out}_s)"""


@query("interpolate_linear", f"WITH {SPARSE}, {interpolate_sql('dense', 'li')} SELECT series, period, {r4('interpolated')} AS interpolated FROM li")
def interpolate_linear(spark, sf):
    return with_interpolated(densify(sparse_cells(spark, sf))).select("series", "period", round_half_up("interpolated").alias("interpolated"))


# Outliers: raw daily event values are heavy-tailed, so their maxima per day give a tight fence.
DAYMAX = """dm AS (SELECT event_type AS series, CAST(ts AS DATE) AS period, max(value) AS value FROM events GROUP BY 1, 2)"""


def day_max(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("period")).agg(
        F.max("value").alias("value"))


@query("iqr_bounds", f"""WITH {DAYMAX}, q AS (SELECT series, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM dm GROUP BY 1)
SELECT series, {r4('q1')} AS q1, {r4('q3')} AS q3, {r4('q1 - 1.5 * (q3 - q1)')} AS lower, {r4('q3 + 1.5 * (q3 - q1)')} AS upper FROM q""")
def iqr_bounds_q(spark, sf):
    return rounded(iqr_bounds(day_max(spark, sf), k=1.5), ["series"])


@query("iqr_outliers", f"""WITH {DAYMAX}, q AS (SELECT series, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM dm GROUP BY 1)
SELECT series, period, value, (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS is_outlier FROM dm JOIN q USING (series)""")
def iqr_outliers(spark, sf):
    return flag_iqr_outliers(day_max(spark, sf), k=1.5).select("series", "period", "value", "is_outlier")


# ---- preprocessing of one long set of targets ----

PREP = f"""{FILLS},
fl AS (SELECT series, period, coalesce(ffill, bfill) AS value FROM fills),
qs AS (SELECT series, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM fl GROUP BY 1),
hole AS (SELECT series, period, (value < q1 - 0.5 * (q3 - q1) OR value > q3 + 0.5 * (q3 - q1)) AS is_outlier,
  CASE WHEN NOT (value < q1 - 0.5 * (q3 - q1) OR value > q3 + 0.5 * (q3 - q1)) THEN value END AS value FROM fl JOIN qs USING (series)),
{interpolate_sql('hole', 'sm')},
prep AS (SELECT series, period, is_outlier, interpolated AS value,
  {', '.join(f'lag(interpolated, {k}) OVER ({_S}) AS lag_{k}' for k in (1, 3, 6, 12))},
  {', '.join(f'avg(interpolated) OVER ({_S} ROWS {w - 1} PRECEDING) AS rolling_{w}_mean' for w in (3, 6, 12))},
  stddev_samp(interpolated) OVER ({_S} ROWS 2 PRECEDING) AS rolling_3_std,
  (interpolated - lag(interpolated) OVER ({_S})) / nullif(lag(interpolated) OVER ({_S}), 0) * 100 AS mom_pct,
  CAST(month(period) AS INT) AS month, CAST(quarter(period) AS INT) AS quarter, CAST(year(period) AS INT) AS year FROM sm)"""
_PREP_KEEP = ("series", "period", "is_outlier", "month", "quarter", "year")
_PREP_NUM = ("value", "lag_1", "lag_3", "lag_6", "lag_12", "rolling_3_mean", "rolling_6_mean", "rolling_12_mean", "rolling_3_std", "mom_pct")


# A fence of 0.5 IQR instead of the default 3 so that values really are replaced.
@query("preprocess_target", f"WITH {PREP} SELECT {', '.join(_PREP_KEEP)}, {', '.join(f'{r4(c)} AS {c}' for c in _PREP_NUM)} FROM prep WHERE value IS NOT NULL")
def preprocess_target(spark, sf):
    return rounded(preprocess(sparse_cells(spark, sf), iqr_k=0.5), _PREP_KEEP)


@query("preprocess_normalized", f"""WITH {PREP}, z AS (SELECT series, period, value, avg(value) OVER (PARTITION BY series) AS m, stddev_samp(value) OVER (PARTITION BY series) AS s
  FROM prep WHERE value IS NOT NULL)
SELECT series, period, {r4('CASE WHEN s = 0 THEN value ELSE (value - m) / s END')} AS value FROM z WHERE s IS NOT NULL""")
def preprocess_normalized(spark, sf):
    return preprocess(sparse_cells(spark, sf), iqr_k=0.5, normalize=True).select("series", "period", round_half_up("value").alias("value"))


@query("train_test_split", f"""WITH {SPARSE}, n AS (SELECT series, period, value, row_number() OVER ({_S}) AS i, count(*) OVER (PARTITION BY series) AS n FROM dense)
SELECT series, period, value, CASE WHEN i <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM n""")
def train_test_split(spark, sf):
    return chronological_split(densify(sparse_cells(spark, sf)), "series")


# ---- the 17-series feature table ----

WIDE17 = wide17_sql()


def fwide(spark, sf):
    return feature_wide(feature_cells(feature_observations(spark, sf)))


query("feature_wide_17", f"WITH {WIDE17} SELECT * FROM wide17")(fwide)
query("feature_wide_17_joins", f"WITH {WIDE17} SELECT * FROM wide17")(
    lambda spark, sf: feature_wide_by_joins(feature_cells(feature_observations(spark, sf))))


@query("feature_null_report", f"""WITH {WIDE17} SELECT column_name, CAST(n_null AS BIGINT) AS n_null FROM (
  UNPIVOT (SELECT {', '.join(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}' for c in FEATURE_COLUMNS)} FROM wide17)
  ON {', '.join(FEATURE_COLUMNS)} INTO NAME column_name VALUE n_null)""")
def feature_null_report(spark, sf):
    return null_counts(fwide(spark, sf), FEATURE_COLUMNS)


def _past(fn, w, mp, src="value"):
    f = f"OVER ({_S} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({src}) {f} >= {mp} THEN {fn}({src}) {f} END"


ENG = f"""{WIDE17},
filled17 AS (SELECT period, series, last_value(value IGNORE NULLS) OVER ({_S} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM long17),
eng AS (SELECT period, series, value, {', '.join(f'lag(value, {k}) OVER ({_S}) AS lag_{k}' for k in LAGS)},
  {', '.join(f"{_past(fn, w, max(2, w // 2))} AS roll{w}_{n}" for w in ROLLS for n, fn in (('mean', 'avg'), ('std', 'stddev_samp')))},
  (value - lag(value) OVER ({_S})) / nullif(lag(value) OVER ({_S}), 0) * 100 AS mom_pct,
  value - {_past('avg', 12, 6)} AS vs_12mo_avg FROM filled17)"""
_ENG_NUM = ["value", *MEASURES, "vs_12mo_avg"]


def eng_long(spark, sf):
    return engineered_long(fwide(spark, sf))


@query("feature_engineered_long", f"WITH {ENG} SELECT period, series, {', '.join(f'{r4(c)} AS {c}' for c in _ENG_NUM)} FROM eng")
def feature_engineered_long(spark, sf):
    return rounded(eng_long(spark, sf), ("period", "series"))


def _wide_eng_cols(src="series"):
    out = [f"{r4(f'''max(CASE WHEN series = '{c}' THEN value END)''')} AS {c}" for c in FEATURE_COLUMNS]
    out += [f"{r4(f'''max(CASE WHEN series = '{c}' THEN {m} END)''')} AS {c}_{m}" for c in FEATURE_COLUMNS for m in MEASURES]
    return ", ".join(out)


@query("feature_engineered_192", f"""WITH {ENG} SELECT period, {_wide_eng_cols()},
  CAST(month(period) AS INT) AS month, CAST(quarter(period) AS INT) AS quarter,
  {r4('sin(2 * pi() * month(period) / 12)')} AS month_sin, {r4('cos(2 * pi() * month(period) / 12)')} AS month_cos,
  {r4("max(CASE WHEN series = 'gas_storage' THEN vs_12mo_avg END)")} AS storage_vs_12mo_avg FROM eng GROUP BY period""")
def feature_engineered_192(spark, sf):
    return rounded(engineered_wide(eng_long(spark, sf)), ("period", "month", "quarter"))


@query("feature_lags", f"WITH {ENG} SELECT period, series, {', '.join(f'lag_{k}' for k in LAGS)} FROM eng")
def feature_lags(spark, sf):
    filled = unpivot(fwide(spark, sf), FEATURE_COLUMNS).withColumn("value", forward_fill("value", "series"))
    return filled.select("period", "series", *[lag("value", k, "series").alias(f"lag_{k}") for k in LAGS])


@query("feature_rolling", f"""WITH {ENG} SELECT period, series, {', '.join(f"{r4(f'roll{w}_{s}')} AS roll{w}_{s}" for w in ROLLS for s in ('mean', 'std'))} FROM eng""")
def feature_rolling(spark, sf):
    filled = unpivot(fwide(spark, sf), FEATURE_COLUMNS).withColumn("value", forward_fill("value", "series"))
    return filled.select("period", "series", *[
        round_half_up(trailing_past(fn, "value", w, "series")).alias(f"roll{w}_{n}")
        for w in ROLLS for n, fn in (("mean", F.avg), ("std", F.stddev_samp))])


@query("feature_momentum", f"WITH {ENG} SELECT period, series, {r4('mom_pct')} AS mom_pct FROM eng")
def feature_momentum(spark, sf):
    filled = unpivot(fwide(spark, sf), FEATURE_COLUMNS).withColumn("value", forward_fill("value", "series"))
    return filled.select("period", "series", round_half_up(pct_change("value", lag("value", 1, "series"))).alias("mom_pct"))


@query("feature_seasonality", f"""WITH {feature_cells_sql()} SELECT DISTINCT period, CAST(month(period) AS INT) AS month, CAST(quarter(period) AS INT) AS quarter,
  {r4('sin(2 * pi() * month(period) / 12)')} AS month_sin, {r4('cos(2 * pi() * month(period) / 12)')} AS month_cos FROM fcells""")
def feature_seasonality(spark, sf):
    months = feature_observations(spark, sf).select(F.trunc("period", "month").alias("period")).distinct()
    return rounded(with_seasonality(months), ("period", "month", "quarter"))


@query("storage_vs_12mo", f"WITH {ENG} SELECT period, {r4('vs_12mo_avg')} AS storage_vs_12mo_avg FROM eng WHERE series = 'gas_storage'")
def storage_vs_12mo(spark, sf):
    return eng_long(spark, sf).filter(F.col("series") == "gas_storage").select(
        "period", round_half_up("vs_12mo_avg").alias("storage_vs_12mo_avg"))


def _z(c, fit="true"):
    x = f"CASE WHEN {fit} THEN {c} END"
    w = "OVER (PARTITION BY series)"
    dev = f"stddev_samp({x}) {w}"
    return r4(f"({c} - avg({x}) {w}) / (CASE WHEN {dev} = 0 THEN 1 ELSE {dev} END)")


_Z = ["value", *MEASURES, "vs_12mo_avg"]


@query("zscore", f"WITH {ENG} SELECT period, series, {', '.join(f'{_z(c)} AS {c}' for c in _Z)} FROM eng")
def zscore(spark, sf):
    return rounded(scaled(eng_long(spark, sf), _Z), ("period", "series"))


@query("zscore_fit_window", f"""WITH {ENG} SELECT period, series, {', '.join(f'''{_z(c, "period <= DATE '1999-12-01'")} AS {c}''' for c in _Z)} FROM eng""")
def zscore_fit_window(spark, sf):
    return rounded(scaled(eng_long(spark, sf), _Z, "period <= DATE'1999-12-01'"), ("period", "series"))


@query("zscore_parameters", f"""WITH {ENG} SELECT series, {', '.join(f"{r4(f'avg({c})')} AS {c}_mean, {r4(f'stddev_samp({c})')} AS {c}_std" for c in _Z)} FROM eng GROUP BY 1""")
def zscore_parameters(spark, sf):
    """Mean and spread of the value and of every measure."""
    return rounded(scaler(eng_long(spark, sf), _Z), ("series",))


@query("zscore_inverse", f"WITH {ENG} SELECT period, series, {r4('value')} AS value FROM eng")
def zscore_inverse(spark, sf):
    long = eng_long(spark, sf).select("period", "series", "value")
    return rounded(unscaled(scaled(long, ["value"]), scaler(long, ["value"]), "value"), ("period", "series")).select("period", "series", "value")


def _strict_sql():
    back = ", ".join(f"lag(value, {k} IGNORE NULLS) OVER ({_S}) AS b{k}" for k in range(1, 13))

    def mean(w):
        return "(" + " + ".join(f"b{k}" for k in range(1, w + 1)) + f") / {float(w)}"

    return f"""{WIDE17}, st AS (SELECT period, series, value, lag(value) OVER ({_S}) AS prev, {back} FROM long17),
strict AS (SELECT period, series, value, prev, {', '.join(f'b{k} AS lag_{k}' for k in LAGS)},
  {', '.join(f'{mean(w)} AS roll{w}_mean' for w in ROLLS)}, (b1 - b2) / nullif(b2, 0) * 100 AS mom_pct, b1 - {mean(12)} AS vs_12mo_avg,
  {_past('stddev_samp', 3, 2)} AS roll3_std FROM st)"""


STRICT = _strict_sql()


def strict_long(spark, sf):
    return strict_measures(unpivot(fwide(spark, sf), FEATURE_COLUMNS))


@query("strict_features", f"""WITH {STRICT} SELECT period, series, value, prev, {', '.join(f'lag_{k}' for k in LAGS)},
  {', '.join(f"{r4(c)} AS {c}" for c in [*[f'roll{w}_mean' for w in ROLLS], 'mom_pct', 'vs_12mo_avg', 'roll3_std'])} FROM strict""")
def strict_features(spark, sf):
    return rounded(strict_long(spark, sf), ("period", "series", "value", "prev", *[f"lag_{k}" for k in LAGS]))


@query("strict_features_wide", f"""WITH {STRICT} SELECT period, max(CASE WHEN series = 'henry_hub_price' THEN value END) AS henry_hub_price,
  {', '.join(f"{r4(f'''max(CASE WHEN series = '{s}' THEN {m} END)''')} AS {n}" for n, (s, m) in HENRY_HUB_FEATURES.items())},
  {r4('sin(2 * pi() * month(period) / 12)')} AS month_sin, {r4('cos(2 * pi() * month(period) / 12)')} AS month_cos FROM strict GROUP BY period""")
def strict_features_wide(spark, sf):
    return rounded(strict_wide(strict_long(spark, sf), "henry_hub_price", HENRY_HUB_FEATURES), ("period",))
