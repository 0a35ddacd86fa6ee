"""Source, sink, scalar and streaming queries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrid.catalog import FEATURE_COLUMNS, RUN_DEFINITIONS
from monthgrid.functions.scalars import (month_of, parse_number, parse_period, round_half_up, safe_divide, stable_id,
                                         title_label)
from monthgrid.operators.cells import mean_cells
from monthgrid.plans.features import feature_cells
from monthgrid.registry.core import (GAS, OIL, all_obs_sql, feature_cells_sql, mean_cells_sql, month, query, r4, wide17_sql)
from monthgrid.registry.features import fwide
from monthgrid.registry.medallion import GOLD, SILVER_OIL, gold_df, silver_gas_df, silver_oil_df
from monthgrid.plans.stored import StoredDomain, StoredMart
from monthgrid.session import new_path, stage
from monthgrid.sinks.tables import (append_bronze, backfill_runs, round_trip_csv, round_trip_parquet, run_records, truncate_load, typed, RunLog)
from monthgrid.sources.payloads import (OBSERVATION_SCHEMA, RESPONSE_SCHEMA, catalog_frame, monthly_mean, observation_rows,
                                        observation_text, parse_payload_text, payload_text, response_rows, split_corrupt,
                                        stamp)
from monthgrid.sources.reads import (actuals_only, between_periods, incremental_start, latest_rows, numeric_columns,
                                     preflight, validation_report)
from monthgrid.sources.tables import (DRIVER_FEATURES, DRIVER_GAS, DRIVER_OIL, all_observations, feature_observations, gas_observations,
                                      oil_observations, table)
from monthgrid.streaming.ingest import daily_means, landed, monthly_means, stream_into_table
from monthgrid.streaming.payloads import VERDICTS, PayloadTable, landed_lines, lines

# ---- payloads: each order and each event is first written as the JSON its API would send ----


def order_payloads(spark, sf):
    """One monthly payload per order; a pending order has no value."""
    o = table(spark, sf, "orders")
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string"))
    text = payload_text(F.date_format("o_orderdate", "yyyy-MM"), value, F.col("o_orderpriority"))
    return o.select(F.col("o_orderpriority").alias("series_id"), "o_orderkey", text.alias("text"))


@query("payload_monthly_rows", f"""SELECT o_orderpriority AS series_id, {month('o_orderdate')} AS period, count(*) AS n, min(o_totalprice) AS least, max(o_totalprice) AS most
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
def payload_monthly_rows(spark, sf):
    good, _ = split_corrupt(parse_payload_text(order_payloads(spark, sf), "text", RESPONSE_SCHEMA))
    return response_rows(good, ["series_id"]).groupBy("series_id", "period").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


def event_payloads(spark, sf):
    """One daily payload per event; a reading below 1 is reported missing, as a dot."""
    e = table(spark, sf, "events")
    value = F.when(F.col("value") < 1, F.lit(".")).otherwise(F.col("value").cast("string"))
    return e.select(F.col("event_type").alias("series_id"), "event_id",
                    observation_text(F.date_format("ts", "yyyy-MM-dd"), value).alias("text"))


@query("payload_daily_to_monthly", f"""SELECT event_type AS series_id, {month('ts')} AS period, {r4('avg(value)')} AS value FROM events WHERE value >= 1 GROUP BY 1, 2""")
def payload_daily_to_monthly(spark, sf):
    good, _ = split_corrupt(parse_payload_text(event_payloads(spark, sf), "text", OBSERVATION_SCHEMA))
    return monthly_mean(observation_rows(good, ["series_id"]), ["series_id"])


@query("payload_quarantine", """SELECT event_type AS series_id, count(*) FILTER (WHERE value < 50) AS n_read, count(*) FILTER (WHERE value >= 50) AS n_quarantined FROM events GROUP BY 1""")
def payload_quarantine(spark, sf):
    """Payloads of large readings arrive cut short; they are set aside and the others still load."""
    p = event_payloads(spark, sf).join(table(spark, sf, "events").select("event_id", "value"), "event_id")
    cut = F.when(F.col("value") >= 50, F.expr("left(text, length(text) - 3)")).otherwise(F.col("text"))
    good, bad = split_corrupt(parse_payload_text(p.select("series_id", cut.alias("text")), "text", OBSERVATION_SCHEMA))
    counted = good.select("series_id", F.lit(1).alias("r"), F.lit(0).alias("q")).unionByName(
        bad.select("series_id", F.lit(0).alias("r"), F.lit(1).alias("q")))
    return counted.groupBy("series_id").agg(F.sum("r").alias("n_read"), F.sum("q").alias("n_quarantined"))


_NAMES = ", ".join(f"('{n}', '{s}', '{p}')" for p, m in DRIVER_FEATURES.items() for s, n in m.items())


@query("stamp_from_catalog", f"""WITH {OIL}, cat(series_name, series_id, provider) AS (VALUES {_NAMES})
SELECT oil.series_id, series_name, 'USD' AS unit, cat.provider, count(*) AS n FROM oil LEFT JOIN cat ON cat.series_id = oil.series_id AND cat.provider = 'oil' GROUP BY ALL
""".replace("'USD' AS unit", "CASE WHEN series_name IS NOT NULL THEN 'USD' END AS unit"))
def stamp_from_catalog(spark, sf):
    cat = catalog_frame(spark, [(n, s, "USD", "oil") for s, n in DRIVER_FEATURES["oil"].items()])
    counts = oil_observations(spark, sf).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    return stamp(counts, cat)


# ---- reads ----

@query("fetch_range", f"WITH {OIL} SELECT series_id, period, value FROM oil WHERE period BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")
def fetch_range(spark, sf):
    return oil_observations(spark, sf, "1997-01-01", "1998-12-31").select("series_id", "period", "value")


@query("actuals_cutoff", f"WITH {GAS} SELECT series_id, {month('period')} AS period, count(*) AS n FROM gas WHERE {month('period')} <= DATE '2000-05-01' GROUP BY 1, 2")
def actuals_cutoff(spark, sf):
    monthly = gas_observations(spark, sf).withColumn("period", month_of("period"))
    return actuals_only(monthly, "2000-05-17").groupBy("series_id", "period").agg(F.count(F.lit(1)).alias("n"))


@query("incremental_start", f"WITH {all_obs_sql()} SELECT provider, max(period) AS latest_period, CAST(max(period) - INTERVAL 60 DAY AS DATE) AS start FROM obs GROUP BY 1")
def incremental_start_q(spark, sf):
    return incremental_start(all_observations(spark, sf), ["provider"], "2000-01-01")


@query("incremental_pull", f"""WITH {OIL}, s AS (SELECT CAST(max(period) - INTERVAL 60 DAY AS DATE) AS start FROM oil)
SELECT series_id, count(*) AS n FROM oil, s WHERE period >= start GROUP BY 1""")
def incremental_pull(spark, sf):
    """The start is one date, so it becomes a literal that prunes files; a join on it would read them all."""
    start = incremental_start(oil_observations(spark, sf), ["provider"], "2000-01-01").first()["start"]
    return oil_observations(spark, sf, str(start)).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))


# Two loads: everything up to the end of May 2000, then the rest.
_FIRST_LOAD = "2000-05-31"


def stored_oil(spark, sf):
    out = StoredDomain(spark, new_path(spark, "stored-oil"), DRIVER_OIL)
    out.load(oil_observations(spark, sf, end=_FIRST_LOAD), 0)
    out.load(oil_observations(spark, sf, start="2000-06-01"), 1)
    return out


@query("silver_range_read", f"WITH {SILVER_OIL} SELECT * FROM so WHERE period BETWEEN DATE '1998-01-01' AND DATE '1999-06-01' ORDER BY period")
def silver_range_read(spark, sf):
    """From the stored silver table, which two loads have filled: two year folders are read."""
    return stored_oil(spark, sf).read("1998-01-01", "1999-06-01").orderBy("period")


@query("gold_stored", f"WITH {GOLD} SELECT * FROM gold")
def gold_stored(spark, sf):
    """The stored gold table after two loads of both domains."""
    gas = StoredDomain(spark, new_path(spark, "stored-gas"), DRIVER_GAS)
    gas.load(gas_observations(spark, sf, end=_FIRST_LOAD), 0)
    gas.load(gas_observations(spark, sf, start="2000-06-01"), 1)
    mart = StoredMart(stored_oil(spark, sf), gas, new_path(spark, "stored-mart"))
    mart.refresh()
    return mart.read()


@query("filtered_latest_read", f"WITH {GOLD} SELECT period, wti_price FROM gold WHERE wti_price IS NOT NULL ORDER BY period DESC LIMIT 50")
def filtered_latest_read(spark, sf):
    g = gold_df(spark, sf).filter(F.col("wti_price").isNotNull()).select("period", "wti_price")
    return latest_rows(g, 50, F.col("period").desc())


@query("preflight_checks", f"""WITH {GOLD} SELECT 'silver_petroleum' AS layer, count(*) AS n_rows, max(period) AS latest_period, count(*) > 0 AS passed FROM so
UNION ALL SELECT 'silver_natural_gas', count(*), max(period), count(*) > 0 FROM sg UNION ALL SELECT 'gold_energy_prices', count(*), max(period), count(*) > 0 FROM gold
UNION ALL SELECT 'bronze_petroleum', count(*), max(period), count(*) > 0 FROM oil""")
def preflight_checks(spark, sf):
    layers = [(silver_oil_df(spark, sf), "silver_petroleum"), (silver_gas_df(spark, sf), "silver_natural_gas"),
              (gold_df(spark, sf), "gold_energy_prices"), (oil_observations(spark, sf), "bronze_petroleum")]
    return reduce(DataFrame.unionByName, [preflight(df, n) for df, n in layers])


@query("validation_report", """SELECT 'orders' AS name, 'not_empty' AS check_name, count(*) > 0 AS passed FROM orders
UNION ALL SELECT 'orders', 'has_columns', true UNION ALL SELECT 'events', 'not_empty', count(*) > 0 FROM events UNION ALL SELECT 'events', 'has_columns', false""")
def validation_report_q(spark, sf):
    a = validation_report(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"], "orders")
    return a.unionByName(validation_report(table(spark, sf, "events"), ["event_id", "unit"], "events"))


# ---- scalars and predicates ----

@query("coerce_values", """SELECT event_id, CAST(CASE WHEN value < 1 THEN NULL ELSE value END AS DOUBLE) AS value,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN CAST(date_trunc('month', ts) AS DATE) ELSE CAST(ts AS DATE) END AS period FROM events""")
def coerce_values(spark, sf):
    """Texts as feeds send them: dots for missing numbers, months or days or junk for dates."""
    e = table(spark, sf, "events")
    number = F.when(F.col("value") < 1, F.lit(".")).otherwise(F.col("value").cast("string"))
    date = (F.when(F.col("event_type") == "error", F.lit("n/a")).when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd")))
    texts = e.select("event_id", number.alias("value"), date.alias("period"))
    return texts.select("event_id", parse_number("value").alias("value"), parse_period("period").alias("period"))


@query("dropna_subset", f"WITH {GOLD} SELECT period, wti_price, henry_hub_price FROM gold WHERE wti_price IS NOT NULL AND henry_hub_price IS NOT NULL AND wti_yoy_change IS NOT NULL")
def dropna_subset(spark, sf):
    return gold_df(spark, sf).dropna(subset=["wti_price", "henry_hub_price", "wti_yoy_change"]).select("period", "wti_price", "henry_hub_price")


@query("safe_divide", f"""SELECT o_orderkey, {r4('CAST(o_totalprice AS DOUBLE) / nullif(CAST(month(o_orderdate) - 6 AS DOUBLE), 0)')} AS ratio FROM orders""")
def safe_divide_q(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", round_half_up(safe_divide("o_totalprice", F.month("o_orderdate") - 6)).alias("ratio"))


@query("flag_logic", f"WITH {GOLD} SELECT period, has_outlier, coalesce(wti_mom_change > 50, false) OR coalesce(gas_mom_change > 50, false) AS jumped, coalesce(wti_price, 0) AS wti_or_zero FROM gold")
def flag_logic(spark, sf):
    jump = F.coalesce(F.col("wti_mom_change") > 50, F.lit(False)) | F.coalesce(F.col("gas_mom_change") > 50, F.lit(False))
    return gold_df(spark, sf).select("period", "has_outlier", jump.alias("jumped"), F.coalesce("wti_price", F.lit(0.0)).alias("wti_or_zero"))


@query("in_and_between", f"WITH {OIL} SELECT series_id, period, value FROM oil WHERE series_id IN ('1-URGENT', '3-MEDIUM') AND period BETWEEN DATE '1999-01-01' AND DATE '1999-03-31'")
def in_and_between(spark, sf):
    obs = oil_observations(spark, sf, "1999-01-01", "1999-03-31")
    return obs.filter(F.col("series_id").isin("1-URGENT", "3-MEDIUM")).select("series_id", "period", "value")


@query("numeric_columns_only", "SELECT c_custkey, c_acctbal FROM customer")
def numeric_columns_only(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(*numeric_columns(c, exclude=["c_nationkey"]))


@query("contract_columns", f"WITH {GOLD} SELECT 'wti_price' AS target, 'observed' AS model_name, period AS forecast_period, wti_price AS forecast_value FROM gold")
def contract_columns(spark, sf):
    return gold_df(spark, sf).select(F.lit("wti_price").alias("target"), F.lit("observed").alias("model_name"),
                                     F.col("period").alias("forecast_period"), F.col("wti_price").alias("forecast_value"))


@query("month_bucket", f"SELECT {month('ts')} AS period, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def month_bucket(spark, sf):
    return table(spark, sf, "events").groupBy(month_of("ts").alias("period"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("scalar_functions", f"""WITH {OIL}, {mean_cells_sql('oil', 'c')} SELECT series_id, period, {r4('value / 3')} AS rounded, abs(value - 200000) AS distance, {r4('sqrt(value)')} AS root, {r4('power(value / 1000, 2)')} AS squared,
  CAST(month(period) AS INT) AS month, CAST(quarter(period) AS INT) AS quarter, CAST(year(period) AS INT) AS year, strftime(period, '%Y-%m') AS year_month, strftime(period, '%b %Y') AS month_name,
  CAST(period - INTERVAL 60 DAY AS DATE) AS sixty_days_before, CAST(period - INTERVAL 1 MONTH AS DATE) AS previous_month, nullif(value, 0) AS not_zero,
  sha256(series_id || '#' || CAST(period AS VARCHAR)) AS row_id, upper(replace(series_id, '-', ' ')) AS label, printf('%s has %d digits', series_id, length(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR))) AS details FROM c""")
def scalar_functions(spark, sf):
    c = mean_cells(oil_observations(spark, sf), ["series_id"])
    v = F.col("value")
    return c.select(
        "series_id", "period", round_half_up(v / 3).alias("rounded"), F.abs(v - 200000).alias("distance"),
        round_half_up(F.sqrt(v)).alias("root"), round_half_up(F.pow(v / 1000, F.lit(2))).alias("squared"),
        F.month("period").alias("month"), F.quarter("period").alias("quarter"), F.year("period").alias("year"),
        F.date_format("period", "yyyy-MM").alias("year_month"), F.date_format("period", "MMM yyyy").alias("month_name"),
        F.date_sub("period", 60).alias("sixty_days_before"), F.add_months("period", -1).alias("previous_month"),
        F.nullif(v, F.lit(0.0)).alias("not_zero"), stable_id("series_id", "period").alias("row_id"),
        F.upper(F.replace("series_id", F.lit("-"), F.lit(" "))).alias("label"),
        F.format_string("%s has %d digits", "series_id", F.length(F.floor(v).cast("string"))).alias("details"))


@query("title_labels", f"""WITH {feature_cells_sql()} SELECT series, array_to_string(list_transform(string_split(series, '_'),
  lambda w: upper(w[1]) || lower(w[2:])), ' ') AS label, count(*) AS n FROM fcells GROUP BY 1""")
def title_labels(spark, sf):
    c = feature_cells(feature_observations(spark, sf))
    return c.groupBy("series", title_label("series").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("raw_json_column", """SELECT event_type, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1""")
def raw_json_column(spark, sf):
    """The raw row is stored as a variant and still readable."""
    e = table(spark, sf, "events").withColumn("raw_response", F.parse_json("props"))
    return e.groupBy("event_type").agg(F.sum(F.variant_get("raw_response", "$.k", "long")).alias("total"))


# ---- sinks: written, then read back ----

@query("bronze_append", f"WITH {all_obs_sql()} SELECT provider, 2 * count(*) AS n, max(value) AS most FROM obs GROUP BY 1")
def bronze_append(spark, sf):
    """The same pull appended twice stays twice in bronze; silver later keeps the latest."""
    path = new_path(spark, "bronze")
    obs = all_observations(spark, sf)
    append_bronze(obs, path)
    append_bronze(obs, path)
    return spark.read.schema(obs.schema).parquet(path).groupBy("provider").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("most"))


@query("truncate_load", f"WITH {OIL}, {GAS} SELECT 'oil' AS provider, count(*) AS n, max(value) AS most FROM oil UNION ALL SELECT 'gas', count(*), -1 * min(value) FROM gas")
def truncate_load_q(spark, sf):
    """Reloading one provider replaces its partition and leaves the other."""
    path = new_path(spark, "bronze")
    both = oil_observations(spark, sf).unionByName(gas_observations(spark, sf))
    truncate_load(both, path)
    truncate_load(gas_observations(spark, sf).withColumn("value", -F.col("value")), path)
    return spark.read.schema(both.schema).parquet(path).groupBy("provider").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("most"))


_W17 = wide17_sql()


# Decimal places of the typed table by column; whole numbers are bigint, all others have two places.
PLACES = {name: 2 for name in FEATURE_COLUMNS} | {"gas_storage": 1, "gas_production": 1, "refinery_util": 3, "hdd": 0, "cdd": 0}


@query("typed_feature_table", f"WITH {_W17} SELECT period, " + ", ".join(
    f"CAST(trunc({c}) AS BIGINT) AS {c}" if n == 0 else f"CAST(round(CAST(CAST({c} AS VARCHAR) AS DECIMAL(24, 8)), {n}) AS DOUBLE) AS {c}" for c, n in PLACES.items()) + " FROM wide17")
def typed_feature_table(spark, sf):
    """All 17 columns in their declared types, written and read back; decimals are shown as doubles to be compared."""
    kinds = {"period": "date"} | {c: f"decimal(16,{n})" if n else "bigint" for c, n in PLACES.items()}
    written = round_trip_parquet(typed(fwide(spark, sf), kinds), new_path(spark, "features-typed"))
    return written.select("period", *[F.col(c).cast("double").alias(c) if n else F.col(c) for c, n in PLACES.items()])


@query("csv_round_trip", f"WITH {_W17} SELECT * FROM wide17")
def csv_round_trip(spark, sf):
    return round_trip_csv(fwide(spark, sf), new_path(spark, "features-csv"))


@query("parquet_round_trip", f"WITH {GOLD} SELECT * FROM gold")
def parquet_round_trip(spark, sf):
    return round_trip_parquet(gold_df(spark, sf), new_path(spark, "gold"))


_RUN = "CASE " + " ".join(f"WHEN series IN ({', '.join(repr(s) for s in ss)}) THEN '{r}'" for r, ss in RUN_DEFINITIONS.items()) + " END"


def _run_of():
    """The load a series belongs to."""
    return reduce(lambda c, r: c.when(F.col("series").isin(list(r[1])), r[0]), RUN_DEFINITIONS.items(), F.when(F.lit(False), ""))


@query("backfill_runs", f"""WITH {feature_cells_sql()}, c AS (SELECT series, count(*) AS n_rows FROM fobs GROUP BY 1)
SELECT {_RUN} AS run_name, 'success' AS status, CAST(sum(n_rows) AS BIGINT) AS rows_ingested, CAST(0 AS BIGINT) AS rows_failed, count(*) AS n_tables FROM c
  WHERE {_RUN} IS NOT NULL AND {_RUN} <> 'fred_macro_ingestion' GROUP BY 1""")
def backfill_runs_q(spark, sf):
    counts = feature_observations(spark, sf).groupBy("series").agg(F.count(F.lit(1)).alias("n_rows"))
    logged = spark.createDataFrame([("fred_macro_ingestion",)], "run_name string")
    return backfill_runs(counts, _run_of(), logged)


@query("run_log", f"""WITH {feature_cells_sql()}, c AS (SELECT series, {_RUN} AS run_name, count(*) AS n, max(ingested_at) AS newest FROM fobs GROUP BY 1, 2)
SELECT run_name, 'success' AS status, CAST(sum(n) AS BIGINT) AS rows_ingested, CAST(0 AS BIGINT) AS rows_failed, CAST(NULL AS VARCHAR) AS error_message,
  CAST(max(newest) AS DATE) AS started_on FROM c WHERE run_name IS NOT NULL GROUP BY 1
UNION ALL SELECT 'all_series_ingestion', 'failed', 0, CAST(sum(n) AS BIGINT), 'interrupted', CAST(max(newest) AS DATE) FROM c""")
def run_log_q(spark, sf):
    """A record per load and one of a failed load, each appended twice, as a retry would; the log has each once."""
    per_series = stage(feature_observations(spark, sf).groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("at")), "loads")
    runs = per_series.withColumn("run_name", _run_of()).filter(F.col("run_name").isNotNull()).groupBy("run_name").agg(
        F.sum("n").alias("rows_ingested"), F.max("at").alias("started_at"))
    failed = per_series.agg(F.sum("n").alias("rows_failed"), F.max("at").alias("started_at"))
    log = RunLog(spark, new_path(spark, "run-log"))
    for records in (run_records(runs.withColumn("status", F.lit("success"))),
                    run_records(failed.select(F.lit("all_series_ingestion").alias("run_name"), F.lit("failed").alias("status"), "rows_failed", "started_at",
                                              F.lit("interrupted").alias("error_message")))):
        log.append(records)
        log.append(records)
    return log.read().drop("id").withColumn("started_on", F.col("started_at").cast("date")).drop("started_at")


# ---- streaming ----

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def event_stream(spark, sf):
    return landed(spark, f"{sf}/events.parquet", EVENT_SCHEMA).withColumnRenamed("event_type", "series")


_MEANS = T.StructType([T.StructField("series", T.StringType()), T.StructField("period", T.DateType()),
                       T.StructField("n", T.LongType()), T.StructField("mean_value", T.DoubleType())])


@query("stream_daily_means", f"SELECT event_type AS series, CAST(ts AS DATE) AS period, count(*) AS n, {r4('avg(value)')} AS mean_value FROM events GROUP BY 1, 2")
def stream_daily_means(spark, sf):
    t = stream_into_table(daily_means(event_stream(spark, sf)), "daily-means", _MEANS, ["series", "period"])
    return t.withColumn("mean_value", round_half_up("mean_value"))


@query("stream_monthly_means", f"SELECT event_type AS series, {month('ts')} AS period, count(*) AS n, {r4('avg(value)')} AS mean_value FROM events GROUP BY 1, 2")
def stream_monthly_means(spark, sf):
    t = stream_into_table(monthly_means(event_stream(spark, sf)), "monthly-means", _MEANS, ["series", "period"])
    return t.withColumn("mean_value", round_half_up("mean_value"))


@query("daily_to_monthly_mean", f"SELECT event_type AS series, {month('ts')} AS period, {r4('avg(value)')} AS value FROM events GROUP BY 1, 2")
def daily_to_monthly_mean(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("series"), F.col("ts").alias("period"), "value")
    return monthly_mean(e, ["series"])


@query("stream_latest_wins", """SELECT event_type AS series, CAST(ts AS DATE) AS period, max(ts) AS at, arg_max(event_id, {'t': ts, 'e': event_id}) AS event_id,
  arg_max(value, {'t': ts, 'e': event_id}) AS value FROM events GROUP BY 1, 2""")
def stream_latest_wins(spark, sf):
    """Every event is a row of its series and day; the newest one stays, whatever order files come in. No streaming state."""
    schema = T.StructType([T.StructField("series", T.StringType()), T.StructField("period", T.DateType()), T.StructField("at", T.TimestampNTZType()),
                           T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    rows = event_stream(spark, sf).select("series", F.col("ts").cast("date").alias("period"), F.col("ts").alias("at"), "event_id", "value")
    return stream_into_table(rows, "latest", schema, ["series", "period"], "append", order=["at", "event_id"], by="period")


# ---- landed payloads: a file line per series and month, in no order of time; some are cut short, some are error answers ----

_ORDER_DAYS = f"""days AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS value FROM orders GROUP BY 1, 2),
sent AS (SELECT *, {month('day')} AS period, month(day) = 2 AND year(day) % 2 = 1 AS cut, series_id = '5-LOW' AND month(day) = 11 AS refused,
  dayofmonth(day) = 13 AS dot FROM days)"""


def land_order_days(spark, sf):
    """Writes the payloads as text files and returns (folder, number of files)."""
    day = F.col("o_orderdate").cast("date")
    days = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("series_id"), day.alias("day")).agg(F.max("o_totalprice").alias("value"))
    entry = F.struct(F.date_format("day", "yyyy-MM-dd").alias("date"), F.when(F.dayofmonth("day") == 13, ".").otherwise(F.col("value").cast("string")).alias("value"))
    sent = days.groupBy("series_id", F.trunc("day", "month").alias("period")).agg(F.array_sort(F.collect_list(entry)).alias("observations"))
    text = F.to_json(F.struct("observations"))
    text = (F.when((F.month("period") == 2) & (F.year("period") % 2 == 1), F.expr("left(to_json(struct(observations)), 40)"))
            .when((F.col("series_id") == "5-LOW") & (F.month("period") == 11), '{"error_code":400}').otherwise(text))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_path(spark, "landing")
    lines(sent.withColumn("text", text).repartition(files, F.xxhash64("period", "series_id"))).write.text(folder)
    return folder, files


def ingested_order_days(spark, sf):
    folder, files = land_order_days(spark, sf)
    out = PayloadTable(spark, new_path(spark, "payloads"), merge_every=3)
    out.run(landed_lines(spark, folder, -(-files // 6)))
    return out


@query("stream_payload_months", f"""WITH {_ORDER_DAYS} SELECT series_id, period, count(*) AS n_days, {r4('avg(value)')} AS value FROM sent
  WHERE NOT cut AND NOT refused AND NOT dot GROUP BY 1, 2""")
def stream_payload_months(spark, sf):
    """Monthly means of the days that landed, late ones included."""
    days = ingested_order_days(spark, sf).read(late=True)
    return days.groupBy("series_id", month_of("period").alias("period")).agg(F.count(F.lit(1)).alias("n_days"), round_half_up(F.avg("value")).alias("value"))


@query("stream_payload_ledger", f"""WITH {_ORDER_DAYS} SELECT 'loaded' AS verdict, count(*) AS n FROM sent WHERE NOT cut AND NOT refused AND NOT dot
UNION ALL SELECT 'missing', count(*) FROM sent WHERE dot AND NOT cut AND NOT refused
UNION ALL SELECT 'quarantined', count(DISTINCT (series_id, period)) FROM sent WHERE cut
UNION ALL SELECT 'empty', count(DISTINCT (series_id, period)) FROM sent WHERE refused AND NOT cut
UNION ALL SELECT 'unaccounted', 0 UNION ALL SELECT 'set_aside', count(DISTINCT (series_id, period)) FROM sent WHERE cut""")
def stream_payload_ledger(spark, sf):
    """What landed by verdict (kept or late: loaded), what no verdict accounts for, and the lines in the quarantine table."""
    out = ingested_order_days(spark, sf)
    total = out.ledger().agg(F.sum(F.col("kept") + F.col("late")).alias("loaded"), *[F.sum(v).alias(v) for v in ("missing", "quarantined", "empty")],
                             F.sum(F.col("landed") - sum((F.col(v) for v in VERDICTS), F.lit(0))).alias("unaccounted"))
    rows = total.select(F.expr("stack(5, " + ", ".join(f"'{c}', {c}" for c in total.columns) + ") AS (verdict, n)"))
    return rows.unionByName(out.side("quarantined").agg(F.count(F.lit(1)).alias("n")).withColumn("verdict", F.lit("set_aside")))
