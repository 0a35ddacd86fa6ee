import datetime as dt
import json

import pytest

from monthgrid.session import new_path, stage
from monthgrid.sinks.tables import (append_bronze, backfill_runs, overwrite_column, replace_by_key, round_trip_csv, run_record,
                                    truncate_load, typed, update_by_key)
from monthgrid.sources.payloads import (OBSERVATION_SCHEMA, RESPONSE_SCHEMA, catalog_frame, monthly_mean, observation_rows,
                                        read_payload_files, response_rows, split_corrupt, stamp)
from monthgrid.sources.reads import (actuals_only, incremental_start, numeric_columns, preflight, require_columns, require_rows,
                                     validation_report)
from pyspark.sql import functions as F


def d(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def land(spark, tmp_path):
    def put(**payloads):
        for name, p in payloads.items():
            (tmp_path / f"{name}.json").write_text(p if isinstance(p, str) else json.dumps(p, indent=1))
        return str(tmp_path)

    return put


def test_monthly_payload(spark, land):
    data = [{"period": f"2024-0{i}", "value": v, "series-description": "x"} for i, v in ((1, "74.15"), (2, 77.25), (3, None))]
    path = land(wti={"response": {"data": data + [{"period": None, "value": 1}]}}, empty={"response": {"data": []}}, odd={"error": "x"})
    good, bad = split_corrupt(read_payload_files(spark, path, RESPONSE_SCHEMA))
    rows = response_rows(good).collect()
    assert bad.count() == 0
    assert sorted((r["period"], r["value"]) for r in rows) == [(d("2024-01-01"), 74.15), (d("2024-02-01"), 77.25)]
    assert json.loads(rows[0]["raw_response"])["series-description"] == "x"


def test_daily_payload_becomes_month_means(spark, land):
    obs = [("2024-01-02", "100.5"), ("2024-01-03", "101.2"), ("2024-01-04", "."), ("2024-01-05", "102.1"), ("2024-01-08", "101.8"),
           ("2024-02-01", "103"), ("2024-03-01", "."), ("bad", "1")]
    path = land(fred={"observations": [{"date": a, "value": b} for a, b in obs]}, none={"observations": []}, err={"error_code": 400})
    good, _ = split_corrupt(read_payload_files(spark, path, OBSERVATION_SCHEMA))
    got = {r["period"]: r["value"] for r in monthly_mean(observation_rows(good), []).collect()}
    assert got == {d("2024-01-01"): 101.4, d("2024-02-01"): 103.0}


def test_a_broken_payload_does_not_stop_the_others(spark, land):
    path = land(ok={"response": {"data": [{"period": "2024-01", "value": 1}]}}, cut='{"response": {"data": [{"period": "2024')
    good, bad = split_corrupt(read_payload_files(spark, path, RESPONSE_SCHEMA))
    assert response_rows(good).count() == 1
    assert bad.select("file").first()["file"].endswith("cut.json")


def test_stamp_adds_catalog_columns(spark):
    cat = catalog_frame(spark, [("wti_price", "PET.RWTC.M", "Dollars per Barrel", "EIA_API")])
    r = stamp(spark.createDataFrame([("PET.RWTC.M", 1.0), ("X", 2.0)], "series_id string, value double"), cat)
    assert {x["series_id"]: x["provider"] for x in r.collect()} == {"PET.RWTC.M": "EIA_API", "X": None}


def test_validation(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert require_rows(require_columns(df, ["a"], "t"), ["a"], "t") is df
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(df, ["z"], "t")
    with pytest.raises(ValueError, match="no rows"):
        require_rows(df.filter("false"), ["a"], "t")
    with pytest.raises(ValueError, match="no frame"):
        require_columns(None, ["a"], "t")
    assert [r["passed"] for r in validation_report(df.filter("false"), ["a", "z"], "t").collect()] == [False, False]
    assert numeric_columns(df, ["a"]) == ["b"]
    assert not preflight(df.filter("false"), "silver", "a").first()["passed"]


def test_cutoff_and_incremental_start(monthly):
    df = monthly({"a": list(range(12)), "b": list(range(3))})
    assert actuals_only(df, "2018-06-20").groupBy("series").count().orderBy("series").collect()[0]["count"] == 6
    starts = {r["series"]: r["start"] for r in incremental_start(df, ["series"], "2000-01-01").collect()}
    assert starts == {"a": d("2018-10-02"), "b": d("2017-12-31")}


FC = "target string, model_name string, period date, value double, rmse double"


def test_replace_and_update_by_key(spark):
    old = spark.createDataFrame([("w", "m", d("2024-01-01"), 1.0, 0.5), ("w", "m", d("2024-02-01"), 2.0, 0.5), ("w", "n", d("2024-01-01"), 3.0, None)], FC)
    new = spark.createDataFrame([("w", "m", d("2024-02-01"), 9.0, None), ("h", "m", d("2024-02-01"), 8.0, None)], FC)
    keys = ["target", "model_name", "period"]
    got = sorted(r["value"] for r in replace_by_key(old, new, keys).collect())
    assert got == [1.0, 3.0, 8.0, 9.0]
    assert sorted(r["value"] for r in replace_by_key(old, new.filter("false"), keys).collect()) == [1.0, 2.0, 3.0]
    upd = spark.createDataFrame([("w", "m", None)], "target string, model_name string, rmse double")
    out = update_by_key(old, upd, ["target", "model_name"], ["rmse"], F.col("period") >= "2024-02-01")
    assert sorted((r["value"], r["rmse"]) for r in out.collect()) == [(1.0, 0.5), (2.0, None), (3.0, None)]


def test_append_keeps_and_truncate_replaces_one_partition(spark):
    path = new_path(spark, "t")
    a = spark.createDataFrame([("x", 1.0)], "provider string, value double")
    assert append_bronze(a, path) == 1
    assert append_bronze(a.unionByName(spark.createDataFrame([("y", 5.0)], a.schema)), path) == 2
    read = lambda: sorted((r["provider"], r["value"]) for r in spark.read.schema(a.schema).parquet(path).collect())
    assert read() == [("x", 1.0), ("x", 1.0), ("y", 5.0)]
    truncate_load(spark.createDataFrame([("x", 7.0)], a.schema), path)
    assert read() == [("x", 7.0), ("y", 5.0)]


def test_typed_csv_and_stage(spark):
    df = spark.createDataFrame([(d("2024-01-01"), 1.23456, float("nan")), (d("2024-02-01"), None, 3.0)], "period date, a double, b double")
    t = typed(df, {"period": "date", "b": "decimal(6,1)", "a": "decimal(10,4)"})
    assert dict(t.dtypes) == {"period": "date", "b": "decimal(6,1)", "a": "decimal(10,4)"}
    assert [(r["b"], r["a"]) for r in t.orderBy("period").collect()][0] == (None, __import__("decimal").Decimal("1.2346"))
    assert sorted(map(tuple, round_trip_csv(df.select("period", "a"), new_path(spark, "c")).collect()), key=str) == sorted(
        map(tuple, df.select("period", "a").collect()), key=str)
    staged = stage(df, "s")
    assert "FileScan" in staged._jdf.queryExecution().executedPlan().toString() and staged.count() == 2


def test_run_log_and_backfill(spark):
    at = dt.datetime(2024, 1, 1)
    one, two = (run_record(spark, "ingest", "success", 5, started_at=at).first() for _ in range(2))
    assert one["id"] == two["id"] and one["rows_ingested"] == 5
    counts = spark.createDataFrame([("a", 3), ("b", 4), ("c", 9)], "series string, n_rows long")
    run_of = F.when(F.col("series").isin("a", "b"), "ab").when(F.col("series") == "c", "c")
    got = backfill_runs(counts, run_of, spark.createDataFrame([("c",)], "run_name string")).collect()
    assert [(r["run_name"], r["rows_ingested"], r["n_tables"]) for r in got] == [("ab", 7, 2)]


def test_overwrite_column(spark):
    a = spark.createDataFrame([(1, 0.1, "x"), (2, 0.2, "y")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 10.0)], "k int, v double")
    assert sorted(map(tuple, overwrite_column(a, b, "k", "v").collect())) == [(1, 10.0, "x"), (2, None, "y")]


def test_a_run_appended_twice_is_one_row(spark):
    import datetime as dt

    from monthgrid.session import new_path
    from monthgrid.sinks.tables import RunLog, run_record, run_records

    log = RunLog(spark, new_path(spark, "runs"))
    assert log.read().count() == 0
    first = run_record(spark, "daily", "success", 10, 1, None, dt.datetime(2024, 1, 1))
    log.append(first)
    log.append(first)
    log.append(run_record(spark, "daily", "failed", error_message="no answer", started_at=dt.datetime(2024, 1, 1)))
    log.append(run_record(spark, "daily", "success", 12, started_at=dt.datetime(2024, 1, 2)))
    log.append(first.union(first))
    log.append(run_record(spark, "unknown start", "success"))
    got = sorted((r["run_name"], r["status"], r["rows_ingested"], r["rows_failed"], r["error_message"]) for r in log.read().collect())
    assert got == [("daily", "failed", 0, 0, "no answer"), ("daily", "success", 10, 1, None), ("daily", "success", 12, 0, None), ("unknown start", "success", 0, 0, None)]
    many = run_records(spark.createDataFrame([("a", "success", 5), ("b", "success", 6)], "run_name string, status string, rows_ingested int"))
    log.append(many)
    assert log.read().count() == 6 and log.read().select("id").distinct().count() == 6
