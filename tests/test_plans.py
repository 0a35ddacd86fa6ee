"""Plan shapes that must hold at any scale."""

import re

import pytest

import __spark_entry__ as entry
from monthgrid.sources.tables import oil_observations

SF_DIR = "/root/testdata/sf0.001"
BATCH = """silver_oil silver_gas gold_mart gold_mean_variant outlier_3sigma calendar_densify preprocess_target train_test_split
feature_wide_17 feature_engineered_long feature_engineered_192 zscore strict_features quality_oil quality_generic error_metrics
best_model_flags leaderboard backtest_splits correlation_targets percent_rank_latest latest_and_delta target_model_grid
forecast_seasonal_ar forecast_trend_seasonal backtest window_experiment""".split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_single_task_windows_and_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            above = [x for x in lines[max(0, i - 3):i]]
            assert not any(re.search(r"\bWindow\b", x) for x in above), "\n".join(above)


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = entry.queries()["fetch_range"](spark, SF_DIR)._jdf.queryExecution().toString()
    scan = next(x for x in text.splitlines() if "FileScan parquet" in x)
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in scan
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in scan and "LessThan(o_orderdate,1999-01-01T00:00)" in scan


def test_month_cells_combine_before_the_shuffle(spark):
    from monthgrid.operators.cells import latest_cells, mean_cells

    for fn in (latest_cells, mean_cells):
        text = plan(fn(oil_observations(spark, SF_DIR), ["series_id"]))
        before = text[text.index("Exchange"):]
        assert "partial_" in before


def test_fact_tables_are_never_broadcast(spark):
    text = plan(entry.queries()["gold_mart"](spark, SF_DIR))
    assert "BroadcastExchange" not in text


def test_each_table_is_scanned_once(spark):
    text = plan(entry.queries()["feature_wide_17"](spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet", text)) == 4  # orders, customer, line items, parts


def test_a_rewritten_table_shows_its_new_columns(spark, tmp_path):
    from monthgrid.sources.tables import table

    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    assert table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(3).selectExpr("id", "id AS more").write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    assert table(spark, str(tmp_path), "t").columns == ["id", "more"]


def test_the_chain_of_joins_makes_its_cells_once(spark):
    df = entry.queries()["feature_wide_17_joins"](spark, SF_DIR)
    text = df._jdf.queryExecution().toString()
    assert len(re.findall(r"LeftOuter", plan(df))) == 17
    assert "o_totalprice" not in text and "l_extendedprice" not in text  # the tables were read before, for all joins
