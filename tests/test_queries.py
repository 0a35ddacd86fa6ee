"""Registered queries against their SQL twins.

All of them run by default; ``MONTHGRID_CORE=1`` runs a cross-section.
"""

import os

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

SF_DIR = os.environ.get("MONTHGRID_SF_DIR", "/root/testdata/sf0.001")
CORE = """silver_oil gold_mart gold_mean_variant dedupe_latest calendar_densify ffill_bfill interpolate_linear
preprocess_target train_test_split feature_wide_17 feature_engineered_192 zscore_fit_window strict_features quality_oil
quality_gas quality_generic quality_gate column_tests_gold error_metrics best_model_flags leaderboard replace_by_key
metrics_update backtest_splits correlation_targets percent_rank_latest year_overlay payload_quarantine incremental_start
truncate_load typed_feature_table backfill_runs stream_daily_means forecast_ar_exact""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
NAMES = [n for n in CORE if n in ORACLES] if os.environ.get("MONTHGRID_CORE") else [n for n in ORACLES if not n.startswith("op")]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "period" and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
