"""Collects queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL twin where SQL can express it."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r4(x: str, digits: int = 4) -> str:
    """SQL of ``round_half_up``."""
    return f"(round(({x}) + sign({x}) * 1e-{digits + 5}, {digits}) + 0)"


OIL = """oil AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS period,
  o_totalprice AS value, o_orderdate AS ingested_at FROM orders)"""
GAS = """gas AS (SELECT l_returnflag AS series_id, CAST(l_shipdate AS DATE) AS period,
  l_extendedprice AS value, l_shipdate AS ingested_at FROM lineitem)"""
SEGMENT = """segment AS (SELECT c_mktsegment AS series_id, CAST(o_orderdate AS DATE) AS period,
  o_totalprice AS value, o_orderdate AS ingested_at FROM orders JOIN customer ON o_custkey = c_custkey)"""
PART_TYPE = """part_type AS (SELECT p_type AS series_id, CAST(l_shipdate AS DATE) AS period,
  l_extendedprice AS value, l_shipdate AS ingested_at FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def month(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def latest_cells_sql(src: str, out: str, key: str = "series_id") -> str:
    """CTE of the latest value per (series, month)."""
    return f"""{out} AS (SELECT {key}, period, {r4('value')} AS value FROM (
  SELECT {key}, {month('period')} AS period, value, row_number() OVER (
    PARTITION BY {key}, {month('period')} ORDER BY ingested_at DESC, value DESC) AS rn
  FROM {src} WHERE value IS NOT NULL AND period IS NOT NULL AND value >= 0) WHERE rn = 1)"""


def mean_cells_sql(src: str, out: str, key: str = "series_id") -> str:
    return f"""{out} AS (SELECT {key}, {month('period')} AS period, {r4('avg(value)')} AS value
  FROM {src} GROUP BY 1, 2)"""


def _feature_rows() -> str:
    from monthgrid.sources.tables import DRIVER_FEATURES

    return ", ".join(f"('{p}', '{s}', '{n}')" for p, m in DRIVER_FEATURES.items() for s, n in m.items())


def all_obs_sql() -> str:
    """CTEs ``oil, gas, segment, part_type, obs(provider, series_id, …)``."""
    union = " UNION ALL ".join(f"SELECT '{p}' AS provider, * FROM {p}" for p in ("oil", "gas", "segment", "part_type"))
    return f"{OIL}, {GAS}, {SEGMENT}, {PART_TYPE}, obs AS ({union})"


def feature_cells_sql() -> str:
    """CTEs up to ``fobs`` (the 17 known series) and ``fcells`` (their monthly means)."""
    return f"""{all_obs_sql()},
names(provider, series_id, series) AS (VALUES {_feature_rows()}),
fobs AS (SELECT series, period, value, ingested_at FROM obs JOIN names USING (provider, series_id)),
{mean_cells_sql('fobs', 'fcells', 'series')}"""


def wide17_sql() -> str:
    """CTEs up to ``wide17`` (spine months, 17 columns) and ``long17`` (its complete grid)."""
    from monthgrid.catalog import FEATURE_COLUMNS
    from monthgrid.plans.features import SPINE

    cols = ", ".join(f"max(CASE WHEN series = '{c}' THEN value END) AS {c}" for c in FEATURE_COLUMNS)
    spine = ", ".join(f"'{c}'" for c in SPINE)
    names = ", ".join(f"('{c}')" for c in FEATURE_COLUMNS)
    return f"""{feature_cells_sql()},
spine AS (SELECT DISTINCT period FROM fcells WHERE series IN ({spine})),
wide17 AS (SELECT spine.period, {cols} FROM spine LEFT JOIN fcells USING (period) GROUP BY 1),
cols17(series) AS (VALUES {names}),
long17 AS (SELECT spine.period, cols17.series, fcells.value FROM spine CROSS JOIN cols17
  LEFT JOIN fcells ON fcells.period = spine.period AND fcells.series = cols17.series)"""
