"""Bounded reads, cutoffs, incremental starts and pre-flight checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def between_periods(df: DataFrame, start: str | None = None, end: str | None = None, c: str = "period") -> DataFrame:
    """Rows of an inclusive date range; plain comparisons, so they reach the parquet scan."""
    if start is not None:
        df = df.filter(F.col(c) >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.filter(F.col(c) <= F.to_date(F.lit(end)))
    return df


def actuals_only(df: DataFrame, as_of: str, c: str = "period") -> DataFrame:
    """Drop projections: keep periods up to the first day of the ``as_of`` month."""
    return df.filter(F.col(c) <= F.trunc(F.to_date(F.lit(as_of)), "month"))


def incremental_start(bronze: DataFrame, by: Sequence[str], full_start: str, days: int = 60) -> DataFrame:
    """First date to pull again: the newest period less ``days``, or the full history if none."""
    newest = bronze.groupBy(*by).agg(F.max("period").alias("latest_period"))
    start = F.coalesce(F.date_sub("latest_period", days), F.to_date(F.lit(full_start)))
    return newest.withColumn("start", start)


def latest_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The newest ``n`` rows: a per-task top-n, then one merge of at most n rows per task."""
    return df.orderBy(*order).limit(n)


def require_columns(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Schema check before a write; runs on the driver without a job."""
    if df is None:
        raise ValueError(f"{name}: no frame given")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df


def require_rows(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Schema check and not-empty check (reads at most one row)."""
    require_columns(df, columns, name)
    if df.isEmpty():
        raise ValueError(f"{name}: no rows")
    return df


def validation_report(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The same checks as rows ``(name, check_name, passed)``, for logging rather than stopping."""
    missing = [c for c in columns if c not in df.columns]
    counted = df.agg((F.count(F.lit(1)) > 0).alias("has_rows"))
    return counted.select(F.lit(name).alias("name"), F.expr(
        f"stack(2, 'not_empty', has_rows, 'has_columns', {'false' if missing else 'true'}) AS (check_name, passed)"))


def preflight(df: DataFrame, layer: str, period: str = "period") -> DataFrame:
    """Row count, newest period and verdict of one layer."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(period).alias("latest_period")).select(
        F.lit(layer).alias("layer"), "n_rows", "latest_period", (F.col("n_rows") > 0).alias("passed"))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by schema, less the excluded ones; no job."""
    from pyspark.sql.types import NumericType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]
