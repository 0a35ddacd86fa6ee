"""Raw observations to one value per (series, month): clean, dedupe or average, pivot, unpivot.

Both reductions are grouped aggregates, so every task first shrinks its rows to at most one per
(series, month) and only those are shuffled. A series holding a third of all rows costs no more
shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.functions.scalars import col, month_of, round_half_up


def clean(obs: DataFrame, min_value: Column | float = 0.0) -> DataFrame:
    """Rows with a period and a value not below the series' least legal value."""
    low = min_value if isinstance(min_value, Column) else F.lit(float(min_value))
    return obs.filter(F.col("value").isNotNull() & F.col("period").isNotNull() & (F.col("value") >= low))


def keep_latest(obs: DataFrame, keys: Sequence[str], payload: Sequence[str] = ("value",),
                recency: str = "ingested_at", tie: str = "value") -> DataFrame:
    """The most recently ingested row of each key; equal times are decided by the larger ``tie``."""
    order = F.struct(recency, tie)
    return obs.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in payload])


#: A packed key holds microseconds since the year 1 (18 digits) and the value in ten-thousandths, shifted to be positive (19 digits).
_SINCE, _SHIFT, _PLACES = 62_135_596_800_000_000, 10 ** 18, 10_000
#: Values up to here come back from ten-thousandths as the same doubles.
LARGEST = 2.0 ** 51 / _PLACES


def latest_key(recency: Column, value: Column) -> Column:
    """Load time, then value to four places, as one number: its maximum is the latest row, of equals the largest value.

    A decimal of 38 digits is held in place by the hash aggregate, where a struct would make Spark sort its input. Values beyond
    ``LARGEST``, NaN and times outside the years 1 to 9999 raise an error rather than being cut.
    """
    stamp = F.unix_micros(recency) + F.lit(_SINCE)
    # ``round_half_up`` without decimals: the same nudge, then down to the whole unit
    units = F.signum(value) * F.floor(F.abs(value) * F.lit(float(_PLACES)) + F.lit(0.50001))
    fits = (F.abs(value) < F.lit(LARGEST)) & stamp.between(0, 10 ** 18 - 1)
    packed = stamp.cast("decimal(18,0)") * F.lit(2 * _SHIFT).cast("decimal(19,0)") + (units.cast("bigint") + F.lit(_SHIFT)).cast("decimal(19,0)")
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("a value or load time is out of range for the latest-row key")).cast("decimal(38,0)"))


def latest_parts(key: str) -> tuple[Column, Column]:
    """(load time, value) of a packed key."""
    unit = F.lit(2 * _SHIFT).cast("decimal(19,0)")
    units = (F.col(key) % unit).cast("bigint") - F.lit(_SHIFT)
    stamp = F.expr(f"cast(`{key}` div cast({2 * _SHIFT} AS decimal(19,0)) AS bigint)") - F.lit(_SINCE)
    return F.timestamp_micros(stamp), units / F.lit(float(_PLACES))


def keep_latest_value(obs: DataFrame, keys: Sequence[str], recency: str = "ingested_at", value: str = "value", stamp: bool = False) -> DataFrame:
    """The value of the latest load per key, to four places; of equal times the largest. With ``stamp``, the load time as well.

    One hash aggregate, whether a load stamps its rows with one time or each row has its own: a task sends at most one row per key.
    """
    best = obs.groupBy(*keys).agg(F.max(latest_key(F.col(recency), F.col(value))).alias("_key"))
    at, got = latest_parts("_key")
    return best.select(*keys, got.alias(value), *([at.alias(recency)] if stamp else []))


def latest_cells(obs: DataFrame, by: Sequence[str], stamp: bool = False) -> DataFrame:
    """Month cells holding the latest value; a row of unknown load time counts as the oldest."""
    loaded = F.coalesce(F.col("ingested_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    monthly = obs.select(*by, month_of("period").alias("period"), "value", loaded.alias("ingested_at"))
    # the month leads the keys: where rows are sorted, dates compare faster than series names
    out = keep_latest_value(monthly.filter(F.col("value").isNotNull()), ["period", *by], stamp=stamp)
    return out.select(*by, "period", round_half_up("value").alias("value"), *(["ingested_at"] if stamp else []))


def mean_cells(obs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Month cells holding the mean of all values (duplicates averaged)."""
    monthly = obs.select(*by, month_of("period").alias("period"), "value")
    return monthly.groupBy(*by, "period").agg(round_half_up(F.avg("value")).alias("value"))


def pivot_cells(cells: DataFrame, columns: Mapping[str, str] | Sequence[str], series: str,
                how: str = "max", index: Sequence[str] = ("period",)) -> DataFrame:
    """Long to wide by conditional aggregates: one shuffle on the index, combined map-side.

    ``columns`` maps output column to series id, or lists series ids used as column names; they
    are given, so no job runs to find them.
    """
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    return cells.groupBy(*index).agg(*[_one_series(how, series, sid, "value").alias(out) for out, sid in names.items()])


def _one_series(how: str, series: str, sid: str, measure: str) -> Column:
    return F.expr(f"{how}(CASE WHEN `{series}` = '{sid}' THEN `{measure}` END)")


def unpivot(wide: DataFrame, columns: Sequence[str], index: Sequence[str] = ("period",),
            series: str = "series") -> DataFrame:
    """Wide to long; months a series lacks become NULL rows, which makes the grid complete."""
    return wide.unpivot(list(index), list(columns), series, "value")


def grid(cells: DataFrame, columns: Sequence[str], series: str = "series") -> DataFrame:
    """Every (period of the domain, series) pair, NULL where the series has no value.

    Positional windows (lag 1 = previous row of the *table*) need it: a month only some series
    report still counts as a row for all of them. A pivot and its inverse give it without a join.
    """
    return unpivot(pivot_cells(cells, columns, series), columns, series=series)


def pivot_measures(long: DataFrame, series_values: Sequence[str], measures: Sequence[str], series: str = "series",
                   index: Sequence[str] = ("period",), carry: Sequence[str] = ()) -> DataFrame:
    """Several measures per series to wide columns ``<series>_<measure>``; one row per (index, series).

    ``carry`` names columns that are the same in all rows of an index value.
    """
    return long.groupBy(*index).agg(
        *[F.first(c).alias(c) for c in carry],
        *[_one_series("max", series, s, m).alias(f"{s}_{m}") for s in series_values for m in measures])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one pass, as rows ``(column_name, n_null)``."""
    one = df.agg(*[F.sum(col(c).isNull().cast("long")).alias(c) for c in columns])
    return one.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "n_null")
