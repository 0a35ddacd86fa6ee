"""Window helpers. Every window is partitioned by the series.

The input is always one row per (series, month), so a partition holds at most as many rows as
there are months between the first and the last period, however many raw rows the series had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from monthgrid.functions.scalars import col, pct_change

Keys = str | Sequence[str]


def _keys(by: Keys) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def ordered(by: Keys, order: str = "period") -> WindowSpec:
    return W.partitionBy(*_keys(by)).orderBy(order)


def whole(by: Keys) -> WindowSpec:
    return W.partitionBy(*_keys(by))


def lag(c: str, k: int, by: Keys, order: str = "period") -> Column:
    return F.lag(c, k).over(ordered(by, order))


def lag_present(c: str, k: int, by: str, order: str = "period") -> Column:
    """The k-th earlier value that is not NULL."""
    return F.expr(f"lag({c}, {k}) IGNORE NULLS OVER (PARTITION BY {by} ORDER BY {order})")


def mom_pct(c: str, by: Keys, order: str = "period") -> Column:
    return pct_change(c, lag(c, 1, by, order))


def change_over(c: str, k: int, by: Keys, order: str = "period") -> Column:
    return F.col(c) - lag(c, k, by, order)


def trailing(fn, c: str, w: int, by: Keys, order: str = "period", min_periods: int = 1) -> Column:
    """Aggregate of the last ``w`` rows, the current one included."""
    frame = ordered(by, order).rowsBetween(-(w - 1), 0)
    return F.when(F.count(c).over(frame) >= min_periods, fn(c).over(frame))


def trailing_past(fn, c: str, w: int, by: Keys, order: str = "period", min_periods: int | None = None) -> Column:
    """Aggregate of the ``w`` rows before the current one, so the current month cannot leak in.

    ``min_periods`` counts values, not rows; the default is half the window, two at least.
    """
    need = max(2, w // 2) if min_periods is None else min_periods
    frame = ordered(by, order).rowsBetween(-w, -1)
    return F.when(F.count(c).over(frame) >= need, fn(c).over(frame))


def forward_fill(c: str, by: Keys, order: str = "period") -> Column:
    return F.last(c, ignorenulls=True).over(ordered(by, order).rowsBetween(W.unboundedPreceding, 0))


def backward_fill(c: str, by: Keys, order: str = "period") -> Column:
    return F.first(c, ignorenulls=True).over(ordered(by, order).rowsBetween(0, W.unboundedFollowing))


def three_sigma(c: str, by: Keys) -> Column:
    """True where the value is more than three sample deviations from the series mean."""
    mean = F.avg(c).over(whole(by))
    dev = F.stddev_samp(c).over(whole(by))
    return F.coalesce(F.abs(col(c) - mean) > F.lit(3.0) * dev, F.lit(False))
