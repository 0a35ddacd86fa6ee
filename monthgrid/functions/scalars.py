"""Scalar column expressions: month buckets, tolerant casts, guarded division, labels."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(c: Column | str) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(col(c).cast("date"), "month")


def parse_period(c: Column | str) -> Column:
    """``YYYY-MM``, ``YYYY-MM-DD`` or a timestamp string to a date; junk becomes NULL."""
    return col(c).cast("string").try_cast("date")


def parse_number(c: Column | str) -> Column:
    """Text to double; junk such as ``.`` becomes NULL."""
    return col(c).cast("string").try_cast("double")


def rounding(c: str, digits: int = 4) -> str:
    """SQL text of ``round_half_up`` of a column."""
    return f"round(`{c}` + signum(`{c}`) * 1e-{digits + 5}, {digits}) + 0D"


def round_half_up(c: Column | str, digits: int = 4) -> Column:
    """Round half away from zero, the same for every summation order.

    Partial sums are merged in a different order on every run, so a mean that is an exact tie
    (``x.xxxx5``) carries noise in its last bits. The nudge is far below the kept digits and
    far above that noise.
    """
    if isinstance(c, str):
        return F.expr(rounding(c, digits))
    return F.round(c + F.signum(c) * F.lit(10.0 ** -(digits + 5)), digits) + F.lit(0.0)


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """NULL when the denominator is zero or NULL."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def pct_change(now: Column | str, before: Column | str) -> Column:
    return safe_divide(col(now) - col(before), before) * F.lit(100.0)


def month_sin(period: Column | str) -> Column:
    return F.sin(F.lit(2 * math.pi) * F.month(col(period)) / F.lit(12.0))


def month_cos(period: Column | str) -> Column:
    return F.cos(F.lit(2 * math.pi) * F.month(col(period)) / F.lit(12.0))


def map_label(c: Column | str, labels: Mapping, default: Column | None = None) -> Column:
    """A small fixed mapping as a CASE expression; no join, no shuffle."""
    expr = None
    for k, v in labels.items():
        hit = col(c) == F.lit(k)
        expr = F.when(hit, F.lit(v)) if expr is None else expr.when(hit, F.lit(v))
    return expr if default is None else expr.otherwise(default)


def window_label(n: Column | str, labels: Mapping[int, str]) -> Column:
    """Label of a test window from its training length; unknown lengths read ``<n>-month train``."""
    return map_label(n, labels, F.concat(col(n).cast("string"), F.lit("-month train")))


def title_label(c: Column | str) -> Column:
    """``wti_price`` to ``Wti Price``."""
    return F.initcap(F.replace(col(c), F.lit("_"), F.lit(" ")))


def stable_id(*cols: Column | str) -> Column:
    """A repeatable row id (retries must not change it, so no uuid)."""
    return F.sha2(F.concat_ws("#", *[col(c).cast("string") for c in cols]), 256)
