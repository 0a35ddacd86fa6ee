"""Calendar alignment and gap filling of monthly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrid.functions.windows import backward_fill, forward_fill, ordered


def densify(cells: DataFrame, by: str = "series", values: Sequence[str] = ("value",)) -> DataFrame:
    """Make every month between a series' first and last one exist, NULL where it was missing.

    Each row spawns the months up to the next row of its series, so there is no calendar table
    to join: one shuffle on the series, shared with the windows that follow.
    """
    following = F.lead("period").over(ordered(by))
    until = F.coalesce(F.add_months(following, -1), F.col("period"))
    months = F.sequence(F.col("period"), until, F.expr("interval 1 month"))
    spread = (cells.withColumn("_own", F.col("period")).withColumn("_months", months)
              .withColumn("period", F.explode("_months")))
    return spread.select(by, "period", *[
        F.when(F.col("period") == F.col("_own"), F.col(v)).alias(v) for v in values])


def with_fills(df: DataFrame, by: str = "series", c: str = "value") -> DataFrame:
    """Add ``ffill``, ``bfill`` and ``filled`` (forward first, then backward)."""
    out = df.withColumn("ffill", forward_fill(c, by)).withColumn("bfill", backward_fill(c, by))
    return out.withColumn("filled", F.coalesce("ffill", "bfill"))


def with_interpolated(df: DataFrame, by: str = "series", c: str = "value", out: str = "interpolated") -> DataFrame:
    """Linear interpolation by row position; a trailing gap keeps the last value, a leading one stays NULL."""
    numbered = df.withColumn("_n", F.row_number().over(ordered(by)))
    numbered = numbered.withColumn("_p", F.when(F.col(c).isNotNull(), F.struct(F.col("_n").alias("n"), F.col(c).alias("v"))))
    sides = numbered.withColumn("_l", forward_fill("_p", by)).withColumn("_r", backward_fill("_p", by))
    slope = (F.col("_r.v") - F.col("_l.v")) / (F.col("_r.n") - F.col("_l.n"))
    value = (F.when(F.col(c).isNotNull(), F.col(c))
             .when(F.col("_r").isNull(), F.col("_l.v"))
             .otherwise(F.col("_l.v") + slope * (F.col("_n") - F.col("_l.n"))))
    return sides.withColumn(out, value).drop("_n", "_p", "_l", "_r")
