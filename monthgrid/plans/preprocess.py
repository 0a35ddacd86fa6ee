"""Preparing a target series for forecasting, for all series at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrid.functions.scalars import pct_change
from monthgrid.functions.windows import lag, trailing, whole
from monthgrid.operators.calendar import densify, with_fills, with_interpolated
from monthgrid.operators.stats import flag_iqr_outliers


def preprocess(cells: DataFrame, by: str = "series", iqr_k: float = 3.0, normalize: bool = False) -> DataFrame:
    """Densify, fill gaps, replace outliers by interpolation, add features, optionally z-score.

    ``cells`` is long, one row per (series, month). Everything after the first shuffle on the
    series works inside its partition. Features are taken before the z-score, as the target's
    own lags stay in original units.
    """
    dense = densify(cells, by)
    filled = with_fills(dense, by).select(by, "period", F.col("filled").alias("value"))
    flagged = flag_iqr_outliers(filled, by, k=iqr_k)
    holes = flagged.select(by, "period", "is_outlier", F.when(~F.col("is_outlier"), F.col("value")).alias("value"))
    smooth = with_interpolated(holes, by).select(by, "period", "is_outlier", F.col("interpolated").alias("value"))
    out = smooth.select(
        by, "period", "is_outlier", "value",
        *[lag("value", k, by).alias(f"lag_{k}") for k in (1, 3, 6, 12)],
        *[trailing(F.avg, "value", w, by).alias(f"rolling_{w}_mean") for w in (3, 6, 12)],
        trailing(F.stddev_samp, "value", 3, by).alias("rolling_3_std"),
        pct_change("value", lag("value", 1, by)).alias("mom_pct"),
        F.month("period").alias("month"), F.quarter("period").alias("quarter"), F.year("period").alias("year"))
    if normalize:
        mean, dev = F.avg("value").over(whole(by)), F.stddev_samp("value").over(whole(by))
        # a constant series is left as it is; a single month has no deviation and drops out below
        out = out.withColumn("value", F.when(dev == 0, F.col("value")).otherwise((F.col("value") - mean) / dev))
    return out.filter(F.col("value").isNotNull())
