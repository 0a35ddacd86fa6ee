"""A bit table of fixed size that thins a large table before an exact join on a small set of ids.

The table is 2 MB whatever it is built from, so it can be broadcast. It lets every member through and some others; the join that
follows decides. With ever more members it lets everything through and the join does all the work: it never changes a result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthgrid.llm import words as W

BITS = 24


def _slots(ids: np.ndarray) -> np.ndarray:
    return (W.mix(ids.view(np.uint64)) >> W.U(64 - BITS)).astype(np.int64)


def maybe_in(members: DataFrame, column: str):
    """A function from a bigint column to: may it be a member? Null is not a member."""
    spark = members.sparkSession

    @F.pandas_udf("bigint")
    def slot(ids: pd.Series) -> pd.Series:
        return pd.Series(_slots(ids.to_numpy(np.int64)))

    filled = (members.filter(F.col(column).isNotNull()).select(slot(F.col(column).cast("bigint")).alias("slot"))
              .groupBy(F.expr("slot div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 AS int)))").alias("v")).toArrow())
    table = np.zeros(1 << (BITS - 6), np.int64)
    table[filled.column("at").to_numpy()] = filled.column("v").to_numpy()
    known = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def test(ids: pd.Series) -> pd.Series:
        slots = _slots(ids.to_numpy(np.int64))
        return pd.Series((known.value[slots >> 6] >> (slots & 63)) & 1 == 1)

    def check(ids: Column) -> Column:
        return ids.isNotNull() & test(F.coalesce(ids.cast("bigint"), F.lit(0)))

    return check


def without(df: DataFrame, column: str, removed: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not among ``removed`` (same column name); null stays. Only rows that may be removed are shuffled."""
    maybe = maybe_in(removed, column)(F.col(column))
    return df.filter(~maybe).unionByName(df.filter(maybe).join(removed.select(column).distinct(), column, "left_anti").select(df.columns))
