"""Least squares per group: the sums run on Spark, only the small systems are solved in Python.

A group's rows reduce to their means and k x k covariances by a mergeable aggregate, so a group never
has to fit into one task; what reaches Python is one short array per group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def moments(rows: DataFrame, by: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """``(*by, means, cov, n)`` per group, over rows without a NULL.

    ``means`` of ``xs`` and then ``y``; ``cov`` the upper triangle of their population covariances. Both merge without losing
    digits where values lie far from zero, which raw sums of products do.
    """
    v = [F.col(c) for c in (*xs, y)]
    full = rows.filter(F.array_size(F.filter(F.array(*v), lambda x: x.isNull())) == 0)
    pairs = [(i, j) for i in range(len(v)) for j in range(i, len(v))]
    g = full.groupBy(*by).agg(*[F.avg(x).alias(f"_m{i}") for i, x in enumerate(v)],
                              *[F.covar_pop(v[i], v[j]).alias(f"_c{i}_{j}") for i, j in pairs], F.count(F.lit(1)).alias("n"))
    return g.select(*by, F.array(*[f"_m{i}" for i in range(len(v))]).alias("means"), F.array(*[f"_c{i}_{j}" for i, j in pairs]).alias("cov"), "n")


#: Least eigenvalue of the columns' correlation matrix below which they count as collinear.
COLLINEAR = 1e-10


def solver(k: int, penalty: Sequence[float] | None = None):
    """A UDF solving the centred systems of a batch of groups: ``(means, cov, n) -> {beta, sigma, error}``.

    ``k`` counts the constant. ``penalty`` adds to the diagonal of chosen columns (the constant's is ignored). A column that does
    not vary gets weight 0. Too few rows or collinear columns give NULL and an ``error``, for that group alone.
    """
    m = k - 1
    upper = np.triu_indices(k)
    extra = np.zeros(m) if penalty is None else np.asarray(penalty, dtype=float)[1:]
    schema = T.StructType([T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType()), T.StructField("error", T.StringType())])

    def one(mean, cov, n):
        if n - k <= 1:
            return None, None, "not enough months to fit"
        c = np.zeros((k, k))
        c[upper] = cov
        c = (c + np.triu(c, 1).T) * n
        a, b = c[:m, :m] + np.diag(extra), c[:m, m]
        scale = np.sqrt(np.diag(a))
        used = scale > 1e-12 * max(1.0, float(np.abs(mean[:m]).max(initial=0.0)))
        beta = np.zeros(m)
        if used.any():
            r = a[np.ix_(used, used)] / np.outer(scale[used], scale[used])
            if np.linalg.eigvalsh(r)[0] < COLLINEAR:
                return None, None, "collinear columns"
            beta[used] = np.linalg.solve(r, b[used] / scale[used]) / scale[used]
        rest = c[m, m] - 2 * beta @ b + beta @ c[:m, :m] @ beta
        return [float(mean[m] - beta @ mean[:m]), *beta.tolist()], float(np.sqrt(max(rest, 0.0) / (n - k))), None

    @F.pandas_udf(schema)
    def solve(means: pd.Series, cov: pd.Series, n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(np.asarray(x), np.asarray(c), int(i)) for x, c, i in zip(means, cov, n)], columns=["beta", "sigma", "error"])

    return solve


def fit_ols(rows: DataFrame, by: Sequence[str], y: str, xs: Sequence[str], penalty: Sequence[float] | None = None) -> DataFrame:
    """``(*by, beta, sigma, n, error)``: constant first, then ``xs``. ``beta`` is NULL where ``error`` says why."""
    solve = solver(len(xs) + 1, penalty)
    return moments(rows, by, y, xs).select(*by, "n", solve("means", "cov", "n").alias("_f")).select(
        *by, "_f.beta", F.when(~F.isnan("_f.sigma"), F.col("_f.sigma")).alias("sigma"), "n", "_f.error")


def dot(beta: str, xs: Sequence[str]) -> Column:
    """Constant plus the weighted columns."""
    total = F.col(beta)[0]
    for i, c in enumerate(xs):
        total = total + F.col(beta)[i + 1] * F.col(c)
    return total
