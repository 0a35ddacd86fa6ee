from dataclasses import replace

import numpy as np
import pytest

from monthgrid.operators.evaluate import error_metrics
from monthgrid.plans.features import strict_measures
from monthgrid.plans.trees import (FEATURES, SWEEP, TreeConfig, between, chosen, fit_trees, importances, predict_trees, sweep,
                                   training_rows, wide_rows)
from monthgrid.session import stage

T = np.arange(72)
QUICK = TreeConfig("quick", trees=8, rate=0.3)


@pytest.fixture(scope="module")
def rows(monthly):
    rng = np.random.default_rng(2)
    data = {f"s{k}": list((k + 1) * (100 + 0.5 * T + 20 * np.sin(2 * np.pi * T / 12) + rng.normal(0, 1, 72))) for k in range(4)}
    return stage(training_rows(strict_measures(monthly(data))), "rows")


def test_rows_start_after_a_full_year(rows):
    assert rows.count() == 4 * 60
    assert rows.select("features").first()["features"].size == len(FEATURES)


def test_pooled_model_beats_the_yearly_mean(spark, rows):
    train, test = between(rows, "2018-01-01", "2022-12-01"), between(rows, "2023-01-01", "2023-12-01")
    model = fit_trees(train, QUICK)
    p = predict_trees(model, test, "quick")
    got = error_metrics(p, ["config"], "value", "forecast").first()
    naive = error_metrics(test.withColumnRenamed("scale", "forecast"), [], "value", "forecast").first()
    assert got["n_periods"] == 48 and got["mape"] < naive["mape"] / 2
    imp = importances(model, spark).collect()
    assert len(imp) == len(FEATURES) and sum(r["importance"] for r in imp) == pytest.approx(1)


def test_sweep_scores_every_setting(rows):
    assert [c.label for c in SWEEP].count("baseline") == 1 and len(SWEEP) == 8
    quick = [replace(c, trees=3) for c in SWEEP[:2]]
    assert [c.trees for c in quick] == [3, 3]
    s = sweep(between(rows, "2018-01-01", "2022-12-01"), between(rows, "2023-01-01", "2023-12-01"), quick)
    assert {r["config"] for r in s.collect()} == {"baseline", "depth 3"}
    assert chosen(s).first()["config"] in ("baseline", "depth 3")


def test_wide_rows_drop_incomplete_months(spark):
    wide = spark.createDataFrame([(1.0, None, 3.0), (1.0, 2.0, 3.0), (1.0, 2.0, None)], "y double, a double, b double").withColumn(
        "period", __import__("pyspark.sql.functions", fromlist=["x"]).current_date())
    assert wide_rows(wide, "y", ["a", "b"]).count() == 1


def test_registry_keeps_versions_and_loaded_trees_forecast_the_same(spark, monthly):
    import datetime as dt

    from monthgrid.plans.models import ModelRegistry
    from monthgrid.session import new_path
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(200).selectExpr("cast(id % 2 as string) AS series", "date'2020-01-01' AS period", "cast(id % 17 + 1 as double) AS value", "1.0D AS scale",
                                       "cast(id % 17 + 1 as double) AS label", "cast(id % 17 as double) AS x", "cast(id % 5 as double) AS y")
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(rows)
    registry = ModelRegistry(spark, new_path(spark, "models"))
    assert registry.models().count() == 0
    day = dt.date(2024, 1, 1)
    small, large = (fit_trees(rows, TreeConfig(trees=n, depth=2)) for n in (3, 9))
    assert [registry.save(m, "trees", "all", day) for m in (small, large)] == [1, 2]
    assert registry.save(spark.range(3), "table", "a", day) == 1
    assert registry.save(small, "trees", "all", dt.date(2023, 1, 1)) == 1
    values = lambda m: sorted((r["value"], r["forecast"]) for r in predict_trees(m, rows, "t").collect())
    assert values(registry.load("trees", "all")) == values(large) != values(small)
    assert values(registry.load("trees", "all", day, 1)) == values(registry.load("trees", "all", dt.date(2023, 1, 1))) == values(small)
    assert registry.load("table", "a").count() == 3 and registry.models().count() == 4
    with pytest.raises(LookupError):
        registry.load("trees", "none")
    with pytest.raises(ValueError):
        registry.save(VectorAssembler(inputCols=["x"]), "v", "all", day)


def test_forecasts_equal_the_exported_splits(spark):
    """Every tree walked by hand: the weighted sum of its leaves is the model's value."""
    import re

    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(
        spark.range(300).selectExpr("cast((id * 7) % 31 as double) AS x", "cast((id * 13) % 19 as double) AS y", "sin(id) + (id * 7) % 31 AS label"))
    model = fit_trees(rows, TreeConfig(trees=12, depth=3))

    def leaf(lines, v):
        depth = None
        for line in lines:
            indent = len(line) - len(line.lstrip())
            if depth is not None and indent > depth:
                continue  # inside a branch not taken
            depth = None
            if (hit := re.match(r"\s*(If|Else) \(feature (\d+) (<=|>) ([-0-9.Ee]+)\)", line)):
                _, k, op, cut = hit.groups()
                if (v[int(k)] <= float(cut)) != (op == "<="):
                    depth = indent
            elif (hit := re.match(r"\s*Predict: ([-0-9.Ee]+)", line)):
                return float(hit.group(1))
        raise AssertionError(lines)

    trees = [t.toDebugString.splitlines()[1:] for t in model.trees]
    for r in model.transform(rows).select("x", "y", "prediction").limit(60).collect():
        want = sum(w * leaf(t, (r["x"], r["y"])) for w, t in zip(model.treeWeights, trees))
        assert r["prediction"] == pytest.approx(want, rel=1e-9)
