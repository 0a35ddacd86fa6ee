"""Stored silver and gold: load by load they equal a full build, and only what changed is written."""

import datetime as dt
import random

import pytest
from pyspark.sql import types as T

from monthgrid.catalog import Domain
from monthgrid.plans.medallion import gold, silver
from monthgrid.plans.stored import StoredDomain, StoredMart, read_range
from monthgrid.session import new_path

OIL = Domain(columns={"wti_price": "W", "brent_price": "B", "us_production": "P"}, price="wti_price", change="wti_mom_change", spread=("brent_price", "wti_price"))
GAS = Domain(columns={"henry_hub_price": "H", "us_storage_bcf": "S", "us_production": "Q"}, price="henry_hub_price", change="price_mom_change")
OBS = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("period", T.DateType()), T.StructField("value", T.DoubleType()), T.StructField("ingested_at", T.TimestampType())])


def rows(rng, series, n, first=2015, last=2019):
    return [(rng.choice(series), dt.date(rng.randint(first, last), rng.randint(1, 12), rng.randint(1, 28)), float(rng.randint(-3, 900)) / 4,
             dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 40))) for _ in range(n)]


def table(df):
    return sorted(map(str, df.collect()))


def test_loads_in_any_order_equal_one_build(spark):
    rng = random.Random(8)
    oil, gas = (StoredDomain(spark, new_path(spark, "d"), d) for d in (OIL, GAS))
    mart = StoredMart(oil, gas, new_path(spark, "m"))
    seen = {"o": [], "g": []}
    for k in range(3):
        for store, key, series in ((oil, "o", "WBPx"), (gas, "g", "HSQ")):
            new = rows(rng, series, 250 if k == 0 else 9)
            seen[key] += new
            store.load(spark.createDataFrame(new, OBS), k)
        mart.refresh()
    o, g = (silver(spark.createDataFrame(seen[k], OBS), d) for k, d in (("o", OIL), ("g", GAS)))
    assert table(oil.read()) == table(o) and table(gas.read()) == table(g)
    assert table(mart.read()) == table(gold(o, g).select(*mart.read().columns))
    assert mart.refresh() == [] and oil.load(spark.createDataFrame(rows(rng, "WBP", 50), OBS), 2) == []  # a repeated load


def test_a_late_row_rewrites_only_the_years_it_changes(spark):
    store = StoredDomain(spark, new_path(spark, "d"), OIL)
    at = dt.datetime(2020, 1, 1)
    first = [(s, dt.date(y, m, 1), 50.0 + m, at) for s in "WBP" for y in range(2015, 2020) for m in range(1, 13)]
    assert store.load(spark.createDataFrame(first, OBS), 0) == [2015, 2016, 2017, 2018, 2019]
    late = [("P", dt.date(2017, 5, 9), 70.0, at + dt.timedelta(days=1))]
    assert store.load(spark.createDataFrame(late, OBS), 1) == [2017]
    december = [("W", dt.date(2016, 12, 9), 71.0, at + dt.timedelta(days=1))]
    assert store.load(spark.createDataFrame(december, OBS), 2) == [2016, 2017]  # January looks back on it
    old = [("W", dt.date(2016, 12, 9), 99.0, at - dt.timedelta(days=1))]
    assert store.load(spark.createDataFrame(old, OBS), 3) == []  # an older delivery changes nothing
    everything = spark.createDataFrame(first + late + december + old, OBS)
    assert table(store.read()) == table(silver(everything, OIL).select(*store.read().columns))


def test_a_range_read_opens_its_years(spark, capsys):
    store = StoredDomain(spark, new_path(spark, "d"), OIL)
    store.load(spark.createDataFrame([("W", dt.date(y, 6, 1), 5.0, dt.datetime(2020, 1, 1)) for y in range(2010, 2020)], OBS), 0)
    part = store.read("2012-06-01", "2014-05-31")
    assert [r["period"].year for r in part.orderBy("period").collect()] == [2012, 2013]
    part.explain()
    text = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year" in text and "PushedFilters: [IsNotNull(period), GreaterThanOrEqual(period,2012-06-01)" in text
    assert store.read().count() == 10 and "year" not in store.read().columns


def test_an_empty_first_load(spark):
    store = StoredDomain(spark, new_path(spark, "d"), OIL)
    store.load(spark.createDataFrame([], OBS), 0)
    with pytest.raises(Exception):
        read_range(spark, f"{store.folder}/nothing")
