"""Streams must end in what one batch over the same rows gives, late and repeated rows included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrid.session import new_path
from monthgrid.streaming.ingest import daily_means, exact_once, landed, late_rows, monthly_means, run_once, state_rows, stream_into_table
from monthgrid.streaming.keyed import KeyedTable
from monthgrid.streaming.payloads import VERDICTS, PayloadTable, entries, landed_lines

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("series", T.StringType()), T.StructField("value", T.DoubleType())])
MEANS = T.StructType([T.StructField("series", T.StringType()), T.StructField("period", T.DateType()),
                      T.StructField("n", T.LongType()), T.StructField("mean_value", T.DoubleType())])
KEYS = ["series", "period"]


@pytest.fixture
def rows():
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    out = [(i, start + dt.timedelta(hours=7 * i), rng.choice("abc"), float(rng.randrange(100))) for i in range(180)]
    rng.shuffle(out)  # files arrive in no order of time
    return out


def land(spark, path, rows, files):
    for part in range(files):
        spark.createDataFrame(rows[part::files], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def table(df):
    return sorted((r["series"], r["period"], r["n"], round(r["mean_value"], 9)) for r in df.collect())


@pytest.mark.parametrize("transform", [daily_means, monthly_means])
def test_stream_equals_batch_with_late_files(spark, rows, transform):
    path = new_path(spark, "landing")
    land(spark, path, rows, 4)
    got = stream_into_table(transform(landed(spark, path, SCHEMA, files_per_trigger=1)), "t", MEANS, KEYS)
    assert table(got) == table(transform(spark.createDataFrame(rows, SCHEMA)))


def test_second_run_goes_on_where_the_first_stopped(spark, rows):
    path, folder = new_path(spark, "landing"), new_path(spark, "stream")
    land(spark, path, rows[:100], 1)
    first = stream_into_table(monthly_means(landed(spark, path, SCHEMA)), "t", MEANS, KEYS, folder=folder)
    assert sum(r["n"] for r in first.collect()) == 100
    land(spark, path, rows[100:], 1)
    second = stream_into_table(monthly_means(landed(spark, path, SCHEMA)), "t", MEANS, KEYS, folder=folder)
    assert table(second) == table(monthly_means(spark.createDataFrame(rows, SCHEMA)))
    again = stream_into_table(monthly_means(landed(spark, path, SCHEMA)), "t", MEANS, KEYS, folder=folder)
    assert table(again) == table(second)


def test_redelivered_rows_count_once(spark, rows):
    path = new_path(spark, "landing")
    land(spark, path, rows + rows[:50], 3)
    schema = T.StructType([T.StructField("series", T.StringType()), T.StructField("period", T.DateType()), T.StructField("n", T.LongType())])
    once = exact_once(landed(spark, path, SCHEMA), ["id"], "ts")
    days = once.groupBy("series", F.col("ts").cast("date").alias("period")).agg(F.count(F.lit(1)).alias("n"))
    got = stream_into_table(days, "t", schema, KEYS)
    assert sum(r["n"] for r in got.collect()) == len(rows)


DAY = T.StructType([T.StructField("series", T.StringType()), T.StructField("period", T.DateType()), T.StructField("at", T.LongType()), T.StructField("value", T.DoubleType())])


def day_rows(rng, n):
    return [(rng.choice("ab"), rng.choice([None, dt.date(rng.randint(2019, 2022), rng.randint(1, 12), 1)]), rng.choice([None, rng.randrange(50)]), float(i)) for i in range(n)]


@pytest.mark.parametrize("order, by", [([], None), ([], "period"), (["at"], "period")])
def test_keyed_table_equals_one_reduction_and_stays_small(spark, order, by):
    rng = random.Random(9)
    table = KeyedTable(spark, new_path(spark, "keyed"), DAY, KEYS, order, by, merge_every=3)
    want, folders = {}, []
    for k in range(20):
        rows = day_rows(rng, rng.choice([0, 5, 12]))
        batch = spark.createDataFrame(rows, DAY)
        table.upsert(batch, k)
        if k % 4 == 0:
            table.upsert(spark.createDataFrame(day_rows(rng, 3), DAY), k)  # repeated after its commit: changes nothing
        for s, p, at, v in rows:
            rank = ((-1 if at is None else at) if order else 0, k, (at is not None, at or 0, v))
            if (s, p) not in want or rank >= want[s, p][0]:
                want[s, p] = (rank, at, v)
        folders.append(sum(e.kind in ("base", "delta") for e in table.entries()))
    got = {(r["series"], r["period"]): (r["at"], r["value"]) for r in table.read().collect()}
    assert got == {key: w[1:] for key, w in want.items()}
    parts = 5 if by else 1
    assert max(folders) <= parts + 2 and table.last_batch() == 19
    assert table.read().columns == DAY.fieldNames()


def test_a_read_of_some_years_opens_only_their_parts(spark):
    table = KeyedTable(spark, new_path(spark, "keyed"), DAY, KEYS, by="period", merge_every=1)
    table.upsert(spark.createDataFrame([("a", dt.date(y, 1, 1), 1, float(y)) for y in range(2010, 2020)], DAY), 0)
    some = table.read(2012, 2014)
    assert sorted(r["value"] for r in some.collect()) == [2012.0, 2013.0, 2014.0]
    assert all(any(f"_part={y}" in f for y in (2012, 2013, 2014)) for f in some.inputFiles())


def test_a_batch_interrupted_before_its_commit_is_written_again(spark):
    table = KeyedTable(spark, new_path(spark, "keyed"), DAY, KEYS)
    spark.createDataFrame([("a", dt.date(2020, 1, 1), 1, 1.0)], DAY).write.parquet(f"{table.folder}/delta/batch=0")
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([("a", dt.date(2020, 1, 1), 1, 2.0)], DAY), 0)
    assert [r["value"] for r in table.read().collect()] == [2.0]


def test_state_stops_growing(spark):
    """Twenty files, each a month on: only the last months are held as state, and rows that come too late are counted."""
    path, folder = new_path(spark, "landing"), new_path(spark, "stream")
    for m in range(20):
        at = dt.datetime(2020 + m // 12, m % 12 + 1, 1)
        spark.createDataFrame([(i, at + dt.timedelta(days=i), s, 1.0) for i in range(20) for s in "abc"], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    table = KeyedTable(spark, f"{folder}/table", MEANS, KEYS)
    progress = run_once(monthly_means(landed(spark, path, SCHEMA, files_per_trigger=1)), table.upsert, f"{folder}/checkpoint")
    assert len(state_rows(progress)) >= 20 and max(state_rows(progress)) <= 3 * 4 and late_rows(progress) == 0
    assert sum(r["n"] for r in table.read().collect()) == 20 * 60
    spark.createDataFrame([(1, dt.datetime(2020, 1, 5), "a", 1.0)], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    again = run_once(monthly_means(landed(spark, path, SCHEMA)), table.upsert, f"{folder}/checkpoint")
    assert late_rows(again) == 1 and sum(r["n"] for r in table.read().collect()) == 20 * 60


def payload_lines():
    """(line, verdicts) of every shape a payload takes."""
    good = '{{"observations":[{{"date":"{}","value":"{}"}},{{"date":"{}","value":"."}}]}}'
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=11 * k) for k in range(40)]
    out = [(f"{s}\t" + good.format(d, i, d + dt.timedelta(days=1)), d) for i, d in enumerate(days) for s in ("a", "b")]
    random.Random(3).shuffle(out)
    return out, ['a\t{"observations":[{"da', 'a\t', 'no tab at all', 'b\t{"observations":[]}', 'b\t{"error_code":400}', 'a\t{"observations":[{"date":"soon","value":"1"}]}', "\t[1]"]


def test_payloads_in_any_order_end_in_the_batch_result(spark):
    good, odd = payload_lines()
    path = new_path(spark, "landing")
    text = [g for g, _ in good] + odd
    for part in range(7):
        spark.createDataFrame([(x,) for x in text[part::7]], "value string").coalesce(1).write.mode("append").text(path)
    out = PayloadTable(spark, new_path(spark, "payloads"), merge_every=2)
    out.run(landed_lines(spark, path, 1))
    ledger = out.ledger().collect()
    assert len(ledger) == 7 and all(r["landed"] == sum(r[v] for v in VERDICTS) for r in ledger)
    total = {v: sum(r[v] for r in ledger) for v in VERDICTS}
    assert total["kept"] + total["late"] == 80 and total["late"] > 0 and total["missing"] == 81
    assert total["quarantined"] == out.side("quarantined").count() and total["empty"] >= 2
    assert total["late"] == out.side("late").count()
    batch = entries(spark.createDataFrame([(x,) for x in text], "value string")).filter("verdict = 'kept'").select("series_id", "period", "value")
    want = sorted(map(tuple, batch.collect()))
    assert sorted(map(tuple, out.read(late=True).collect())) == want
    assert out.read().count() == total["kept"]
    out.run(landed_lines(spark, path, 1))  # nothing new
    assert out.ledger().count() == 7


def test_a_judged_batch_repeats_without_effect(spark):
    good, _ = payload_lines()
    out = PayloadTable(spark, new_path(spark, "payloads"))
    df = spark.createDataFrame([(g,) for g, _ in good[:20]], "value string")
    out.ingest(df, 0)
    first = sorted(map(tuple, out.read().collect()))
    out.ingest(df.limit(3), 0)
    assert sorted(map(tuple, out.read().collect())) == first
    assert out.side("late").count() == 0


def test_monthly_response_payloads(spark):
    from monthgrid.sources.payloads import RESPONSE_SCHEMA

    df = spark.createDataFrame([('s\t{"response":{"data":[{"period":"2020-03","value":1.5},{"period":null,"value":2}]}}',), ('s\t{"response":{}}',)], "value string")
    got = sorted((r["verdict"], str(r["period"]), r["value"]) for r in entries(df, RESPONSE_SCHEMA).collect())
    assert got == [("empty", "None", None), ("kept", "2020-03-01", 1.5), ("missing", "None", 2.0)]
