"""Mergeable summaries, clustering along a Z curve, bucketed tables, trends."""

import datetime as dt
import glob
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewell.operators.zorder import z_ordered
from tidewell.plans import gold, reports, summaries
from tidewell.sources import colocated

FIRST = dt.date(2024, 1, 1)


def days(spark, values, columns="user_id string, date date, value double"):
    return spark.createDataFrame([(u, FIRST + dt.timedelta(days=d), v) for u, d, v in values], columns)


def test_merged_quantiles_are_within_their_bound(spark, workspace):
    r = random.Random(3)
    rows = days(spark, [(f"u{i % 7}", i % 170, r.lognormvariate(3, 1) if i % 50 else None) for i in range(30_000)])
    summaries.quantile_sketches(rows, "value").write.parquet(workspace)
    shares = {f"p{n}": n / 100 for n in (1, 25, 50, 75, 99)}
    merged = summaries.merged_quantiles(spark.read.parquet(workspace), [], shares)
    assert merged.first()["readings"] == rows.where("value is not null").count()
    for row in summaries.ranks_of(rows, "value", merged, shares).collect():
        assert row["below"] <= row["share"] + summaries.rank_error() and row["up_to"] >= row["share"] - summaries.rank_error()


def test_quantiles_of_some_months(spark):
    rows = days(spark, [("a", d, float(d)) for d in range(90)] + [("b", 3, None), ("c", 40, 1.5)])
    sketches = summaries.quantile_sketches(rows, "value")
    february = summaries.merged_quantiles(sketches, ["user_id"], {"median": 0.5, "most": 1.0}, dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert {tuple(r) for r in february.collect()} == {("a", 29, 45.0, 59.0), ("c", 1, 1.5, 1.5)}
    assert summaries.merged_quantiles(sketches.limit(0), [], {"median": 0.5}).collect() == []


def test_numbers_stay_and_new_users_get_the_next(spark):
    first = days(spark, [(f"u{i}", 0, 0.0) for i in range(500)] + [(None, 0, 0.0), ("u1", 1, 0.0)])
    once = summaries.numbered(first)
    known = {r["user_id"]: r["number"] for r in once.collect()}
    assert len(known) == 500 == len(set(known.values()))
    again = {r["user_id"]: r["number"] for r in summaries.numbered(days(spark, [(f"u{i}", 0, 0.0) for i in range(400, 700)]), once).collect()}
    assert len(again) == 700 == len(set(again.values())) and known.items() <= again.items()
    assert max(again.values()) < 700 * 3  # close together, so that bitmaps are


def test_daily_bitmaps_add_up(spark):
    r = random.Random(5)
    rows = days(spark, [(f"u{r.randrange(300)}", r.randrange(45), 0.0) for _ in range(4000)])
    numbers = summaries.numbered(rows).withColumn("number", F.col("number") * 101)  # several bitmaps a day
    daily = summaries.daily_users(rows, numbers, "t")
    assert daily.select("bucket").distinct().count() > 1
    for period in ("day", "week", "month"):
        first = F.col("date") if period == "day" else F.date_trunc(period, "date").cast("date")
        want = rows.groupBy(first.alias("first_day")).agg(F.count_distinct("user_id").alias("users"))
        got = summaries.distinct_users(daily, period)
        assert {tuple(x) for x in got.select("first_day", "users").collect()} == {tuple(x) for x in want.collect()}


def test_files_along_the_curve_serve_both_filters(spark, workspace):
    rows = days(spark, [(f"u{u:04d}", d, 0.0) for u in range(400) for d in range(120)] + [(None, 1, 0.0)] + [("hot", d % 120, 0.0) for d in range(20_000)])
    z_ordered(rows, ["user_id", "date"], files=32).write.parquet(workspace)
    assert spark.read.parquet(workspace).exceptAll(rows).count() == 0 and spark.read.parquet(workspace).count() == rows.count()
    files = [pq.ParquetFile(p).metadata for p in glob.glob(f"{workspace}/*.parquet")]
    assert len(files) == 32

    def needed(column, value):
        spans = [[m.row_group(g).column(column).statistics for g in range(m.num_row_groups)] for m in files]
        return sum(any(s.min <= value <= s.max for s in groups) for groups in spans)

    for user in ("u0000", "u0123", "u0399"):
        assert needed(0, user) <= 16  # a third of all rows are those of one user
    for day in (0, 60, 119):
        assert needed(1, FIRST + dt.timedelta(days=day)) <= 16


@pytest.fixture
def bucketed(spark, workspace):
    r = random.Random(8)
    database = colocated.create_database(spark, f"check_{workspace.rsplit('-', 1)[1]}", workspace)
    hrv = days(spark, [(f"u{u}", d, r.uniform(20, 90) if d % 9 else None) for u in range(40) for d in range(30) if (u + d) % 5], "user_id string, date date, hrv_rmssd_ms double")
    sleep = hrv.where("datediff(date, '2024-01-01') % 7 <> 2").select("user_id", "date", *(F.lit(7.5).alias(c) for c in gold.SLEEP_INPUTS))
    sleep = sleep.unionByName(sleep.limit(1).withColumn("date", F.lit(dt.date(2025, 1, 1))))
    colocated.save_by_user(hrv, f"{database}.hrv")
    colocated.save_by_user(sleep, f"{database}.sleep")
    yield database, hrv, sleep
    spark.sql(f"DROP DATABASE `{database}` CASCADE")


def test_bucketed_tables_need_no_exchange(spark, bucketed):
    database, hrv, sleep = bucketed
    joined = colocated.paired(spark, f"{database}.hrv", f"{database}.sleep", ["hrv_rmssd_ms"], gold.SLEEP_INPUTS)
    got = gold.recovery_columns(gold.with_components(gold.with_baselines(joined)))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange", text), text
    assert "Window" in text and "FileScan" in text
    want = gold.daily_recovery(hrv, sleep)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count() and want.count() > 500
    metrics = gold.sleep_metrics(spark.table(f"{database}.sleep"))
    assert "Exchange" not in metrics._jdf.queryExecution().executedPlan().toString()


def test_saving_again_replaces_a_table(spark, bucketed):
    database, hrv, _ = bucketed
    colocated.save_by_user(hrv.where("user_id = 'u1'"), f"{database}.hrv")
    assert spark.table(f"{database}.hrv").select("user_id").distinct().collect() == [("u1",)]
    files = glob.glob(spark.sql(f"DESCRIBE EXTENDED {database}.hrv").where("col_name = 'Location'").first()[1].removeprefix("file:") + "/*.parquet")
    assert len(files) <= colocated.BUCKETS


def trend(spark, nights):
    rows = days(spark, nights, "user_id string, date date, total_sleep_hours double")
    return {(r["user_id"], (r["week"] - FIRST).days // 7): (r["weeks"], r["slope"], r["trend"]) for r in reports.weekly_sleep_trend(rows).collect()}


def test_weekly_trend_keeps_the_distance_of_weeks(spark):
    """FIRST is a Monday."""
    nights = [("a", 7 * w + d, 6.0 + w + d / 10) for w in range(6) for d in (0, 3)]
    nights += [("gap", 0, 6.0), ("gap", 21, 9.0), ("gap", 56, 8.0), ("gap", 63, None), ("level", 0, 7.0), ("level", 7, 7.0), ("down", 1, 8.0), ("down", 10, 7.5)]
    got = trend(spark, nights)
    assert got["a", 0] == (1, None, None) and got["a", 1] == (2, 1.0, "Improving") and got["a", 5] == (4, 1.0, "Improving")
    assert got["gap", 3] == (2, 1.0, "Improving")  # three weeks apart
    assert got["gap", 8] == (1, None, None) and ("gap", 9) not in got  # out of reach; a week without a value
    assert got["level", 1] == (2, 0.0, "Declining") and got["down", 1] == (2, -0.5, "Declining")


def test_sample_is_the_newest(spark):
    rows = days(spark, [(f"u{u}", d, 1.0) for u in range(4) for d in range(3)]).withColumns({"recovery_score": F.lit(1), "recovery_state": F.lit("Red"), "hrv_component": F.lit(1.0)})
    assert [(r["user_id"], r["date"].day) for r in reports.recovery_sample(rows).collect()] == [("u0", 3), ("u1", 3), ("u2", 3), ("u3", 3), ("u0", 2)]
