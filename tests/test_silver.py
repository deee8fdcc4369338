"""Cleaning: duplicates, bounds, quarantine, transforms."""

import json

import pytest
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.functions.bounds import ACTIVITY_BOUNDS, BOUND_REASONS, HRV_BOUNDS, SLEEP_BOUNDS
from tidewell.operators.latest import latest_per_key
from tidewell.operators.validate import (
    pass_rate,
    rejection_rate,
    rule_counts,
    rule_violations,
    split_by_bounds,
    union_all,
    with_rejection_reason,
)
from tidewell.plans import silver

HRV_LAYOUT = "reading_id string, user_id string, date string, hrv_rmssd_ms double, hrv_sdnn_ms double, respiratory_rate_brpm double, is_anomaly boolean, ingested_at string, _ingestion_run_id string, _ingest_timestamp timestamp_ntz"


def hrv_rows(spark, *rows):
    import datetime as dt

    start = dt.datetime(2024, 1, 1)
    full = [
        (
            r.get("id", f"r{i}"),
            r.get("user", "u1"),
            r.get("date", "2024-01-01"),
            r.get("rmssd", 50.0),
            r.get("sdnn", 90.0),
            r.get("resp", 14.0),
            r.get("anomaly", False),
            r.get("at", "2024-01-01"),
            "run",
            start + dt.timedelta(minutes=r.get("minute", 0)),
        )
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, HRV_LAYOUT)


def test_bound_registry():
    columns = [c for b in (HRV_BOUNDS, SLEEP_BOUNDS, ACTIVITY_BOUNDS) for c in b]
    assert len(columns) == len(set(columns)) == 11
    for bounds in (HRV_BOUNDS, SLEEP_BOUNDS, ACTIVITY_BOUNDS):
        for column, (low, high) in bounds.items():
            assert low < high
            assert all(BOUND_REASONS[column]) and len(BOUND_REASONS[column]) == 2


def test_latest_row_wins_and_ties_are_stable(spark):
    df = hrv_rows(
        spark,
        dict(id="a", rmssd=1.0, minute=0),
        dict(id="a", rmssd=2.0, minute=5),
        dict(id="b", rmssd=3.0, minute=1, at="1"),
        dict(id="b", rmssd=4.0, minute=1, at="2"),
        dict(id="c", rmssd=5.0),
        dict(id="c", rmssd=6.0),
    )
    got = {r.reading_id: r.hrv_rmssd_ms for r in latest_per_key(df, "reading_id").collect()}
    assert got["a"] == 2.0 and got["b"] == 4.0
    again = {r.reading_id: r.hrv_rmssd_ms for r in latest_per_key(df.repartition(3), "reading_id").collect()}
    assert got == again


def test_rows_without_key(spark):
    df = hrv_rows(spark, dict(id=None, rmssd=1.0), dict(id=None, rmssd=2.0), dict(id="x"))
    assert latest_per_key(df, "reading_id").count() == 2
    assert latest_per_key(df, "reading_id", null_keys_match=False).count() == 3


def test_split_keeps_limits_and_nulls_and_names_every_breach(spark):
    df = hrv_rows(
        spark,
        dict(id="low", rmssd=5.0),
        dict(id="high", rmssd=250.0),
        dict(id="none", rmssd=None),
        dict(id="two", rmssd=300.5, resp=35.0),
        dict(id="one", sdnn=9.9),
    )
    valid, bad = split_by_bounds(df, HRV_BOUNDS, "reading_id", "bronze.hrv_readings")
    assert {r.reading_id for r in valid.collect()} == {"low", "high", "none"}
    reasons = {r.record_id: r for r in bad.collect()}
    assert reasons["two"].rejection_reason == (
        "hrv_rmssd_ms out of range [5,250]: 300.5; respiratory_rate_brpm out of range [8,30]: 35.0"
    )
    assert reasons["one"].rejection_reason == "hrv_sdnn_ms out of range [10,400]: 9.9"
    assert json.loads(reasons["two"].raw_record)["hrv_rmssd_ms"] == 300.5
    assert bad.columns == schemas.QUARANTINE.names


def test_sleep_limits_print_as_floats(spark):
    df = spark.sql("select 's1' as record_id, 'u' as user_id, '2024-01-01' as date, 15.5D as total_sleep_hours")
    _, bad = split_by_bounds(df, SLEEP_BOUNDS, "record_id", "bronze.sleep_records")
    assert bad.first().rejection_reason == "total_sleep_hours out of range [1.0,14.0]: 15.5"


def test_rejection_rate_also_of_nothing(spark):
    df = hrv_rows(spark, dict(), dict(rmssd=1.0), dict(), dict())
    row = rejection_rate(with_rejection_reason(df, HRV_BOUNDS), "t").first()
    assert (row.valid_count, row.invalid_count, row.rejection_pct) == (3, 1, 25.0)
    empty = rejection_rate(with_rejection_reason(df.limit(0), HRV_BOUNDS), "t").first()
    assert (empty.valid_count, empty.invalid_count, empty.rejection_pct) == (0, 0, None)


def test_hrv_transform(spark):
    df = hrv_rows(spark, dict(id="a", rmssd=50.128), dict(id="b", anomaly=True), dict(id="c", anomaly=None))
    rows = silver.transform_hrv(df).collect()
    assert [r.reading_id for r in rows] == ["a"]
    assert rows[0].hrv_rmssd_ms == 50.13
    assert str(rows[0].date) == "2024-01-01"


def test_sleep_transform(spark):
    df = spark.sql(
        "select '2024-01-02' as date, 7.51D as total_sleep_hours, 100D as rem_sleep_minutes, 80D as deep_sleep_minutes, false as is_anomaly"
        " union all select '2024-01-02', 0D, 0D, 0D, false"
    )
    rows = silver.transform_sleep(df).orderBy("total_sleep_hours").collect()
    assert (rows[0].total_sleep_minutes, rows[0].rem_pct) == (0.0, None)
    assert (rows[1].total_sleep_minutes, rows[1].rem_pct, rows[1].deep_pct) == (451.0, 22.2, 17.7)


def test_activity_transform(spark):
    zones = ", ".join(f"{v} as zone{i}_minutes" for i, v in enumerate([10, 5, "cast(null as int)", 1, 0, 0], start=1))
    row = silver.transform_activity(spark.sql(f"select '2024-01-02' as date, 'HIIT' as workout_type, {zones}")).first()
    assert (row.total_zone_minutes, row.workout_type) == (16, "Hiit")


def test_a_date_that_is_none_goes_to_quarantine(spark):
    df = hrv_rows(spark, dict(id="a", date="yesterday"), dict(id="b", date="yesterday", rmssd=1.0), dict(id="c"))
    assert [r.reading_id for r in silver.clean(df, silver.HRV).collect()] == ["c"]
    reasons = {r.reading_id: r._rejection_reason for r in silver.judged(df, silver.HRV).collect()}
    assert reasons["a"] == "date is not a calendar day: yesterday"
    assert reasons["b"] == "hrv_rmssd_ms out of range [5,250]: 1.0; date is not a calendar day: yesterday"


def test_one_row_per_user_and_day(spark):
    df = hrv_rows(spark, dict(id="a", rmssd=40.0, minute=1), dict(id="b", rmssd=60.0, minute=2), dict(id="c", user="u2"))
    rows = {r.user_id: r.hrv_rmssd_ms for r in silver.clean(df, silver.HRV).collect()}
    assert rows == {"u1": 60.0, "u2": 50.0}


def test_union_fills_missing_columns(spark):
    a, b = spark.sql("select 1 as x, 2 as y"), spark.sql("select 3 as x")
    assert sorted(map(tuple, union_all([a, b]).collect()), key=str) == [(1, 2), (3, None)]


def test_violations_counts_and_pass_rate(spark):
    df = hrv_rows(
        spark,
        dict(id="two", rmssd=300.25, resp=5.0),
        dict(id="one", sdnn=500.0),
        dict(id="ok"),
        dict(id="gone", rmssd=None),
    )
    found = rule_violations(df, HRV_BOUNDS, "reading_id", "bronze.hrv_readings")
    rows = {(r.record_id, r.failed_rule): r for r in found.collect()}
    assert len(rows) == 3
    first = rows[("two", "hrv_rmssd_ms ∈ [5, 250]")]
    assert (first.value, first.side, first.why_it_fails) == (300.2, "high", "rMSSD above any plausible autonomic range")
    assert rows[("two", "respiratory_rate_brpm ∈ [8, 30]")].side == "low"
    counts = {r.failed_rule: (r.violations, r.records, r.records_breaking_several) for r in rule_counts(found).collect()}
    assert counts["hrv_sdnn_ms ∈ [10, 400]"] == (1, 1, 0)
    assert counts["hrv_rmssd_ms ∈ [5, 250]"] == (1, 1, 1)
    nameless = found.unionByName(found.withColumn("record_id", F.lit(None).cast("string")))
    counts = {r.failed_rule: (r.violations, r.records, r.records_breaking_several) for r in rule_counts(nameless).collect()}
    assert counts["hrv_rmssd_ms ∈ [5, 250]"] == (2, 2, 1)
    total = pass_rate([(df, HRV_BOUNDS, "reading_id")]).first()
    assert (total.records_scanned, total.quarantined, total.pass_rate_pct, total.rules_enforced) == (4, 2, 50.0, 3)
    nothing = pass_rate([(df.limit(0), HRV_BOUNDS, "reading_id")]).first()
    assert (nothing.records_scanned, nothing.pass_rate_pct) == (0, 0.0)


def test_every_input_row_is_either_valid_or_rejected(spark):
    df = hrv_rows(spark, *[dict(id=str(i), rmssd=float(i * 7 % 300), resp=float(i % 40)) for i in range(200)])
    valid, bad = split_by_bounds(df, HRV_BOUNDS, "reading_id", "t")
    assert valid.count() + bad.count() == 200
    assert valid.filter((F.col("hrv_rmssd_ms") < 5) | (F.col("hrv_rmssd_ms") > 250)).count() == 0


@pytest.mark.parametrize("value, kept", [(float("nan"), False), (5.0, True)])
def test_nan_is_never_valid(spark, value, kept):
    df = hrv_rows(spark, dict(id="x", rmssd=value))
    assert (split_by_bounds(df, HRV_BOUNDS, "reading_id", "t")[0].count() == 1) is kept
