"""Reports over small hand-made Gold tables."""

import datetime as dt

import pytest

from tidewell.plans import reports


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def recovery(spark, rows):
    full = [
        (u, day(d), s, None if s is None else "Red" if s < 33 else "Yellow" if s < 66 else "Green", v, v, 50.0, 60.0, 70.0, 80.0)
        for u, d, s, v in rows
    ]
    return spark.createDataFrame(
        full,
        "user_id string, date date, recovery_score int, recovery_state string, hrv_rmssd double, hrv_baseline double, "
        "hrv_component double, rhr_component double, sleep_component double, spo2_component double",
    )


def strain(spark, rows):
    return spark.createDataFrame(
        [(u, day(d), s, "Light") for u, d, s in rows], "user_id string, date date, strain_score double, strain_category string"
    )


def metrics(spark, rows):
    return spark.createDataFrame(
        [(u, day(d), h, 90.0, 1.0, "Good") for u, d, h in rows],
        "user_id string, date date, total_sleep_hours double, sleep_efficiency_pct double, sleep_debt_hours double, sleep_quality_tier string",
    )


def test_last_days_count_back_from_the_newest(spark):
    rec = recovery(spark, [("u", d, 50, 40.0) for d in range(60)])
    assert {r.date for r in reports.recovery_last_days(rec, 30).collect()} == {day(d) for d in range(29, 60)}


def test_delta_runs_over_matched_rows(spark):
    rec = recovery(spark, [("u", 1, 50, 1.0), ("u", 2, 60, 1.0), ("u", 3, 90, 1.0), ("v", 1, 10, 1.0)])
    st = strain(spark, [("u", 0, 5.0), ("u", 2, 7.0), ("v", 5, 9.0)])
    got = [(r.user_id, r.strain_date, r.next_day_recovery, r.recovery_delta) for r in reports.strain_vs_next_day(st, rec).orderBy("strain_date").collect()]
    assert got == [("u", day(0), 50, None), ("u", day(2), 90, 40)]


def test_weekday_pattern(spark):
    rec = recovery(spark, [("u", 0, 70, 40.0), ("u", 6, 20, 50.0), ("u", 7, 60, 41.0), ("u", 14, 80, None)])
    got = [(r.day_of_week, r.dow_num, r.avg_recovery, r.avg_hrv_ms, r.sample_days, r.pct_green_days) for r in reports.weekday_pattern(rec).collect()]
    assert got == [("Sunday", 0, 20.0, 50.0, 1, 0.0), ("Monday", 1, 70.0, 40.5, 3, 66.7)]


def test_hrv_trend_of_equal_averages_is_declining(spark):
    rec = recovery(spark, [("u", d, 50, 40.0 + d) for d in range(10)])
    got = [r.hrv_trend for r in reports.hrv_trend(rec).orderBy("date").collect()]
    assert got == ["Declining"] * 7 + ["Improving"] * 3


def test_then_and_now_keep_users_of_either_side(spark):
    then, now = recovery(spark, [("a", 0, 40, 1.0), ("b", 0, 50, 1.0)]), recovery(spark, [("a", 0, 60, 1.0), ("c", 0, 70, 1.0)])
    got = {r.user_id: (r.historical_avg, r.current_avg, r.change) for r in reports.recovery_then_vs_now(then, now).collect()}
    assert got == {"a": (40.0, 60.0, 20.0), "b": (50.0, None, None), "c": (None, 70.0, None)}


def quarantine(spark):
    return spark.createDataFrame(
        [
            ("t", "u1", "2024-01-03", "steps out of range [0,100000]: -5; avg_hr_bpm out of range [30.0,220.0]: 18.0"),
            ("t", "u1", "2024-01-04", "steps out of range [0,100000]: -6"),
            ("t", "u2", "2024-01-04", "user_id is missing"),
            ("t", "u2", "2024-01-10", ""),
            ("s", "u2", "not a day", "date is not a calendar day: not a day"),
        ],
        "source_table string, user_id string, date string, rejection_reason string",
    )


def test_quarantine_by_week(spark):
    got = {(r.source_table, r.week): tuple(r)[2:] for r in reports.quarantine_weekly(quarantine(spark)).collect()}
    assert got == {
        ("t", day(0)): (3, 2, "avg_hr_bpm | steps | user_id"),
        ("t", day(7)): (1, 1, None),
        ("s", None): (1, 1, "calendar_day"),
    }


def test_any_number_of_readings_names_every_rule(spark):
    many = spark.range(20_000).selectExpr(
        "'t' as source_table", "concat('u', id % 7) as user_id", "'2024-01-03' as date",
        "concat(if(id = 19999, 'peak_hr_bpm', 'steps'), ' out of range [0,100000]: ', id) as rejection_reason",
    )
    row = reports.quarantine_weekly(many).first()
    assert (row.quarantined_records, row.affected_users, row.broken_rules) == (20_000, 7, "peak_hr_bpm | steps")
    assert reports.quarantine_weekly_reasons(many).count() == 20_000


def test_user_slice(spark):
    from pyspark.sql import functions as F

    rec = recovery(spark, [("b", 0, 50, 1.0), ("a", 2, 60, 1.0), ("a", 1, 70, 1.0), ("a", 5, 80, 1.0)])
    assert [r.date for r in reports.user_slice(rec).collect()] == [day(1), day(2), day(5)]
    picked = reports.user_slice(rec, F.lit("a"), F.lit(day(2)), F.lit(day(5)))
    assert [r.recovery_score for r in picked.collect()] == [60, 80]


def test_kpis_fill_absent_parts_with_zero(spark):
    rec = recovery(spark, [("a", 0, 80, 40.0), ("a", 1, 40, 60.0)])
    got = {r.user_id: r for r in reports.kpi_per_user(rec, strain(spark, [("b", 0, 6.0)]), metrics(spark, [("a", 0, 7.0)])).collect()}
    a, b = got["a"], got["b"]
    assert (a.avg_recovery, a.recovery_vs_50, a.green_days, a.green_pct, a.avg_strain, a.sleep_vs_8h, a.avg_hrv) == (60.0, 10.0, 1, 50.0, 0.0, -1.0, 50.0)
    assert (b.avg_strain, b.days_tracked, b.green_pct) == (6.0, 0, 0.0)


def test_grid_needs_two_weeks_and_keeps_iso_years_apart(spark):
    start = (dt.date(2024, 12, 23) - dt.date(2024, 1, 1)).days
    rec = recovery(spark, [("u", start + d, d, 1.0) for d in range(14)] + [("v", 0, 50, 1.0)])
    grid = reports.week_weekday_grid(rec).collect()
    assert {(r.user_id, r.iso_year, r.iso_week) for r in grid} == {("u", 2024, 52), ("u", 2025, 1)}
    assert len(grid) == 14
    matrix = reports.week_weekday_matrix(rec).orderBy("iso_year").collect()
    assert matrix[0].Monday == 0.0 and matrix[1].Sunday == 13.0 and len(matrix) == 2


def test_line_through_points(spark):
    rec = recovery(spark, [("u", d + 1, 90 - 5 * d, 1.0) for d in range(5)])
    line = reports.ols_strain_recovery(strain(spark, [("u", d, float(d)) for d in range(5)]), rec).first()
    assert (line.slope, line.intercept, line.r2, line.points) == pytest.approx((-5.0, 90.0, 1.0, 5))


def test_box_and_outliers(spark):
    rec = recovery(spark, [("u", d, 50, float(d)) for d in range(1, 9)] + [("u", 20, 50, 100.0), ("u", 21, 50, None)])
    box = reports.hrv_quartiles(rec).first()
    assert (box.readings, box.q1, box.median, box.q3, box.lower_fence, box.upper_fence) == (9, 3.0, 5.0, 7.0, -3.0, 13.0)
    assert [(r.date, r.side) for r in reports.hrv_outliers(rec).collect()] == [(day(20), "high")]
    assert {(r.class_start, r.readings) for r in reports.hrv_histogram(rec).collect()} == {(0.0, 4), (5.0, 4), (100.0, 1)}


def test_shares_and_their_order(spark):
    rows = [("u", day(0), 1.0, c) for c in ["Hard", "Light", "Light", "All Out"]]
    df = spark.createDataFrame(rows, "user_id string, date date, strain_score double, strain_category string")
    got = [(r.strain_category, r.days, r.share_pct, r.category_no) for r in reports.strain_category_distribution(df).collect()]
    assert got == [("Light", 2, 50.0, 2), ("Hard", 1, 25.0, 4), ("All Out", 1, 25.0, 5)]


def test_sleep_bands(spark):
    hours = [5.99, 6.0, 6.99, 7.0, 9.0, 9.01]
    rec = recovery(spark, [("u", d, 10 * d, 1.0) for d in range(6)])
    got = {r.sleep_band: (r.avg_recovery, r.nights) for r in reports.sleep_band_means(metrics(spark, [("u", d, h) for d, h in enumerate(hours)]), rec).collect()}
    assert got == {"under 6 h": (0.0, 1), "6 to 7 h": (15.0, 2), "7 to 9 h": (35.0, 2), "over 9 h": (50.0, 1)}


def test_training_phases(spark):
    rec = recovery(spark, [("u", d, 10 if d % 28 < 21 else 90, 1.0) for d in range(56)])
    got = {r.phase: (r.avg_recovery, r.days) for r in reports.training_phase_means(rec).collect()}
    assert got == {"training": (10.0, 42), "recovery week": (90.0, 14)}


def test_fitness_levels(spark):
    users = spark.createDataFrame([("a", "athlete"), ("a", "athlete"), ("b", "beginner")], "user_id string, fitness_level string")
    rec = recovery(spark, [("a", 0, 60, 50.0), ("a", 1, None, 60.0), ("b", 0, 40, None), ("x", 0, 99, 1.0)])
    got = {r.fitness_level: (r.avg_recovery, r.avg_hrv, r.days) for r in reports.fitness_level_means(rec, users).collect()}
    assert got == {"athlete": (60.0, 55.0, 2), "beginner": (40.0, None, 1)}


def test_stage_hours_and_component_means(spark):
    sleep = spark.sql(
        "select 'u' as user_id, date'2024-01-01' as date, 60D as deep_sleep_minutes, 90D as rem_sleep_minutes, "
        "240D as light_sleep_minutes, 30D as awake_minutes"
    )
    assert {r.stage: r.hours for r in reports.sleep_stage_hours(sleep).collect()} == {"Deep Sleep": 1.0, "REM": 1.5, "Light Sleep": 4.0, "Awake": 0.5}
    means = reports.component_means(recovery(spark, [("u", 0, 50, 1.0)]), per_user=False).collect()
    assert {r.component: r.mean_score for r in means} == {"hrv_component": 50.0, "rhr_component": 60.0, "sleep_component": 70.0, "spo2_component": 80.0}


def test_run_stats(spark):
    got = {r.statistic: r.value for r in reports.run_stats(strain(spark, [("u", 0, 4.0), ("v", 0, 8.0)]), metrics(spark, [("u", 0, 7.0), ("u", 1, 9.0)])).collect()}
    assert got == {"users": 1.0, "avg_sleep_hours": 8.0, "avg_sleep_debt_hours": 1.0, "strain_records": 2.0, "avg_strain": 6.0, "max_strain": 8.0}
