"""Gold tables against a plain row-by-row statement of the same rules."""

import datetime as dt
import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewell.operators.percent_rank import percent_rank_over
from tidewell.plans import gold

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def make_days(seed=7, users=4, days=30):
    """Rows with gaps, missing values and a user of one day."""
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        for d in range(days):
            if rng.random() < 0.15:
                continue
            rows.append(
                dict(
                    user=f"u{u}",
                    date=day(d),
                    hrv=None if rng.random() < 0.1 else round(rng.gauss(55, 9), 2),
                    hours=round(rng.uniform(3.5, 10), 2),
                    eff=None if rng.random() < 0.03 else float(rng.randint(68, 99)),
                    rem=float(rng.randint(40, 130)),
                    deep=float(rng.randint(30, 110)),
                    spo2=None if rng.random() < 0.05 else round(rng.uniform(88, 100), 1),
                    rhr=None if rng.random() < 0.05 else round(rng.gauss(55, 4), 1),
                )
            )
    rows.append(dict(user="single", date=day(3), hrv=60.0, hours=8.0, eff=90.0, rem=100.0, deep=90.0, spo2=98.0, rhr=50.0))
    rng.shuffle(rows)
    return rows


def frames(spark, rows):
    hrv = spark.createDataFrame([(r["user"], r["date"], r["hrv"]) for r in rows], "user_id string, date date, hrv_rmssd_ms double")
    sleep = spark.createDataFrame(
        [(r["user"], r["date"], r["hours"], r["eff"], r["rem"], r["deep"], r["spo2"], r["rhr"]) for r in rows],
        "user_id string, date date, total_sleep_hours double, sleep_efficiency_pct double, rem_sleep_minutes double, "
        "deep_sleep_minutes double, spo2_avg_pct double, resting_hr_bpm double",
    )
    return hrv, sleep


def known(values):
    return [v for v in values if v is not None]


def spread(values):
    return statistics.stdev(values) if len(values) > 1 else None


def expected_recovery(rows):
    out = {}
    for user in {r["user"] for r in rows}:
        mine = sorted((r for r in rows if r["user"] == user), key=lambda r: r["date"])
        every_hrv, every_rhr = known(r["hrv"] for r in mine), known(r["rhr"] for r in mine)
        for i, r in enumerate(mine):
            hrv7, rhr7 = known(x["hrv"] for x in mine[max(0, i - 7) : i]), known(x["rhr"] for x in mine[max(0, i - 7) : i])
            fresh = len(hrv7) < 3
            if fresh:
                base, sd = (statistics.fmean(every_hrv) if every_hrv else None), spread(every_hrv)
                rbase = statistics.fmean(every_rhr) if every_rhr else None
            else:
                base, sd = statistics.fmean(hrv7), spread(hrv7)
                rbase = statistics.fmean(rhr7) if len(rhr7) >= 3 else None
            out[user, r["date"]] = (fresh, score(r, base, sd, rbase))
    return out


def score(r, base, sd, rbase):
    if None in (base, rbase, r["hrv"], r["rhr"], r["eff"]):
        return None
    sd = sd if sd is not None and sd >= 1 else base * 0.1
    hrv = min(max(50 + 45 * math.tanh((r["hrv"] - base) / sd * 0.75), 5), 98)
    rhr = min(max(75 - 5 * (r["rhr"] - rbase), 5), 98)
    h = r["hours"]
    duration = 0 if h < 4 else (h - 4) * 35 if h < 6 else 70 + (h - 6) * 10 if h <= 9 else 100 - 8 * (h - 9)
    rem, deep = r["rem"] / (h * 60) * 100, r["deep"] / (h * 60) * 100
    stages = min(max((200 - 4 * abs(rem - 22.5) - 5 * abs(deep - 17.5)) / 2, 0), 100)
    eff = min(max((r["eff"] - 70) * 4, 0), 100)
    sleep = min(max(duration * 0.5 + stages * 0.3 + eff * 0.2, 0), 100)
    o = r["spo2"]
    spo2 = 0 if o is None else 100 if o >= 97 else 80 + (o - 95) * 10 if o >= 95 else 20 + (o - 90) * 12 if o >= 90 else max(0, o - 80) * 2
    return min(max(round(hrv * 0.4 + rhr * 0.25 + sleep * 0.25 + spo2 * 0.1), 0), 100)


def test_daily_recovery(spark):
    rows = make_days()
    got = gold.daily_recovery(*frames(spark, rows)).collect()
    want = expected_recovery(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.needs_more_baseline, r.recovery_score) == want[r.user_id, r.date], r
        state = None if r.recovery_score is None else "Red" if r.recovery_score < 33 else "Yellow" if r.recovery_score < 66 else "Green"
        assert r.recovery_state == state
    assert any(r.recovery_score is None for r in got)
    single = next(r for r in got if r.user_id == "single")
    assert single.needs_more_baseline and single.hrv_component == 50.0


def test_colocated_inputs_give_the_same_rows(spark):
    hrv, sleep = frames(spark, make_days(seed=3))
    order = ["user_id", "date"]
    assert (
        gold.daily_recovery(hrv, sleep).orderBy(order).collect()
        == gold.daily_recovery(hrv, sleep, colocate=True).orderBy(order).collect()
    )


def test_baseline_frame_counts_rows_and_skips_nulls(spark):
    rows = [(f"u", day(2 * i), float(i) if i != 1 else None, 50.0) for i in range(6)]
    df = spark.createDataFrame(rows, "user_id string, date date, hrv_rmssd_ms double, resting_hr_bpm double")
    got = [(r.needs_more_baseline, r._base) for r in gold.with_baselines(df).orderBy("date").collect()]
    assert [g[0] for g in got] == [True, True, True, True, False, False]
    assert got[4][1] == pytest.approx((0 + 2 + 3) / 3)
    assert got[5][1] == pytest.approx((0 + 2 + 3 + 4) / 4)


def test_sleep_metrics(spark):
    rows = make_days(seed=11)
    _, sleep = frames(spark, rows)
    got = {(r.user_id, r.date): r for r in gold.sleep_metrics(sleep).collect()}
    assert len(got) == len(rows)
    for user in {r["user"] for r in rows}:
        mine = sorted((r for r in rows if r["user"] == user), key=lambda r: r["date"])
        for i, r in enumerate(mine):
            g = got[user, r["date"]]
            debt = max(sum(8 - x["hours"] for x in mine[max(0, i - 13) : i + 1]), 0)
            assert g.sleep_debt_hours == pytest.approx(debt, abs=0.0051)
            sd = spread([x["hours"] for x in mine[max(0, i - 6) : i + 1]]) or 0.0
            assert g.duration_7d_std == pytest.approx(sd)
            assert g.sleep_consistency_score == pytest.approx(min(max((1 - sd / 2) * 100, 0), 100), abs=0.051)
            eff = known(x["eff"] for x in mine[max(0, i - 6) : i + 1])
            assert g.efficiency_7d_avg == pytest.approx(statistics.fmean(eff), abs=0.051)
            assert g.rem_pct == pytest.approx(r["rem"] / r["hours"] / 60 * 100, abs=0.051)


def test_sleep_debt_report(spark):
    _, sleep = frames(spark, make_days(seed=5))
    metrics = gold.sleep_metrics(sleep)
    nights = metrics.collect()
    for row in gold.sleep_debt_report(metrics).collect():
        mine = [n for n in nights if n.user_id == row.user_id]
        assert row.total_nights == len(mine)
        assert row.avg_sleep_hours == pytest.approx(statistics.fmean(n.total_sleep_hours for n in mine), abs=0.0051)
        assert row.excellent_nights == sum(n.sleep_quality_tier == "Excellent" for n in mine)
        assert row.poor_nights == sum(n.sleep_quality_tier == "Poor" for n in mine)
        assert row.max_sleep_debt == max(n.sleep_debt_hours for n in mine)


def activity(spark, rows):
    zones = ", ".join(f"zone{i}_minutes int" for i in range(1, 7))
    return spark.createDataFrame(rows, f"user_id string, date date, peak_hr_bpm double, {zones}")


def test_strain_uses_the_profile_or_the_default(spark):
    df = activity(
        spark,
        [
            ("known", day(0), 100.0, 5, 20, 30, 15, 5, 0),
            ("unset", day(0), 95.0, 0, 0, 0, 0, 0, 0),
            ("absent", day(0), 95.0, None, None, 3, None, None, None),
        ],
    )
    users = spark.createDataFrame([("known", 200), ("known", 200), ("unset", None)], "user_id string, max_hr int")
    got = {r.user_id: r for r in gold.strain_scores(df, users).collect()}
    assert len(got) == 3
    assert (got["known"].strain_score, got["known"].strain_category, got["known"].peak_hr_pct_max) == (13.09, "Moderate", 50.0)
    assert (got["known"].total_active_minutes, got["known"].dominant_zone) == (75, 3)
    assert (got["unset"].strain_score, got["unset"].dominant_zone, got["unset"].peak_hr_pct_max) == (0.0, 1, 50.0)
    assert (got["absent"].zone1_minutes, got["absent"].dominant_zone, got["absent"].total_active_minutes) == (0.0, 3, 3)


def test_cohort_benchmarks(spark):
    rows = [("a", 50), ("a", 70), ("b", 60), ("c", 80), ("d", 90), ("e", None)]
    df = spark.createDataFrame(rows, "user_id string, recovery_score int").withColumns(
        {"hrv_rmssd": F.lit(50.0), "hrv_baseline": F.lit(51.0)}
    )
    got = {r.user_id: (r.avg_recovery, r.days_tracked, r.recovery_percentile) for r in gold.cohort_benchmarks(df).collect()}
    assert got == {
        "e": (None, 1, 0.0),
        "a": (60.0, 2, 25.0),
        "b": (60.0, 1, 25.0),
        "c": (80.0, 1, 75.0),
        "d": (90.0, 1, 100.0),
    }


def check_rank(spark, values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double").repartition(3)
    got = {r.id: r.share for r in percent_rank_over(df, "v", "share", low=0, high=100, **options).collect()}
    want = {r.id: r.p for r in df.withColumn("p", F.percent_rank().over(Window.orderBy("v"))).collect()}
    assert got == pytest.approx(want)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-20, 120).map(lambda x: x / 2)), min_size=1, max_size=40))
def test_percent_rank_equals_the_built_in(spark, values):
    check_rank(spark, values, slices=7)


def test_percent_rank_with_a_value_held_by_most_rows(spark):
    rng = random.Random(1)
    check_rank(spark, [50.0] * 3000 + [round(rng.uniform(0, 100), 3) for _ in range(3000)] + [None] * 500)


def test_percent_rank_of_one_row(spark):
    check_rank(spark, [3.0])
