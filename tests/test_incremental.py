"""Gold brought up to date from changes equals Gold computed from all of Silver."""

import datetime as dt
import glob
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.plans import gold, incremental, silver
from tidewell.plans.pipeline import Lakehouse
from tidewell.session import at_once
from tidewell.sources.merged_table import MergedTable

FIRST = dt.date(2024, 1, 1)


def rows(spark, layout, values):
    names = layout.names
    return spark.createDataFrame([tuple(v.get(n) for n in names) for v in values], schemas.as_nullable(layout))


def reading(user, day, seed, hrv=True):
    """The three Silver rows of a user-day."""
    r = random.Random(f"{user}-{day}-{seed}")
    own = {"user_id": user, "date": FIRST + dt.timedelta(days=day)}
    zones = {z: r.randrange(40) for z in schemas.ZONES}
    return (
        own | {"reading_id": f"{user}_{day}", "hrv_rmssd_ms": round(r.uniform(20, 90), 2) if hrv else None},
        own | {"record_id": f"{user}_{day}", "total_sleep_hours": r.randrange(400, 1000) / 100, "sleep_efficiency_pct": float(r.randrange(70, 99)), "rem_sleep_minutes": 90.0, "deep_sleep_minutes": 80.0, "spo2_avg_pct": 96.5, "resting_hr_bpm": r.randrange(450, 700) / 10},
        own | {"record_id": f"{user}_{day}", "peak_hr_bpm": 150.0, **zones},
    )


def load(house, days, parts=(0, 1, 2)):
    def one(i):
        feed = silver.FEEDS[i]
        house.silver(feed).create_if_absent().upsert(rows(house.spark, feed.silver_layout, [d[i] for d in days]), house.new_changes(feed))

    at_once(*(partial(one, i) for i in parts))


def users(spark, **max_hr):
    return rows(spark, schemas.USERS, [{"user_id": u, "max_hr": m} for u, m in max_hr.items()])


def plain(df):
    return sorted(([round(v, 9) if isinstance(v, float) else v for v in r] for r in df.collect()), key=repr)


def assert_up_to_date(house, profiles):
    hrv, sleep, activity = (house.silver(feed).read() for feed in silver.FEEDS)
    recovery = gold.daily_recovery(hrv, sleep)
    want = {
        "daily_recovery": recovery,
        "sleep_analytics": gold.sleep_metrics(sleep),
        "user_strain_summary": gold.strain_scores(activity, profiles),
        "cohort_benchmarks": gold.cohort_benchmarks(recovery),
    }
    for name, df in want.items():
        got = incremental.read_gold(house, name)
        assert plain(got.select(*df.columns)) == plain(df), name


def test_late_corrected_and_sparse_rows(spark, workspace):
    house, profiles = Lakehouse(spark, workspace), users(spark, a=180, b=185, c=None)
    r = random.Random(1)
    # a sends daily, b every other day with gaps in HRV, c once in about three weeks, d starts late
    all_days = [reading("a", d, 0) for d in range(0, 25)]
    all_days += [reading("b", d, 0, hrv=d % 5 > 1) for d in range(0, 25, 2)]
    all_days += [reading("c", d, 0) for d in range(0, 200, 19)]
    all_days += [reading("d", d, 0) for d in range(22, 25)]
    first = [d for d in all_days if r.random() < 0.7]
    load(house, first)
    incremental.update_gold(house, profiles)
    assert_up_to_date(house, profiles)

    load(house, [d for d in all_days if d not in first and r.random() < 0.5])
    load(house, [reading("a", 20, 1), reading("c", 95, 1), reading("b", 16, 1, hrv=False)], parts=(0, 1))
    load(house, all_days[10:12])  # as they were
    incremental.update_gold(house, profiles)
    assert_up_to_date(house, profiles)

    load(house, [d for d in all_days if d not in first], parts=(1, 2))  # some of these without HRV
    incremental.update_gold(house, profiles)
    assert_up_to_date(house, profiles)


def test_partitions_that_no_change_reaches_are_not_read(spark, workspace):
    house, profiles = Lakehouse(spark, workspace), users(spark, a=180, b=170)
    load(house, [reading("a", d, 0) for d in range(0, 45)] + [reading("b", d, 0) for d in range(15, 45)])
    incremental.update_gold(house, profiles)
    silver_days = {feed.name: house.silver(feed).path for feed in silver.FEEDS}
    gold_days = [f"{workspace}/gold_by_day/{name}" for name in ("daily_recovery", "sleep_analytics", "user_strain_summary")]
    before = {name: plain(incremental.read_gold(house, name).where("date < '2024-01-15'")) for name in ("daily_recovery", "sleep_analytics")}
    far = [FIRST + dt.timedelta(days=d) for d in [*range(0, 15), 18]]
    saved = {}
    for folder in (*silver_days.values(), *gold_days):
        for day in far:
            for path in glob.glob(f"{folder}/date={day}/*.parquet"):
                with open(path, "rb+") as f:
                    saved[path] = f.read()
                    f.seek(0)
                    f.write(b"\0" * len(saved[path]))
    assert len(saved) > 60
    with pytest.raises(Exception):
        house.silver(silver.HRV).read().select(F.max("hrv_rmssd_ms")).collect()

    load(house, [reading("b", 45, 0)])  # the next day of b, whose first days still look at the whole history
    counts = incremental.update_gold(house, profiles)
    assert counts["daily_recovery"] == 4 and counts["sleep_analytics"] == 1 and counts["user_strain_summary"] == 1
    for path, content in saved.items():
        with open(path, "rb+") as f:
            f.write(content)
    assert_up_to_date(house, profiles)
    assert {name: plain(incremental.read_gold(house, name).where("date < '2024-01-15'")) for name in before} == before


def test_a_run_that_dies_is_finished_by_the_next(spark, workspace, monkeypatch):
    house, profiles = Lakehouse(spark, workspace), users(spark, a=180)
    load(house, [reading("a", d, 0) for d in range(20)])
    incremental.update_gold(house, profiles)
    load(house, [reading("a", d, 1) for d in (3, 4)] + [reading("b", d, 0) for d in range(5)])
    whole = MergedTable.merge

    def dies(self, rows):
        if "recovery_users" in self.path:
            raise RuntimeError("lost")
        whole(self, rows)

    monkeypatch.setattr(MergedTable, "merge", dies)
    with pytest.raises(RuntimeError, match="lost"):
        incremental.update_gold(house, profiles)
    monkeypatch.setattr(MergedTable, "merge", whole)
    assert incremental.update_gold(house, profiles) == {"profiles": 0, "user_strain_summary": 0}  # nothing new besides
    assert_up_to_date(house, profiles)


def test_a_new_maximum_heart_rate_reaches_all_days_of_its_user(spark, workspace):
    house = Lakehouse(spark, workspace)
    load(house, [reading(u, d, 0) for u in "ab" for d in range(10)])
    incremental.update_gold(house, users(spark, a=180))
    later = users(spark, a=180, b=150)
    assert incremental.update_gold(house, later)["user_strain_summary"] == 10
    assert_up_to_date(house, later)


def test_nothing_yet(spark, workspace):
    house, profiles = Lakehouse(spark, workspace), users(spark)
    for feed in silver.FEEDS:
        house.silver(feed).create_if_absent()
    incremental.update_gold(house, profiles)
    assert incremental.read_gold(house, "daily_recovery").count() == 0
    # a feed that is there without its partner
    load(house, [reading("a", 1, 0)], parts=(0,))
    incremental.update_gold(house, profiles)
    assert incremental.read_gold(house, "daily_recovery").count() == 0
    load(house, [reading("a", 1, 0)], parts=(1, 2))
    incremental.update_gold(house, profiles)
    assert_up_to_date(house, profiles)


def test_no_search_goes_on_when_every_day_is_read(spark, workspace):
    changed = spark.createDataFrame([("u", FIRST + dt.timedelta(days=d)) for d in (3, 9)], "user_id string, date date")
    spans = spark.createDataFrame([("u", FIRST, FIRST + dt.timedelta(days=12))], "user_id string, first_day date, last_day date")

    def keys(_):
        raise AssertionError("rows are looked at though no day is left")

    assert incremental.days_to_read(keys, changed, spans, 7, workspace) == [FIRST + dt.timedelta(days=d) for d in range(13)]


def test_merge_notes_the_changed_user_days(spark, workspace):
    house = Lakehouse(spark, workspace)
    table = house.silver(silver.HRV).create_if_absent()

    def merged(**values):
        changes = house.new_changes(silver.HRV)
        table.merge(rows(spark, silver.HRV.silver_layout, [{"user_id": u, "date": FIRST, "hrv_rmssd_ms": v} for u, v in values.items()]), changes)
        return sorted(r["user_id"] for r in spark.read.parquet(changes).collect())

    assert merged(a=1.0, b=2.0, c=None) == ["a", "b", "c"]
    assert merged(a=1.0, b=3.0, c=None, d=4.0) == ["b", "d"]
    assert {r["user_id"]: r["hrv_rmssd_ms"] for r in table.read().collect()} == {"a": 1.0, "b": 3.0, "c": None, "d": 4.0}
