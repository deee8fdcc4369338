"""Streams started anew for every delivery give what a batch run gives."""

import copy
import datetime as dt
import random
import time
from functools import partial

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.plans import gold, incremental, silver
from tidewell.plans.pipeline import Lakehouse
from tidewell.session import at_once
from tidewell.sources.json_feed import write_records
from tidewell.sources.merged_table import MergedTable
from tidewell.streaming import silver_stream
from tidewell.streaming.gold_stream import _FRESH, DAY_MS, History, group_frames, stream_gold
from tidewell.streaming.silver_stream import stream_silver, take_batch

FIRST = dt.date(2024, 1, 1)


def rows(spark, layout, values):
    return spark.createDataFrame([tuple(v.get(n) for n in layout.names) for v in values], schemas.as_nullable(layout))


def hrv(user, day, value, upload="12:00", **more):
    date = str(FIRST + dt.timedelta(days=day)) if isinstance(day, int) else day
    return {"reading_id": f"{user}_{day}", "user_id": user, "date": date, "hrv_rmssd_ms": value, "is_anomaly": False, "ingested_at": f"2024-03-01 {upload}:00", **more}


def sleep(user, day, r):
    date = str(FIRST + dt.timedelta(days=day))
    return {"record_id": f"{user}_{day}", "user_id": user, "date": date, "total_sleep_hours": r.randrange(400, 1000) / 100, "sleep_efficiency_pct": float(r.randrange(70, 99)), "rem_sleep_minutes": 90.0, "deep_sleep_minutes": 80.0, "spo2_avg_pct": 96.5, "resting_hr_bpm": r.randrange(450, 700) / 10, "is_anomaly": False, "ingested_at": "2024-03-01 12:00:00"}


class Delivery:
    def __init__(self, house):
        self.house, self.number = house, 0

    def __call__(self, feed, values):
        self.number += 1
        write_records(rows(self.house.spark, feed.layout, values), f"{self.house.root}/raw/{feed.name}/{self.number}")
        stream_silver(self.house, feed, f"{self.house.root}/raw/{feed.name}/*", f"run-{self.number}")


def table_of(house):
    return {(r["user_id"], r["date"].day): r["hrv_rmssd_ms"] for r in house.silver(silver.HRV).read().collect()}


def reasons(house):
    return {r["record_id"]: r["rejection_reason"] for r in house.quarantine().read().collect()}


def test_silver_stream(spark, workspace):
    house = Lakehouse(spark, workspace)
    deliver = Delivery(house)
    deliver(silver.HRV, [hrv("a", 0, 40.0), hrv("a", 0, 41.0, "13:00"), hrv("a", 1, 42.0), hrv("b", 1, 300.0), hrv("c", "soon", 50.0)])
    assert table_of(house) == {("a", 1): 41.0, ("a", 2): 42.0}
    # again as it was, an older reading of a known day, a newer one, and days that move the feed on
    deliver(silver.HRV, [hrv("a", 1, 42.0), hrv("a", 0, 10.0, "08:00"), hrv("b", 0, 60.0), hrv("a", 5, 45.0)])
    deliver(silver.HRV, [hrv("a", 2, 43.0, "14:00"), hrv("b", 1, 61.0), hrv("b", 0, 62.0, "15:00"), hrv("d", 5, 44.0)])
    assert table_of(house) == {("a", 1): 41.0, ("a", 2): 42.0, ("a", 3): 43.0, ("b", 1): 60.0, ("a", 6): 45.0, ("d", 6): 44.0}
    found = reasons(house)
    assert found["b_0"] == "day was closed: 2024-01-01" and found["b_1"] == "day was closed: 2024-01-02"
    assert "out of range" in found["c_soon"] or "no" in found["c_soon"]


def test_a_repeated_batch_changes_nothing(spark, workspace):
    house = Lakehouse(spark, workspace)
    layout = silver_stream.with_malformed(schemas.as_nullable(silver.HRV.layout))
    batches = [rows(spark, layout, [hrv("a", d, 40.0 + d) for d in days]) for days in ((0, 1, 2), (8, 9), (1, 10))]
    for number, batch in enumerate(batches):
        take_batch(house, silver.HRV, batch, number, "run")
    once = (table_of(house), reasons(house))
    assert set(once[1]) == {"a_1"}
    take_batch(house, silver.HRV, batches[2], 2, "run")  # as after a failure
    take_batch(house, silver.HRV, batches[1], 1, "run")
    assert (table_of(house), reasons(house)) == once


def test_malformed_records_and_empty_batches(spark, workspace):
    house = Lakehouse(spark, workspace)
    layout = silver_stream.with_malformed(schemas.as_nullable(silver.HRV.layout))
    take_batch(house, silver.HRV, rows(spark, layout, []), 0, "run")
    broken = rows(spark, layout, [{"_malformed": "{oops"}, hrv(None, 1, 40.0), hrv("a", 1, 40.0), hrv("a", 2, 40.0, reading_id=None)])
    take_batch(house, silver.HRV, broken, 1, "run")
    assert table_of(house) == {("a", 2): 40.0}
    assert sorted(reasons(house).values()) == ["record is malformed", "record key is missing", "user_id is missing"]


def test_feeds_taken_side_by_side_share_the_quarantine(spark, workspace, monkeypatch):
    """Two feeds reject records of the same days at once: none gets lost, and no file goes while the other reads it."""
    house, r, write, begun = Lakehouse(spark, workspace), random.Random(2), MergedTable._write, []

    def waiting(table, *args):  # for the other feed to begin its write, should it not have to wait itself
        if table.path.endswith("quarantine"):
            begun.append(table.path)
            until = time.time() + 5
            while len(begun) % 2 and time.time() < until:
                time.sleep(0.05)
        write(table, *args)

    monkeypatch.setattr(MergedTable, "_write", waiting)
    for turn in range(2):
        users, day = [f"{turn}{u}" for u in range(3)], turn
        batches = [(silver.HRV, [hrv(u, day, 300.0) for u in users]), (silver.SLEEP, [sleep(u, day, r) | {"spo2_avg_pct": 20.0} for u in users])]
        made = [(feed, rows(spark, silver_stream.with_malformed(schemas.as_nullable(feed.layout)), values)) for feed, values in batches]
        at_once(*(partial(take_batch, house, feed, batch, turn, "run", 99) for feed, batch in made))
        assert house.quarantine().read().count() == 6 * (turn + 1)


def plain(df):
    return sorted(([round(v, 9) if isinstance(v, float) else v for v in r] for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1])
def test_gold_stream_equals_batch(spark, workspace, seed):
    """Days in disorder within the delay, gaps, users that stop, users without HRV for a while."""
    house, r = Lakehouse(spark, workspace), random.Random(seed)
    deliver, waiting = Delivery(house), []
    for days in (range(0, 12), range(12, 30), range(30, 45)):
        pulses, nights = [], []
        for d in days:
            for user, often, until in (("a", 1.0, 99), ("b", 0.5, 99), ("c", 0.15, 99), ("d", 1.0, 20)):
                if d < until and r.random() < often:
                    pulses.append(hrv(user, d, None if user == "b" and 10 < d < 20 else round(r.uniform(20, 90), 2)))
                    nights.append(sleep(user, d, r))
        # the last days of a delivery come in part with the next one, one feed without the other
        held = [x for x in nights if x["date"] >= str(FIRST + dt.timedelta(days=days[-1] - 1)) and r.random() < 0.5]
        deliver(silver.HRV, r.sample(pulses, len(pulses)))
        deliver(silver.SLEEP, [x for x in nights if x not in held] + waiting)
        waiting = held
        stream_gold(house)
    pulses, nights = house.silver(silver.HRV).read(), house.silver(silver.SLEEP).read()
    last = [df.agg(F.max("date")).first()[0] for df in (pulses, nights)]
    closed = F.col("date") < min(last) - dt.timedelta(days=silver_stream.DELAY_DAYS)
    recovery = gold.daily_recovery(pulses.where(closed), nights.where(closed))
    got = incremental.read_gold(house, "daily_recovery")
    assert recovery.where("needs_more_baseline").count() > 6
    assert plain(got.select(*recovery.columns)) == plain(recovery)
    figures = ["user_id", "date", "sleep_debt_hours", "duration_7d_std", "efficiency_7d_avg", "sleep_quality_tier"]
    assert plain(incremental.read_gold(house, "sleep_analytics").select(*figures)) == plain(gold.sleep_metrics(nights.where(closed)).select(*figures))
    stream_gold(house)  # nothing new
    assert plain(incremental.read_gold(house, "daily_recovery").select(*recovery.columns)) == plain(recovery)


class State:
    """The state of one group, with a watermark of the test's choice."""

    exists, get, timer = False, (None,), None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutTimestamp(self, at):
        assert at > self.watermark
        self.timer = at


def test_many_users_in_one_step():
    """One step brings up all users of a group as each by itself, and by a timer those that deliver no more."""
    r, state, alone, got, want = random.Random(3), State(), {}, [], []
    for turn in range(6):
        days = range(4 * turn, 4 * turn + 4)
        batch = [(f"u{u}", d, kind, r.uniform(20, 90), r.uniform(70, 99), r.uniform(45, 70)) for u in range(60) for d in days for kind in ("hrv", "sleep") if u % 3 or turn < 2]
        state.watermark = max(0, days[0] - 2) * DAY_MS
        got += [f for f in group_frames((7,), [pd.DataFrame(batch, columns=["user_id", "day", "kind", "a", "b", "c"])] if turn < 4 else [], state)]
        for user, day, kind, a, b, c in batch if turn < 4 else []:
            alone.setdefault(user, History(copy.deepcopy(_FRESH))).hold(day, **({"sleep": [a, b, c]} if kind == "sleep" else {"hrv": a}))
        want += [{"user_id": user, **row} for user, one in alone.items() for row in one.close(days[0] - 3)]
    found = pd.concat(got)
    assert len(got) <= 6 and len(found) == len(want) > 60 * 8
    columns = ["user_id", "day", "kind", "_recent", "_all", "_debt"]
    assert repr(found[columns].values.tolist()) == repr(pd.DataFrame(want, columns=found.columns).astype(found.dtypes)[columns].values.tolist())


def test_a_timer_is_behind_the_day_that_it_closes():
    """The watermark stands at the ends of days, and a timer goes off only when it is past."""
    state = State()
    state.watermark = 4 * DAY_MS
    list(group_frames((0,), [pd.DataFrame([("a", 5, "sleep", 7.0, 90.0, 50.0)], columns=["user_id", "day", "kind", "a", "b", "c"])], state))
    assert state.timer < 6 * DAY_MS
    state.watermark = 6 * DAY_MS
    (closed,) = group_frames((0,), [], state)
    assert closed[["user_id", "day", "kind"]].values.tolist() == [["a", 5, "sleep"]]
