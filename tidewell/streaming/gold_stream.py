"""Row frames on a stream: recovery baselines and sleep figures from the state of each user.

Silver's log is read as a stream. Per user, the state holds what the frames need: the last nights and readings, counts
and sums of the whole history, the days that still fall back on it, and the rows of days that are not closed yet. When
the watermark closes a day, its row is placed behind the ones before, so disorder within the delay does not change a
frame; a timer brings a user up whose days close without new rows. Each step returns the figures of the rows
that became final, and again those of rows whose fallback moved; the scores come from the same expressions as in a
batch run, and rows are merged into the Gold tables by key.

The state of a user has a fixed size but for the days that fall back, usually three. Users are stepped in groups by
their hash, as starting a step costs far more than a user's rows; a step reads and writes the state of its group.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewell.functions import scoring as S
from tidewell.plans import gold, silver
from tidewell.plans.incremental import table
from tidewell.plans.pipeline import Lakehouse
from tidewell.session import new_workspace, ship
from tidewell.sources.merged_table import delete_path
from tidewell.streaming.silver_stream import DELAY_DAYS, log_path

DAY_MS = 86_400_000
#: Groups of users. The state of a stream holds to it, so the place of its progress names it.
GROUPS = 1024
_FIGURES = ("_hrv_rows", "_recent", "_recent_spread", "_rhr_rows", "_recent_rhr", "_all", "_all_spread", "_all_rhr", "_debt", "_spread", "_efficiency")
_OUT = "user_id string, day int, kind string, " + ", ".join(f"{c} double" for c in _FIGURES)
_NAMES = ["user_id", "day", "kind", *_FIGURES]
_FRESH = {"closed": None, "hrv": [], "rhr": [], "nights": [], "sums": [0, 0.0, 0.0, 0, 0.0], "open": [], "pending": {}}


def _mean(values: list) -> float | None:
    known = [v for v in values if v is not None]
    return math.fsum(known) / len(known) if known else None


def _spread(values: list) -> float | None:
    known = [v for v in values if v is not None]
    if len(known) < 2:
        return None
    middle = _mean(known)
    return math.sqrt(math.fsum((v - middle) ** 2 for v in known) / (len(known) - 1))


class History:
    """What is known of a user, as of the last closed day."""

    def __init__(self, memory: dict):
        self.m = memory

    def hold(self, day: int, **values) -> None:
        """Keep the values of a day that is not closed; a later delivery replaces an earlier one."""
        if self.m["closed"] is None or day > self.m["closed"]:
            self.m["pending"].setdefault(str(day), {}).update(values)

    def close(self, until: int) -> list[dict]:
        """Place the rows of all days up to ``until``; the figures that are new or moved."""
        due = sorted(int(d) for d in self.m["pending"] if int(d) <= until)
        out, moved = [], False
        for day in due:
            row = self.m["pending"].pop(str(day))
            self.m["closed"] = day
            if "sleep" in row:
                out.append(self._night(day, *row["sleep"][:2]))
            if "sleep" in row and "hrv" in row:
                settled = self._reading(day, row["hrv"], row["sleep"][2])
                moved = True
                if settled:
                    out.append(settled)
                else:
                    self.m["open"].append(day)
        if moved:  # the history has grown: rows that rest on it change
            out += [{"day": day, "kind": "recovery", "_hrv_rows": 0, "_rhr_rows": 0, **self._whole()} for day in self.m["open"]]
        return out

    def _night(self, day: int, hours: float | None, efficiency: float | None) -> dict:
        nights = self.m["nights"] = [*self.m["nights"], [hours, efficiency]][-max(S.DEBT_ROWS, S.CONSISTENCY_ROWS) :]
        owed = [S.IDEAL_SLEEP_HOURS - h for h, _ in nights[-S.DEBT_ROWS :] if h is not None]
        week = nights[-S.CONSISTENCY_ROWS :]
        return {"day": day, "kind": "sleep", "_debt": math.fsum(owed) if owed else None, "_spread": _spread([h for h, _ in week]), "_efficiency": _mean([e for _, e in week])}

    def _reading(self, day: int, hrv: float | None, rhr: float | None) -> dict | None:
        """The figures of a row whose baseline is settled; then the row joins the history."""
        before, pulse = self.m["hrv"], self.m["rhr"]
        rows = sum(v is not None for v in before)
        found = None
        if rows >= S.BASELINE_MIN_ROWS:
            found = {"day": day, "kind": "recovery", "_hrv_rows": rows, "_recent": _mean(before), "_recent_spread": _spread(before), "_rhr_rows": sum(v is not None for v in pulse), "_recent_rhr": _mean(pulse)}
        self.m["hrv"], self.m["rhr"] = [*before, hrv][-S.BASELINE_ROWS :], [*pulse, rhr][-S.BASELINE_ROWS :]
        n, total, squares, m, pulses = self.m["sums"]
        if hrv is not None:
            n, total, squares = n + 1, total + hrv, squares + hrv * hrv
        if rhr is not None:
            m, pulses = m + 1, pulses + rhr
        self.m["sums"] = [n, total, squares, m, pulses]
        return found

    def _whole(self) -> dict:
        n, total, squares, m, pulses = self.m["sums"]
        spread = math.sqrt(max(squares - total * total / n, 0.0) / (n - 1)) if n > 1 else None
        return {"_all": total / n if n else None, "_all_spread": spread, "_all_rhr": pulses / m if m else None}


def _known(value) -> float | None:
    return None if value is None or pd.isna(value) else float(value)


def group_frames(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The step of a group of users: take what came, close the days that the watermark has passed."""
    memory = json.loads(state.get[0]) if state.exists else {}
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.user_id not in memory:
                memory[row.user_id] = json.loads(json.dumps(_FRESH))
            history = History(memory[row.user_id])
            if row.kind == "sleep":
                history.hold(int(row.day), sleep=[_known(row.a), _known(row.b), _known(row.c)])
            else:
                history.hold(int(row.day), hrv=_known(row.a))
    watermark = state.getCurrentWatermarkMs()
    until = watermark // DAY_MS - 1  # a day closes when the watermark reaches its end
    found = [{"user_id": user, **row} for user, own in memory.items() for row in History(own).close(until)]
    state.update((json.dumps(memory),))
    pending = [int(d) for own in memory.values() for d in own["pending"]]
    if pending:  # a timer goes off when the watermark is behind it
        state.setTimeoutTimestamp(max((min(pending) + 1) * DAY_MS - 1, watermark + 1))
    if found:
        yield pd.DataFrame(found, columns=_NAMES).astype(dict.fromkeys(_FIGURES, float) | {"day": int})


def _merge(house: Lakehouse, figures: DataFrame) -> None:
    """Score the rows that have new figures, and merge them into the Gold tables."""
    spark, stage = house.spark, new_workspace(house.spark, "gold-stream")
    try:
        figures.withColumn("date", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day"))).drop("day").write.parquet(f"{stage}/figures")
        figures = spark.read.parquet(f"{stage}/figures")
        hrv, sleep = house.silver(silver.HRV), house.silver(silver.SLEEP)
        for kind, name in (("sleep", "sleep_analytics"), ("recovery", "daily_recovery")):
            own = figures.where(F.col("kind") == kind).drop("kind")
            days = [r[0] for r in own.select("date").distinct().collect()]
            if not days:
                continue
            if kind == "sleep":
                framed = sleep.read(days=days).join(own.select(*silver.USER_DAY, "_debt", "_spread", "_efficiency"), silver.USER_DAY)
                rows = gold.sleep_columns(framed)
            else:
                inputs = gold.recovery_inputs(hrv.read(days=days), sleep.read(days=days))
                measured = inputs.join(own.drop("_debt", "_spread", "_efficiency"), silver.USER_DAY)
                rows = gold.recovery_columns(gold.with_components(gold.settled_baselines(measured, inputs.columns)), "resting_hr_bpm")
            rows.write.parquet(f"{stage}/{name}")
            target = table(house, name).create_if_absent()
            target.merge(spark.read.schema(target._stored_layout()).parquet(f"{stage}/{name}"))
    finally:
        delete_path(spark, stage)


def stream_gold(house: Lakehouse, delay_days: int = DELAY_DAYS) -> None:
    """Bring daily recovery and sleep analytics up to the days that are closed in both feeds, then stop.

    A run goes on from the state of the one before. The delay must be that of the Silver streams, which take nothing
    for closed days.
    """
    spark = house.spark
    ship(spark)

    def rows(feed: silver.Feed, *columns: str) -> DataFrame:
        log = spark.readStream.schema(feed.silver_layout).parquet(log_path(house, feed))
        day = F.datediff("date", F.lit("1970-01-01").cast("date"))
        values = [(F.col(c) if c else F.lit(None)).cast("double").alias(n) for c, n in zip(columns, "abc", strict=True)]
        kind = F.lit("sleep" if feed is silver.SLEEP else "hrv").alias("kind")
        end = F.timestamp_millis((day.cast("long") + 1) * DAY_MS).alias("end")
        return log.select("user_id", day.alias("day"), kind, *values, end).withWatermark("end", f"{delay_days + 1} days")

    both = rows(silver.HRV, "hrv_rmssd_ms", None, None).unionByName(rows(silver.SLEEP, "total_sleep_hours", "sleep_efficiency_pct", "resting_hr_bpm"))
    grouped = both.withColumn("group", F.pmod(F.hash("user_id"), F.lit(GROUPS)))
    figures = grouped.groupBy("group").applyInPandasWithState(group_frames, _OUT, "memory string", "append", GroupStateTimeout.EventTimeTimeout)
    query = (
        figures.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{house.root}/progress/gold-frames-{GROUPS}")
        .foreachBatch(lambda batch, _: _merge(house, batch))
        .start()
    )
    query.awaitTermination()
