"""Silver: latest record per id, bounds applied, types settled, one row per user and day."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.functions.bounds import ACTIVITY_BOUNDS, HRV_BOUNDS, SLEEP_BOUNDS, Bounds
from tidewell.functions.numeric import ratio
from tidewell.operators.latest import latest_per_key
from tidewell.operators.validate import REASON, valid_rows, with_rejection_reason
from tidewell.schemas import ZONES

USER_DAY = ["user_id", "date"]


AS_DATE = "try_cast(date as date)"


def _derive(df: DataFrame, **columns: str) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def transform_hrv(valid: DataFrame) -> DataFrame:
    return _derive(
        valid.filter("not is_anomaly"),
        hrv_rmssd_ms="round(hrv_rmssd_ms, 2)",
        hrv_sdnn_ms="round(hrv_sdnn_ms, 2)",
        date=AS_DATE,
    )


def transform_sleep(valid: DataFrame) -> DataFrame:
    minutes = "round(total_sleep_hours * 60, 0)"
    return _derive(
        valid.filter("not is_anomaly"),
        total_sleep_minutes=minutes,
        rem_pct=f"round({ratio('rem_sleep_minutes', minutes)} * 100, 1)",
        deep_pct=f"round({ratio('deep_sleep_minutes', minutes)} * 100, 1)",
        date=AS_DATE,
    )


def transform_activity(valid: DataFrame) -> DataFrame:
    return _derive(
        valid,
        total_zone_minutes=" + ".join(f"coalesce({z}, 0)" for z in ZONES),
        workout_type="initcap(workout_type)",
        date=AS_DATE,
    )


@dataclass(frozen=True)
class Feed:
    """How one sensor feed becomes a Silver table."""

    name: str
    key: str
    bounds: Bounds
    layout: object
    silver_layout: object
    transform: Callable[[DataFrame], DataFrame]

    @property
    def source_table(self) -> str:
        return f"bronze.{self.name}"


HRV = Feed("hrv_readings", "reading_id", HRV_BOUNDS, schemas.HRV, schemas.SILVER_HRV, transform_hrv)
SLEEP = Feed("sleep_records", "record_id", SLEEP_BOUNDS, schemas.SLEEP, schemas.SILVER_SLEEP, transform_sleep)
ACTIVITY = Feed(
    "activity_records", "record_id", ACTIVITY_BOUNDS, schemas.ACTIVITY, schemas.SILVER_ACTIVITY, transform_activity
)
FEEDS = [HRV, SLEEP, ACTIVITY]


def judged(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Latest record per id with its rejection reason.

    A text that is no date is a reason of its own: such a row has no user-day and would otherwise
    pass through every later join unseen. So is a missing user or record key: no later table could
    tell such rows apart.
    """
    latest = latest_per_key(bronze, feed.key, null_keys_match=False)  # rows without key are not one another's copies
    checked = with_rejection_reason(latest, feed.bounds)
    no_day = f"if({AS_DATE} is null, concat('date is not a calendar day: ', coalesce(date, 'NULL')), null)"
    no_user = "if(user_id is null, 'user_id is missing', null)"
    no_key = f"if({feed.key} is null, 'record key is missing', null)"
    return checked.withColumn(REASON, F.expr(f"nullif(concat_ws('; ', {REASON}, {no_day}, {no_user}, {no_key}), '')"))


def clean(bronze: DataFrame, feed: Feed) -> DataFrame:
    return one_per_user_day(feed.transform(valid_rows(judged(bronze, feed))), feed.key)


def one_per_user_day(df: DataFrame, key: str) -> DataFrame:
    """Gold works on one row per user and day, so a user's group never outgrows the calendar."""
    return latest_per_key(df, USER_DAY, settle_ties_by=[key])
