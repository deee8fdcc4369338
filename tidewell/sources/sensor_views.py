"""Sensor feeds derived from the given ``events`` and ``customer`` tables.

Each event stands for one raw reading of each sensor, so record ids (user and day) repeat and carry
faults, gaps and anomalies.  The expressions are plain SQL text that Spark and DuckDB read alike;
``{text}`` is the engine's string type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_UID = "concat('u', cast(user_id as {text}))"
_DAY = "cast(cast(ts as date) as {text})"


def _id(kind: str) -> str:
    return f"concat('u', cast(user_id as {{text}}), '_', cast(cast(ts as date) as {{text}}), '_{kind}')"


_TAIL = {
    "ingested_at": "cast(ts as {text})",
    "_ingestion_run_id": "'run-1'",
    "_ingest_timestamp": "ts",
}
_HOURS = "(case when event_id % 149 = 0 then 15.5e0 else (400 + (event_id * 37 + user_id * 11) % 650) / 100.0e0 end)"


def _stage(percent: str) -> str:
    return f"round({_HOURS} * 60.0e0 * ({percent}) / 100.0e0, 0)"


HRV_VIEW = {
    "reading_id": _id("hrv"),
    "user_id": _UID,
    "date": _DAY,
    "hrv_rmssd_ms": "case when event_id % 211 = 0 then cast(null as double) else round(value + 4.0e0, 2) end",
    "hrv_sdnn_ms": "round((value + 4.0e0) * 1.8e0, 2)",
    "respiratory_rate_brpm": "case when event_id % 97 = 0 then 35.0e0 else 10.0e0 + (event_id % 12) end",
    "is_anomaly": "(event_id % 50) = 0",
    **_TAIL,
}
SLEEP_VIEW = {
    "record_id": _id("sleep"),
    "user_id": _UID,
    "date": _DAY,
    "total_sleep_hours": _HOURS,
    "deep_sleep_minutes": _stage("12 + event_id % 14"),
    "rem_sleep_minutes": _stage("16 + event_id % 12"),
    "light_sleep_minutes": _stage("50 - event_id % 9"),
    "awake_minutes": _stage("4 + event_id % 7"),
    "sleep_efficiency_pct": "76.0e0 + (event_id % 22)",
    "spo2_avg_pct": "case when event_id % 89 = 0 then 78.0e0 else 90.0e0 + (event_id % 100) / 10.0e0 end",
    "resting_hr_bpm": "48.0e0 + (user_id % 15) + ((event_id * 13) % 300) / 10.0e0",
    "is_anomaly": "(event_id % 50) = 0",
    **_TAIL,
}
_ZONES = [
    "case when event_id % 60 < 20 then 0 else event_id % 60 end",
    "case when event_id % 5 = 0 then 0 else (event_id * 3) % 25 end",
    "case when event_id % 5 = 0 then 0 else (event_id * 7) % 20 end",
    "case when event_id % 3 = 0 then (event_id * 11) % 30 else 0 end",
    "case when event_id % 4 = 0 then (event_id * 5) % 20 else 0 end",
    "case when event_id % 7 = 0 then event_id % 35 else 0 end",
]
ACTIVITY_VIEW = {
    "record_id": _id("activity"),
    "user_id": _UID,
    "date": _DAY,
    "workout_type": "event_type",
    "workout_duration_minutes": "cast(" + " + ".join(f"({z})" for z in _ZONES) + " as int)",
    "steps": "cast(1000 + (event_id * 17) % 14000 as int)",
    "active_calories": "cast(50 + (event_id * 7) % 900 as int)",
    "total_calories": "cast(1550 + (event_id * 7) % 900 as int)",
    "avg_hr_bpm": "case when event_id % 101 = 0 then 18.0e0 else 95.0e0 + event_id % 70 end",
    "peak_hr_bpm": "case when event_id % 103 = 0 then 240.0e0 else 120.0e0 + event_id % 75 end",
    **{f"zone{i}_minutes": f"cast({z} as int)" for i, z in enumerate(_ZONES, start=1)},
    **_TAIL,
}
# A customer in debt has not set a maximum heart rate.
USERS_VIEW = {
    "user_id": "concat('u', cast(c_custkey as {text}))",
    "age": "cast(20 + c_custkey % 25 as int)",
    "fitness_level": "case when c_mktsegment = 'AUTOMOBILE' then 'beginner' "
    "when c_mktsegment in ('MACHINERY', 'BUILDING') then 'intermediate' else 'athlete' end",
    "hrv_baseline": "30.0e0 + c_custkey % 40",
    "resting_hr_baseline": "48.0e0 + c_custkey % 15",
    "max_hr": "cast(case when c_acctbal < 0 then null else 200 - c_custkey % 25 end as int)",
}


def select_list(view: dict[str, str], text: str) -> list[str]:
    return [f"{expression.format(text=text)} as {name}" for name, expression in view.items()]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def hrv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(*select_list(HRV_VIEW, "string"))


def sleep_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(*select_list(SLEEP_VIEW, "string"))


def activity_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(*select_list(ACTIVITY_VIEW, "string"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(*select_list(USERS_VIEW, "string"))


def up_to_day(raw: DataFrame, day) -> DataFrame:
    """The feed as it stood at the end of a day."""
    return raw.filter(F.col("date") <= F.lit(day).cast("string"))
