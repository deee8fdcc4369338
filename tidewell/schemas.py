"""Column layouts of the sensor feeds and of the quarantine.  Fixed values: names and types are the data contract."""

from __future__ import annotations

from pyspark.sql import types as T


def _layout(required: str, **optional: T.DataType) -> T.StructType:
    head = [T.StructField(name, T.StringType(), False) for name in required.split()]
    return T.StructType(head + [T.StructField(name, kind, True) for name, kind in optional.items()])


_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

HRV = _layout(
    "reading_id user_id date",
    hrv_rmssd_ms=_D,
    hrv_sdnn_ms=_D,
    respiratory_rate_brpm=_D,
    is_anomaly=_B,
    ingested_at=_S,
)

SLEEP = _layout(
    "record_id user_id date",
    total_sleep_hours=_D,
    deep_sleep_minutes=_D,
    rem_sleep_minutes=_D,
    light_sleep_minutes=_D,
    awake_minutes=_D,
    sleep_efficiency_pct=_D,
    spo2_avg_pct=_D,
    resting_hr_bpm=_D,
    is_anomaly=_B,
    ingested_at=_S,
)

ZONES = [f"zone{z}_minutes" for z in range(1, 7)]

ACTIVITY = _layout(
    "record_id user_id date",
    workout_type=_S,
    workout_duration_minutes=_I,
    steps=_I,
    active_calories=_I,
    total_calories=_I,
    avg_hr_bpm=_D,
    peak_hr_bpm=_D,
    **{zone: _I for zone in ZONES},
    ingested_at=_S,
)

SKIN_TEMP = _layout("record_id user_id date", skin_temp_delta_c=_D, ingested_at=_S)

USERS = T.StructType(
    [
        T.StructField("user_id", _S),
        T.StructField("age", _I),
        T.StructField("fitness_level", _S),
        T.StructField("hrv_baseline", _D),
        T.StructField("resting_hr_baseline", _D),
        T.StructField("max_hr", _I),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("_ingestion_run_id", _S),
        T.StructField("_ingest_timestamp", T.TimestampType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("source_table", _S),
        T.StructField("record_id", _S),
        T.StructField("user_id", _S),
        T.StructField("date", _S),
        T.StructField("rejection_reason", _S),
        T.StructField("raw_record", _S),
        T.StructField("quarantined_at", T.TimestampType()),
    ]
)


def with_audit(layout: T.StructType) -> T.StructType:
    return T.StructType(layout.fields + AUDIT.fields)


def as_nullable(layout: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in layout.fields])


def retyped(layout: T.StructType, **changes: T.DataType) -> T.StructType:
    """The layout with some columns given another type, new columns appended."""
    fields = [T.StructField(f.name, changes.pop(f.name, f.dataType), True) for f in layout.fields]
    return T.StructType(fields + [T.StructField(name, kind, True) for name, kind in changes.items()])


SILVER_HRV = retyped(with_audit(HRV), date=T.DateType())
SILVER_SLEEP = retyped(
    with_audit(SLEEP), date=T.DateType(), total_sleep_minutes=_D, rem_pct=_D, deep_pct=_D
)
SILVER_ACTIVITY = retyped(with_audit(ACTIVITY), date=T.DateType(), total_zone_minutes=_I)
