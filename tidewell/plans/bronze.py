"""Bronze: typed rows stamped with the run that brought them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_audit_columns(df: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_run_id": F.lit(run_id),
            "_ingest_timestamp": F.current_timestamp() if now is None else now,
        }
    )
