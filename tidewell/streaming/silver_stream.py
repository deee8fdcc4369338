"""Silver from a stream of delivered files: repeated records dropped, late ones quarantined, in one step per batch.

The days of a feed close: once a day has been seen, days more than ``delay_days`` before it take no more rows. How far
a feed has come is noted per batch, and a batch goes by the notes of those before it, so that a batch that is
repeated decides the same. Only days that are still open are looked at for earlier deliveries of a record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.validate import REASON, quarantine_rows, union_all, valid_rows
from tidewell.plans import silver
from tidewell.plans.bronze import add_audit_columns
from tidewell.plans.pipeline import Lakehouse
from tidewell.session import new_workspace
from tidewell.sources.json_feed import MALFORMED, path_exists, with_malformed, without_nan
from tidewell.sources.merged_table import delete_path

#: Days after which a day takes no more rows.
DELAY_DAYS = 3


def log_path(house: Lakehouse, feed: silver.Feed) -> str:
    """The rows that were taken, batch by batch, for streams that go on from here."""
    return f"{house.root}/silver_log/{feed.name}"


def _horizon_path(house: Lakehouse, feed: silver.Feed) -> str:
    return f"{house.root}/progress/{feed.name}-horizon"


def open_since(house: Lakehouse, feed: silver.Feed, batch_id: int, delay_days: int):
    """The first day that is open to a batch; None before anything has been seen."""
    path = _horizon_path(house, feed)
    if not path_exists(house.spark, path):
        return None
    notes = house.spark.read.schema("last_day date, batch int").parquet(path)  # a row per batch
    return notes.where(F.col("batch") < batch_id).agg(F.date_sub(F.max("last_day"), delay_days)).first()[0]


def take_batch(house: Lakehouse, feed: silver.Feed, batch: DataFrame, batch_id: int, run_id: str, delay_days: int = DELAY_DAYS) -> None:
    """Both outcomes of one batch: rows for Silver and its log, and rows for the quarantine with their reason.

    Of several deliveries of a user-day the newest counts, whichever batch brings it; the same one again changes
    nothing. Text that is no record, records without key, and rows out of bounds are quarantined as in a batch run.
    """
    spark, stage = house.spark, new_workspace(house.spark, "silver-stream")
    try:
        uploaded = F.coalesce(F.expr("try_cast(ingested_at as timestamp)"), F.current_timestamp())
        add_audit_columns(batch, run_id).withColumn("_ingest_timestamp", uploaded).write.parquet(f"{stage}/batch")
        staged = spark.read.parquet(f"{stage}/batch")
        malformed = staged.where(F.col(MALFORMED).isNotNull()).withColumn(REASON, F.lit("record is malformed")).withColumn(feed.key, F.lit(None).cast("string"))
        judged = silver.judged(staged.where(F.col(MALFORMED).isNull()).drop(MALFORMED), feed)
        since = open_since(house, feed, batch_id, delay_days)
        closed = f"{silver.AS_DATE} < date'{since}'" if since else "false"
        late = f"if({closed}, concat('day was closed: ', date), null)"
        judged = judged.withColumn(REASON, F.expr(f"nullif(concat_ws('; ', {REASON}, {late}), '')"))
        judged.write.parquet(f"{stage}/judged")
        judged = spark.read.schema(judged.schema).parquet(f"{stage}/judged")

        table = house.silver(feed).create_if_absent()
        valid = silver.one_per_user_day(feed.transform(valid_rows(judged)), feed.key).select(*feed.silver_layout.names)
        days = [r[0] for r in valid.select("date").distinct().collect()]  # open days only
        known = table.read(days=days).select(*silver.USER_DAY, F.col("_ingest_timestamp").alias("_known"))
        newer = valid.join(known, silver.USER_DAY, "left").where("_known is null or _ingest_timestamp > _known").drop("_known")
        log = f"{log_path(house, feed)}/batch={batch_id}"
        if not path_exists(spark, f"{log}/_SUCCESS"):  # the log goes first: it holds what the table will have
            newer.write.mode("overwrite").parquet(log)
        table.upsert(spark.read.schema(valid.schema).parquet(log), house.new_changes(feed))
        rejected = [quarantine_rows(rows, feed.key, feed.source_table) for rows in (judged, malformed.drop(MALFORMED))]
        house.quarantine().create_if_absent().upsert(union_all(rejected))
        last = judged.where(F.col(REASON).isNull()).agg(F.max(F.expr(silver.AS_DATE)).alias("last_day"))
        last.write.mode("overwrite").parquet(f"{_horizon_path(house, feed)}/batch={batch_id}")
    finally:
        delete_path(spark, stage)


def stream_silver(house: Lakehouse, feed: silver.Feed, folder: str, run_id: str, files_per_batch: int = 1000, delay_days: int = DELAY_DAYS) -> None:
    """Take every record-per-line file of ``folder`` that no earlier run has taken, then stop."""
    reader = house.spark.readStream.schema(with_malformed(feed.layout)).option("columnNameOfCorruptRecord", MALFORMED)
    arrivals = without_nan(reader.option("maxFilesPerTrigger", files_per_batch).json(folder), feed.layout)
    query = (
        arrivals.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{house.root}/progress/silver-{feed.name}")
        .foreachBatch(lambda batch, batch_id: take_batch(house, feed, batch, batch_id, run_id, delay_days))
        .start()
    )
    query.awaitTermination()
