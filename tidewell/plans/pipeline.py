"""The three layers with their writes: Bronze upserts, Silver upserts and quarantine, Gold versions."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.operators.quality import gate_summary, run_gate
from tidewell.operators.validate import REASON, quarantine_rows, union_all, valid_rows
from tidewell.plans import gold, silver
from tidewell.plans.bronze import add_audit_columns
from tidewell.session import at_once, new_workspace
from tidewell.sources.json_feed import MALFORMED, path_exists, read_feed, write_records
from tidewell.sources.merged_table import MergedTable, delete_path
from tidewell.sources.versioned_table import VersionedTable

FILES = {"hrv_readings": "hrv.json", "sleep_records": "sleep.json", "activity_records": "activity.json"}
GOLD_TABLES = ["daily_recovery", "user_strain_summary", "sleep_analytics", "cohort_benchmarks"]


@dataclass
class Lakehouse:
    """All tables below one shared root folder."""

    spark: SparkSession
    root: str

    def bronze(self, feed: silver.Feed) -> MergedTable:
        return self._by_text_date(f"bronze/{feed.name}", schemas.with_audit(feed.layout), [feed.key])

    def _by_text_date(self, place: str, layout, keys: list[str]) -> MergedTable:
        # a record id holds its day, and a quarantined record keeps the date it came with
        return MergedTable(self.spark, f"{self.root}/{place}", layout, keys, "_day", silver.AS_DATE, key_fixes_partition=True)

    def skin_temp(self) -> MergedTable:
        return self._by_text_date("bronze/skin_temp_readings", schemas.with_audit(schemas.SKIN_TEMP), ["record_id"])

    def silver(self, feed: silver.Feed) -> MergedTable:
        name = {"hrv_readings": "hrv_clean", "sleep_records": "sleep_clean", "activity_records": "activity_clean"}
        return MergedTable(self.spark, f"{self.root}/silver/{name[feed.name]}", feed.silver_layout, silver.USER_DAY)

    def quarantine(self) -> MergedTable:
        return self._by_text_date("silver/quarantine", schemas.QUARANTINE, ["source_table", "record_id"])

    def new_changes(self, feed: silver.Feed) -> str:
        """A folder for the user-days that one upsert of a Silver table changes."""
        return f"{self.root}/changes/{feed.name}/{uuid.uuid4().hex}"

    def gold(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/gold/{name}")


def _into_bronze(house: Lakehouse, feed: silver.Feed, raw: DataFrame, run_id: str, stage: str) -> DataFrame:
    """Upsert delivered records; returns the quarantine's rows of those that are no record or have no key."""
    raw.write.parquet(stage)  # parsed once, read for both
    parsed = house.spark.read.schema(raw.schema).parquet(stage)
    keyed = F.col(feed.key).isNotNull() & F.col(MALFORMED).isNull()
    house.bronze(feed).create_if_absent().upsert(add_audit_columns(parsed.where(keyed).drop(MALFORMED), run_id))
    reason = F.when(F.col(MALFORMED).isNotNull(), F.lit("record is malformed")).otherwise(F.lit("record key is missing"))
    unkeyed = parsed.where(~keyed).withColumn(REASON, reason).withColumn(feed.key, F.lit(None).cast("string"))
    return quarantine_rows(unkeyed, feed.key, feed.source_table)


def load_bronze(house: Lakehouse, feed: silver.Feed, raw: DataFrame, run_id: str) -> None:
    """Upsert delivered records; what is no record or has no key goes to the quarantine with its text."""
    stage = new_workspace(house.spark, "bronze-stage")
    try:
        house.quarantine().create_if_absent().upsert(_into_bronze(house, feed, raw, run_id, stage))
    finally:
        delete_path(house.spark, stage)


def run_bronze(house: Lakehouse, data_dir: str, run_id: str) -> None:
    """Load every delivered feed file; loading a file again changes nothing but the audit columns.

    Feeds are loaded side by side, and what is wrong in any of them goes to the quarantine in one upsert."""
    # told apart one after the other: reading large arrays holds a setting of the session
    raws = [read_feed(house.spark, f"{data_dir}/{FILES[feed.name]}", feed.layout, keep_malformed=True) for feed in silver.FEEDS]
    stage_root = new_workspace(house.spark, "bronze-stage")
    try:
        loads = (partial(_into_bronze, house, feed, raw, run_id, f"{stage_root}/{feed.name}") for feed, raw in zip(silver.FEEDS, raws, strict=True))
        house.quarantine().create_if_absent().upsert(union_all(at_once(*loads)))
    finally:
        delete_path(house.spark, stage_root)
    # a sensor that joins later: its table appears with its first file
    late = f"{data_dir}/skin_temp.json"
    if path_exists(house.spark, late):
        raw = read_feed(house.spark, late, schemas.SKIN_TEMP)
        if not raw.isEmpty():
            house.skin_temp().create_if_absent().upsert(add_audit_columns(raw, run_id))


def run_silver(house: Lakehouse, since: str | None = None, track: bool = False) -> dict[str, dict[str, int]]:
    """Clean every feed; returns valid and rejected counts per feed.

    With ``track`` the user-days that change are noted for ``incremental.update_gold``.

    ``since`` limits the run to Bronze partitions from that day on; without it all are read.
    The judged rows are written once and both outcomes are read back from there, so the
    deduplication behind them runs a single time and the counts come along with the write.
    """
    spark = house.spark
    stage_root = new_workspace(spark, "silver-stage")

    def cleaned(feed: silver.Feed) -> tuple[dict[str, int], DataFrame]:
        judged = silver.judged(house.bronze(feed).read(since), feed)
        seen, stage = Observation(), f"{stage_root}/{feed.name}"
        (
            judged.observe(
                seen,
                F.count_if(F.col(REASON).isNull()).alias("valid"),
                F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
            )
            .write.parquet(stage)
        )
        staged = spark.read.schema(judged.schema).parquet(stage)
        house.silver(feed).create_if_absent().upsert(feed.transform(valid_rows(staged)), house.new_changes(feed) if track else None)
        return seen.get, quarantine_rows(staged, feed.key, feed.source_table)

    try:
        counts, rejected = zip(*at_once(*(partial(cleaned, feed) for feed in silver.FEEDS)), strict=True)
        # by record rather than appended: a second run reports each bad record once
        house.quarantine().create_if_absent().upsert(union_all(list(rejected)))
    finally:
        delete_path(spark, stage_root)
    return dict(zip((feed.name for feed in silver.FEEDS), counts, strict=True))


@contextmanager
def _shared_user_hash(spark: SparkSession):
    """Lets a join on (user, date) use inputs hashed on the user alone while the block runs."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_gold(house: Lakehouse, users: DataFrame) -> dict[str, int]:
    """Replace the four Gold tables; returns the version of each."""
    hrv, sleep, activity = (house.silver(feed).read() for feed in silver.FEEDS)

    def replaced(name: str, rows: DataFrame) -> int:
        return house.gold(name).replace(gold.stamped(rows))

    def recovery() -> tuple[int, int]:
        version = replaced("daily_recovery", gold.daily_recovery(hrv, sleep, colocate=True))
        return version, replaced("cohort_benchmarks", gold.cohort_benchmarks(house.gold("daily_recovery").read()))

    with _shared_user_hash(house.spark):
        (days, cohorts), strain, nights = at_once(
            recovery,
            lambda: replaced("user_strain_summary", gold.strain_scores(activity, users)),
            lambda: replaced("sleep_analytics", gold.sleep_metrics(sleep)),
        )
    return {"daily_recovery": days, "user_strain_summary": strain, "sleep_analytics": nights, "cohort_benchmarks": cohorts}


def run_gate_report(house: Lakehouse, data_dir: str, report_path: str) -> DataFrame:
    """Check the delivered raw files and write the rule results as JSON; returns the summary."""
    feeds = {
        feed.name: read_feed(house.spark, f"{data_dir}/{FILES[feed.name]}", feed.layout)
        for feed in silver.FEEDS
        if path_exists(house.spark, f"{data_dir}/{FILES[feed.name]}")
    }
    results = run_gate(feeds)
    write_records(results.withColumn("run_timestamp", F.current_timestamp()), report_path)
    return gate_summary(house.spark.read.schema(results.schema).json(report_path))


def maintain_gold(house: Lakehouse, older_than, retain_last: int = 3) -> None:
    for name in GOLD_TABLES[:3]:
        table = house.gold(name)
        table.compact()
        table.expire(older_than, retain_last)


def export_gold(house: Lakehouse, out_dir: str) -> None:
    """The Gold tables as JSON records."""
    for name in GOLD_TABLES:
        write_records(house.gold(name).read(), f"{out_dir}/{name}.json")


def gold_or_recomputed(house: Lakehouse, name: str, recompute) -> DataFrame:
    """The stored Gold table, or its recomputation where none has been written."""
    table = house.gold(name)
    return table.read() if path_exists(house.spark, f"{table.path}/log") else recompute()
