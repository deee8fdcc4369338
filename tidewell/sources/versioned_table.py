"""Create-or-replace tables that keep their earlier versions readable."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.sources.json_feed import path_exists
from tidewell.sources.merged_table import delete_path

LOG_LAYOUT = "version long, committed_at timestamp_ntz, operation string, row_count long"


def live_versions(log: DataFrame) -> DataFrame:
    """Versions committed and not expired.  The log has a few rows per run."""
    gone = log.filter("operation = 'expire'").select("version")
    return log.filter("operation <> 'expire'").join(gone, "version", "left_anti")


def retention(log: DataFrame, older_than, retain_last: int = 3) -> DataFrame:
    """Marks each live version: kept when among the newest ``retain_last`` or not older than the time."""
    cutoff = older_than if not isinstance(older_than, dt.datetime) else F.lit(older_than).cast("timestamp_ntz")
    newest_first = Window.orderBy(F.col("version").desc())
    return live_versions(log).withColumn(
        "kept", (F.row_number().over(newest_first) <= retain_last) | (F.col("committed_at") >= cutoff)
    )


@dataclass
class VersionedTable:
    """Each replace writes a new version folder and then one log row; readers follow the log.

    A run that dies before the log row leaves the table as it was.  One writer at a time.
    """

    spark: SparkSession
    path: str

    def log(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/log"):
            return self.spark.createDataFrame([], LOG_LAYOUT)
        return self.spark.read.schema(LOG_LAYOUT).parquet(f"{self.path}/log")

    def _append_log(self, entries: list[tuple]) -> None:
        self.spark.createDataFrame(entries, LOG_LAYOUT).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def replace(self, df: DataFrame, committed_at: dt.datetime | None = None, operation: str = "replace") -> int:
        """Write ``df`` as the new version; returns its number."""
        version = 1
        if path_exists(self.spark, f"{self.path}/log"):
            version += self.log().agg(F.max("version")).first()[0]
        counted = Observation()
        (
            df.observe(counted, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .parquet(f"{self.path}/data/version={version}")
        )
        when = committed_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._append_log([(version, when, operation, counted.get["rows"])])
        return version

    def row_count(self, version: int) -> int:
        return self.log().filter((F.col("version") == version) & (F.col("operation") != "expire")).first()["row_count"]

    def read(self, version: int | None = None, as_of: dt.datetime | None = None) -> DataFrame:
        """The current version, a numbered one, or the newest committed at or before ``as_of``."""
        candidates = live_versions(self.log())
        if version is not None:
            candidates = candidates.filter(F.col("version") == version)
        if as_of is not None:
            candidates = candidates.filter(F.col("committed_at") <= F.lit(as_of).cast("timestamp_ntz"))
        chosen = candidates.agg(F.max("version")).first()[0]
        if chosen is None:
            raise LookupError(f"no such version in {self.path}: version={version}, as_of={as_of}")
        return self.spark.read.parquet(f"{self.path}/data/version={chosen}")

    def expire(self, older_than: dt.datetime, retain_last: int = 3) -> list[int]:
        """Drop versions older than the time, always keeping the newest few."""
        doomed = [r["version"] for r in retention(self.log(), older_than, retain_last).filter("NOT kept").collect()]
        if doomed:
            self._append_log([(v, older_than, "expire", None) for v in doomed])
            for version in doomed:
                delete_path(self.spark, f"{self.path}/data/version={version}")
        return doomed

    def compact(self) -> int:
        """Rewrite the current version into well-sized files with users and dates clustered."""
        current = self.read()
        order = [c for c in ("user_id", "date") if c in current.columns]
        packed = current.hint("rebalance")
        return self.replace(packed.sortWithinPartitions(*order) if order else packed, operation="compact")
