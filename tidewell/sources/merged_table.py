"""Date-partitioned Parquet tables with keyed upserts."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.latest import RECENCY, latest_per_key
from tidewell.schemas import as_nullable
from tidewell.session import new_workspace

#: Of every table that this process has changed, by its path, what lets one change run at a time.
_TURNS: dict[str, threading.RLock] = {}


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@dataclass
class MergedTable:
    """One row per key, rows stored by day.

    ``partition`` names the column the files are laid out by.  Feeds carry their date as text, which
    may be anything, so their tables derive the day with ``partition_from``: text that is no day shares
    one partition, and the number of partitions stays that of the calendar.

    An upsert rewrites only the dates it touches, by dynamic partition overwrite: new files are
    staged and moved in at job commit, so lost tasks are simply run again, and repeating an upsert
    gives the same table.  Changes that threads of one driver ask for side by side take turns, as each reads the
    days that it writes again; several drivers must not write to one table.  Should the driver die while a commit moves files, a
    day can be left without its old rows: run the upsert again from its source, and for days that other
    sources brought, theirs as well.

    Where the day is not part of the key, a row may move to another day, and an upsert has to look for
    its key in all days.  ``key_fixes_partition`` declares that keys never move, and limits it to the
    days that come in.
    """

    spark: SparkSession
    path: str
    layout: T.StructType
    keys: Sequence[str]
    partition: str = "date"
    partition_from: str | None = None
    key_fixes_partition: bool = False

    def _stored_layout(self) -> T.StructType:
        fields = as_nullable(self.layout).fields
        if self.partition in self.layout.names:
            return T.StructType(fields)
        return T.StructType([*fields, T.StructField(self.partition, T.DateType())])

    def _turn(self) -> threading.RLock:
        return _TURNS.setdefault(self.path, threading.RLock())

    def create_if_absent(self) -> "MergedTable":
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(where)
        return self

    def declare(self, database: str, name: str) -> None:
        """Enter the table into the session catalog, so that SQL can read it by name."""
        self.create_if_absent()
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.path}.db'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._stored_layout().fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet "
            f"PARTITIONED BY (`{self.partition}`) LOCATION '{self.path}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE `{database}`.`{name}`")

    def _stored(self) -> DataFrame:
        layout = self._stored_layout()
        return self.spark.read.schema(layout).parquet(self.path).select(*layout.names)

    def read(self, since: str | None = None, days: Sequence | None = None) -> DataFrame:
        """The rows, or only those of the partitions from a day on, or of the partitions named."""
        rows = self._stored()
        if days is not None:
            rows = rows.filter(self._on_dates(days))
        if since is not None:
            rows = rows.filter(F.col(self.partition) >= F.lit(since).cast("date"))
        return rows.select(*self.layout.names)

    def _write(self, df: DataFrame, sort_by: Sequence[str] = ()) -> None:
        # the rebalance step cuts large days into several files and packs small ones together
        packed = df.hint("rebalance", self.partition)
        if sort_by:
            packed = packed.sortWithinPartitions(*sort_by)
        (
            packed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.partition)
            .parquet(self.path)
        )

    def _on_dates(self, dates: Sequence) -> Column:
        known = [d for d in dates if d is not None]
        match = F.col(self.partition).isin(known) if known else F.lit(False)
        return match | F.col(self.partition).isNull() if len(known) < len(dates) else match

    def _dates(self, df: DataFrame) -> list:
        """Distinct dates, a list no longer than the calendar."""
        return [row[0] for row in df.select(self.partition).distinct().collect()]

    def upsert(self, source: DataFrame, changes_to: str | None = None) -> None:
        """Insert new keys, replace rows of known keys; the newest row wins within the source.

        A key that is not complete raises: such rows could never be matched, and a repeated run would
        insert them again. The source is written once; its days and its incomplete keys are counted on
        the way.

        The keys of rows that are new, or differ from the stored ones in more than the record of their ingestion,
        are written to the folder ``changes_to`` before the table changes; a repeated run can only name more.
        """
        keys = list(self.keys)
        newest = latest_per_key(source, keys).select(*self.layout.names)
        if self.partition_from:
            newest = newest.withColumn(self.partition, F.expr(self.partition_from))
        stage, seen = new_workspace(self.spark, "upsert"), Observation()
        incomplete = " or ".join(f"`{k}` is null" for k in keys)
        try:
            newest.observe(
                seen,
                F.count_if(F.expr(incomplete)).alias("incomplete"),
                F.count_if(F.col(self.partition).isNull()).alias("no_day"),
                F.collect_set(self.partition).alias("days"),  # no longer than the calendar
            ).write.parquet(stage)
            if seen.get["incomplete"]:
                raise ValueError(f"{seen.get['incomplete']} rows without a complete key ({', '.join(keys)})")
            days = [*seen.get["days"], *([None] if seen.get["no_day"] else [])]
            incoming = self.spark.read.schema(newest.schema).parquet(stage)
            self._noted(incoming, days, changes_to)
        finally:
            delete_path(self.spark, stage)

    def _changed(self, incoming: DataFrame, days: list) -> DataFrame:
        """The keys of incoming rows that the table does not hold with these values, on tables whose keys fix the day."""
        keys = list(self.keys)
        if self._is_empty():
            return incoming.select(*keys)
        values = F.struct(*(c for c in self.layout.names if c not in keys and c not in RECENCY))
        known = self._stored().filter(self._on_dates(days)).select(*keys, values.alias("_held"))
        beside = incoming.select(*keys, values.alias("_values")).join(known, keys, "left")
        return beside.filter(~F.col("_values").eqNullSafe(F.col("_held"))).select(*keys)

    def merge(self, rows: DataFrame, changes_to: str | None = None) -> None:
        """Upsert rows that are stored elsewhere already and have distinct and complete keys."""
        self._noted(rows, self._dates(rows), changes_to)

    def _noted(self, incoming: DataFrame, days: list, changes_to: str | None) -> None:
        with self._turn():
            if changes_to:
                self._changed(incoming, days).write.mode("overwrite").parquet(changes_to)
            self._merge(incoming, days)

    def _merge(self, incoming: DataFrame, new_dates: list) -> None:
        keys, left = list(self.keys), []
        if not new_dates:
            return
        if self._is_empty():
            self._write(incoming)
            return
        if self.partition not in keys and not self.key_fixes_partition:
            matched = self._stored().select(*keys, self.partition).join(incoming.select(*keys), keys, "left_semi")
            left = [d for d in self._dates(matched) if d not in new_dates]
        kept = self._stored().filter(self._on_dates(new_dates + left)).join(incoming.select(*keys), keys, "left_anti")
        emptied = []
        if left:
            # rows that moved to another date may leave their old date without any row
            remaining = self._dates(kept.filter(self._on_dates(left)))
            emptied = [d for d in left if d not in remaining]
        self._write(kept.unionByName(incoming))
        for date in emptied:
            value = "__HIVE_DEFAULT_PARTITION__" if date is None else date
            delete_path(self.spark, f"{self.path}/{self.partition}={value}")

    def _is_empty(self) -> bool:
        """Whether no partition has been written yet; one listing of the table's folder."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.partition}=*")
        return not self.spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(where)

    def compact(self) -> None:
        """Rewrite every day with rebalanced files, rows of a key next to each other."""
        with self._turn():
            self._write(self._stored(), sort_by=[self.partition, *self.keys])
