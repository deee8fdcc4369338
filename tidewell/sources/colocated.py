"""Stored tables whose rows of a user lie in one bucket, read by name through the catalog.

What is bucketed by user needs no exchange for windows over users. Pairing two such tables by user and day needs none
either, if they meet by user alone: each brings the days of a user as one row, and these are taken apart again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a table; a cluster reads as many at once.
BUCKETS = 16


def create_database(spark: SparkSession, name: str, location: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    return name


def save_by_user(rows: DataFrame, table: str, buckets: int = BUCKETS) -> None:
    """Create or replace a catalog table with its rows in buckets by user, sorted by user and day: a file per bucket."""
    dealt = rows.repartition(buckets, "user_id")  # the same hash as that of the buckets
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, "user_id").sortBy("user_id", "date").saveAsTable(table)


def paired(spark: SparkSession, left: str, right: str, left_columns: Sequence[str], right_columns: Sequence[str]) -> DataFrame:
    """The rows of user-days that both tables hold, without an exchange. Both have one row per user and day."""
    a, b = spark.table(left), spark.table(right)
    kinds = {**{f.name: f.dataType for f in b.schema.fields}, **{f.name: f.dataType for f in a.schema.fields}}
    columns = [*left_columns, *right_columns]

    def side(rows: DataFrame, own: Sequence[str], number: int) -> DataFrame:
        values = [F.col(c) if c in own else F.lit(None).cast(kinds[c]).alias(c) for c in columns]
        day = F.struct("date", *values, F.lit(number).alias("_side"))
        return rows.groupBy("user_id").agg(F.collect_list(day).alias(f"_days_{number}"))  # no longer than the calendar

    both = side(a, left_columns, 1).join(side(b, right_columns, 2).hint("merge"), "user_id")
    days = both.select("user_id", F.inline(F.concat("_days_1", "_days_2")))
    together = days.groupBy("user_id", "date").agg(F.bit_or("_side").alias("_side"), *(F.max(c).alias(c) for c in columns))
    return together.where("_side = 3").drop("_side")
