"""Rule suites over the raw feeds: one aggregation per table, one result row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.validate import union_all


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    low: float | None = None
    high: float | None = None

    def expectation(self) -> str:
        wording = {
            "not_null": f"column '{self.column}' to not be null",
            "between": f"column '{self.column}' to be between {self.low} and {self.high}",
            "unique": f"column '{self.column}' to be unique",
        }
        return wording[self.kind]

    def failures(self) -> Column:
        """How many rows fail, as an aggregate."""
        value = F.col(self.column)
        if self.kind == "not_null":
            return F.count_if(value.isNull())
        if self.kind == "between":
            return F.count_if((value < self.low) | (value > self.high))
        if self.kind == "unique":
            # rows beyond the first of each value; all NULLs together count as one value
            return F.count("*") - F.count_distinct(value) - F.max(F.when(value.isNull(), 1).otherwise(0))
        raise ValueError(f"unknown rule kind {self.kind!r}")

    def complaint(self) -> str:
        return {
            "not_null": "null values found",
            "between": "out-of-range values",
            "unique": "duplicates found",
        }[self.kind]


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", c) for c in columns]


def between(**limits: tuple[float, float]) -> list[Rule]:
    return [Rule("between", c, low, high) for c, (low, high) in limits.items()]


# What the gate expects of each feed.  Wider than the Silver limits on purpose.
SUITES = {
    "hrv_readings": not_null("reading_id", "user_id", "date")
    + between(hrv_rmssd_ms=(5, 250), hrv_sdnn_ms=(10, 400), respiratory_rate_brpm=(8, 30))
    + [Rule("unique", "reading_id")],
    "sleep_records": not_null("record_id", "user_id")
    + between(
        total_sleep_hours=(0, 16), sleep_efficiency_pct=(0, 100), spo2_avg_pct=(80, 100), resting_hr_bpm=(25, 140)
    )
    + [Rule("unique", "record_id")],
    "activity_records": not_null("record_id", "user_id")
    + between(steps=(0, 100000), avg_hr_bpm=(30, 220), peak_hr_bpm=(30, 225))
    + [Rule("unique", "record_id")],
}


def check_rules(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """Columns ``table_name, rule_no, expectation, passed, details, failing_rows``."""
    counted = df.agg(*[F.coalesce(rule.failures(), F.lit(0)).alias(f"_f{i}") for i, rule in enumerate(rules)])
    outcomes = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("rule_no"),
                F.lit(rule.expectation()).alias("expectation"),
                F.col(f"_f{i}").cast("long").alias("failing_rows"),
                F.lit(rule.complaint()).alias("complaint"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counted.select(F.explode(outcomes).alias("_r")).select(
        F.lit(table).alias("table_name"),
        "_r.rule_no",
        "_r.expectation",
        (F.col("_r.failing_rows") == 0).alias("passed"),
        F.when(F.col("_r.failing_rows") == 0, "OK")
        .otherwise(F.concat_ws(" ", F.col("_r.failing_rows").cast("string"), F.col("_r.complaint")))
        .alias("details"),
        "_r.failing_rows",
    )


def run_gate(feeds: dict[str, DataFrame], suites: dict[str, list[Rule]] | None = None) -> DataFrame:
    """All rules of all given feeds; a feed that was not delivered is left out."""
    suites = SUITES if suites is None else suites
    return union_all([check_rules(feeds[name], name, rules) for name, rules in suites.items() if name in feeds])


def user_date_uniqueness(df: DataFrame, table: str) -> DataFrame:
    """Whether every user has one row a day at most; rows without user or date count as of one user and day."""
    days = df.groupBy("user_id", "date").agg(F.count("*").alias("n"))
    return days.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"), F.count_if(F.col("n") > 1).alias("user_days_affected")
    ).select(F.lit(table).alias("table_name"), "surplus_rows", "user_days_affected", (F.col("surplus_rows") == 0).alias("passed"))


def gate_summary(results: DataFrame) -> DataFrame:
    """Passed and total rules per table and whether the gate as a whole is open."""
    per_table = results.groupBy("table_name").agg(
        F.count_if("passed").alias("rules_passed"), F.count("*").alias("rules_total")
    )
    over_tables = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per_table.select(
        "table_name",
        "rules_passed",
        "rules_total",
        F.round(F.col("rules_passed") / F.col("rules_total") * 100.0, 1).alias("pass_rate_pct"),
        F.every(F.col("rules_passed") == F.col("rules_total")).over(over_tables).alias("overall_passed"),
    )
