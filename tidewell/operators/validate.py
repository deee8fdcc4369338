"""Bound validation: valid rows, quarantined rows with reasons, rejection rates, violation lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.bounds import Bounds, all_within, breach_text, present, side_reason, within
from tidewell.functions.numeric import half_even, ratio

REASON = "_rejection_reason"


def with_rejection_reason(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Adds the reasons as one text column, NULL for a valid row."""
    limits = present(bounds, df.columns)
    return df.withColumn(REASON, F.expr(f"if({all_within(limits)}, null, {breach_text(limits)})"))


def valid_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(REASON).isNull()).drop(REASON)


def quarantine_rows(judged: DataFrame, id_column: str, source_table: str, now: Column | None = None) -> DataFrame:
    """Rejected rows in the quarantine layout, each with the whole record as JSON.

    A row without key gets one from its content, so that the quarantine reports it once.
    """
    record = [c for c in judged.columns if c != REASON]
    return judged.filter(F.col(REASON).isNotNull()).select(
        F.lit(source_table).alias("source_table"),
        F.coalesce(id_column, F.concat(F.lit("no-key-"), F.hex(F.xxhash64(*record)))).alias("record_id"),
        F.col("user_id"),
        F.col("date").cast("string").alias("date"),
        F.col(REASON).alias("rejection_reason"),
        F.to_json(F.struct(*record)).alias("raw_record"),
        (F.current_timestamp() if now is None else now).alias("quarantined_at"),
    )


def split_by_bounds(df: DataFrame, bounds: Bounds, id_column: str, source_table: str) -> tuple[DataFrame, DataFrame]:
    judged = with_rejection_reason(df, bounds)
    return valid_rows(judged), quarantine_rows(judged, id_column, source_table)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rejection_rate(judged: DataFrame, source_table: str) -> DataFrame:
    """Valid and rejected counts with the percentage, one row, also for an empty table."""
    valid, bad = F.count_if(F.col(REASON).isNull()), F.count_if(F.col(REASON).isNotNull())
    return judged.agg(valid.alias("valid_count"), bad.alias("invalid_count")).select(
        F.lit(source_table).alias("source_table"),
        "valid_count",
        "invalid_count",
        F.expr(f"round({ratio('invalid_count * 100D', 'double(valid_count + invalid_count)')}, 1)").alias("rejection_pct"),
    )


def rule_violations(df: DataFrame, bounds: Bounds, id_column: str, source_table: str) -> DataFrame:
    """One row per broken rule: which record, which rule, what value, on which side and why."""
    checks = [
        f"if(not {within(name, low, high)}, named_struct("
        f"'failed_rule', '{name} ∈ [{low}, {high}]', 'value', {half_even(f'double({name})', 1)}, "
        f"'side', if({name} < {low}, 'low', 'high'), 'why_it_fails', {side_reason(name, low, high)}), null)"
        for name, (low, high) in present(bounds, df.columns).items()
    ]
    return df.selectExpr(
        f"'{source_table}' as source_table",
        f"{id_column} as record_id",
        f"inline(array_compact(array({', '.join(checks)})))",
    )


def rule_counts(violations: DataFrame) -> DataFrame:
    """Violations and distinct records per rule, with the records that break other rules too.

    Violations without a record id each count as a record of their own that breaks one rule: nothing
    says which belong together.
    """
    broken = violations.groupBy("source_table", "record_id", "failed_rule").agg(F.count("*").alias("n"))
    rules_broken = F.count("*").over(Window.partitionBy("source_table", "record_id"))  # at most one row per rule
    several = F.col("record_id").isNotNull() & (F.col("rules_broken") > 1)
    return (
        broken.withColumn("rules_broken", rules_broken)
        .groupBy("source_table", "failed_rule")
        .agg(
            F.sum("n").alias("violations"),
            F.sum(F.when(F.col("record_id").isNull(), F.col("n")).otherwise(1)).alias("records"),
            F.count_if(several).alias("records_breaking_several"),
        )
    )


def pass_rate(tables: list[tuple[DataFrame, Bounds, str]]) -> DataFrame:
    """Scanned and quarantined records, pass rate and rule count over several tables, one row.

    Records are counted once however often they break rules or appear.
    """
    per_row = [
        df.selectExpr(f"if({all_within(present(bounds, df.columns))}, null, {key}) as bad_record", "1 as one")
        for df, bounds, key in tables
    ]
    rules = sum(len(present(bounds, df.columns)) for df, bounds, _ in tables)
    counted = union_all(per_row).agg(
        F.count("one").alias("records_scanned"), F.count_distinct("bad_record").alias("quarantined")
    )
    scanned = F.greatest(F.col("records_scanned"), F.lit(1)).cast("double")
    return counted.select(
        "records_scanned",
        "quarantined",
        F.round((F.col("records_scanned") - F.col("quarantined")) / scanned * 100.0, 2).alias("pass_rate_pct"),
        F.lit(rules).alias("rules_enforced"),
    )
