"""Percent rank over a whole table without pulling the table into one window partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOT_SHARE = 1000


def percent_rank_over(df: DataFrame, value: str, out: str, low: float, high: float, slices: int = 100_000, by: str | None = None) -> DataFrame:
    """``percent_rank() OVER (ORDER BY value)`` as a column, NULLs first, equal to the built-in.

    ``percent_rank`` with no PARTITION BY sorts the whole table in one task.  Here:

    1. equal values collapse to (value, rows) with a combine before the shuffle;
    2. values fall into at most ``slices`` equal slices of the known domain [low, high]; only the
       slice totals, never more than ``slices + 2`` rows, are summed up in one place and broadcast;
    3. rows below a value = rows in lower slices + rows of smaller values in its slice.

    The rank goes back by an equi-join on the value.  At most ``HOT_SHARE`` values can hold more than
    a ``1/HOT_SHARE`` share of the rows; those are broadcast, so a value shared by a third of the
    table moves no rows.  The value must be reproducible (an integer, or a quotient of integers):
    it is a join key.  Values outside the domain go to the end slices and stay exact, but a slice is
    sorted in one task: the domain should hold nearly all values.

    With ``by``, a column of few values, the rank is taken within each of them (NULL is one).
    """
    own = F.lit(0) if by is None else F.col(by)
    df = df.withColumn("_by", own)
    width = (high - low) / slices
    position = F.floor((F.col(value) - F.lit(float(low))) / F.lit(width))
    slice_no = F.when(position.isNull(), -1).otherwise(F.greatest(F.lit(0), F.least(F.lit(slices), position))).cast("int")

    sizes = df.groupBy("_by", value).agg(F.count("*").alias("_rows")).withColumn("_slice", slice_no)
    totals = sizes.groupBy("_by", "_slice").agg(F.sum("_rows").alias("_in_slice"))
    running = Window.partitionBy("_by").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_by").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        F.col("_by").alias("_of"),
        F.col("_slice").alias("_at"),
        F.coalesce(F.sum("_in_slice").over(running), F.lit(0)).alias("_before"),
        F.sum("_in_slice").over(whole).alias("_total"),
    )
    smaller = Window.partitionBy("_by", "_slice").orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        sizes.withColumn("_smaller", F.coalesce(F.sum("_rows").over(smaller), F.lit(0)))
        .join(F.broadcast(starts), F.col("_by").eqNullSafe(F.col("_of")) & (F.col("_slice") == F.col("_at")))
        .select(
            "_of",
            F.col(value).alias("_value"),
            (F.col("_rows") * HOT_SHARE > F.col("_total")).alias("_hot"),
            F.when(F.col("_total") > 1, (F.col("_before") + F.col("_smaller")) / (F.col("_total") - 1))
            .otherwise(F.lit(0.0))
            .alias(out),
        )
    )
    hot = F.broadcast(ranks.filter("_hot").select("_of", "_value", out))
    cold = ranks.filter(~F.col("_hot")).select("_of", "_value", out)
    same = F.col(value).eqNullSafe(F.col("_value")) & F.col("_by").eqNullSafe(F.col("_of"))
    from_hot = df.join(hot, same, "inner")
    from_cold = df.join(hot.select("_of", "_value"), same, "left_anti").join(cold, same, "inner")
    return from_hot.unionByName(from_cold).drop("_value", "_by", "_of")
