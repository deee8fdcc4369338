"""Clustering by several columns at once: rows in the order of interleaved bits (a Z curve)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that each column contributes: it is cut into so many ranges (to the power of two) of about equal size.
BITS = 8


def _bounds(rows: DataFrame, column: str) -> list:
    """The values between the ranges of a column: every 1/256th of its distinct values, in order.

    The ordered list is made by range, and one value per cut comes to the driver.
    """
    values = rows.select(F.col(column).alias("v")).where("v is not null").distinct()
    step = max(1, -(-values.count() // (1 << BITS)))
    ordered = values.repartitionByRange("v").sortWithinPartitions("v").withColumn("at", F.monotonically_increasing_id())
    place = F.col("at").bitwiseAND((1 << 33) - 1)  # within its partition
    cuts = ordered.where(place % step == 0).select("v").collect()  # at most one more per partition than asked for
    return sorted(r["v"] for r in cuts)


def _range_of(column: str, bounds: Sequence) -> Column:
    """The range that a value lies in, on a scale of BITS bits however many ranges there are; NULL is in the first."""
    places = F.array(*(F.lit(b) for b in bounds))
    number = F.coalesce(F.size(F.filter(places, lambda b: b <= F.col(column))), F.lit(0))
    return F.floor(number * ((1 << BITS) - 1) / max(len(bounds), 1))


def z_value(columns: Sequence[Column]) -> Column:
    """The BITS bits of each column (whole numbers) in turn, the highest of each first."""
    bits = [
        F.shiftleft(F.shiftright(column, bit).bitwiseAND(1).cast("long"), bit * len(columns) + len(columns) - 1 - place)
        for place, column in enumerate(columns)
        for bit in range(BITS)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def z_ordered(rows: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """``rows`` dealt into ``files`` ranges of the curve over ``columns`` and sorted along it.

    A file then covers a small part of each column, so that filters on any of them skip files by their statistics.
    Many rows with the same values can share a range of the curve; the other columns cut it further.
    """
    curve = z_value([_range_of(c, _bounds(rows, c)) for c in columns])
    return rows.withColumn("_z", curve).repartitionByRange(files, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z")
