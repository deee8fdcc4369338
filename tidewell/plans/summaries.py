"""Summaries that add up: stored once per user and month, or table and day, merged for any range later.

Quantiles come from KLL sketches, distinct users from bitmaps over a numbering of the users. Merging touches the
summaries of the range only, never the rows behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Size of a sketch: with up to so many values it holds them all, and quantiles are exact.
SKETCH_SIZE = 200
#: Parts that users are numbered in.
NUMBER_PARTS = 64


def rank_error(k: int = SKETCH_SIZE) -> float:
    """How far the rank of a quantile can be off, as a share of all values, in 99 of 100 cases: the published
    fit for these sketches, and what merging does not add to."""
    return 2.446 / k**0.9433


def _month(day: str = "date") -> Column:
    return F.trunc(day, "month").alias("month")


def quantile_sketches(rows: DataFrame, value: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One sketch of ``value`` per user and month. A month without values has a sketch of nothing and is left out."""
    known = rows.where(F.col(value).isNotNull())
    return known.groupBy("user_id", _month()).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str], shares: dict[str, float], since=None, until=None) -> DataFrame:
    """``by`` with ``readings`` and a column per share, over the sketches of the months from ``since`` to ``until``.

    With fewer values than SKETCH_SIZE the result is exact: the least value with at least that share at or below it.
    """
    chosen = sketches
    if since is not None:
        chosen = chosen.where(F.col("month") >= F.lit(since))
    if until is not None:
        chosen = chosen.where(F.col("month") <= F.lit(until))
    merged = chosen.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("_all"))
    merged = merged.where(F.kll_sketch_get_n_double("_all") > 0)  # over no rows at all there is one of nothing
    quantiles = [F.kll_sketch_get_quantile_double("_all", F.lit(share)).alias(name) for name, share in shares.items()]
    return merged.select(*by, F.kll_sketch_get_n_double("_all").alias("readings"), *quantiles)


def ranks_of(rows: DataFrame, value: str, quantiles: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Per share of one row of quantiles: the exact shares of values below it, and at or below it, in one pass."""
    found = quantiles.first()  # a number per share
    at = {name: F.lit(found[name] if found else None).cast("double") for name in shares}
    mean = lambda condition: F.avg(condition.cast("double"))
    known = rows.where(F.col(value).isNotNull())
    one = known.agg(*(mean(F.col(value) < q).alias(f"below_{n}") for n, q in at.items()), *(mean(F.col(value) <= q).alias(f"up_to_{n}") for n, q in at.items()))
    told = [F.struct(F.lit(n).alias("name"), F.lit(share).alias("share"), F.col(f"below_{n}").alias("below"), F.col(f"up_to_{n}").alias("up_to")) for n, share in shares.items()]
    return one.select(F.inline(F.array(*told)))


def numbered(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``user_id`` and ``number`` for every user: numbers that are given stay, new users get the next ones of their
    part, so numbers stay close together without any task seeing all users."""
    part = F.pmod(F.xxhash64("user_id"), F.lit(NUMBER_PARTS))
    new = users.select("user_id").where("user_id is not null").distinct()
    if known is None:
        known = new.select("user_id", F.lit(0).cast("long").alias("number")).limit(0)
    new = new.join(known, "user_id", "left_anti").withColumn("_part", part)
    taken = known.groupBy((F.col("number") % NUMBER_PARTS).alias("_part")).agg(F.max(F.floor(F.col("number") / NUMBER_PARTS)).alias("_last"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("user_id"))
    placed = new.withColumn("_place", place).join(F.broadcast(taken), "_part", "left")  # a row per part
    number = ((F.coalesce("_last", F.lit(-1)) + F.col("_place")) * NUMBER_PARTS + F.col("_part")).cast("long")
    return known.select("user_id", "number").unionByName(placed.select("user_id", number.alias("number")))


def daily_users(rows: DataFrame, numbers: DataFrame, source_table: str) -> DataFrame:
    """Who sent anything, per day: bitmaps of the users' numbers, one per 32,768 of them."""
    seen = rows.join(numbers, "user_id").select("date", "number")
    bucket, bit = F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number")
    maps = seen.groupBy("date", bucket).agg(F.bitmap_construct_agg(bit).alias("users"))
    return maps.select(F.lit(source_table).alias("source_table"), "date", "bucket", "users")


def distinct_users(daily: DataFrame, period: str) -> DataFrame:
    """Distinct users per table and ``day``, ``week`` (from Monday) or ``month``, from the daily bitmaps."""
    first = F.col("date") if period == "day" else F.date_trunc(period, "date").cast("date")
    merged = daily.groupBy("source_table", first.alias("first_day"), "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    counted = merged.groupBy("source_table", "first_day").agg(F.sum(F.bitmap_count("users")).alias("users"))
    return counted.select("source_table", F.lit(period).alias("period"), "first_day", "users")
