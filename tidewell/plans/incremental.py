"""Gold kept up to date: only the user-days that a change can reach are computed again and merged.

Every upsert of a Silver table notes the user-days that it changes. From these follow the rows to compute:

* recovery of a changed row and of the seven rows after it, as their baselines hold it; and every row of the
  same user that still falls back on the whole history, wherever it is;
* sleep analytics of a changed row and of the thirteen after it;
* strain of a changed row, and of all rows of a user whose maximum heart rate changed;
* the benchmarks of the users whose recovery changed, ranked among all users.

Rows count, not calendar days, so the days to read are found by looking at the keys around a change, further out only
around those changes that have too few rows yet. What would need a user's whole history is kept in one row per user:
first and last day, the days that fall back, counts and sums. Partitions of other days are neither read nor
written.

A run is computed into a folder of its own first. Only when it is complete is it merged, by key, so a run that dies
is merged again by the next one with the same result. One writer at a time, as for the tables themselves.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import schemas
from tidewell.functions import scoring as S
from tidewell.plans import gold, silver
from tidewell.plans.pipeline import Lakehouse
from tidewell.session import at_once
from tidewell.sources.json_feed import path_exists
from tidewell.sources.merged_table import MergedTable, delete_path

USER_DAY = silver.USER_DAY
#: Files of user rows: a user's row is in the bucket of its hash.
BUCKETS = 32
#: Rows after a changed one whose sleep analytics hold it.
SLEEP_ROWS = max(S.DEBT_ROWS, S.CONSISTENCY_ROWS) - 1

_COUNTS = ("n_hrv", "n_rhr", "n_days", "n_score", "sum_score", "n_rmssd", "n_base")
_SUMS = ("sum_hrv", "squares_hrv", "sum_rhr")
_EXACT = ("sum_rmssd", "sum_base")  # of values with two decimals
def _layout(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_OWNER = {"user_id": T.StringType(), "bucket": T.IntegerType()}
_SPANS = _layout(**_OWNER, first_day=T.DateType(), last_day=T.DateType())
_USERS = _layout(
    **_OWNER,
    first_day=T.DateType(),
    last_day=T.DateType(),
    fallback_days=T.ArrayType(T.DateType()),
    **dict.fromkeys(_COUNTS, T.LongType()),
    **dict.fromkeys(_SUMS, T.DoubleType()),
    **dict.fromkeys(_EXACT, T.DecimalType(38, 2)),
)
_PROFILES = _layout(**_OWNER, max_hr=T.IntegerType())
_TABLES = ("daily_recovery", "recovery_users", "sleep_analytics", "sleep_users", "user_strain_summary", "profiles")


def _bucket() -> Column:
    return F.pmod(F.hash("user_id"), F.lit(BUCKETS)).alias("bucket")


def table(house: Lakehouse, name: str) -> MergedTable:
    """The Gold tables by day, and the rows per user that go with them."""
    spark = house.spark
    empty = lambda layout: spark.createDataFrame([], schemas.as_nullable(layout))
    by_user = {"recovery_users": _USERS, "sleep_users": _SPANS, "profiles": _PROFILES}
    path = f"{house.root}/gold_by_day/{name}"
    if name in by_user:
        return MergedTable(spark, path, by_user[name], ["user_id"], "bucket", key_fixes_partition=True)
    hrv, sleep, activity = (empty(layout) for layout in (schemas.SILVER_HRV, schemas.SILVER_SLEEP, schemas.SILVER_ACTIVITY))
    if name == "daily_recovery":
        layout = gold.daily_recovery(hrv, sleep).schema.add("resting_hr_bpm", T.DoubleType())
    elif name == "sleep_analytics":
        layout = gold.sleep_metrics(sleep).schema
    else:
        layout = gold.strain_scores(activity, empty(schemas.USERS)).schema
    return MergedTable(spark, path, layout, USER_DAY)


def read_gold(house: Lakehouse, name: str) -> DataFrame:
    """A Gold table as of the last update."""
    if name == "cohort_benchmarks":
        return house.spark.read.parquet(f"{house.root}/gold_by_day/{name}")
    rows = table(house, name).create_if_absent().read()
    return rows.drop("resting_hr_bpm") if name == "daily_recovery" else rows


def _folders(spark: SparkSession, path: str, complete: str) -> list[str]:
    """The folders in ``path`` in which the file ``complete`` says that they were written to the end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(where))
    return [f"{path}/{n}" for n in names if path_exists(spark, f"{path}/{n}/{complete}")]


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schemas.as_nullable(df.schema)).parquet(path)


def _days(rows: DataFrame) -> list[dt.date]:
    """The distinct days of rows: no more than the calendar has."""
    return sorted(r[0] for r in rows.select("date").distinct().collect())


def _around(days: Iterable[dt.date], span: int) -> set[dt.date]:
    return {day + dt.timedelta(days=k) for day in days for k in range(-span, span + 1)}


def days_to_read(keys: Callable[[list], DataFrame], changed: DataFrame, spans: DataFrame, rows: int, scratch: str) -> list[dt.date]:
    """The days on which ``rows`` rows before and after every changed user-day lie, or all of them that there are.

    ``keys`` reads the user-days of given days, ``spans`` has the first and last day of every changed user. Around
    user-days with too few rows in reach the search goes on twice as far, around the others it does not, and it ends
    when no day is left.
    """
    known = spans.agg(F.min("first_day"), F.max("last_day")).first()
    wanted: set[dt.date] = set()
    open_, reach, turn = changed, 2 * rows, 0
    while True:
        wanted |= {d for d in _around(_days(open_), reach) if known[0] <= d <= known[1]}
        if len(wanted) > (known[1] - known[0]).days:
            return sorted(wanted)
        seen = keys(sorted(wanted)).join(spans.select("user_id", "first_day", "last_day"), "user_id")
        seen = seen.join(open_.select(*USER_DAY, F.lit(True).alias("_open")), USER_DAY, "left")
        order = "partition by user_id order by datediff(date, date'1970-01-01') range between"
        counted = seen.selectExpr("*", f"count(*) over ({order} {reach} preceding and 1 preceding) as _before", f"count(*) over ({order} 1 following and {reach} following) as _after")
        few = f"_before < {rows} and date_sub(date, {reach}) > first_day or _after < {rows} and date_add(date, {reach}) < last_day"
        open_ = _staged(counted.where(f"_open and ({few})").select(*USER_DAY), f"{scratch}/open-{turn}")
        if open_.isEmpty():
            return sorted(wanted)
        reach, turn = 2 * reach, turn + 1


def _reached(rows: DataFrame, changed: DataFrame, after: int) -> DataFrame:
    """``rows`` of the changed users, with ``_reached``: is the row changed, or one of the rows before it?"""
    users = changed.select("user_id").distinct()
    flagged = rows.join(users, "user_id", "left_semi").join(changed.select(*USER_DAY, F.lit(True).alias("_changed")), USER_DAY, "left")
    return flagged.selectExpr("*", f"coalesce(bool_or(_changed) over (partition by user_id order by date rows between {after} preceding and current row), false) as _reached").drop("_changed")


def _with_spans(known: DataFrame, changed: DataFrame) -> DataFrame:
    """First and last day per changed user, with the changed days."""
    now = changed.groupBy("user_id").agg(F.min("date").alias("_low"), F.max("date").alias("_high"))
    spans = now.join(known, "user_id", "left")
    return spans.withColumns({"first_day": F.least("first_day", "_low"), "last_day": F.greatest("last_day", "_high"), "bucket": _bucket()}).drop("_low", "_high")


def _totals(rows: DataFrame, sign: int, values: dict[str, str]) -> DataFrame:
    """What ``rows`` add to (or, with -1, take from) the counts and sums of their users."""
    return rows.select("user_id", *(F.expr(f"{sign} * ({text})").alias(name) for name, text in values.items()))


def _moved(users: DataFrame, new: DataFrame, old: DataFrame, values: dict[str, str]) -> DataFrame:
    """``users`` with counts and sums moved from the old rows to the new ones."""
    change = _totals(new, 1, values).unionByName(_totals(old, -1, values)).groupBy("user_id").agg(*(F.sum(c).alias(f"_{c}") for c in values))
    beside = users.join(change, "user_id", "left")
    kinds = {f.name: f.dataType for f in _USERS.fields}
    moved = {c: (F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))).cast(kinds[c]) for c in values}
    return beside.withColumns(moved).drop(*(f"_{c}" for c in values))


def _readings(hrv: str, rhr: str) -> dict[str, str]:
    return {
        "n_hrv": f"int({hrv} is not null)",
        "sum_hrv": f"coalesce({hrv}, 0D)",
        "squares_hrv": f"coalesce({hrv} * {hrv}, 0D)",
        "n_rhr": f"int({rhr} is not null)",
        "sum_rhr": f"coalesce({rhr}, 0D)",
    }


_SCORES = {
    "n_days": "1",
    "n_score": "int(recovery_score is not null)",
    "sum_score": "coalesce(recovery_score, 0)",
    "n_rmssd": "int(hrv_rmssd is not null)",
    "sum_rmssd": "cast(coalesce(hrv_rmssd, 0D) as decimal(20, 2))",
    "n_base": "int(hrv_baseline is not null)",
    "sum_base": "cast(coalesce(hrv_baseline, 0D) as decimal(20, 2))",
}


def _update_recovery(house: Lakehouse, changed: DataFrame, out: str, scratch: str) -> None:
    """Recovery rows to merge, and the rows of their users."""
    hrv, sleep = house.silver(silver.HRV), house.silver(silver.SLEEP)
    stored = table(house, "daily_recovery").create_if_absent()
    inputs = lambda days: gold.recovery_inputs(hrv.read(days=days), sleep.read(days=days))
    # days on which only one of the two feeds has a row are none of recovery's
    days = _days(changed)
    new = _staged(inputs(days).join(changed, USER_DAY, "left_semi"), f"{scratch}/new")
    old = stored.read(days=days).join(changed, USER_DAY, "left_semi")
    users = _with_spans(table(house, "recovery_users").create_if_absent().read(), new)
    readings = _moved(users, new.withColumnRenamed("hrv_rmssd_ms", "hrv_rmssd"), old, _readings("hrv_rmssd", "resting_hr_bpm"))
    users = _staged(readings.withColumn("fallback_days", F.coalesce("fallback_days", F.array().cast("array<date>"))), f"{scratch}/users")
    if users.isEmpty():
        return

    keys = lambda some: hrv.read(days=some).select(*USER_DAY).join(sleep.read(days=some).select(*USER_DAY), USER_DAY)
    around = days_to_read(keys, new.select(*USER_DAY), users, S.BASELINE_ROWS, f"{scratch}/recovery")
    columns = new.columns
    measured = _reached(inputs(around), new, S.BASELINE_ROWS).selectExpr("*", *gold.recent_measures())
    reached = _staged(measured.where("_reached").drop("_reached"), f"{scratch}/reached")
    fallen_back = users.select("user_id", F.explode("fallback_days").alias("date")).join(reached, USER_DAY, "left_anti")
    fallen_back = _staged(fallen_back, f"{scratch}/fallback")
    none = ["0L as _hrv_rows", "double(null) as _recent", "double(null) as _recent_spread", "0L as _rhr_rows", "double(null) as _recent_rhr"]
    rest = inputs(_days(fallen_back)).join(fallen_back, USER_DAY, "left_semi").selectExpr(*columns, *none)
    history = users.selectExpr(
        "user_id",
        "if(n_hrv > 0, sum_hrv / n_hrv, null) as _all",
        "if(n_hrv > 1, sqrt(greatest(squares_hrv - sum_hrv * sum_hrv / n_hrv, 0D) / (n_hrv - 1)), null) as _all_spread",
        "if(n_rhr > 0, sum_rhr / n_rhr, null) as _all_rhr",
    )
    based = gold.settled_baselines(reached.unionByName(rest).join(history, "user_id"), columns)
    rows = _staged(gold.recovery_columns(gold.with_components(based), "resting_hr_bpm"), f"{out}/daily_recovery")

    judged = rows.groupBy("user_id").agg(F.collect_set("date").alias("_judged"), F.collect_set(F.when(F.col("needs_more_baseline"), F.col("date"))).alias("_open"))
    days_now = F.array_sort(F.array_union(F.array_except("fallback_days", "_judged"), "_open"))
    before = stored.read(days=_days(rows)).join(rows, USER_DAY, "left_semi")
    users = _moved(users.join(judged, "user_id").withColumn("fallback_days", days_now), rows, before, _SCORES)
    users.select(*_USERS.names).write.mode("overwrite").parquet(f"{out}/recovery_users")


def _update_sleep(house: Lakehouse, changed: DataFrame, out: str, scratch: str) -> None:
    sleep = house.silver(silver.SLEEP)
    users = _staged(_with_spans(table(house, "sleep_users").create_if_absent().read(), changed), f"{scratch}/users")
    if users.isEmpty():
        return
    around = days_to_read(lambda days: sleep.read(days=days).select(*USER_DAY), changed, users, SLEEP_ROWS, f"{scratch}/around")
    rows = gold.sleep_metrics(_reached(sleep.read(days=around), changed, SLEEP_ROWS)).where("_reached").drop("_reached")
    rows.write.mode("overwrite").parquet(f"{out}/sleep_analytics")
    users.select("user_id", "bucket", "first_day", "last_day").write.mode("overwrite").parquet(f"{out}/sleep_users")


def _update_strain(house: Lakehouse, changed: DataFrame, users: DataFrame, out: str, scratch: str) -> None:
    activity, known = house.silver(silver.ACTIVITY), table(house, "profiles").create_if_absent().read()
    now = gold.profiles(users).where("user_id is not null")
    beside = now.join(known.select("user_id", F.col("max_hr").alias("_known"), F.lit(True).alias("_there")), "user_id", "left")
    moved = beside.where("_there is null or not (max_hr <=> _known)").select("user_id", _bucket(), "max_hr")
    moved = _staged(moved, f"{scratch}/profiles")
    rows = activity.read(days=_days(changed)).join(changed, USER_DAY, "left_semi")
    if not moved.isEmpty():  # all days of these users
        others = activity.read().join(moved, "user_id", "left_semi").join(changed, USER_DAY, "left_anti")
        rows = rows.unionByName(others)
    gold.strain_scores(rows, users).write.mode("overwrite").parquet(f"{out}/user_strain_summary")
    moved.write.mode("overwrite").parquet(f"{out}/profiles")


def _replace_benchmarks(house: Lakehouse) -> None:
    """Averages per user from their counts and sums, ranked among all: a row per user, whatever the days."""
    path = f"{house.root}/gold_by_day/cohort_benchmarks"
    mean = lambda total, n: F.expr(f"if({n} > 0, double({total}) / {n}, null)")
    users = table(house, "recovery_users").create_if_absent().read()
    averages = users.select("user_id", mean("sum_score", "n_score").alias("avg_recovery"), mean("sum_rmssd", "n_rmssd").alias("avg_hrv"), mean("sum_base", "n_base").alias("avg_hrv_baseline"), F.col("n_days").alias("days_tracked"))
    gold.ranked_users(averages).write.mode("overwrite").parquet(path)


def _finish(house: Lakehouse, folder: str) -> dict[str, int]:
    """Merge a complete run; every step gives the same when it is repeated."""
    spark = house.spark

    def merged(name: str) -> int:
        target = table(house, name).create_if_absent()
        rows = spark.read.schema(target._stored_layout()).parquet(f"{folder}/{name}")
        target.merge(rows)
        return rows.count()

    names = [name for name in _TABLES if path_exists(spark, f"{folder}/{name}/_SUCCESS")]
    counts = dict(zip(names, at_once(*(partial(merged, name) for name in names)), strict=True)) if names else {}
    if "recovery_users" in counts:
        _replace_benchmarks(house)
    for row in spark.read.schema("path string").parquet(f"{folder}/consumed").collect():  # a row per upsert since the last run
        delete_path(spark, row["path"])
    delete_path(spark, folder)
    return counts


def update_gold(house: Lakehouse, users: DataFrame) -> dict[str, int]:
    """Bring the Gold tables up to the changes noted since the last run; returns the rows merged per table.

    The first run finds every row changed and builds the tables. Without changes nothing is written.
    """
    spark, pending = house.spark, f"{house.root}/pending"
    for left in _folders(spark, pending, "consumed/_SUCCESS"):
        _finish(house, left)
    sets = {feed.name: _folders(spark, f"{house.root}/changes/{feed.name}", "_SUCCESS") for feed in silver.FEEDS}
    out = f"{pending}/{uuid.uuid4().hex}"
    scratch = f"{out}/scratch"

    def changes(*feeds: silver.Feed) -> DataFrame | None:
        found = [p for feed in feeds for p in sets[feed.name]]
        if not found:
            return None
        noted = reduce(DataFrame.unionByName, (spark.read.schema("user_id string, date date").parquet(p) for p in found))
        return _staged(noted.distinct(), f"{scratch}/changed-{'-'.join(f.name for f in feeds)}")

    def recovery() -> None:
        if (changed := changes(silver.HRV, silver.SLEEP)) is not None:
            _update_recovery(house, changed, out, f"{scratch}/recovery")

    def sleep() -> None:
        if (changed := changes(silver.SLEEP)) is not None:
            _update_sleep(house, changed, out, f"{scratch}/sleep")

    def strain() -> None:
        changed = changes(silver.ACTIVITY)
        _update_strain(house, spark.createDataFrame([], "user_id string, date date") if changed is None else changed, users, out, f"{scratch}/strain")

    at_once(recovery, sleep, strain)
    consumed = [(p,) for paths in sets.values() for p in paths]
    spark.createDataFrame(consumed, "path string").coalesce(1).write.mode("overwrite").parquet(f"{out}/consumed")
    return _finish(house, out)
