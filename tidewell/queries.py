"""The registered queries: each takes a session and a data folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import schemas
from tidewell.functions.numeric import settle
from tidewell.operators.latest import latest_per_key
from tidewell.operators.percent_rank import percent_rank_over
from tidewell.operators.quality import gate_summary, run_gate, user_date_uniqueness
from tidewell.operators.validate import (
    pass_rate,
    rejection_rate,
    rule_counts,
    rule_violations,
    split_by_bounds,
    union_all,
)
from tidewell.operators.zorder import z_ordered
from tidewell.plans import bronze, gold, incremental, pipeline, reports, silver, summaries
from tidewell.session import at_once, new_workspace, shared_root, ship
from tidewell.sources import colocated
from tidewell.sources import sensor_views as views
from tidewell.sources.json_feed import read_feed, read_optional_feed, write_records
from tidewell.sources.merged_table import MergedTable
from tidewell.streaming.gold_stream import stream_gold
from tidewell.streaming.silver_stream import stream_silver

Query = Callable[[SparkSession, str], DataFrame]
HRV_COLUMNS = schemas.HRV.names
SLEEP_COLUMNS = schemas.SLEEP.names
ACTIVITY_COLUMNS = schemas.ACTIVITY.names


def _settled(df: DataFrame) -> DataFrame:
    """Doubles cut at nine decimals, so that results compare equal whatever the summation order."""
    doubles = {f.name: F.expr(settle(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(doubles) if doubles else df


# ---- shared inputs ------------------------------------------------------------------------------


def _raw(feed: silver.Feed, spark: SparkSession, sf: str) -> DataFrame:
    source = {
        "hrv_readings": views.hrv_raw,
        "sleep_records": views.sleep_raw,
        "activity_records": views.activity_raw,
    }
    return source[feed.name](spark, sf)


def _clean(feed: silver.Feed, spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean(_raw(feed, spark, sf), feed)


def _recovery(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_recovery(_clean(silver.HRV, spark, sf), _clean(silver.SLEEP, spark, sf))


def _strain(spark: SparkSession, sf: str) -> DataFrame:
    return gold.strain_scores(_clean(silver.ACTIVITY, spark, sf), views.users(spark, sf))


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.sleep_metrics(_clean(silver.SLEEP, spark, sf))


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    joined = gold.recovery_inputs(_clean(silver.HRV, spark, sf), _clean(silver.SLEEP, spark, sf))
    return gold.with_components(gold.with_baselines(joined))


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return union_all(
        [split_by_bounds(latest_per_key(_raw(f, spark, sf), f.key), f.bounds, f.key, f.source_table)[1] for f in silver.FEEDS]
    )


def _violations(spark: SparkSession, sf: str) -> DataFrame:
    return union_all([rule_violations(_raw(f, spark, sf), f.bounds, f.key, f.source_table) for f in silver.FEEDS])


def _gate(spark: SparkSession, sf: str) -> DataFrame:
    return run_gate({f.name: _raw(f, spark, sf) for f in silver.FEEDS})


def _midway(spark: SparkSession, sf: str) -> Column:
    """The day in the middle of the recorded time."""
    day = F.col("ts").cast("date")
    span = spark.read.parquet(f"{sf}/events.parquet").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return span.select(F.date_add("a", F.floor(F.datediff("b", "a") / 2).cast("int"))).scalar()


def _recovery_midway(spark: SparkSession, sf: str) -> DataFrame:
    day = _midway(spark, sf)
    hrv, sleep = (
        silver.clean(views.up_to_day(_raw(feed, spark, sf), day), feed) for feed in (silver.HRV, silver.SLEEP)
    )
    return gold.daily_recovery(hrv, sleep)


def _syncs(raw: DataFrame) -> list[DataFrame]:
    """Two uploads a day that overlap in the afternoon; together they hold every reading."""
    hour = F.hour(F.col("_ingest_timestamp"))
    return [raw.filter(hour < 18), raw.filter(hour >= 12)]


# ---- sources and table management ---------------------------------------------------------------


def json_scan_typed(spark: SparkSession, sf: str) -> DataFrame:
    """A folder that mixes both kinds of files: an array per user for users divisible by ten, lines for others."""
    path, raw = f"{new_workspace(spark, 'feed')}/hrv.json", views.hrv_raw(spark, sf).select(*HRV_COLUMNS)
    as_array = F.substring("user_id", -1, 1) == "0"
    arrays = raw.where(as_array).groupBy("user_id").agg(F.to_json(F.collect_list(F.struct(*HRV_COLUMNS))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/arrays")
    write_records(raw.where(~as_array), f"{path}/lines")
    return read_feed(spark, f"{path}/*", schemas.HRV)


#: Records of an array file that one task writes.
_ARRAY_RECORDS = 250_000


def json_array_split(spark: SparkSession, sf: str) -> DataFrame:
    """All HRV records delivered as one array in a single file, or in a file per 250,000 records, each read by many tasks."""
    path, raw = f"{new_workspace(spark, 'array')}/hrv.json", views.hrv_raw(spark, sf).select(*HRV_COLUMNS)
    note = F.struct(F.concat(F.lit('ends in }, "{'), F.col("date")).alias("text"), F.array(F.struct(F.lit(1).alias("deep"))).alias("more"))
    files = max(1, raw.count() // _ARRAY_RECORDS)
    records = raw.select(F.to_json(F.struct(*HRV_COLUMNS, note.alias("note"))).alias("value"), F.monotonically_increasing_id().alias("place"))
    in_file = Window.partitionBy("file").orderBy("place")
    before = F.when(F.row_number().over(in_file) == 1, "[").otherwise(", ")
    after = F.when(F.lead("place").over(in_file).isNull(), " ]").otherwise("")
    written = records.withColumn("file", F.col("place") % files).select("file", F.concat(before, "value", after).alias("value"))
    written.write.option("lineSep", " ").partitionBy("file").text(path)
    return read_feed(spark, path, schemas.HRV, split_bytes=1 << 18)


def audit_stamp(spark: SparkSession, sf: str) -> DataFrame:
    stamped = bronze.add_audit_columns(views.hrv_raw(spark, sf).select(*HRV_COLUMNS), "run-7")
    return stamped.select(*HRV_COLUMNS, "_ingestion_run_id", F.col("_ingest_timestamp").isNotNull().alias("stamped"))


def upsert_single_key(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.hrv_raw(spark, sf)
    table = MergedTable(spark, new_workspace(spark, "hrv"), raw.schema, ["reading_id"]).create_if_absent()
    for sync in _syncs(raw):
        table.upsert(sync)
    return table.read().select(*HRV_COLUMNS)


def upsert_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    batches = [silver.clean(sync, silver.SLEEP) for sync in _syncs(views.sleep_raw(spark, sf))]
    table = MergedTable(spark, new_workspace(spark, "sleep"), batches[0].schema, silver.USER_DAY).create_if_absent()
    for batch in batches:
        table.upsert(batch)
    return table.read().select(*SLEEP_COLUMNS)


def table_create_replace(spark: SparkSession, sf: str) -> DataFrame:
    rows = _clean(silver.ACTIVITY, spark, sf)
    database = "tidewell_check"
    table = MergedTable(spark, new_workspace(spark, "activity"), rows.schema, silver.USER_DAY)
    table.create_if_absent().upsert(rows)
    table.declare(database, "activity_clean")
    location = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.activity_clean").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP DATABASE `{database}` CASCADE")  # an external table: its files stay
    return spark.read.schema(rows.schema).parquet(location).select(*ACTIVITY_COLUMNS, "total_zone_minutes")


def quarantine_append(spark: SparkSession, sf: str) -> DataFrame:
    """Written twice, as by a repeated run; each bad record is there once."""
    table = MergedTable(
        spark,
        new_workspace(spark, "quarantine"),
        schemas.QUARANTINE,
        ["source_table", "record_id"],
        partition="_day",
        partition_from=silver.AS_DATE,
    ).create_if_absent()
    for _ in range(2):
        table.upsert(_quarantine(spark, sf))
    return table.read().select("source_table", "record_id", "user_id", "date", "rejection_reason")


def recovery_then_vs_now(spark: SparkSession, sf: str) -> DataFrame:
    return reports.recovery_then_vs_now(_recovery_midway(spark, sf), _recovery(spark, sf))


def _files_per_day(table: MergedTable) -> DataFrame:
    """Rows and files per day as they are now, counted before the table changes."""
    files = table.spark.read.schema(table.layout).parquet(table.path).groupBy("date").agg(F.count("*").alias("rows"), F.count_distinct("_metadata.file_path").alias("files"))
    return files.checkpoint()


def user_date_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The first user's recovery from the middle of the recorded time up to a week later."""
    user = _events_user(spark, sf)
    return reports.user_slice(_recovery(spark, sf), user, _midway(spark, sf), F.date_add(_midway(spark, sf), 7))


def _events_user(spark: SparkSession, sf: str) -> Column:
    return views.hrv_raw(spark, sf).select(F.min("user_id")).scalar()


def compacted_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = _clean(silver.HRV, spark, sf)
    shared_root(spark)
    table = MergedTable(spark, new_workspace(spark, "compact"), rows.schema, silver.USER_DAY)
    hour = F.pmod(F.xxhash64("user_id"), F.lit(2))
    for part in (0, 1):  # each upload leaves its own files
        rows.where(hour == part).write.mode("append").partitionBy("date").parquet(table.path)
    before = _files_per_day(table)
    table.compact()
    after = _files_per_day(table).withColumnRenamed("files", "files_after")
    fewer = (F.col("files_after") < F.col("files")) | (F.col("files") == 1)
    return before.drop("rows").join(after, "date").select("date", "rows", fewer.alias("compacted"))


def gold_from_silver(spark: SparkSession, sf: str) -> DataFrame:
    """All three layers with their writes, from JSON feeds to the stored recovery table."""
    root = new_workspace(spark, "house")

    def deliver(feed: silver.Feed) -> None:
        raw = _raw(feed, spark, sf).select(*feed.layout.names)
        write_records(raw, f"{root}/raw/{pipeline.FILES[feed.name]}")

    at_once(*(partial(deliver, feed) for feed in silver.FEEDS))
    house = pipeline.Lakehouse(spark, root)
    pipeline.run_bronze(house, f"{root}/raw", run_id="run-1")
    pipeline.run_silver(house)
    pipeline.run_gold(house, views.users(spark, sf))
    return house.gold("daily_recovery").read().drop("computed_at")


def _late(spark: SparkSession, sf: str) -> Column:
    """User-days that come with the second sync: one in eleven anywhere, and the last five days."""
    last = spark.read.parquet(f"{sf}/events.parquet").agg(F.date_sub(F.max(F.col("ts").cast("date")), 5)).scalar()
    return (F.pmod(F.xxhash64("user_id", "date"), F.lit(11)) == 0) | (F.col("date") > last)


def gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two syncs, each followed by an update of Gold: the second brings late user-days, corrects one in thirteen of the
    first, and delivers one in five again as it was."""
    house = pipeline.Lakehouse(spark, new_workspace(spark, "incremental"))
    late, users = _late(spark, sf), views.users(spark, sf)
    wrong, again = F.pmod(F.hash("user_id", "date"), F.lit(13)) == 0, F.pmod(F.hash("date", "user_id"), F.lit(5)) == 0
    slips = {"hrv_readings": "hrv_rmssd_ms", "sleep_records": "total_sleep_hours", "activity_records": "zone2_minutes"}

    def load(sync: int, feed: silver.Feed) -> None:
        delivered, slip = f"{house.root}/clean/{feed.name}", slips[feed.name]
        if sync == 1:  # cleaned once for both, a row per user and day
            _clean(feed, spark, sf).select(*feed.silver_layout.names).write.parquet(delivered)
        rows = spark.read.schema(schemas.as_nullable(feed.silver_layout)).parquet(delivered)
        if sync == 1:
            kind = feed.silver_layout[slip].dataType
            rows = rows.where(~late).withColumn(slip, F.when(wrong, F.col(slip) + 1).otherwise(F.col(slip)).cast(kind))
        else:
            rows = rows.where(late | wrong | again)
        house.silver(feed).create_if_absent().merge(rows, house.new_changes(feed))

    for sync in (1, 2):
        at_once(*(partial(load, sync, feed) for feed in silver.FEEDS))
        incremental.update_gold(house, users)
    return _gold_side_by_side(*(incremental.read_gold(house, name) for name in pipeline.GOLD_TABLES))


#: Days of the first and second delivery to the streams, and those of which some users deliver with the third only.
_DELIVERIES, _HELD_BACK = (10, 20), 5


def _deliveries(feed: silver.Feed, spark: SparkSession, sf: str) -> list[DataFrame]:
    """A feed in three parts by day. Every 17th user delivers the first days with the last part, far too late."""
    first = spark.read.parquet(f"{sf}/events.parquet").agg(F.min(F.col("ts").cast("date"))).scalar()
    day = F.datediff(F.col("date").cast("date"), first)
    held_back = (F.substring("user_id", 2, 20).cast("long") % 17 == 3) & (day < _HELD_BACK)
    part = F.when(held_back | (day >= _DELIVERIES[1]), 3).when(day >= _DELIVERIES[0], 2).otherwise(1)
    raw = _raw(feed, spark, sf).select(*feed.layout.names)
    return [raw.where(part == number) for number in (1, 2, 3)]


def _streamed(spark: SparkSession, sf: str, feeds: list[silver.Feed], then: Callable[[pipeline.Lakehouse], None] = lambda _: None) -> pipeline.Lakehouse:
    """A lakehouse whose Silver tables came from streams that were started anew for each delivery."""
    house = pipeline.Lakehouse(spark, new_workspace(spark, "stream"))
    ship(spark)

    def take(feed: silver.Feed, number: int, rows: DataFrame) -> None:
        write_records(rows, f"{house.root}/raw/{feed.name}/{number}")
        stream_silver(house, feed, f"{house.root}/raw/{feed.name}/*", f"run-{number}")

    parts = {feed.name: _deliveries(feed, spark, sf) for feed in feeds}
    for number in range(3):
        at_once(*(partial(take, feed, number, parts[feed.name][number]) for feed in feeds))
        then(house)
    return house


def silver_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Where every HRV record of three deliveries went: Silver, or the quarantine with its reason."""
    house = _streamed(spark, sf, [silver.HRV])
    taken = house.silver(silver.HRV).read().select("reading_id", "user_id", F.col("date").cast("string").alias("date"), "hrv_rmssd_ms", F.lit(None).cast("string").alias("rejection_reason"))
    gone = house.quarantine().read().select(F.col("record_id").alias("reading_id"), "user_id", "date", F.lit(None).cast("double").alias("hrv_rmssd_ms"), "rejection_reason")
    return taken.unionByName(gone)


def gold_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Recovery and sleep figures of all closed days, brought up after each of three deliveries."""
    house = _streamed(spark, sf, [silver.HRV, silver.SLEEP], stream_gold)
    sleep = incremental.read_gold(house, "sleep_analytics")
    own = sleep.select(*silver.USER_DAY, "sleep_debt_hours", "duration_7d_std", "sleep_consistency_score", "efficiency_7d_avg", "sleep_quality_tier")
    return incremental.read_gold(house, "daily_recovery").join(own, silver.USER_DAY, "full")


_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def sketched_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """HRV quartiles per user from stored monthly sketches, and a last row that says whether those of all users
    together are within the sketches' bound of the exact ranks."""
    path, recovery = f"{new_workspace(spark, 'sketches')}/hrv", _recovery(spark, sf).select("user_id", "date", "hrv_rmssd")
    summaries.quantile_sketches(recovery, "hrv_rmssd").write.partitionBy("month").parquet(path)
    stored = spark.read.schema("user_id string, sketch binary, month date").parquet(path)
    per_user = summaries.merged_quantiles(stored, ["user_id"], _QUARTILES)
    ranks = summaries.ranks_of(recovery, "hrv_rmssd", summaries.merged_quantiles(stored, [], _QUARTILES), _QUARTILES)
    bound = summaries.rank_error()
    near = (F.col("below") <= F.col("share") + bound) & (F.col("up_to") >= F.col("share") - bound)
    whole = ranks.agg((F.every(near) & (F.count("*") == len(_QUARTILES))).alias("within_bound"))
    return per_user.unionByName(whole, allowMissingColumns=True)


def active_users(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct users per feed and day, week and month, all from stored daily bitmaps."""
    root, feeds = new_workspace(spark, "active"), {f.name: _raw(f, spark, sf).select("user_id", F.expr(silver.AS_DATE).alias("date")) for f in silver.FEEDS}
    # the feeds come one after the other: each adds its new users to the numbering
    numbers = None
    for name, rows in feeds.items():
        summaries.numbered(rows, numbers).write.parquet(f"{root}/numbers-{name}")
        numbers = spark.read.schema("user_id string, number long").parquet(f"{root}/numbers-{name}")
        summaries.daily_users(rows, numbers, name).write.mode("append").partitionBy("date").parquet(f"{root}/daily")
    daily = spark.read.schema("source_table string, bucket long, users binary, date date").parquet(f"{root}/daily")
    return union_all([summaries.distinct_users(daily, period) for period in ("day", "week", "month")])


def colocated_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """Recovery from Silver tables of the catalog that are bucketed by user."""
    root = new_workspace(spark, "catalog")
    database = colocated.create_database(spark, f"tidewell_{root.rsplit('-', 1)[1]}", root)
    for feed, name in ((silver.HRV, "hrv_clean"), (silver.SLEEP, "sleep_clean")):
        colocated.save_by_user(_clean(feed, spark, sf), f"{database}.{name}")
    joined = colocated.paired(spark, f"{database}.hrv_clean", f"{database}.sleep_clean", ["hrv_rmssd_ms"], gold.SLEEP_INPUTS)
    return gold.recovery_columns(gold.with_components(gold.with_baselines(joined)))


def zordered_table(spark: SparkSession, sf: str) -> DataFrame:
    """Recovery stored along a Z curve: rows of one user and of one day, and the share of files that such a filter
    needs. By statistics a filter on either column leaves out most files."""
    path, rows = f"{new_workspace(spark, 'zorder')}/recovery", _recovery(spark, sf).select("user_id", "date", "recovery_score")
    staged = f"{path}-staged"
    rows.write.parquet(staged)
    z_ordered(spark.read.schema(rows.schema).parquet(staged), ["user_id", "date"], files=16).write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    file = F.col("_metadata.file_path").alias("file")
    out = []
    for column in ("user_id", "date"):
        middle = stored.select(F.min(column)).scalar()
        spans = stored.groupBy(file).agg(F.min(column).alias("low"), F.max(column).alias("high"))
        needed = spans.agg((F.count_if((F.col("low") <= middle) & (F.col("high") >= middle)) / F.count("*")).alias("needed"))
        found = stored.where(F.col(column) == middle).agg(F.lit(column).alias("filter_on"), F.count("*").alias("rows"))
        out.append(found.select("filter_on", "rows", (needed.select("needed").scalar() <= 0.5).alias("most_files_skipped")))
    return union_all(out)


def _gold_side_by_side(recovery: DataFrame, strain: DataFrame, metrics: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """All columns of the four Gold tables per user-day."""
    own = metrics.select(*silver.USER_DAY, "sleep_debt_hours", "duration_7d_std", "sleep_consistency_score", "efficiency_7d_avg", "sleep_quality_tier")
    days = recovery.join(strain, silver.USER_DAY, "full").join(own, silver.USER_DAY, "full")
    return days.join(benchmarks, "user_id", "left")


def profile_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{new_workspace(spark, 'profiles')}/users.json"
    write_records(views.users(spark, sf), path)
    return read_feed(spark, path, schemas.USERS, array_layout=False)


def late_sensor(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that is there beside one that no device delivers yet."""
    root = new_workspace(spark, "late")
    delta = (F.col("respiratory_rate_brpm") / 10).alias("skin_temp_delta_c")
    rows = views.hrv_raw(spark, sf).select(F.col("reading_id").alias("record_id"), "user_id", "date", delta, "ingested_at")
    write_records(rows, f"{root}/skin_temp.json")
    return union_all([read_optional_feed(spark, f"{root}/{name}.json", schemas.SKIN_TEMP) for name in ("skin_temp", "not_there")])


def gold_export(spark: SparkSession, sf: str) -> DataFrame:
    """Recovery as stored and exported as JSON records, strain recomputed because nothing is stored."""
    root = new_workspace(spark, "export")
    house = pipeline.Lakehouse(spark, root)
    house.gold("daily_recovery").replace(_recovery(spark, sf).select("user_id", "date", "recovery_score"))
    stored = pipeline.gold_or_recomputed(house, "daily_recovery", lambda: _recovery(spark, sf).limit(0))
    write_records(stored, f"{root}/daily_recovery.json")
    exported = spark.read.schema(stored.schema).json(f"{root}/daily_recovery.json")
    strain = pipeline.gold_or_recomputed(house, "user_strain_summary", lambda: _strain(spark, sf))
    return exported.join(strain.select("user_id", "date", "strain_score"), ["user_id", "date"])


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """The gate over delivered files, its results written as records and summed up from there."""
    root = new_workspace(spark, "report")
    for feed in silver.FEEDS:
        write_records(_raw(feed, spark, sf).select(*feed.layout.names), f"{root}/raw/{pipeline.FILES[feed.name]}")
    return pipeline.run_gate_report(pipeline.Lakehouse(spark, root), f"{root}/raw", f"{root}/report.json")


def gold_from_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Recovery over unfiltered readings: no bounds, no anomaly filter, latest reading per user-day."""
    hrv, sleep = (
        silver.one_per_user_day(_raw(feed, spark, sf).withColumn("date", F.expr(silver.AS_DATE)), feed.key)
        for feed in (silver.HRV, silver.SLEEP)
    )
    return gold.daily_recovery(hrv, sleep)


# ---- the registry -------------------------------------------------------------------------------


def _bounds_split_valid(spark: SparkSession, sf: str) -> DataFrame:
    feed = silver.SLEEP
    latest = latest_per_key(_raw(feed, spark, sf), feed.key)
    return split_by_bounds(latest, feed.bounds, feed.key, feed.source_table)[0].select(*SLEEP_COLUMNS)


def _bounds_split_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    feed = silver.HRV
    latest = latest_per_key(_raw(feed, spark, sf), feed.key)
    return split_by_bounds(latest, feed.bounds, feed.key, feed.source_table)[1].drop("quarantined_at")


def _rejection_rate(spark: SparkSession, sf: str) -> DataFrame:
    return union_all([rejection_rate(silver.judged(_raw(f, spark, sf), f), f.source_table) for f in silver.FEEDS])


def _percent_rank_scaled(spark: SparkSession, sf: str) -> DataFrame:
    shared_root(spark)
    days = _recovery(spark, sf).select("user_id", "date", "recovery_score").checkpoint()
    return percent_rank_over(days, "recovery_score", "score_rank", low=0, high=100, slices=100)


def _zone_allocation(spark: SparkSession, sf: str) -> DataFrame:
    sessions = latest_per_key(_raw(silver.ACTIVITY, spark, sf), "record_id")
    return reports.hr_zone_allocation(sessions, views.users(spark, sf))


def _on_recovery(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: report(_recovery(spark, sf))


_QUERIES: dict[str, Query] = {
    "json_scan_typed": json_scan_typed,
    "json_array_split": json_array_split,
    "audit_stamp": audit_stamp,
    "upsert_single_key": upsert_single_key,
    "upsert_composite_key": upsert_composite_key,
    "table_create_replace": table_create_replace,
    "quarantine_append": quarantine_append,
    "dedup_latest": lambda s, d: latest_per_key(views.hrv_raw(s, d), "reading_id").select(*HRV_COLUMNS),
    "bounds_split_valid": _bounds_split_valid,
    "bounds_split_quarantine": _bounds_split_quarantine,
    "quarantine_union": lambda s, d: _quarantine(s, d).drop("raw_record", "quarantined_at"),
    "rejection_rate": _rejection_rate,
    "silver_hrv": lambda s, d: _clean(silver.HRV, s, d).select(*HRV_COLUMNS),
    "silver_sleep": lambda s, d: _clean(silver.SLEEP, s, d).select(
        *SLEEP_COLUMNS, "total_sleep_minutes", "rem_pct", "deep_pct"
    ),
    "silver_activity": lambda s, d: _clean(silver.ACTIVITY, s, d).select(*ACTIVITY_COLUMNS, "total_zone_minutes"),
    "hrv_component": lambda s, d: _parts(s, d).select(
        "user_id",
        "date",
        F.col("_base").alias("base"),
        F.col("_spread").alias("sd0"),
        F.col("needs_more_baseline").alias("fresh"),
        F.col("_hrv").alias("c_hrv"),
    ),
    "rhr_component": lambda s, d: _parts(s, d).select(
        "user_id", "date", F.col("_rhr_base").alias("rbase"), F.col("_rhr").alias("c_rhr")
    ),
    "sleep_component": lambda s, d: _parts(s, d).select("user_id", "date", F.col("_sleep").alias("c_sleep")),
    "spo2_component": lambda s, d: _parts(s, d).select("user_id", "date", F.col("_spo2").alias("c_spo2")),
    "daily_recovery": _recovery,
    "strain_scores": _strain,
    "sleep_metrics": lambda s, d: _metrics(s, d).drop("_ingestion_run_id", "_ingest_timestamp"),
    "sleep_debt_report": lambda s, d: gold.sleep_debt_report(_metrics(s, d)),
    "cohort_benchmarks": _on_recovery(gold.cohort_benchmarks),
    "percent_rank_scaled": _percent_rank_scaled,
    "hr_zone_allocation": _zone_allocation,
    "gold_from_raw": gold_from_raw,
    "gold_from_silver": gold_from_silver,
    "gold_incremental": gold_incremental,
    "silver_stream": silver_stream,
    "gold_stream": gold_stream,
    "sketched_quartiles": sketched_quartiles,
    "active_users": active_users,
    "colocated_recovery": colocated_recovery,
    "zordered_table": zordered_table,
    "weekly_sleep_trend": lambda s, d: reports.weekly_sleep_trend(_clean(silver.SLEEP, s, d)),
    "recovery_sample": _on_recovery(reports.recovery_sample),
    "recovery_last_30d": _on_recovery(reports.recovery_last_days),
    "strain_vs_next_day": lambda s, d: reports.strain_vs_next_day(_strain(s, d), _recovery(s, d)),
    "weekday_pattern": _on_recovery(reports.weekday_pattern),
    "hrv_trend": _on_recovery(reports.hrv_trend),
    "sleep_vs_recovery": lambda s, d: reports.sleep_vs_recovery(_metrics(s, d), _recovery(s, d)),
    "performance_tiers": lambda s, d: reports.performance_tiers(gold.cohort_benchmarks(_recovery(s, d))),
    "recovery_then_vs_now": recovery_then_vs_now,
    "quarantine_weekly": lambda s, d: reports.quarantine_weekly(_quarantine(s, d)),
    "quarantine_weekly_reasons": lambda s, d: reports.quarantine_weekly_reasons(_quarantine(s, d)),
    "user_date_slice": user_date_slice,
    "recovery_last_7d": lambda s, d: reports.recovery_last_days(_recovery(s, d), days=7),
    "kpi_summary": lambda s, d: reports.kpi_per_user(_recovery(s, d), _strain(s, d), _metrics(s, d)),
    "run_stats": lambda s, d: reports.run_stats(_strain(s, d), _metrics(s, d)),
    "component_means": _on_recovery(reports.component_means),
    "week_weekday_grid": _on_recovery(reports.week_weekday_grid),
    "week_weekday_matrix": _on_recovery(reports.week_weekday_matrix),
    "sleep_stage_long": lambda s, d: reports.sleep_stage_hours(_clean(silver.SLEEP, s, d)),
    "ols_strain_recovery": lambda s, d: reports.ols_strain_recovery(_strain(s, d), _recovery(s, d)),
    "hrv_quartiles": _on_recovery(reports.hrv_quartiles),
    "hrv_outliers": _on_recovery(reports.hrv_outliers),
    "hrv_histogram": _on_recovery(reports.hrv_histogram),
    "recovery_state_distribution": _on_recovery(reports.recovery_state_distribution),
    "strain_category_distribution": lambda s, d: reports.strain_category_distribution(_strain(s, d)),
    "sleep_tier_share": lambda s, d: reports.sleep_tier_share(_metrics(s, d)),
    "component_correlations": _on_recovery(reports.component_correlations),
    "sleep_band_means": lambda s, d: reports.sleep_band_means(_clean(silver.SLEEP, s, d), _recovery(s, d)),
    "training_phase_means": _on_recovery(reports.training_phase_means),
    "fitness_level_means": lambda s, d: reports.fitness_level_means(_recovery(s, d), views.users(s, d)),
    "rule_violations": _violations,
    "rule_overlap": lambda s, d: rule_counts(_violations(s, d)),
    "pass_rate": lambda s, d: pass_rate([(_raw(f, s, d), f.bounds, f.key) for f in silver.FEEDS]),
    "quality_gate": _gate,
    "quality_gate_summary": lambda s, d: gate_summary(_gate(s, d)),
    "compacted_table": compacted_table,
    "profile_scan": profile_scan,
    "late_sensor": late_sensor,
    "gold_export": gold_export,
    "quality_report": quality_report,
    "level_benchmarks": lambda s, d: gold.level_benchmarks(_recovery(s, d), views.users(s, d)),
    "user_date_uniqueness": lambda s, d: union_all([user_date_uniqueness(_raw(f, s, d), f.name) for f in silver.FEEDS]),
}


# Results with doubles that the query itself does not round.
_UNROUNDED = {
    "hrv_component",
    "rhr_component",
    "sleep_component",
    "spo2_component",
    "sleep_metrics",
    "cohort_benchmarks",
    "gold_incremental",
    "gold_stream",
    "weekly_sleep_trend",
    "level_benchmarks",
    "percent_rank_scaled",
    "recovery_then_vs_now",
    "hrv_trend",
    "kpi_summary",
    "run_stats",
    "component_means",
    "week_weekday_grid",
    "week_weekday_matrix",
    "sleep_stage_long",
    "ols_strain_recovery",
    "hrv_quartiles",
    "component_correlations",
    "sleep_band_means",
    "training_phase_means",
    "fitness_level_means",
}


def _registered(name: str, query: Query) -> Query:
    if name not in _UNROUNDED:
        return query
    return lambda spark, sf_dir: _settled(query(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _registered(name, query) for name, query in _QUERIES.items()}
