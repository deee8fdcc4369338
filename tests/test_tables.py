"""Feeds and tables on disk."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.plans import pipeline, silver
from tidewell.sources import sensor_views as views
from tidewell.sources.json_feed import read_feed, read_optional_feed, write_records
from tidewell.sources.merged_table import MergedTable
from tidewell.sources.versioned_table import VersionedTable, retention
from tidewell.streaming.ingest import ingest_new_files

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files_of(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet")]


def keyed(spark, *values):
    return spark.createDataFrame(list(values), "k string, date string, v int")


def table_of(spark, path, keys=("k",)):
    layout = spark.createDataFrame([], "k string, date string, v int").schema
    return MergedTable(spark, path, layout, list(keys)).create_if_absent()


def test_both_json_layouts_read_alike(spark, tmp_path):
    records = [
        {"reading_id": "a", "user_id": "u", "date": "2024-01-01", "hrv_rmssd_ms": 50.5, "is_anomaly": False, "extra": 1},
        {"reading_id": "b", "user_id": "u", "date": "2024-01-02", "hrv_sdnn_ms": None},
    ]
    (tmp_path / "array.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in records))
    array = read_feed(spark, str(tmp_path / "array.json"), schemas.HRV)
    lines = read_feed(spark, str(tmp_path / "lines.json"), schemas.HRV)
    assert rows(array) == rows(lines) and array.count() == 2
    assert [(f.name, f.dataType) for f in array.schema] == [(f.name, f.dataType) for f in schemas.HRV]
    assert array.filter("reading_id = 'b'").first().hrv_rmssd_ms is None


def test_users_scan_and_missing_feed(spark, tmp_path):
    (tmp_path / "users.json").write_text(json.dumps([{"user_id": "u1", "age": 30, "max_hr": 188}]))
    user = read_feed(spark, str(tmp_path / "users.json"), schemas.USERS).first()
    assert (user.user_id, user.age, user.max_hr, user.hrv_baseline) == ("u1", 30, 188, None)
    absent = read_optional_feed(spark, str(tmp_path / "skin_temp.json"), schemas.SKIN_TEMP)
    assert absent.isEmpty() and absent.columns == schemas.SKIN_TEMP.names


def test_upsert_inserts_replaces_and_repeats(spark, workspace):
    table = table_of(spark, workspace)
    table.upsert(keyed(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 2)))
    second = keyed(spark, ("b", "2024-01-02", 20), ("c", "2024-01-03", 3))
    for _ in range(2):
        table.upsert(second)
        assert rows(table.read()) == [("a", "2024-01-01", 1), ("b", "2024-01-02", 20), ("c", "2024-01-03", 3)]


def test_upsert_touches_only_its_dates(spark, workspace):
    table = table_of(spark, workspace)
    table.upsert(keyed(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 2)))
    before = {f for f in files_of(workspace) if "date=2024-01-01" in f}
    table.upsert(keyed(spark, ("b", "2024-01-02", 5)))
    assert before == {f for f in files_of(workspace) if "date=2024-01-01" in f} and before


def test_upsert_follows_a_row_to_another_date(spark, workspace):
    table = table_of(spark, workspace)
    table.upsert(keyed(spark, ("a", "2024-01-01", 1), ("b", "2024-01-01", 2), ("c", "2024-01-02", 3)))
    table.upsert(keyed(spark, ("a", "2024-01-03", 10), ("c", "2024-01-03", 30)))
    assert rows(table.read()) == [("a", "2024-01-03", 10), ("b", "2024-01-01", 2), ("c", "2024-01-03", 30)]


def test_upsert_of_nothing_and_of_duplicates(spark, workspace):
    table = table_of(spark, workspace)
    table.upsert(keyed(spark, ("a", "2024-01-01", 1)).limit(0))
    assert table.read().isEmpty()
    table.upsert(keyed(spark, ("a", "2024-01-01", 1), ("a", "2024-01-01", 1)))
    assert table.read().count() == 1


def test_upsert_refuses_rows_without_key_and_leaves_no_files(spark, workspace):
    table, root = table_of(spark, workspace), os.path.dirname(workspace.removeprefix("file:"))
    table.upsert(keyed(spark, ("a", "2024-01-01", 1)))
    before = {f for f in os.listdir(root) if f.startswith("upsert-")}
    for _ in range(2):
        with pytest.raises(ValueError, match="2 rows without a complete key|1 rows without a complete key"):
            table.upsert(keyed(spark, ("b", "2024-01-01", 2), (None, "2024-01-01", 5), (None, "2024-01-01", 6)))
        assert rows(table.read()) == [("a", "2024-01-01", 1)]
    assert {f for f in os.listdir(root) if f.startswith("upsert-")} == before


def test_keys_that_fix_their_day_leave_other_days_unread(spark, workspace):
    table = table_of(spark, workspace)
    table.key_fixes_partition = True
    table.upsert(keyed(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 2)))
    for f in files_of(workspace):
        if "date=2024-01-01" in f:
            with open(f, "wb") as broken:  # reading it would fail
                broken.write(b"no parquet")
    table.upsert(keyed(spark, ("b", "2024-01-02", 5)))
    assert rows(table.read(since="2024-01-02")) == [("b", "2024-01-02", 5)]


def test_a_folder_may_mix_arrays_and_lines(spark, tmp_path):
    records = [{"reading_id": f"r{i}", "user_id": "u", "date": "2024-01-01"} for i in range(8)]
    (tmp_path / "a.json").write_text(json.dumps(records[:3], indent=2))
    (tmp_path / "b.json").write_text("\n\n" + "\n".join(json.dumps(r) for r in records[3:]))
    (tmp_path / "c.json").write_text("")
    assert {r.reading_id for r in read_feed(spark, str(tmp_path), schemas.HRV).collect()} == {f"r{i}" for i in range(8)}
    (tmp_path / "d.json").write_text("reading_id,user_id")
    with pytest.raises(ValueError, match="d.json"):
        read_feed(spark, str(tmp_path), schemas.HRV)


def test_what_has_no_key_or_is_no_json_is_quarantined_once(spark, workspace, tmp_path):
    good = {"reading_id": "r", "user_id": "u", "date": "2024-01-01", "hrv_rmssd_ms": 50.0, "is_anomaly": False}
    lines = [json.dumps(good), json.dumps(good | {"reading_id": None}), '{"reading_id": "x", broken', '{"reading_id": "y", broken']
    lines.append(json.dumps(good | {"reading_id": "nobody", "user_id": None}))
    (tmp_path / "hrv.json").write_text("\n".join(lines))
    for name in ("sleep.json", "activity.json"):
        (tmp_path / name).write_text("")
    house = pipeline.Lakehouse(spark, workspace)
    for _ in range(2):
        pipeline.run_bronze(house, str(tmp_path), "run")
        pipeline.run_silver(house)
    assert house.silver(silver.HRV).read().count() == 1
    bad = house.quarantine().read()
    assert sorted(r.rejection_reason for r in bad.collect()) == ["record is malformed", "record is malformed", "record key is missing", "user_id is missing"]
    assert bad.where("raw_record like '%x%broken%'").count() == 1


def test_upsert_by_two_keys(spark, workspace):
    table = table_of(spark, workspace, keys=("date", "k"))
    table.upsert(keyed(spark, ("a", "2024-01-01", 1), ("a", "2024-01-02", 2)))
    table.upsert(keyed(spark, ("a", "2024-01-02", 7)))
    assert rows(table.read()) == [("a", "2024-01-01", 1), ("a", "2024-01-02", 7)]


def test_compaction_keeps_rows_and_packs_files(spark, workspace):
    table = table_of(spark, workspace)
    data = spark.range(400).selectExpr("string(id) as k", "'2024-01-01' as date", "int(id) as v")
    data.repartition(8).write.partitionBy("date").mode("overwrite").parquet(workspace)
    before, kept = len(files_of(workspace)), rows(table.read())
    table.compact()
    assert len(files_of(workspace)) < before and rows(table.read()) == kept


def test_declared_table_is_readable_by_name(spark, workspace):
    table = table_of(spark, workspace)
    table.upsert(keyed(spark, ("a", "2024-01-01", 1)))
    for _ in range(2):
        table.declare("tidewell_test", "declared")
    assert spark.table("tidewell_test.declared").select("k", "date", "v").collect() == table.read().collect()


def test_versions_as_of_expiry_and_compaction(spark, workspace):
    table = VersionedTable(spark, workspace)
    days = [dt.datetime(2024, 1, d) for d in (1, 5, 9, 13, 17)]
    for i, when in enumerate(days, start=1):
        assert table.replace(spark.range(i).withColumnRenamed("id", "user_id"), committed_at=when) == i
    assert table.read().count() == 5
    assert table.read(version=2).limit(5).count() == 2
    assert table.read(as_of=dt.datetime(2024, 1, 10)).count() == 3
    assert table.row_count(4) == 4
    with pytest.raises(LookupError):
        table.read(as_of=dt.datetime(2023, 1, 1))
    assert sorted(table.expire(dt.datetime(2024, 1, 6), retain_last=3)) == [1, 2]
    with pytest.raises(LookupError):
        table.read(version=1)
    assert table.compact() == 6 and table.read().count() == 5
    # the newest versions stay however old they are
    assert sorted(table.expire(dt.datetime(2030, 1, 1), retain_last=3)) == [3]


def test_retention_rule(spark):
    log = spark.createDataFrame(
        [(v, dt.datetime(2024, 1, v), "replace", 1) for v in range(1, 8)], "version long, committed_at timestamp_ntz, operation string, row_count long"
    )
    kept = {r.version for r in retention(log, dt.datetime(2024, 1, 4), 3).filter("kept").collect()}
    assert kept == {4, 5, 6, 7}
    assert {r.version for r in retention(log, dt.datetime(2025, 1, 1), 3).filter("kept").collect()} == {5, 6, 7}


def deliver(spark, folder):
    raw = {"hrv_readings": views.hrv_raw, "sleep_records": views.sleep_raw, "activity_records": views.activity_raw}
    for feed in silver.FEEDS:
        write_records(raw[feed.name](spark, SF).select(*feed.layout.names), f"{folder}/{pipeline.FILES[feed.name]}")


def test_the_three_layers(spark, workspace, tmp_path):
    source = f"{workspace}/raw"
    deliver(spark, source)
    house = pipeline.Lakehouse(spark, f"{workspace}/house")
    users = views.users(spark, SF)
    assert pipeline.gold_or_recomputed(house, "daily_recovery", lambda: "recomputed") == "recomputed"

    pipeline.run_bronze(house, source, "run-1")
    assert house.bronze(silver.HRV).read().count() == 397
    assert not os.path.exists(house.skin_temp().path)
    counts = pipeline.run_silver(house)
    assert all(c["valid"] + c["rejected"] == 397 for c in counts.values())
    assert house.quarantine().read().count() == sum(c["rejected"] for c in counts.values())
    assert pipeline.run_gold(house, users)["daily_recovery"] == 1

    # a second run with one more sensor: same rows, new versions
    write_records(
        spark.sql("select 't1' as record_id, 'u1' as user_id, '2024-01-30' as date, 0.3D as skin_temp_delta_c, 'x' as ingested_at"),
        f"{source}/skin_temp.json",
    )
    clean, bad = house.silver(silver.SLEEP).read().drop("_ingestion_run_id", "_ingest_timestamp"), house.quarantine().read().count()
    before = rows(clean)
    pipeline.run_bronze(house, source, "run-2")
    pipeline.run_silver(house)
    pipeline.run_silver(house, since="2024-01-20")
    assert rows(house.silver(silver.SLEEP).read().drop("_ingestion_run_id", "_ingest_timestamp")) == before
    assert house.quarantine().read().count() == bad
    assert house.skin_temp().read().count() == 1
    assert pipeline.run_gold(house, users)["daily_recovery"] == 2
    table = house.gold("daily_recovery")
    assert rows(table.read(version=1).drop("computed_at")) == rows(table.read().drop("computed_at"))

    summary = pipeline.run_gate_report(house, source, f"{workspace}/report").collect()
    assert {r.table_name for r in summary} == {"hrv_readings", "sleep_records", "activity_records"}
    assert not any(r.overall_passed for r in summary)
    pipeline.export_gold(house, f"{workspace}/out")
    assert spark.read.json(f"{workspace}/out/daily_recovery.json").count() == table.read().count()
    pipeline.maintain_gold(house, dt.datetime(2000, 1, 1))
    assert table.read().count() == table.read(version=1).count()
    assert pipeline.gold_or_recomputed(house, "daily_recovery", None).count() == table.read().count()


def test_stream_takes_each_file_once(spark, workspace):
    house = pipeline.Lakehouse(spark, f"{workspace}/house")
    raw = views.hrv_raw(spark, SF).select(*schemas.HRV.names)
    folder = f"{workspace}/arrivals"
    raw.filter("date < '2024-01-16'").coalesce(1).write.json(folder)
    ingest_new_files(house, silver.HRV, folder, "run-1")
    first = house.bronze(silver.HRV).read()
    assert first.count() == raw.filter("date < '2024-01-16'").select("reading_id").distinct().count()
    raw.filter("date >= '2024-01-16'").coalesce(1).write.mode("append").json(folder)
    ingest_new_files(house, silver.HRV, folder, "run-2")
    final = house.bronze(silver.HRV).read()
    assert final.count() == 397
    assert final.filter(F.col("_ingestion_run_id") == "run-1").count() == first.filter("date < '2024-01-16'").count()


def test_dates_that_are_none_share_one_partition(spark, workspace):
    layout = spark.createDataFrame([], "k string, date string, v int").schema
    table = MergedTable(spark, workspace, layout, ["k"], "_day", "try_cast(date as date)").create_if_absent()
    odd = [(f"k{i}", f"no day {i}", i) for i in range(20)]
    table.upsert(keyed(spark, ("a", "2024-01-01", 1), *odd))
    table.upsert(keyed(spark, ("a", "2024-01-02", 2), ("k3", "2024-01-02", 33)))
    assert {p for p in os.listdir(workspace.removeprefix("file:")) if p.startswith("_day")} == {
        "_day=__HIVE_DEFAULT_PARTITION__",
        "_day=2024-01-02",
    }
    assert table.read().count() == 21
    assert rows(table.read(since="2024-01-02")) == [("a", "2024-01-02", 2), ("k3", "2024-01-02", 33)]
