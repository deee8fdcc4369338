"""Array files read by many tasks give what the reader of whole files gives."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell import queries, schemas
from tidewell.sources import json_array, json_feed
from tidewell.sources import sensor_views as views
from tidewell.sources.json_feed import MALFORMED, read_feed

LAYOUT = schemas.SKIN_TEMP


def write(spark, path, text):
    """One file with exactly this content."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)


def rows(df):
    return sorted(map(repr, df.collect()))


def both(spark, path, **more):
    whole = read_feed(spark, path, LAYOUT, array_layout=True, **more)
    return rows(read_feed(spark, path, LAYOUT, split_bytes=256, **more)), rows(whole)


def records(n, seed=1):
    r = random.Random(seed)
    odd = ["}", "{", "]", '"', "\\", "\\\\", '\\"}', "é😀}", ",", "[{", "\n", "} ,{"]
    for i in range(n):
        note = "".join(r.choice(odd) for _ in range(r.randrange(12)))
        yield {"record_id": f"{i}{note}", "user_id": "u", "date": "2024-01-01", "skin_temp_delta_c": i / 8, "note": {"text": note, "more": [{"a": []}, {"b": {"c": note}}]}}


@pytest.mark.parametrize("indent", [None, 2])
def test_same_records_as_the_reader_of_whole_files(spark, workspace, indent):
    write(spark, workspace, json.dumps(list(records(120)), indent=indent, ensure_ascii=False))
    found, want = both(spark, workspace)
    assert len(want) == 120 and found == want


def test_a_record_longer_than_many_splits(spark, workspace):
    long = {"record_id": "long", "user_id": "}{" * 2000, "date": "2024-01-01", "note": [{"x": "}"}] * 500}
    write(spark, workspace, json.dumps([*records(5), long, *records(5, 2), long]))
    found, want = both(spark, workspace)
    assert len(want) == 12 and found == want


@pytest.mark.parametrize(
    "text",
    [
        "[]",
        ' [ {"record_id": "a"} ] ',
        '[{"record_id": "a"}, 5, {"record_id": "b"}]' + " " * 400,
        '[{"record_id": "a"}, {"record_id": "b"' + " " * 400,
        '[{"record_id": "a"}, {"record_id": "b}]' + " " * 400,
        '[{"record_id": "a"} {"record_id": "b"}]' + " " * 400,
        '["a}b", {"record_id": "b"}]' + " " * 400,
        '[[{"record_id": "a"}], {"record_id": "b"}]' + " " * 400,
        '[{"record_id": "a"}]' + " " * 400 + '{"record_id": "b"}',
    ],
)
def test_what_is_no_array_of_records(spark, workspace, text):
    write(spark, workspace, text)
    found, want = both(spark, workspace, keep_malformed=True)
    assert found == want


def test_a_malformed_record_stays_one(spark, workspace):
    """One record with a value of another type; the others are read."""
    good = [json.dumps(r) for r in records(20)]
    write(spark, workspace, "[" + ",\n".join([*good, '{"record_id": "x", "skin_temp_delta_c": "warm"}']) + "]")
    got = read_feed(spark, workspace, LAYOUT, split_bytes=256, keep_malformed=True)
    assert got.where(f"{MALFORMED} is null").count() == 20
    assert got.where(f"{MALFORMED} is not null").select("record_id").first()[0] == "x"


def test_several_tasks_read_one_file(spark, workspace):
    write(spark, f"{workspace}/feed", json.dumps(list(records(400))))
    with json_array._fixed_splits(spark, 4096):
        pieces = json_array._pieces(spark, [f"{workspace}/feed"])
        assert pieces.rdd.getNumPartitions() > 4
        assert pieces.select("block").distinct().count() > 4
    layout = schemas.as_nullable(LAYOUT)
    parsed = json_array.read_arrays(spark, [f"{workspace}/feed"], layout, {}, f"{workspace}/cut", 4096)
    stored = spark.read.parquet(f"{workspace}/cut")
    assert parsed.count() == 400 and stored.where(f"kind = {json_array.FRAGMENT}").count() > 2


def test_splits_grow_with_the_file(spark, workspace):
    """The size asked for is the least one: no more than so many splits per core."""
    write(spark, workspace, json.dumps(list(records(4000))))
    with json_array._fixed_splits(spark, 256):
        blocks = json_array._pieces(spark, [workspace]).select("block").distinct().count()
    assert blocks <= json_array._SPLITS_PER_CORE * spark.sparkContext.defaultParallelism + 1


def test_deliveries_of_several_files(spark, workspace, monkeypatch):
    """Every record is delivered, the smallest one as often as it is there."""
    columns = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    events = spark.range(2000).selectExpr("greatest(id, 5) as event_id", "timestamp_ntz'2024-01-01 10:00:00' as ts", "if(id < 5, 1, 2 + id % 7) as user_id", "'view' as event_type", "if(id < 5, 1, id) / 8 as value", "'' as props")
    events.to(events.sparkSession.createDataFrame([], columns).schema).write.parquet(f"{workspace}/events.parquet")
    want = rows(views.hrv_raw(spark, workspace).select(*schemas.HRV.names))
    monkeypatch.setattr(queries, "_ARRAY_RECORDS", 900)
    got = queries.json_array_split(spark, workspace)
    assert rows(got) == want and len(want) == 2000


@pytest.mark.parametrize("most", [1000, 0])
def test_files_are_told_apart(spark, workspace, monkeypatch, most):
    """By their first bytes, or by tasks: the same layouts; only what starts in another way is read."""
    texts = {"lines": '{"record_id": "a"}\n{"record_id": "b"}', "array": '[{"record_id": "c"}]', "blank": " \n  ", "late": " " * 300 + '[{"record_id": "d"}]', "marked": '\ufeff{"record_id": "e"}', "spaced": '\r\n {"record_id": "f"}'}
    for name, text in texts.items():
        write(spark, f"{workspace}/in/kind={name}", text)
    monkeypatch.setattr(json_feed, "_FILES_ASKED", most)
    by_line, arrays = json_feed.files_by_layout(spark, f"{workspace}/in")
    name = lambda f: f.split("kind=")[1].split("/")[0]
    assert sorted(map(name, by_line)) == ["lines", "marked", "spaced"] and sorted(map(name, arrays)) == ["array", "late"]
    assert sorted(r["record_id"] for r in json_feed.read_feed(spark, f"{workspace}/in", LAYOUT).collect()) == list("abcdef")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("told", "told")
    json_feed.files_by_layout(spark, f"{workspace}/in/kind=array")
    assert bool(jobs.getJobIdsForGroup("told")) == (most == 0)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet='a"\\{}[]é', max_size=40), st.booleans())
def test_structure_by_a_plain_walk(text, inside):
    data, want, escaped, now = text.encode(), [], False, inside
    for i, c in enumerate(data):
        if escaped:
            escaped = False
            plain = False
        else:
            escaped = c == ord("\\")
            plain = True
        if c == ord('"') and plain:
            now = not now
        elif c in b"{}[]" and not now:
            want.append((i, 1 if c in b"{[" else -1))
    places, steps, ends = json_array.structure(np.frombuffer(data, np.uint8), inside)
    assert list(zip(places.tolist(), steps.tolist())) == want and ends == now
