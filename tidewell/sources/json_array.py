"""Large JSON arrays, read by many tasks.

The text reader cuts a file after every closing brace, so any part of it can be read from any split. What a cut
means depends on all that comes before it: it may end a record, or be inside a text or a nested object. So a first
pass finds, for every split and both possibilities of starting inside or outside of a text, where it ends and how
deep; put together in order, the state at the start of each split is known. A second pass cuts the records out, and
what lies across splits is joined from its pieces. Records go through ``from_json``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import ship

QUOTE, BACKSLASH = 34, 92
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1
_BLANK = b" \t\r\n"
#: Splits per core where files are large: enough to keep cores busy, few enough that starting them does not count.
_SPLITS_PER_CORE = 32
#: What the second pass gives out.
RECORD, FRAGMENT, FOREIGN = 0, 1, 2


@contextmanager
def _fixed_splits(spark: SparkSession, split_bytes: int | None):
    """Both passes cut files in the same places, whatever the cluster does meanwhile. ``split_bytes`` is the least of a
    split: larger files have larger ones, up to what the session reads in a task, and not more of them."""
    cores = spark.sparkContext.defaultParallelism
    wanted = {"spark.sql.files.minPartitionNum": str(cores)}
    if split_bytes:
        most = max(split_bytes, int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))
        wanted = {
            "spark.sql.files.minPartitionNum": str(_SPLITS_PER_CORE * cores),
            "spark.sql.files.maxPartitionBytes": str(most),
            "spark.sql.files.openCostInBytes": str(split_bytes),
        }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _pieces(spark: SparkSession, files: list[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "}").text(files)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def structure(text: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the brackets that stand outside of texts, the step in depth at each, and whether the end is inside."""
    marks = text == QUOTE
    slashes = np.flatnonzero(text == BACKSLASH)
    if len(slashes):  # a character after an odd number of backslashes is escaped
        first = np.flatnonzero(np.concatenate([[True], np.diff(slashes) > 1]))
        runs = np.diff(np.append(first, len(slashes)))
        after = slashes[first] + runs
        marks[after[(runs % 2 == 1) & (after < len(text))]] = False
    quotes = np.flatnonzero(marks)
    places = np.flatnonzero(_STEP[text])
    before = np.searchsorted(quotes, places) + inside
    places = places[before % 2 == 0]
    return places, _STEP[text[places]].astype(np.int64), bool((len(quotes) + inside) % 2)


def _by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """The text of consecutive pieces, each with its closing brace, split by split."""
    for batch in batches:
        files, blocks = batch.column("file").dictionary_encode().indices.to_numpy(), batch.column("block").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])])) if batch.num_rows else []
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            part = batch.slice(start, end - start)
            yield part.column("file")[0].as_py(), int(blocks[start]), ("}".join(part.column("value").to_pylist()) + "}").encode()


def _surveyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split, for a start outside and inside of a text: does it end inside, how does the depth change, and how
    low does it get on the way."""
    seen: dict[tuple[str, int], list[list]] = {}
    for file, block, text in _by_split(batches):
        ways = seen.setdefault((file, block), [[False, 0, 0], [True, 0, 0]])
        for way in ways:
            _, steps, way[0] = structure(np.frombuffer(text, np.uint8), way[0])
            if len(steps):
                depths = way[1] + np.cumsum(steps)
                way[1], way[2] = int(depths[-1]), min(way[2], int(depths.min()))
    rows = [{"file": f, "block": b, "ends": [w[0] for w in ways], "depth": [w[1] for w in ways], "low": [w[2] for w in ways]} for (f, b), ways in seen.items()]
    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("ends", pa.list_(pa.bool_())), ("depth", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))]))


def start_states(splits: list) -> tuple[dict, list[str]]:
    """Per file and block: is the start inside of a text, its depth, and the block in which the record that is open
    there began (None: none is); and the files that do not end as an array does."""
    states: dict[tuple[str, int], tuple[bool, int, int | None]] = {}
    now: dict[str, tuple[bool, int, int | None]] = {}
    for s in sorted(splits, key=lambda s: (s["file"], s["block"])):
        inside, depth, began = states[s["file"], s["block"]] = now.get(s["file"], (False, 0, None))
        ends, end_depth = s["ends"][inside], depth + s["depth"][inside]
        whole = began is not None and depth + s["low"][inside] > 1  # no record ends in this split
        now[s["file"]] = (ends, end_depth, (began if whole else s["block"]) if end_depth > 1 or ends else None)
    # the text after the last brace got one that is not there
    return states, sorted(f for f, (inside, depth, _) in now.items() if inside or depth != -1)


_ROWS = "file string, began long, at long, kind int, value string"


def _cut(states: dict) -> Callable:
    """Records, and the pieces of those that lie across splits. Anything else between records is foreign."""
    schema = pa.schema([("file", pa.string()), ("began", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("value", pa.string())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*((*r[:4], r[4].decode()) for r in rows), strict=True) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches):
        key, inside, depth, began, open_ = None, False, 0, None, b""

        def element(text: bytes, block: int) -> bytes | None:
            """The text from its opening brace on; None if anything but the separator stands before it."""
            start = text.find(b"{")
            before = text[: max(start, 0)].translate(None, _BLANK)
            return text[start:] if before == b"," or (before == b"[" and block == 0) else None

        def rest():
            """What the split leaves open belongs to a record that goes on in the next one."""
            if key and depth > 1:
                part = open_ if began is not None else element(open_, key[1])
                yield (key[0], key[1] if began is None else began, key[1], FOREIGN if part is None else FRAGMENT, part or b"")

        for file, block, text in _by_split(batches):
            out = []
            if (file, block) != key:
                out += rest()
                key, open_ = (file, block), b""
                inside, depth, began = states[key]
            new = np.frombuffer(text, np.uint8)
            places, steps, inside = structure(new, inside)
            depths = depth + np.cumsum(steps)
            offset = len(open_)
            whole = open_ + text
            ends = places[(depths == 1) & (steps == -1)] + offset + 1
            at = 0
            for end in ends.tolist():
                value, at = whole[at:end], end
                if began is not None:
                    out.append((file, began, block, FRAGMENT, value))
                    began = None
                    continue
                record = element(value, block) if value.endswith(b"}") else None
                out.append((file, None, None, FOREIGN if record is None else RECORD, record or b""))
            depth = int(depths[-1]) if len(depths) else depth
            open_ = whole[at:]
            if depth < 0 and open_.translate(None, _BLANK) not in (b"]}", b"[]}"):
                out.append((file, None, None, FOREIGN, b""))
            yield batch_of(out)
        yield batch_of(list(rest()))

    return run


def read_arrays(spark: SparkSession, files: list[str], columns: T.StructType, options: dict[str, str], folder: str, split_bytes: int | None = None) -> DataFrame:
    """The records of files that hold one JSON array each, as the reader of whole files gives them.

    Records are cut out once and kept in ``folder``, which all executors must reach. The driver sees a row per
    split. A file that is no array of objects is left to the reader of whole files, which takes it as malformed.
    """
    ship(spark)
    with _fixed_splits(spark, split_bytes):
        surveyed = _pieces(spark, files).mapInArrow(_surveyed, "file string, block long, ends array<boolean>, depth array<long>, low array<long>").collect()
        states, broken = start_states(surveyed)
        shared = spark.sparkContext.broadcast(states)  # a row per split
        cut = _pieces(spark, files).mapInArrow(lambda batches: _cut(shared.value)(batches), _ROWS)
        cut.write.mode("overwrite").parquet(folder)
    stored = spark.read.schema(_ROWS).parquet(folder)
    broken = sorted({*broken, *(r["file"] for r in stored.where(F.col("kind") == FOREIGN).select("file").distinct().collect())})
    fine = stored.where(~F.col("file").isin(broken)) if broken else stored
    pieces = fine.where(F.col("kind") == FRAGMENT).groupBy("file", "began").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "")
    records = fine.where(F.col("kind") == RECORD).select("value").unionByName(pieces.select(joined.alias("value")))
    parsed = records.select(F.from_json("value", columns, options).alias("r")).select("r.*")
    if broken:
        parsed = parsed.unionByName(spark.read.schema(columns).options(**options).option("multiLine", True).json(broken))
    return parsed
