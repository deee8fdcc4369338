"""Token ids in binary files: Simple-8b words in blocks, with a directory for vectorised decoding.

A 64-bit word has a selector in its top four bits and ``count`` values of ``bits`` bits below it, first value
lowest. Selector 0 is the escape: the next word is one raw 64-bit value. A block packs up to ``BLOCK`` ids and
starts with a word of its own, so blocks decode independently, all words of one selector at a time.

File, little-endian: ``TWS8``, version, numbers of documents, ids, blocks and words; per document its id, a flag
(0: the id is NULL) and its number of ids; per block the first word (one more for the end); the words.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.batches import documents_only, steady_heap, text_slices
from tidewell.llm.word_ids import word_ids

BLOCK = 1 << 16
#: Ids in a file, but for the document that crosses the bound: documents are never divided.
FILE_IDS = 8 << 20
MAGIC, VERSION = b"TWS8", 1
HEAD = struct.Struct("<4sIQQQQ")

#: Values in a word and their bits, by selector; fixed values of the format.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_POWERS = np.array([1 << b for b in range(61)], np.uint64)
#: Bits that small values need.
_SMALL_BITS = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def pack(values: np.ndarray) -> np.ndarray:
    """The words of one block: at every place the selector that takes most values."""
    values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64)
    need = _SMALL_BITS[values] if values.max() < len(_SMALL_BITS) else np.searchsorted(_POWERS, values, side="right").astype(np.uint8)
    taken = np.zeros(n, np.uint8)  # selector by place; 0 where nothing else fits
    widest, width = need, 1  # most bits among the next ``width`` values; what lies beyond the end needs none
    for selector in range(len(COUNTS) - 1, 0, -1):
        count, bits = int(COUNTS[selector]), int(BITS[selector])
        while width < count:
            by = min(width, count - width)
            shifted = np.zeros(n, np.uint8)
            shifted[: max(0, n - by)] = widest[by:]
            widest, width = np.maximum(widest, shifted), width + by
        fits = widest <= bits
        if not fits.any():  # more values of fewer bits fit nowhere either
            break
        taken[fits] = selector
    jumps, places, at = COUNTS[taken].tolist(), [], 0
    while at < n:
        places.append(at)
        at += jumps[at]
    places = np.array(places)
    chosen = taken[places]
    spans = np.where(chosen == 0, 2, 1)
    slots = np.cumsum(spans) - spans
    words = np.zeros(int(spans.sum()), np.uint64)
    padded = np.concatenate([values, np.zeros(64, np.uint64)])
    for selector in np.unique(chosen):
        mine = np.flatnonzero(chosen == selector)
        if selector == 0:
            words[slots[mine] + 1] = values[places[mine]]
            continue
        count, bits = int(COUNTS[selector]), int(BITS[selector])
        rows = padded[places[mine][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
        words[slots[mine]] = np.bitwise_or.reduce(rows, axis=1) | np.uint64(int(selector) << 60)
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of one block."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    if not selectors.all():  # a raw value follows an escape and has no selector of its own
        is_raw, at = np.zeros(len(words), bool), 0
        for at in np.flatnonzero(selectors == 0):
            if not is_raw[at]:
                is_raw[at + 1] = True
        heads = np.flatnonzero(~is_raw)
    else:
        heads = np.arange(len(words))
    chosen = selectors[heads]
    counts = COUNTS[chosen]
    starts = np.cumsum(counts) - counts
    values = np.zeros(int(counts.sum()), np.uint64)
    for selector in np.unique(chosen):
        mine = np.flatnonzero(chosen == selector)
        if selector == 0:
            values[starts[mine]] = words[heads[mine] + 1]
            continue
        count, bits = int(COUNTS[selector]), int(BITS[selector])
        rows = (words[heads[mine]][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(bits))) & np.uint64((1 << bits) - 1)
        values[starts[mine][:, None] + np.arange(count)] = rows
    return values[:n]


def file_bytes(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    blocks = [pack(ids[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)]
    firsts = np.zeros(len(blocks) + 1, "<u8")
    np.cumsum([len(b) for b in blocks], out=firsts[1:])
    table = np.zeros(len(doc_ids), [("doc_id", "<i8"), ("known", "u1"), ("n", "<u8")])
    table["doc_id"], table["known"], table["n"] = [d or 0 for d in doc_ids], [d is not None for d in doc_ids], lengths
    head = HEAD.pack(MAGIC, VERSION, len(doc_ids), len(ids), len(blocks), int(firsts[-1]))
    return b"".join([head, table.tobytes(), firsts.tobytes(), *(b.astype("<u8").tobytes() for b in blocks)])


def read_file(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of a file in order, each with its ids; blocks are decoded as they are reached."""
    magic, version, n_docs, n_ids, n_blocks, n_words = HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token file of this version")
    table = np.frombuffer(data, [("doc_id", "<i8"), ("known", "u1"), ("n", "<u8")], n_docs, HEAD.size)
    firsts = np.frombuffer(data, "<u8", n_blocks + 1, HEAD.size + table.nbytes)
    words = np.frombuffer(data, "<u8", n_words, HEAD.size + table.nbytes + firsts.nbytes)
    block, held = 0, np.empty(0, "<u4")
    for doc_id, known, n in zip(table["doc_id"].tolist(), table["known"].tolist(), table["n"].tolist(), strict=True):
        parts = [held]
        size = len(held)
        while size < n:
            at = slice(int(firsts[block]), int(firsts[block + 1]))
            parts.append(unpack(words[at], min(BLOCK, n_ids - block * BLOCK)).astype("<u4"))
            size += len(parts[-1])
            block += 1
        held = np.concatenate(parts) if len(parts) > 1 else held
        yield doc_id if known else None, held[:n]
        held = held[n:]


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int) -> DataFrame:
    """Writes the ids of all texts, with ``end_id`` after each, in ascending order of ``doc_id`` below ``folder``
    and returns the manifest: a row per file in order, with the number of ids in the files before it.

    A NULL text is an empty one; a NULL ``doc_id`` sorts first; rows with one ``doc_id`` follow each other in an
    order fixed by their text. Only files that the manifest names count: a task that ran twice or died leaves
    files that nobody reads. ``folder`` must be shared by all executors.
    """
    kinds = "part int, number int, file string, n_docs long, n_ids long, n_bytes long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(path), np.array([end_id], "<u4").tobytes()
        part, number = TaskContext.get().partitionId(), 0
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{root}/files", recursive=True)
        doc_ids, parts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"files/{part:06d}-{number:04d}-{uuid.uuid4().hex}.tws8"
            lengths = [len(p) // 4 for p in parts]
            data = file_bytes(doc_ids, lengths, np.frombuffer(b"".join(parts), "<u4"))
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            row = [part], [number], [name], [len(doc_ids)], [sum(lengths)], [len(data)]
            types = pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=[k.split()[0] for k in kinds.split(", ")])

        for batch, texts in text_slices(batches):
            with steady_heap():
                coded = encoder.many(texts)
            for doc_id, ids in zip(batch.column(0).to_pylist(), coded, strict=True):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                size += len(parts[-1]) // 4
                if size >= FILE_IDS:
                    yield flush()
                    number, size = number + 1, 0
                    doc_ids, parts = [], []
        if doc_ids:
            yield flush()

    ordered = documents_only(docs).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(run, kinds).write.mode("overwrite").parquet(f"{folder}/manifest")
    return manifest(docs.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Files in order; one row per file, so that summing in one place stays small."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema("part int, number int, file string, n_docs long, n_ids long, n_bytes long").parquet(f"{folder}/manifest")
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the files below ``folder``: ``doc_id``, ``start`` (ids of all documents before it) and
    ``ids`` as little-endian unsigned 32-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{name}") as source:
                    data = source.readall()
                doc_ids, starts, ids, size = [], [], [], 0
                for doc_id, own in read_file(data):
                    doc_ids.append(doc_id)
                    starts.append(start)
                    ids.append(own.tobytes())
                    start += len(own)
                    size += own.nbytes
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], schema=schema)
                        doc_ids, starts, ids, size = [], [], [], 0
                if doc_ids:
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], schema=schema)

    files = manifest(spark, folder).select("file", "start")
    # a task per file: their names are small, so adaptive execution would read them all in one
    return files.repartition(max(1, files.count())).mapInArrow(run, "doc_id long, start long, ids binary")
