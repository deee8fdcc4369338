"""Packing of documents into sequences along a space-filling curve.

A document's ids are projected to a few dimensions by random signs, the direction is put on a grid, and the
grid's Hilbert index is the document's key. Documents are range-sorted by key, so neighbours on the curve, which
share words and language, land in the same sequences. Each range is cut every LENGTH ids; only its last sequence
has padding.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import documents_only, over_texts
from tidewell.llm.components import stored
from tidewell.llm.word_ids import word_ids

LENGTH = 2048
DIMENSIONS, GRID_BITS = 4, 8
#: Rows of the projection; ids beyond share rows.
PROJECTION_ROWS = 1 << 16
#: Bytes of ids in a range, so that a task's work stays the same at any input size; fewer on small inputs, so that all
#: cores have one, but not so few that the padding at a range's end counts.
RANGE_BYTES, LEAST_RANGE = 16 << 20, 4 << 20


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    """A row of values per dimension."""
    return np.random.default_rng(20240101).standard_normal((DIMENSIONS, PROJECTION_ROWS), np.float32)


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of rows of coordinates with so many bits (Skilling's transformation)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swapped = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swapped)
            x[i] ^= swapped if i else 0
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] & (1 << bit)) != 0, (1 << bit) - 1, 0)
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def curve_keys(ids: list[bytes]) -> np.ndarray:
    """The curve positions of documents, each of at least one id."""
    if not ids:
        return np.zeros(0, np.int64)
    starts = np.cumsum([0, *(len(i) // 4 for i in ids[:-1])])
    rows = np.frombuffer(b"".join(ids), "<u4") & (PROJECTION_ROWS - 1)
    vectors = np.stack([np.add.reduceat(values.take(rows), starts) for values in _projection()], axis=1).astype(np.float64)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return hilbert_index(np.clip((vectors + 1) / 2 * (1 << GRID_BITS), 0, (1 << GRID_BITS) - 1), GRID_BITS)


def _cut(length: int):
    kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, offset = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            rows, size = [], 0
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total, start = len(ids) // 4, 0
                while start < total:
                    n = min(total - start, length - offset)
                    rows.append((doc_id, start, ids[4 * start : 4 * (start + n)], total, sequence, offset))
                    start, offset = start + n, offset + n
                    if offset == length:
                        sequence, offset = sequence + 1, 0
                size += len(ids)
                if size >= 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    return run


def pack(docs: DataFrame, path: str, folder: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents: ``doc_id``, ``start`` in its document, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset`` there.

    Every document ends with ``end_id``, so a NULL or empty text is one id. A sequence has at most ``length`` ids;
    sequence ids are unique and ascend along the curve. Equal documents share a key; ties are broken by a hash of
    the ids, then ``doc_id``, so copies spread over ranges by id. ``folder`` must be shared by all executors.
    """

    def make():
        encoder, end = word_ids(path), np.array([end_id], "<u4").tobytes()

        def columns(texts: list) -> dict:
            ids = [own + end for own in encoder.many(texts)]
            return {"ids": ids, "key": curve_keys(ids)}

        return columns

    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("key", pa.int64())])
    # written once: sorting by range reads the order twice, and the ranges follow the size
    coded = documents_only(docs).mapInArrow(over_texts(make, schema), "doc_id long, ids binary, key long")
    coded = stored(coded.withColumns({"tie": F.xxhash64("ids"), "size": F.octet_length("ids").cast("long")}), f"{folder}/coded")
    size = coded.agg(F.sum("size")).first()[0] or 0
    ranges = max(1, min(docs.sparkSession.sparkContext.defaultParallelism, size // LEAST_RANGE), size // RANGE_BYTES)
    order = ["key", "tie", "doc_id"]
    ordered = coded.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    return ordered.mapInArrow(_cut(length), "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long")
