"""Small helpers of the operators that run Python over Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text handed on in one output batch; bounds a worker's memory whatever the row count.
SLICE_BYTES = 4 << 20
#: What the worker holds between tasks: nothing, or a maker, its key and what it made.
_HELD: list[tuple] = []


def documents_only(docs: DataFrame) -> DataFrame:
    """The two columns that operators read. Columns of other names, whatever they are, stay out of the way."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each batch cut into runs of bounded text size, with the texts as Python strings (None for NULL)."""
    for batch in batches:
        texts, start, size = batch.column(batch.schema.get_field_index("text")).to_pylist(), 0, 0
        for at, text in enumerate(texts):
            size += len(text) if text else 0
            if size >= SLICE_BYTES:
                yield batch.slice(start, at + 1 - start), texts[start : at + 1]
                start, size = at + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def held_alone(make: Callable) -> Callable:
    """``make`` with its last result kept for the tasks to come. A worker keeps one result in all: the tables of one
    operator go before another operator builds its own in the same worker, as in a pipeline."""

    def get(key):
        if not _HELD or _HELD[0][0] is not make or _HELD[0][1] != key:
            _HELD.clear()
            _HELD.append((make, key, make(key)))
        return _HELD[0][2]

    return get


@contextmanager
def steady_heap() -> Iterator[None]:
    """No search for reference cycles meanwhile: there are none, and it would walk the workers' large tables."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def over_texts(make: Callable[[], Callable[[list], dict]], schema: pa.Schema) -> Callable:
    """A mapInArrow function: ``make`` runs once per task; its result turns texts into further columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = make()
        for batch, texts in text_slices(batches):
            with steady_heap():
                made = columns(texts)
            arrays = [made[f.name] if f.name in made else batch.column(batch.schema.get_field_index(f.name)) for f in schema]
            yield pa.RecordBatch.from_arrays([_typed(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

    return run


def _typed(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)
