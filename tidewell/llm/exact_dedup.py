"""Exact duplicates by an exchange of Golomb-coded fingerprints.

A first pass cuts the rows of every task into blocks and sends, for each block, the sorted distinct fingerprints
of its normalised texts to the owners of the hash ranges, as gaps in a Golomb code with a power of two as
parameter. Owners answer each block with a bitmap: bit *i* says whether the *i*-th fingerprint occurs in another
block too. A second pass over the rows applies the bitmaps, so that only suspects, rows whose fingerprint occurs
twice, are shuffled; there, texts are compared byte by byte.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.batches import documents_only, text_slices

#: Bits of a fingerprint. Chance matches only make suspects.
FINGERPRINT_BITS = 48
#: A block ends after so many rows or characters, whatever comes first; a task holds one block of texts.
BLOCK_ROWS, BLOCK_CHARS = 1 << 16, 32 << 20
WHITE = b" \t\n\x0b\x0c\r"
HEAD = struct.Struct("<IBI")


def golomb_encode(values: np.ndarray) -> bytes:
    """Ascending distinct values below 2**63 as gaps: quotients in unary, then remainders of ``k`` bits."""
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    k = max(0, int(np.log2(max(1.0, 0.69 * float(gaps.mean()) if len(gaps) else 1.0))))
    ends = np.cumsum((gaps >> k) + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    rest = ((gaps[:, None] >> np.arange(k)) & 1).astype(np.uint8)
    packed = np.packbits(unary).tobytes()
    return HEAD.pack(len(gaps), k, len(packed)) + packed + np.packbits(rest.ravel()).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    n, k, size = HEAD.unpack_from(data)
    if not n:
        return np.empty(0, np.int64)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, size, HEAD.size))
    quotients = np.diff(np.flatnonzero(unary)[:n], prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=HEAD.size + size))[: n * k].reshape(n, k)
    return np.cumsum((quotients.astype(np.int64) << k) + bits.astype(np.int64) @ (1 << np.arange(k, dtype=np.int64)) + 1) - 1


class _Block:
    """Rows that follow each other in a task."""

    def __init__(self):
        self.doc_ids, self.texts, self.normal, self.hashes, self.size = [], [], [], [], 0

    def add(self, doc_id, text: str | None) -> None:
        normal = (text or "").encode().translate(None, WHITE)
        self.doc_ids.append(doc_id)
        self.texts.append(len(text or ""))
        self.normal.append(normal)
        self.hashes.append(hashlib.sha256(normal).digest())
        self.size += len(normal)

    def fingerprints(self) -> np.ndarray:
        return np.array([int.from_bytes(h[: FINGERPRINT_BITS // 8]) for h in self.hashes], np.int64)

    def name(self, distinct: np.ndarray) -> str:
        """Blocks are addressed by content: should a second pass cut the rows otherwise, no bitmap fits."""
        return hashlib.sha256(distinct.tobytes()).hexdigest()[:40]


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[_Block]:
    block = _Block()
    for batch, texts in text_slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            block.add(doc_id, text)
            if len(block.doc_ids) >= BLOCK_ROWS or block.size >= BLOCK_CHARS:
                yield block
                block = _Block()
    if block.doc_ids:
        yield block


def classes(docs: DataFrame, folder: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are the same without white space; NULL is an empty text, and all empty texts are
    equal. Of equal texts the one with most code points in the original stays, then the smallest ``doc_id`` (NULL
    last); of rows that agree in all of that, one. ``folder`` must be shared by all executors.
    """
    spark = docs.sparkSession
    source = documents_only(docs)
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    span = -(-(1 << FINGERPRINT_BITS) // owners)
    first = "doc_id long, n_points long, sha binary, owner int, block string, payload binary"
    fields = pa.schema([("doc_id", pa.int64()), ("n_points", pa.int64()), ("sha", pa.binary()), ("owner", pa.int32()), ("block", pa.string()), ("payload", pa.binary())])

    def send(batches):
        for block in _blocks(batches):
            distinct, counts = np.unique(block.fingerprints(), return_counts=True)
            name, n = block.name(distinct), len(block.doc_ids)
            empty = [None] * n
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((block.doc_ids, block.texts, block.hashes, empty, empty, empty), fields, strict=True)], schema=fields)
            cuts = np.searchsorted(distinct, np.arange(owners + 1, dtype=np.int64) * span)
            rows = [(o, golomb_encode(distinct[a:b] - o * span)) for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            empty = [None] * len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((empty, empty, empty, [r[0] for r in rows], [name] * len(rows), [r[1] for r in rows]), fields, strict=True)], schema=fields)

    source.mapInArrow(send, first).write.mode("overwrite").parquet(f"{folder}/sent")
    sent = spark.read.schema(first).parquet(f"{folder}/sent")

    def answer(table: pa.Table) -> pa.Table:
        received = [golomb_decode(p) for p in table.column("payload").to_pylist()]
        values, counts = np.unique(np.concatenate(received), return_counts=True)
        twice = values[counts > 1]
        bitmaps = [np.packbits(np.isin(r, twice, assume_unique=True)).tobytes() for r in received]
        return pa.table({"block": table.column("block"), "owner": table.column("owner"), "n": pa.array([len(r) for r in received], pa.int32()), "bitmap": pa.array(bitmaps, pa.binary())})

    def keep(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("owner").to_pylist(), table.column("n").to_pylist(), table.column("bitmap").to_pylist(), strict=True))
        seen, bits = set(), []
        for owner, n, bitmap in rows:
            if owner not in seen:  # blocks of the same content sent the same and got the same answer
                bits.append(np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n])
                seen.add(owner)
        name = table.column("block")[0].as_py()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{root}/bitmaps", recursive=True)
        draft = f"{root}/bitmaps/draft-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(np.packbits(np.concatenate(bits)).tobytes())
        store.move(draft, f"{root}/bitmaps/{name}")
        return pa.table({"block": [name]})

    answers = sent.where("owner is not null").groupBy("owner").applyInArrow(answer, "block string, owner int, n int, bitmap binary")
    answers.groupBy("block").applyInArrow(keep, "block string").write.mode("overwrite").parquet(f"{folder}/answered")

    def suspects(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for block in _blocks(batches):
            prints = block.fingerprints()
            distinct, place, counts = np.unique(prints, return_inverse=True, return_counts=True)
            path = f"{root}/bitmaps/{block.name(distinct)}"
            if store.get_file_info(path).type == fs.FileType.File:
                with store.open_input_file(path) as stored:
                    bits = np.unpackbits(np.frombuffer(stored.readall(), np.uint8))[: len(distinct)]
                suspect = (bits.astype(bool) | (counts > 1))[place]
            else:
                suspect = np.ones(len(prints), bool)
            for at in range(0, len(prints), 2048):
                rows = [at + int(i) for i in np.flatnonzero(suspect[at : at + 2048])]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.doc_ids[i] for i in rows], pa.int64()), pa.array([block.texts[i] for i in rows], pa.int64()), pa.array([block.normal[i] for i in rows], pa.binary())],
                        names=["doc_id", "n_points", "normal"],
                    )

    last_id = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    found = source.mapInArrow(suspects, "doc_id long, n_points long, normal binary")
    best = F.min(F.struct((-F.col("n_points")).alias("points"), last_id.alias("last_id"), "doc_id"))
    groups = found.groupBy("normal").agg(F.count("*").alias("group_size"), best.alias("best")).where("group_size > 1")
    groups = groups.select(F.unhex(F.sha2("normal", 256)).alias("sha"), "group_size", "best")
    # a row of a group that could be the one that stays is numbered, in case it is there more than once
    turn = F.row_number().over(Window.partitionBy("sha", "doc_id", "n_points").orderBy("doc_id"))
    rows = sent.where("sha is not null").select("doc_id", "n_points", "sha").join(groups, "sha", "left")
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n_points") == -F.col("best.points"))
    grouped = rows.where("best is not null").withColumn("kept", stays & (turn == 1))
    alone = rows.where("best is null").withColumn("kept", F.lit(True))
    out = [F.lower(F.hex("sha")).alias("text_sha256")]
    return grouped.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", "kept", *out).union(alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "kept", *out))
