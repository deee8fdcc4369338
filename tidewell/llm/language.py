"""Language identification with the nearest of several centroids per language.

A text becomes a vector of hashed character n-grams (one to three bytes of letters, words set off by a blank),
weighted by TF-IDF and normalised. Per language, spherical k-means puts a few centroids; the language of the
centroid with the largest cosine wins. A text whose cosine is lower than nearly all training texts of its length
is rejected as belonging to none.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.batches import documents_only, held_alone, over_texts, text_slices
from tidewell.llm.components import stored
from tidewell.session import new_workspace

UNKNOWN = "und"
#: Training rows of a language, at most; those with the smallest hashes are taken.
MAX_ROWS = 1_500
DIMENSIONS, CENTROIDS, ROUNDS = 1 << 12, 4, 12
#: Bounds between classes of text length, in n-grams.
LENGTHS = (64, 256, 1024, 4096)
#: A text is rejected below this share of the lowest cosine of its length in training.
SLACK = 0.6
_LETTER = regex.compile(r"\p{L}")
#: Characters of ASCII that are no letters become blanks; others are kept, which is right for all scripts' letters.
_BLANKS = bytes(c if not (c < 128 and not chr(c).isalpha()) else 32 for c in range(256))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: bytes
    centroids: bytes
    owners: tuple[int, ...]
    floors: tuple[float, ...]


def counts(text: str) -> np.ndarray:
    """Occurrences of the hashed n-grams of a text."""
    data = np.frombuffer(b" " + text.lower().encode().translate(_BLANKS) + b" ", np.uint8)
    data = data[np.concatenate([[True], (data[1:] != 32) | (data[:-1] != 32)])].astype(np.uint32)
    pairs = (data[:-1] << 8) | data[1:]
    triples = (pairs[:-1] << 8) | data[2:]
    shift = np.uint32(32 - 12)
    total = np.bincount((data * np.uint32(0x9E3779B1)) >> shift, minlength=DIMENSIONS)
    for grams, by in ((pairs, 0x85EBCA77), (triples, 0xC2B2AE3D)):
        total += np.bincount((grams * np.uint32(by) + np.uint32(by >> 7)) >> shift, minlength=DIMENSIONS)
    return total


def _vectors(rows: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(np.array(rows, np.float32)) * idf
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norms > 0, norms, 1)


def _length_class(lengths: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, lengths, side="right")


def _k_means(x: np.ndarray, seed: int) -> np.ndarray:
    """Spherical k-means; starts from rows that are far from each other."""
    chosen = [seed % len(x)]
    while len(chosen) < min(CENTROIDS, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centres = x[chosen]
    for _ in range(ROUNDS):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.array([x[nearest == i].sum(axis=0) if (nearest == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres


def _has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _drawn(known: DataFrame) -> DataFrame:
    """``lang`` and ``doc_id`` of at most MAX_ROWS rows per language, those with the smallest hashes.

    A bound on the hash, from the size of the language, leaves about twice as many to be ranked: no task ranks a
    language whole. Only where chance leaves too few of them are fewer taken.
    """
    sizes = known.groupBy("lang").agg(F.count("*").alias("rows"))  # a row per language
    share = (F.xxhash64("doc_id", F.lit("language")) / float(1 << 64) + 0.5).alias("order")
    picked = known.select("lang", "doc_id", share).join(F.broadcast(sizes), "lang").where(F.col("order") * F.col("rows") < 2 * MAX_ROWS)
    by_hash = Window.partitionBy("lang").orderBy("order", "doc_id")
    return picked.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= MAX_ROWS).select("lang", "doc_id").distinct()


def _count_rows(batches):
    for batch, texts in text_slices(batches):
        held = [i for i, t in enumerate(texts) if _has_letter(t)]
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in held], pa.int64()), pa.array([langs[i] for i in held], pa.string()), pa.array([counts(texts[i]).astype("<u4").tobytes() for i in held], pa.binary())], names=["doc_id", "lang", "counts"])


def _own_rows(table: pa.Table) -> list[np.ndarray]:
    """The counts of a language's rows, in an order of their own; at most MAX_ROWS, but for rows that share an id."""
    rows = sorted(zip(table.column("doc_id").to_pylist(), table.column("counts").to_pylist(), strict=True))[: 2 * MAX_ROWS]
    return [np.frombuffer(c, "<u4") for _, c in rows]


def _seen(table: pa.Table) -> pa.Table:
    """In how many of a language's rows each cell occurs."""
    found = np.zeros(DIMENSIONS, np.int64)
    rows = _own_rows(table)
    for row in rows:
        found += row > 0
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()]), "n": pa.array([len(rows)], pa.int64()), "seen": pa.array([found.tobytes()], pa.binary())})


def _centres(idf: np.ndarray):
    """The centroids of a language, and the cosine of each of its rows to the nearest, with its length."""

    def run(table: pa.Table) -> pa.Table:
        name, rows = table.column("lang")[0].as_py(), _own_rows(table)
        x = np.vstack([_vectors(rows[at : at + 128], idf) for at in range(0, len(rows), 128)])
        centres = _k_means(x, zlib.crc32(name.encode())).astype(np.float32)
        best = (x @ centres.T).max(axis=1).astype("<f4")
        lengths = np.array([int(r.sum(dtype=np.int64)) for r in rows], "<i8")
        return pa.table({"lang": pa.array([name]), "centres": pa.array([centres.tobytes()], pa.binary()), "best": pa.array([best.tobytes()], pa.binary()), "lengths": pa.array([lengths.tobytes()], pa.binary())})

    return run


def _floors(best: np.ndarray, lengths: np.ndarray) -> tuple[float, ...]:
    """The lowest cosine that a text of each length class may have. A class with few rows takes the floor of the
    nearest one with more, the shorter of two."""
    classes = _length_class(lengths)
    sizes = np.bincount(classes, minlength=len(LENGTHS) + 1)
    filled = np.flatnonzero(sizes >= 20) if (sizes >= 20).any() else [int(sizes.argmax())]
    own = {int(c): float(np.quantile(best[classes == c], 0.001)) * SLACK for c in filled}
    return tuple(own[min(own, key=lambda f: (abs(f - c), f))] for c in range(len(LENGTHS) + 1))


def fit(docs: DataFrame, folder: str | None = None) -> Model:
    """A model from rows with ``text`` and ``lang``; at most MAX_ROWS of each language are used. Rows without
    letters, id or language are left out. Without any rows the model knows no language.

    Each language is clustered in a task of its own. The driver gets per language its centroids, one count per cell
    and a cosine per row: some hundred kilobytes. ``folder`` must be shared by all executors.
    """
    spark, folder = docs.sparkSession, folder or new_workspace(docs.sparkSession, "language")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null and doc_id is not null")
    # the picked ids are few, by the bound on rows and the number of languages
    rows = known.join(F.broadcast(_drawn(known)), ["lang", "doc_id"]).select("doc_id", "lang", "text").mapInArrow(_count_rows, "doc_id long, lang string, counts binary")
    rows = stored(rows, f"{folder}/rows")
    per_language = rows.groupBy("lang").applyInArrow(_seen, "lang string, n long, seen binary").collect()
    if not per_language:
        return Model((), b"", b"", (), ())
    n, seen = sum(r["n"] for r in per_language), sum(np.frombuffer(r["seen"], np.int64) for r in per_language)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    found = sorted(rows.groupBy("lang").applyInArrow(_centres(idf), "lang string, centres binary, best binary, lengths binary").collect(), key=lambda r: r["lang"])
    owners = [i for i, r in enumerate(found) for _ in range(len(r["centres"]) // (4 * DIMENSIONS))]
    best, lengths = np.concatenate([np.frombuffer(r["best"], "<f4") for r in found]), np.concatenate([np.frombuffer(r["lengths"], "<i8") for r in found])
    return Model(tuple(r["lang"] for r in found), idf.tobytes(), b"".join(r["centres"] for r in found), tuple(owners), _floors(best, lengths))


@held_alone
def _arrays(model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(model.idf, np.float32), np.frombuffer(model.centroids, np.float32).reshape(-1, DIMENSIONS), np.array(model.owners)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and ``rejected`` of every text.

    NULL texts and texts without letters are ``und`` with score 0, and rejected; so is everything under a model
    without languages. A rejected text with letters still names its nearest language. One pass, no shuffle.
    """

    def make():
        idf, centres, owners = _arrays(model)
        names, floors = np.array([*model.languages, UNKNOWN], object), np.array(model.floors)

        def columns(texts: list) -> dict:
            known = np.array([bool(model.languages) and _has_letter(t) for t in texts])
            language, score, rejected = np.full(len(texts), len(model.languages)), np.zeros(len(texts)), np.ones(len(texts), bool)
            places = np.flatnonzero(known)
            for at in range(0, len(places), 256):
                mine = places[at : at + 256]
                rows = [counts(texts[i]) for i in mine]
                cosines = _vectors(rows, idf) @ centres.T
                nearest = cosines.argmax(axis=1)
                language[mine], score[mine] = owners[nearest], np.clip(cosines.max(axis=1), 0, 1)
                rejected[mine] = score[mine] < floors[_length_class(np.array([r.sum() for r in rows]))]
            return {"lang_pred": names[language].tolist(), "score": score, "rejected": rejected}

        return columns

    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    return documents_only(docs).mapInArrow(over_texts(make, schema), "doc_id long, lang_pred string, score double, rejected boolean")
