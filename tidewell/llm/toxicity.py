"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows that are typical of toxic texts and one on windows of
ordinary texts. A window is a word between fixed marks; what the ordinary dictionary needs more than the toxic
one to compress it is its distance. A text is judged by its largest distances, through a logistic curve that is
calibrated on labelled rows which neither dictionary has seen.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import documents_only, over_texts, text_slices

#: Bound of the labelled rows used for fitting, by label; the rows with the smallest hashes are taken.
MAX_TOXIC, MAX_ORDINARY = 4_000, 12_000
#: Windows of either kind that reach the driver for training.
MAX_WINDOWS = 60_000
#: A window is typical of toxic texts from this log-likelihood ratio on (about one chance find in 600 words).
MIN_RATIO = 10.0
SIZES, LEVEL = (16 << 10, 32 << 10), 19
MARK = bytes(range(1, 9))
TRIM = b".,!?;:*#$%&|()[]\"'"
#: Largest distances of a text that count, and windows remembered by a worker.
TOP, MEMORY = 3, 400_000


@dataclass(frozen=True)
class Model:
    toxic: tuple[bytes, ...]
    ordinary: tuple[bytes, ...]
    weights: tuple[float, ...]


def windows(text: str) -> set[bytes]:
    return {w.strip(TRIM) for w in text.lower().encode().split()}


def _framed(word: bytes) -> bytes:
    return MARK + b" " + word + b" " + MARK


class Distances:
    """Distances of windows; the memory of windows is emptied when full."""

    def __init__(self, toxic: tuple[bytes, ...], ordinary: tuple[bytes, ...]):
        self.pairs = [(self._compressor(t), self._compressor(o)) for t, o in zip(toxic, ordinary, strict=True)]
        self.memory: dict[bytes, int] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL,
            source_size=64,
            dict_size=len(content),
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=0,
            write_checksum=0,
            write_dict_id=0,
        )
        return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content), compression_params=settings)

    def of(self, word: bytes) -> int:
        known = self.memory.get(word)
        if known is None:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            framed = _framed(word)
            known = self.memory[word] = sum(len(o.compress(framed)) - len(t.compress(framed)) for t, o in self.pairs)
        return known

    def features(self, text: str | None) -> list[float]:
        own = windows(text) if text else ()
        top = sorted((self.of(w) for w in own), reverse=True)[:TOP]
        return [*(max(0, d) for d in top), *[0] * (TOP - len(top)), math.log1p(len(own))]


@lru_cache(maxsize=2)
def _distances(model: Model) -> Distances:
    return Distances(model.toxic, model.ordinary)


def _trained(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the samples themselves serve as the dictionary
        return b"".join(samples)[-size:] or MARK


def _count_windows(batches):
    """Per batch: in how many toxic and ordinary texts a window occurs."""
    for batch, texts in text_slices(batches):
        counts = (Counter(), Counter())
        for text, toxic in zip(texts, batch.column(batch.schema.get_field_index("toxic")).to_pylist(), strict=True):
            counts[toxic].update(w for w in windows(text or "") if 3 < len(w) <= 64)
        found = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.binary()), pa.array([counts[1][w] for w in found], pa.int64()), pa.array([counts[0][w] for w in found], pa.int64())],
            names=["window", "toxic", "ordinary"],
        )


def _ratio(toxic, ordinary, n_toxic: int, n_ordinary: int):
    """Log-likelihood ratio of a window's frequency in the two kinds of texts, as a column."""
    n = n_toxic + n_ordinary

    def part(seen, total, kind):
        return F.when(seen > 0, seen * F.log(seen * n / (total * kind))).otherwise(0.0)

    both = toxic + ordinary
    return 2 * (part(toxic, both, n_toxic) + part(ordinary, both, n_ordinary) + part(n_toxic - toxic, n - both, n_toxic) + part(n_ordinary - ordinary, n - both, n_ordinary))


def _logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression by Newton steps with a small ridge; the last one is the intercept."""
    x = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(x.shape[1])
    ridge = np.diag([*[1.0] * (x.shape[1] - 1), 1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        weights -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - labels) + ridge @ weights)
    return weights


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the texts of labelled rows: ``labels`` has ``doc_id`` and ``toxic`` (0 or 1, others are left
    out). At most MAX_TOXIC and MAX_ORDINARY rows are used; a third of them calibrates, the others train."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").dropDuplicates(["doc_id"])
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    sample = known.where("toxic = 1").orderBy(order, "doc_id").limit(MAX_TOXIC).union(known.where("toxic = 0").orderBy(order, "doc_id").limit(MAX_ORDINARY))
    sample = sample.withColumn("calibrates", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    texts = documents_only(docs).join(F.broadcast(sample), "doc_id")  # bounded by the two limits
    trains = texts.where("not calibrates").select("text", "toxic")
    sizes = {r["toxic"]: r["n"] for r in sample.where("not calibrates").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_ordinary = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_ordinary:
        return Model((MARK,), (MARK,), (0.0,) * (TOP + 1) + (-20.0 if not n_toxic else 0.0,))
    counted = trains.mapInArrow(_count_windows, "window binary, toxic long, ordinary long").groupBy("window").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    toxic, ordinary = F.least(F.col("toxic"), F.lit(n_toxic)), F.least(F.col("ordinary"), F.lit(n_ordinary))
    typical = (toxic / n_toxic > ordinary / n_ordinary) & (_ratio(toxic, ordinary, n_toxic, n_ordinary) >= MIN_RATIO)
    counted = counted.withColumn("typical", typical).withColumn("plain", (toxic + 0.5) / (n_toxic + 1) < 3 * (ordinary + 0.5) / (n_ordinary + 1))
    found = counted.where("typical").orderBy(F.desc("toxic"), "window").limit(MAX_WINDOWS).collect()
    plain = counted.where("plain and not typical and ordinary > 0").orderBy(F.xxhash64("window"), "window").limit(MAX_WINDOWS).collect()
    # a frequent window is shown more often, up to 30 and 3 times
    toxic_samples = [_framed(bytes(r["window"])) for turn in range(30) for r in found if r["toxic"] > turn]
    plain_samples = [_framed(bytes(r["window"])) for r in plain for _ in range(min(3, r["ordinary"]))][:MAX_WINDOWS]
    dictionaries = [tuple(_trained(samples, size) for size in SIZES) for samples in (toxic_samples, plain_samples)]
    bare = Model(*dictionaries, weights=())

    def features(batches):
        distances = _distances(bare)
        for batch, own in text_slices(batches):
            rows = [distances.features(t) for t in own]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(batch.schema.get_field_index("toxic"))], names=["features", "toxic"])

    rows = texts.where("calibrates").select("text", "toxic").mapInArrow(features, "features array<double>, toxic int").collect()
    if not rows:
        return Model(*dictionaries, weights=(0.0,) * (TOP + 1) + (0.0,))
    weights = _logistic(np.array([r["features"] for r in rows]), np.array([float(r["toxic"]) for r in rows]))
    return Model(*dictionaries, weights=tuple(weights.tolist()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``distance`` (the largest of a window) and ``score`` in [0, 1] of every whole text.

    A NULL text counts as empty and, like every text without windows, gets the score of no evidence. Repeated
    rows give repeated results. One pass, no shuffle.
    """

    def make():
        distances, weights = _distances(model), np.array(model.weights)

        def columns(texts: list) -> dict:
            rows = np.array([distances.features(t) for t in texts]).reshape(len(texts), TOP + 1)
            return {"distance": rows[:, 0], "score": 1 / (1 + np.exp(-np.clip(rows @ weights[:-1] + weights[-1], -30, 30)))}

        return columns

    schema = pa.schema([("doc_id", pa.int64()), ("distance", pa.float64()), ("score", pa.float64())])
    return documents_only(docs).mapInArrow(over_texts(make, schema), "doc_id long, distance double, score double")
