"""Log-bilinear language model trained by noise-contrastive estimation, with numpy inside Spark tasks.

Tokens are lower-cased words and one end per text. The model predicts the most frequent words themselves and all
others by their shape; a word of a shape then has its share of the shape's smoothed counts. The vectors of the two
tokens before give the predicted vector, its products with all token vectors the scores. Training walks over every
text that may be learnt from: each task starts from the same parameters, takes AdaGrad steps with shared noise
samples, and the parameters of all tasks are averaged by their tokens. Normalisers of all contexts come from
batched matrix products, once; scoring looks them up.

Counts of words are exact and cover every training text. Only the counts of the most frequent words, a fixed
number, are broadcast; those of rarer words come by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import text_slices
from tidewell.llm.components import stored

#: The end of a text as a word; no real word has a blank.
END = b" "
#: Words that the model predicts by themselves; words whose counts are broadcast; distinct words that a task counts
#: before it hands counts on.
MODEL_WORDS, BROADCAST_WORDS, COUNTER_WORDS = 700, 200_000, 300_000
DIMENSIONS, NOISE, BATCH, RATE = 24, 32, 2048, 0.08
SMOOTH = 0.1
#: Word shapes: accented or not, by last character, by length.
ENDINGS = (b".", b",", b"*#$%&", b"!?;:", b"0123456789")
SHAPES = 2 * (len(ENDINGS) + 1) * 3


def shape(word: bytes) -> int:
    ending = next((i for i, e in enumerate(ENDINGS) if word[-1] in e), len(ENDINGS))
    length = 0 if len(word) < 5 else 1 if len(word) < 10 else 2
    return ((not word.isascii()) * (len(ENDINGS) + 1) + ending) * 3 + length


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


@dataclass(frozen=True)
class Statistics:
    """Exact counts of the training tokens and what follows from them. Classes are the shapes, then the model's
    words; ``norms`` are the smoothed totals of shapes without the model's words."""

    total: int
    distinct: int
    counts: dict[bytes, int]
    classes: dict[bytes, int]
    class_counts: np.ndarray
    norms: np.ndarray


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "count"])

    for _, texts in text_slices(batches):
        for text in texts:
            seen.update(tokens(text))
        if len(seen) >= COUNTER_WORDS:
            yield told()
            seen.clear()
    yield told()


def _by_shape(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((SHAPES, 2), np.int64)
    for batch in batches:
        for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[shape(word)] += (count, 1)
    kinds = pa.int32(), pa.int64(), pa.int64()
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((np.arange(SHAPES), sums[:, 0], sums[:, 1]), kinds, strict=True)], names=["shape", "count", "words"])


def _frequent(counts: DataFrame) -> dict[bytes, int]:
    """The words down to the least frequency at which they are at most BROADCAST_WORDS, most frequent first.

    The frequency comes from a histogram over classes of frequency, so no task sends candidates of its own.
    """
    scale = F.floor(F.log2("count") * 64).cast("long")
    least, n = None, 0
    for row in counts.groupBy(scale.alias("scale")).count().orderBy(F.desc("scale")).collect():
        n += row["count"]
        if n > BROADCAST_WORDS:
            break
        least = row["scale"]
    rows = counts.where(scale >= F.lit(least)).collect() if least is not None else []
    return {bytes(r["word"]): r["count"] for r in sorted(rows, key=lambda r: (-r["count"], bytes(r["word"])))}


def gather(texts: DataFrame, folder: str) -> tuple[DataFrame, Statistics]:
    """The table of all training words with their counts, and the statistics from it."""
    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "word binary, count long").groupBy("word").agg(F.sum("count").alias("count"))
    counts = stored(counts, f"{folder}/counts")
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    known = _frequent(counts)
    words = [END, *[w for w in list(known)[:MODEL_WORDS] if w != END]]
    classes = {w: SHAPES + i for i, w in enumerate(words)}
    sums = np.zeros((SHAPES, 2), np.int64)
    for r in counts.where(F.col("word") != END).mapInArrow(_by_shape, "shape int, count long, words long").groupBy("shape").agg(F.sum("count").alias("count"), F.sum("words").alias("words")).collect():
        sums[r["shape"]] = r["count"], r["words"]
    for word in words[1:]:
        sums[shape(word)] -= (known[word], 1)
    class_counts = np.concatenate([sums[:, 0], [known.get(w, 0) for w in words]]).astype(float)
    return counts, Statistics(total, distinct, known, classes, class_counts, sums[:, 0] + SMOOTH * (sums[:, 1] + 1))


class Model:
    """Parameters: token vectors (one more for the start of a text), a matrix per context position, biases."""

    def __init__(self, class_counts: np.ndarray):
        n, draw = len(class_counts), np.random.default_rng(7)
        self.noise = (class_counts + 1) / (class_counts + 1).sum()
        self.values = {
            "vectors": (draw.standard_normal((n + 1, DIMENSIONS)) * 0.1).astype(np.float32),
            "first": np.eye(DIMENSIONS, dtype=np.float32) * 0.5,
            "second": np.eye(DIMENSIONS, dtype=np.float32) * 0.5,
            "biases": np.log(self.noise).astype(np.float32),
        }
        self.squares = {k: np.full_like(v, 1e-3) for k, v in self.values.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.values.values()]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name, value in self.values.items():
            self.values[name] = flat[at : at + value.size].reshape(value.shape).astype(np.float32)
            at += value.size

    def step(self, before: np.ndarray, last: np.ndarray, target: np.ndarray, noise: np.ndarray) -> None:
        """One noise-contrastive step on a batch; the noise samples serve all of its rows."""
        vectors, first, second, biases = self.values.values()
        log_noise = np.log(len(noise) * self.noise).astype(np.float32)
        a, b, out, other = vectors[last], vectors[before], vectors[target], vectors[noise]
        predicted = a @ first + b @ second
        at_target = -_sigmoid(-((predicted * out).sum(axis=1) + biases[target] - log_noise[target]))
        at_noise = _sigmoid(predicted @ other.T + (biases[noise] - log_noise[noise]))
        slope = at_target[:, None] * out + at_noise @ other
        rows = np.concatenate([target, last, before, noise])
        gradients = np.concatenate([at_target[:, None] * predicted, slope @ first.T, slope @ second.T, at_noise.T @ predicted])
        self._update("first", slice(None), a.T @ slope)
        self._update("second", slice(None), b.T @ slope)
        self._update("vectors", *_summed_rows(rows, gradients))
        self._update("biases", slice(None), np.bincount(np.concatenate([target, noise]), np.concatenate([at_target, at_noise.sum(axis=0)]), len(biases)).astype(np.float32))

    def _update(self, name: str, rows, gradient: np.ndarray) -> None:
        self.squares[name][rows] += gradient * gradient
        self.values[name][rows] -= RATE * gradient / np.sqrt(self.squares[name][rows])

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of every token after every last token and every token before it, and the normalisers of all
        pairs of contexts, in natural logarithms."""
        vectors, first, second, biases = self.values.values()
        outputs = vectors[:-1].T
        by_last, by_before = vectors @ first @ outputs + biases, vectors @ second @ outputs
        norms = np.empty((len(vectors), len(vectors)), np.float32)
        for before in range(len(vectors)):
            scores = by_last + by_before[before]
            highest = scores.max(axis=1)
            norms[before] = highest + np.log(np.exp(scores - highest[:, None]).sum(axis=1))
        return by_last, by_before, norms


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _summed_rows(rows: np.ndarray, gradients: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[starts], np.add.reduceat(gradients[order], starts, axis=0)


class _Classes(dict):
    """The class of every word: its own, or that of its shape, which is remembered."""

    def __init__(self, own: dict[bytes, int]):
        super().__init__(own)
        self.own = own

    def __missing__(self, word: bytes) -> int:
        if len(self) >= COUNTER_WORDS:
            self.clear()
            self.update(self.own)
        found = self[word] = self.own[word] if word in self.own else shape(word)
        return found


def _classified(listed: list[list[bytes]], classes: _Classes) -> np.ndarray:
    """Classes of the tokens of some texts, one text after the other."""
    return np.fromiter(map(classes.__getitem__, chain.from_iterable(listed)), np.int32, sum(map(len, listed)))


def _contexts(own: np.ndarray, lengths: list[int], start: int) -> tuple[np.ndarray, np.ndarray]:
    """The last token and the one before it at every place; ``start`` where the text has none."""
    last, before = np.empty_like(own), np.empty_like(own)
    last[1:], before[2:] = own[:-1], own[:-2]
    begins = np.cumsum([0, *lengths[:-1]])
    last[begins] = start
    before[begins] = start
    seconds = begins[np.array(lengths) > 1] + 1
    before[seconds] = start
    return last, before


def train(texts: DataFrame, statistics: Statistics) -> Model:
    """The average of what all tasks learn, each from its share of the texts."""
    shared = texts.sparkSession.sparkContext.broadcast((statistics.classes, statistics.class_counts))

    def learn(batches):
        own_classes, class_counts = shared.value
        classes = _Classes(own_classes)
        model, draw, seen = Model(class_counts), np.random.default_rng(TaskContext.get().partitionId()), 0
        for _, own in text_slices(batches):
            listed = [tokens(t) for t in own]
            targets = _classified(listed, classes)
            last, before = _contexts(targets, [len(x) for x in listed], len(class_counts))
            seen += len(targets)
            order = draw.permutation(len(targets))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                model.step(before[rows], last[rows], targets[rows], draw.choice(len(class_counts), NOISE, p=model.noise))
        if seen:
            flat = model.flat() * seen
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([seen], pa.int64()), pa.array([flat.tobytes()], pa.binary())], names=["part", "seen", "sums"])

    def add(batches):
        seen, sums = 0, None
        for batch in batches:
            for n, flat in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                seen, sums = seen + n, np.frombuffer(flat) + (0 if sums is None else sums)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([seen], pa.int64()), pa.array([sums.tobytes()], pa.binary())], names=["part", "seen", "sums"])

    kinds = "part int, seen long, sums binary"
    parts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(learn, kinds)
    # sums of sums: a task adds what it gets one by one
    parts = parts.repartition(16).mapInArrow(add, kinds).coalesce(1).mapInArrow(add, kinds)
    model = Model(statistics.class_counts)
    for row in parts.collect():
        model.load(np.frombuffer(row["sums"]) / row["seen"])
    return model


def score(docs: DataFrame, counts: DataFrame, statistics: Statistics, model: Model, folder: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    ``base_score`` is the smoothed unigram log10 probability, ``score`` the model's. A NULL text is empty and has
    one token, its end. Repeated rows give repeated results. ``folder`` must be shared by all executors.
    """
    spark = docs.sparkSession
    tables = model.tables()
    by_count = {w: math.log10(c + SMOOTH) for w, c in statistics.counts.items()}
    shared = spark.sparkContext.broadcast((statistics.classes, by_count, np.log10(statistics.norms), *tables))
    start = len(statistics.class_counts)
    kinds = "row long, doc_id long, n_tokens long, n_known long, base double, lm double, word binary, times long"
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("lm", pa.float64()), ("word", pa.binary()), ("times", pa.int64())])

    def look_up(batches):
        own_classes, logs, norms, by_last, by_before, normalisers = shared.value
        classes = _Classes(own_classes)
        row = TaskContext.get().partitionId() << 40
        for batch, texts in text_slices(batches):
            listed = [tokens(t) for t in texts]
            lengths = [len(x) for x in listed]
            own = _classified(listed, classes)
            last, before = _contexts(own, lengths, start)
            logs10 = (by_last[last, own] + by_before[before, own] - normalisers[before, last]).astype(float) / math.log(10)
            of_shape = own < SHAPES
            logs10[of_shape] -= norms[own[of_shape]]
            of_count = np.fromiter(map(logs.get, chain.from_iterable(listed), repeat(np.nan)), float, len(own))
            rare = np.isnan(of_count)
            of_count[rare] = 0.0
            begins = np.cumsum([0, *lengths[:-1]])
            base = np.add.reduceat(of_count, begins)
            lm = np.add.reduceat(logs10 + of_count * of_shape, begins)
            known = np.array(lengths) - np.add.reduceat(rare.astype(np.int64), begins)
            n = len(listed)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((row + np.arange(n), batch.column(0), lengths, known, base, lm, [None] * n, [None] * n), schema, strict=True)], schema=schema)
            found = Counter()
            place = np.repeat(np.arange(n), lengths)
            flat = [w for words in listed for w in words]
            for at in np.flatnonzero(rare).tolist():
                found[int(place[at]), flat[at]] += 1
            if found:
                m = len(found)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(([row + k[0] for k in found], [None] * m, [None] * m, [None] * m, [None] * m, [None] * m, [k[1] for k in found], list(found.values())), schema, strict=True)], schema=schema)
            row += n

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source.mapInArrow(look_up, kinds).write.mode("overwrite").parquet(f"{folder}/scored")
    scored = spark.read.schema(kinds).parquet(f"{folder}/scored")
    rare = scored.where("word is not null").select("row", "word", "times").join(counts, "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + SMOOTH)).alias("rare"),
        F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
    )
    norm = math.log10(statistics.total + SMOOTH * (statistics.distinct + 1))
    extra = F.coalesce("rare", F.lit(0.0))
    return scored.where("word is null").join(rare, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("base") + extra - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("lm") + extra).alias("score"),
    )
