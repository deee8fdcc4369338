"""Spelling variants: words that one inserted, deleted or replaced character sets apart, found in a frequency-vector trie.

A word's vector counts its letters by group. One edit adds at most one to the counts and takes at most one away, so
words at distance one differ by a surplus of one and a deficit of one at most. Words are dealt out by the first
counts of their vectors, and every word visits, as a query, its own group and those that the budget reaches. There
the group's words are arranged by their further counts, as the paths of a trie; a depth-first search takes all queries
down together, each spending its budget where a count differs, and drops it where there is none left. The words of
the leaves that a query reaches are compared by halves, one of which any two such words share, and then character by
character.

A pair is looked for once: from its longer word, or at equal length from the one whose counts come first (with equal
first counts, from the smaller word).
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.components import stored

#: Letter groups in the order of the levels; whatever else occurs is the last level. Any grouping gives the same result.
GROUPS = ("e", "a", "i", "n", "r", "s", "t", "o", "u", "l", "dw", "cgk", "mpb", "fhv", "jqxyz")
LEVELS = len(GROUPS) + 1
#: Words of a group at most, where more levels can divide it; the numbers of levels that are tried for it.
GROUP_WORDS, KEY_LEVELS = 1 << 14, (4, 6, 8, 10, 12, LEVELS)
#: A node with so few words is a leaf.
LEAF = 64
#: Words are runs of these characters.
RUN = "[A-Za-zÀ-ÿ]+"
_PAIR = "a string, b string, a_n long, b_n long"
_GROUP_OF = np.full(256, LEVELS - 1, np.int64)
for _level, _letters in enumerate(GROUPS):
    _GROUP_OF[list(_letters.encode())] = _level


def occurrences(docs: DataFrame, damage: int = 97) -> DataFrame:
    """A row ``word`` per run of letters, ASCII letters lower-cased. Where ``damage`` divides the crc32 of
    ``<doc_id>:<run>``, one character is deleted, at that crc32 modulo the length: planted misspellings.

    NULL texts have no runs; a NULL id counts as an empty one.
    """
    lowered = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("doc_id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return hashed.select(F.when(F.col("h") % damage == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_chars: int = 5, least_rows: int = 3) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough."""
    return words.where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_rows)


def _counts(levels: int) -> list[Column]:
    """The first counts of a word's vector."""
    length = F.char_length("word")
    known = [length - F.char_length(F.translate("word", letters, "")) for letters in GROUPS[:levels]]
    return known if levels <= len(GROUPS) else [*known, F.char_length(F.translate("word", "".join(GROUPS), ""))]


def _reachable(levels: int) -> Column:
    """The groups that a word visits: their counts, and how much of the deficit and the surplus is left there."""

    def visit(changes: dict[int, int], deficit: int, surplus: int) -> Column:
        counts = [F.col("counts")[i] + changes.get(i, 0) for i in range(levels)]
        return F.struct(F.array(*counts).alias("key"), F.lit(deficit).alias("deficit"), F.lit(surplus).alias("surplus"))

    visits = [visit({}, 1, 1), *(visit({i: -1}, 0, 1) for i in range(levels))]
    visits += [visit({i: 1, j: -1}, 0, 0) for i in range(levels) for j in range(i + 1, levels)]
    return F.filter(F.array(*visits), lambda v: F.array_min(v["key"]) >= 0)


def one_apart(longer: bytes, other: bytes) -> bool:
    """Does one deletion from ``longer``, or one replacement at equal length, give ``other``?"""
    skipped = len(longer) - len(other)
    at = next((i for i, (x, y) in enumerate(zip(longer, other, strict=False)) if x != y), len(other))
    return at < len(longer) and longer[at + 1 :] == other[at + 1 - skipped :]


class _Words:
    """Words with their vectors and hashes of their halves."""

    def __init__(self, table: pa.Table):
        self.words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        self.n = table.column("n").to_numpy()
        lengths = np.array([len(w) for w in self.words], np.int64)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        letters = _GROUP_OF[np.frombuffer(b"".join(self.words), np.uint8)]
        self.vectors = np.bincount(rows * LEVELS + letters, minlength=len(lengths) * LEVELS).reshape(-1, LEVELS)
        # halves, told apart by the whole length; the same for the word that a deletion leaves
        self.head = self._hashes(lambda w, h: (len(w), w[:h]))
        self.tail = self._hashes(lambda w, h: (len(w), w[h:]))

    def _hashes(self, part, shorter: int = 0) -> np.ndarray:
        return np.fromiter((hash(part(w, (len(w) - shorter) // 2)) for w in self.words), np.int64, len(self.words))

    def without_one(self) -> tuple[np.ndarray, np.ndarray]:
        return self._hashes(lambda w, h: (len(w) - 1, w[:h]), 1), self._hashes(lambda w, h: (len(w) - 1, w[h + 1 :]), 1)


def _equal(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places where values of ``x`` and ``y`` agree, as pairs."""
    order = np.argsort(y, kind="stable")
    low, high = (np.searchsorted(y, x, side, sorter=order) for side in ("left", "right"))
    times = high - low
    i = np.repeat(np.arange(len(x)), times)
    return i, order[np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]


def _leaves(own: _Words, queries: _Words, deficit: np.ndarray, surplus: np.ndarray, first_level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Depth-first search: the words (places in ``own``) of each leaf, and the queries that reach it."""
    order = np.lexsort(own.vectors.T[::-1])
    vectors = own.vectors[order]
    stack = [(0, len(order), first_level, np.arange(len(queries.words)), deficit, surplus)]
    while stack:
        low, high, level, alive, deficit, surplus = stack.pop()
        if high - low <= LEAF or level == LEVELS:
            yield order[low:high], alive
            continue
        column, asked = vectors[low:high, level], queries.vectors[alive, level]
        starts = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
        for start, end in zip(starts, [*starts[1:], high - low], strict=True):
            missing = asked - column[start]  # what the query has more
            left, over = deficit - np.maximum(missing, 0), surplus - np.maximum(-missing, 0)
            on = (left >= 0) & (over >= 0)
            if on.any():
                stack.append((low + start, low + end, level + 1, alive[on], left[on], over[on]))


def _near(first_level: int):
    def run(group: pa.Table, visitors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if group.num_rows and visitors.num_rows:
            own, queries = _Words(group), _Words(visitors)
            deficit, surplus = (visitors.column(c).to_numpy().astype(np.int64) for c in ("deficit", "surplus"))
            same_group = (deficit == 1) & (surplus == 1)
            heads, tails = queries.without_one()
            for words, alive in _leaves(own, queries, deficit, surplus, first_level):
                pairs = [_equal(x[alive], y[words]) for x, y in ((queries.head, own.head), (queries.tail, own.tail), (heads, own.head), (tails, own.tail))]
                for q, w in {(int(alive[i]), int(words[j])) for many in pairs for i, j in zip(*many, strict=True)}:
                    a, b = queries.words[q], own.words[w]
                    if (len(a) > len(b) or not same_group[q] or a < b) and one_apart(a, b):
                        found.append((a.decode("latin-1"), b.decode("latin-1"), int(queries.n[q]), int(own.n[w])))
        columns = zip(*found, strict=True) if found else ([], [], [], [])
        return pa.table({name: pa.array(c, kind) for name, kind, c in zip("a b a_n b_n".split(), (pa.string(), pa.string(), pa.int64(), pa.int64()), columns, strict=True)})

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``b``, ``a_n``, ``b_n`` of every pair of near words in ``words`` (``word``, distinct, and ``n``), once."""
    for levels in KEY_LEVELS:  # the group sizes, one number per choice
        keyed = words.select("word", "n", F.array(*_counts(levels)).alias("counts"))
        sizes = keyed.groupBy("counts").agg(F.count("*").alias("size"))
        if (sizes.agg(F.max("size")).first()[0] or 0) <= GROUP_WORDS:
            break
    # words that all levels leave together are cut by hash, and their visitors go to every part
    parts = sizes.select(F.col("counts").alias("key"), F.ceil(F.col("size") / GROUP_WORDS).cast("int").alias("parts"))
    groups = keyed.withColumnRenamed("counts", "key").join(parts, "key").select("key", F.pmod(F.xxhash64("word"), "parts").cast("int").alias("part"), "word", "n")
    visits = keyed.select("word", "n", F.inline(_reachable(levels))).join(parts, "key")
    visits = visits.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "word", "n", "deficit", "surplus")
    by = ["key", "part"]
    groups = groups.select(*(F.col(c).alias(c) for c in groups.columns))  # columns of its own beside those of the visits
    return groups.groupBy(*by).cogroup(visits.groupBy(*by)).applyInArrow(_near(levels), _PAIR)


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """``word`` and ``root``, the end of the way over ``form``, for rows with ``word`` and ``form``. Every round doubles
    the steps; a way has as many as a count can double."""
    now, turn = stored(forms.select("word", F.col("form").alias("root")), f"{folder}/roots-0"), 0
    while True:
        turn += 1
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"{folder}/roots-{turn}")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def variants(words: DataFrame, folder: str) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` for ``words`` (``word``, distinct, and ``n``).

    The form of a word is its most frequent near word (of equals the first by code point) if that is at least twice
    as frequent, else NULL; the root is where forms end, the word itself without a form. No words give no rows. Words
    of any length are compared whole. Words must consist of the characters of RUN. ``folder`` must be shared by all
    executors.
    """
    words = stored(words.select("word", "n"), f"{folder}/words")
    pairs = stored(near_pairs(words), f"{folder}/pairs")
    ways = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("b_n").alias("a_n"), F.col("a_n").alias("b_n")))
    near = ways.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near"))).alias("best"))
    strong = -F.col("best.less") >= 2 * F.col("n")
    judged = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"))
    judged = stored(judged, f"{folder}/forms")
    ends = roots(judged.where("form is not null"), folder)
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
