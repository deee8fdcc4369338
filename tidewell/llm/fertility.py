"""Quality rules from tokeniser fertility.

A public vocabulary with byte fallback splits every word. Three measures of a text follow: characters per token
(garbled words, symbols and shouting split finely), the share of byte-fallback tokens (characters the vocabulary
lacks) and the entropy of the token distribution (repetition has little). Bands of rejection are drawn per
language and script around the middle half of all texts.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import held_alone, over_texts

#: Words remembered by a worker, and the longest remembered.
MEMORY, LONGEST = 600_000, 64
#: Base rules: fewest words, and largest share of repeated words.
MIN_WORDS, MAX_REPEATED = 50, 0.5
#: Bands, in standard deviations estimated from the middle half: lowest sum of the two measures, lowest and highest
#: single measure; and the least standard deviations.
LOWEST_SUM, LOWEST, HIGHEST_CHARS = -6.0, -8.0, 12.0
CHARS_SPREAD, ENTROPY_SPREAD = 0.02, 0.05
#: Byte-fallback tokens are rejected beyond this share above the upper quartile.
BYTES_ABOVE = 0.10
#: Entropy grows with length, so it is compared with texts of like length (classes of half a power of two). A class
#: with fewer texts takes its usual entropy from its neighbours; a group with fewer takes its script's band, or all's.
LEAST_ROWS = 20
SYMBOLS, WHITE = b"#*$%&|<>", " \t\n\x0b\x0c\r"
#: Scripts that are told apart; others are "other".
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Han", "Hiragana", "Katakana", "Hangul", "Thai")
_SCRIPT = {name: regex.compile(rf"\p{{{name}}}") for name in SCRIPTS}

MEASURES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("lang", pa.string()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("script", pa.string()),
        ("n_tokens", pa.int64()),
        ("chars_per_token", pa.float64()),
        ("byte_share", pa.float64()),
        ("entropy", pa.float64()),
    ]
)


class Pieces:
    """Token ids of words, as little-endian 16-bit bytes, with a bounded memory."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.words: dict[bytes, bytes] = {}

    def many(self, listed: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.words) >= MEMORY:
            self.words.clear()
        found = [list(map(self.words.get, words)) for words in listed]
        gaps = [(n, at) for n, ids in enumerate(found) if None in ids for at, x in enumerate(ids) if x is None]
        if gaps:
            fresh = list({listed[n][at] for n, at in gaps})
            made = self.model.encode([w.decode() for w in fresh], num_threads=1)
            learnt = {w: np.array(ids, "<u2").tobytes() for w, ids in zip(fresh, made, strict=True)}
            for n, at in gaps:
                found[n][at] = learnt[listed[n][at]]
            self.words.update((w, ids) for w, ids in learnt.items() if len(w) <= LONGEST)
        return [np.frombuffer(b"".join(ids), "<u2") for ids in found]


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[2:]
    mixed.sort()
    if (mixed[1:] != mixed[:-1]).all():
        return 0
    first, covered = {}, bytearray(len(words))
    for at, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        earlier = first.setdefault(window, at)
        if earlier != at:
            covered[earlier : earlier + 3] = covered[at : at + 3] = b"\x01\x01\x01"
    return sum(covered)


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script of most letters; ties go to the first in SCRIPTS."""
    if text.isascii():
        return "Latin" if _SCRIPT["Latin"].search(text) else "other"
    found = {name: len(pattern.findall(text)) for name, pattern in _SCRIPT.items() if pattern.search(text)}
    return max(found, key=found.get) if found else "other"


@held_alone
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def measure(docs: DataFrame, path: str) -> DataFrame:
    """A row of measures per row of ``docs``, see MEASURES; ``path`` is a sentencepiece model with byte fallback.

    A NULL text has no words. A text without words has zero counts, script "other" and NULL measures of
    fertility. A column ``lang`` is used where there is one. One pass, no shuffle.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"))

    def make():
        pieces = _pieces(path)

        def columns(texts: list) -> dict:
            texts = [t or "" for t in texts]
            coded = [t.encode() for t in texts]
            listed = [b.split() for b in coded]
            made: dict[str, list] = {name: [] for name in MEASURES.names[2:]}
            for text, data, words, ids in zip(texts, coded, listed, pieces.many(listed), strict=True):
                chars = len(text) - sum(map(text.count, WHITE))
                made["n_words"].append(len(words))
                made["word_chars"].append(chars)
                made["n_symbols"].append(len(data) - len(data.translate(None, SYMBOLS)))
                made["n_dup_lines"].append(duplicate_lines(text))
                made["n_repeat_words"].append(repeated_words(words))
                made["script"].append(script_of(text))
                made["n_tokens"].append(len(ids))
                if len(ids):
                    seen = np.bincount(ids)
                    share = seen[seen > 0] / len(ids)
                    made["chars_per_token"].append(chars / len(ids))
                    made["byte_share"].append(float(pieces.is_byte[ids].mean()))
                    made["entropy"].append(float(-(share * np.log2(share)).sum()))
                else:
                    for name in ("chars_per_token", "byte_share", "entropy"):
                        made[name].append(None)
            return made

        return columns

    kinds = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, script string, n_tokens long, chars_per_token double, byte_share double, entropy double"
    return source.mapInArrow(over_texts(make, MEASURES), kinds)


def _curves(sound: DataFrame, scope: str) -> DataFrame:
    """Per ``scope``, the usual entropy of its length classes with LEAST_ROWS texts, in order of length. Over
    everything, all classes count if none has so many."""
    cells = sound.groupBy(scope, "length").agg(F.percentile_approx("entropy", 0.5, 10_000).alias("usual"), F.count("*").alias("n"))
    cell = F.struct("length", "usual")
    filled = F.collect_list(F.when(F.col("n") >= LEAST_ROWS, cell))  # lengths are logarithms, so few
    found = cells.groupBy(scope).agg(F.sort_array(filled).alias("curve"), F.sort_array(F.collect_list(cell)).alias("any"))
    if scope == "everything":
        return found.select(scope, F.when(F.size("curve") > 0, F.col("curve")).otherwise(F.col("any")).alias(f"{scope}_curve"))
    return found.where(F.size("curve") > 0).select(scope, F.col("curve").alias(f"{scope}_curve"))


def _on_curve(curve: Column, length: Column) -> Column:
    """The usual entropy of a length: between two classes in proportion, above the highest as there, as entropy levels
    off, and below the lowest along the line through the lowest two."""
    below = F.array_max(F.filter(curve, lambda c: c["length"] <= length))
    above = F.array_min(F.filter(curve, lambda c: c["length"] > length))

    def slope(low, high):
        return (high["usual"] - low["usual"]) / (high["length"] - low["length"])

    second = F.get(curve, F.lit(1))
    between = below["usual"] + slope(below, above) * (length - below["length"])
    rising = F.coalesce(F.greatest(slope(above, second), F.lit(0.0)), F.lit(0.0))
    return F.when(below.isNull(), above["usual"] + rising * (length - above["length"])).when(above.isNull(), below["usual"]).otherwise(
        F.when(below["length"] == length, below["usual"]).otherwise(between)
    )


def judge(measures: DataFrame) -> DataFrame:
    """The measures with ``base_failed``, ``fertile`` (inside all bands) and ``kept``.

    Bands come from all texts that pass the base rules, by ``lang`` (NULL is a language of its own) and
    ``script``; what a usual entropy is, and its band, by these where there are LEAST_ROWS texts, else by script, else
    over all. ``measures`` is read several times and should be stored. A text that passes has words, so bands exist
    for it.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = measures.withColumn("base_failed", failed)
    rows = rows.withColumn("group", F.concat_ws("/", F.coalesce("lang", F.lit("?")), "script")).withColumn("length", F.floor(2 * F.log2("n_tokens"))).withColumn("everything", F.lit(0))
    sound = rows.where("not base_failed")

    scopes = ("group", "script", "everything")

    def with_excess(df: DataFrame) -> DataFrame:
        for scope in scopes:
            df = df.join(curves[scope], scope, "left")
        own, wide, length = F.col("group_curve"), F.coalesce("script_curve", "everything_curve"), F.col("length")
        # beyond its own classes a group has its level, and how entropy goes on from there is as in its script
        held = F.greatest(F.element_at(own, 1)["length"], F.least(F.element_at(own, -1)["length"], length))
        usual = F.coalesce(_on_curve(own, held) + _on_curve(wide, length) - _on_curve(wide, held), _on_curve(wide, length))
        df = df.withColumn("excess", F.col("entropy") - usual).withColumn("sure", F.exists(F.coalesce(own, wide), lambda c: c["length"] == length))
        return df.drop(*(f"{scope}_curve" for scope in scopes))

    curves = {scope: _curves(sound, scope) for scope in scopes}
    quarters = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    judged = with_excess(sound)
    bands = judged.groupBy("group").agg(
        F.percentile_approx("chars_per_token", quarters, 10_000).alias("chars_per_token_band"),
        F.percentile_approx("byte_share", 0.75, 10_000).alias("byte_band"),
    )
    spreads = {scope: judged.where("sure").groupBy(scope).agg(F.percentile_approx("excess", quarters, 10_000).alias(f"{scope}_spread"), F.count("*").alias("n")) for scope in scopes}
    spreads = {scope: (df if scope == "everything" else df.where(F.col("n") >= LEAST_ROWS)).drop("n") for scope, df in spreads.items()}

    def deviation(name: str, least: float):
        band = F.col(f"{name}_band")
        return F.coalesce((F.col(name) - band[1]) / F.greatest((band[2] - band[0]) / 1.349, F.lit(least)), F.lit(0.0))

    chars, entropy = deviation("chars_per_token", CHARS_SPREAD), deviation("excess", ENTROPY_SPREAD)
    fertile = (chars + entropy >= LOWEST_SUM) & (F.least(chars, entropy) >= LOWEST) & (chars <= HIGHEST_CHARS)
    fertile &= F.col("byte_share") <= F.col("byte_band") + BYTES_ABOVE
    joined = with_excess(rows).join(bands, "group", "left")
    for scope in scopes:
        joined = joined.join(spreads[scope], scope, "left")
    joined = joined.withColumn("excess_band", F.coalesce(*(f"{scope}_spread" for scope in scopes))).withColumn("fertile", F.coalesce(fertile, F.lit(False)))
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("fertile")).select(*measures.columns, "base_failed", "fertile", "kept")
