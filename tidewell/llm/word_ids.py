"""Ids of a lower-casing word tokenizer, text by text, with a bounded memory of the words met.

The tokenizer drops white space and never joins what white space separates, so a text's ids are those of its
words, one after the other. Words come from the library; the library's own cache sits behind normalisation and
splitting, which cost more than the merges, so known words are kept in front of them.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tidewell.llm.batches import held_alone

#: Words and word parts remembered by a worker, in two halves.
MAX_WORDS = 200_000
MAX_PARTS = 200_000
#: Longer words are not kept.
LONGEST = 64

#: Characters that no normalisation touches and whose lower case does not depend on their neighbours.
_SIMPLE = "!-~¡-ÿĀ-įĲ-ɏ"
_ODD = re.compile(rf"[^\n{_SIMPLE}]|<\|")


def _lower_case(kind: str) -> str:
    """The characters of a Unicode class among the lower-case forms of the simple ones."""
    simple = re.compile(f"[{_SIMPLE}]")
    return "".join(sorted({c.lower() for c in map(chr, range(0x250)) if simple.match(c) and regex.match(kind, c.lower())}))


#: How the tokenizer splits a word; a fixed value of its file, here for lower-cased simple characters and a line break
#: between words.
_LETTERS, _NUMBERS = _lower_case(r"\p{L}"), _lower_case(r"\p{N}")
_PARTS = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\n{_LETTERS}{_NUMBERS}]+")
#: Parts that the library merges in one call.
TOGETHER = 2_000


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1 characters stand for
    themselves, the others get the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Memory:
    """Values by key. A full newer half becomes the older one; what is asked for again moves back from there, so words
    that recur stay when the many that do not are dropped. What is forgotten changes no result."""

    def __init__(self, most: int):
        self.half, self.new, self.old = most // 2, {}, {}

    def recall(self, keys: list) -> tuple[list, list]:
        """The values of distinct ``keys``, None where neither half has one, and the keys of these, in order. All that is
        found is in the newer half afterwards."""
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        values = list(map(self.new.get, keys))
        missing = list(compress(keys, [v is None for v in values])) if self.new else keys
        older = list(map(self.old.get, missing)) if self.old else []
        unknown = [v is None for v in older]
        if not all(unknown):
            self.new.update(compress(zip(missing, older, strict=True), [not u for u in unknown]))
            values = list(map(self.new.get, keys))
        return values, list(compress(missing, unknown)) if older else missing


def _joined(values: list[bytes], places: pa.Array, bounds: np.ndarray) -> list[bytes]:
    """The ``values`` at ``places``, joined from each of the ``bounds`` among these to the next one."""
    taken = pa.array(values, pa.large_binary()).take(places)
    starts, data = np.frombuffer(taken.buffers()[1], np.int64), taken.buffers()[2]
    ends, data = starts[bounds].tolist(), data.to_pybytes() if data else b""
    return [data[a:b] for a, b in pairwise(ends)]


class WordIds:
    """Calling it with a text gives the ids as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.stop = self.letters[10]  # a line break, which is in no word
        self.merges = Tokenizer(self.full.model)  # the same merges, without normalising and splitting
        self.merges.pre_tokenizer = pre_tokenizers.Split(self.stop, "isolated")
        self.stop_ids = self.merges.encode(self.stop, add_special_tokens=False).ids
        self.words, self.parts = _Memory(MAX_WORDS), _Memory(MAX_PARTS)

    def _merged(self, parts: list[str]) -> list[bytes]:
        """The ids of word parts, with a line break after each, as a call for every part costs as much as its merges."""
        if len(self.stop_ids) != 1:  # a vocabulary without it
            return [array("I", made.ids).tobytes() for made in self.merges.encode_batch_fast(self._spelt(parts), add_special_tokens=False)]
        merged, spelt = [], self._spelt(parts)
        for at in range(0, len(spelt), TOGETHER):
            text = self.stop.join([*spelt[at : at + TOGETHER], ""])
            ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends, data = (4 * np.flatnonzero(ids == self.stop_ids[0])).tolist(), ids.tobytes()
            merged += [data[a:b] for a, b in zip([0, *(end + 4 for end in ends[:-1])], ends, strict=True)]
        return merged

    def _spelt(self, parts: list[str]) -> list[str]:
        """Word parts in byte-level letters."""
        return [p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in parts]

    def _part_ids(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct word parts; a line break between words has none."""
        values, fresh = self.parts.recall(parts)
        fresh = [p for p in fresh if p != "\n"]
        learnt = dict(zip(fresh, self._merged(fresh), strict=True))
        self.parts.new.update(learnt)
        learnt["\n"] = b""
        return [learnt[p] if v is None else v for p, v in zip(parts, values, strict=True)]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words not met before."""
        text = b"\n".join(words).decode()
        texts, odd = text.split("\n"), _ODD.search(text) is not None
        unsure = [len(t) > LONGEST or (odd and _ODD.search(t) is not None) for t in texts]  # only the library splits these
        learnt = {w: array("I", self.full.encode(t, add_special_tokens=False).ids).tobytes() for w, t in compress(zip(words, texts, strict=True), unsure)} if any(unsure) else {}
        plain = [w for w in words if w not in learnt]
        if plain:
            text = b"\n".join(plain).decode() if learnt else text
            coded = pa.array(_PARTS.findall(text.lower()), pa.string()).dictionary_encode()
            parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            breaks = np.flatnonzero(coded.indices.to_numpy() == parts.index("\n")) if len(plain) > 1 else np.empty(0, np.int64)
            learnt.update(zip(plain, _joined(self._part_ids(parts), coded.indices, np.concatenate([[0], breaks, [len(coded)]])), strict=True))
        return learnt

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        values, fresh = self.words.recall(words)
        if fresh:
            learnt = self._learn(fresh)
            values = [learnt[w] if v is None else v for w, v in zip(words, values, strict=True)]
            self.words.new.update(compress(learnt.items(), [len(w) <= LONGEST for w in learnt]))
        return values

    def many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit bytes; none for NULL. Texts should be few megabytes together.

        Texts are split at ASCII white space only; what is empty beside it is a word without ids. A-Z are lower-cased, as
        the tokenizer does, where no accent (U+0300 to U+033F) could join the letter first and no special token stand in
        the text."""
        data = [text.encode() if text else b"" for text in texts]
        data = [d if b"\xcc" in d or b"<|" in d else d.lower() for d in data]
        split = pc.ascii_split_whitespace(pa.array(data, pa.large_binary()).cast(pa.large_string()))
        coded = split.values.dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        return _joined(self._ids(words), coded.indices, split.offsets.to_numpy())

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


@held_alone
def word_ids(path: str) -> WordIds:
    return WordIds(path)
