"""Byte-level BPE as a finite-state transducer, and decoding with an incremental UTF-8 machine.

The merges are compiled on demand. A *configuration* of the transducer holds the longest suffix of the bytes
read that still begins some token, and for every position inside that suffix the last token of the one BPE
encoding that ends there. A token may follow another exactly if merging the two together gives the two back;
so the encoding of every prefix has one last token, and only the positions inside the suffix can still become
part of a longer token. What all of them agree on is emitted at once: the lookahead is bounded by the longest
token. Configurations are numbered as they are met (lazy determinisation) and kept in a bounded table.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewell.llm.batches import documents_only, over_texts

NONE, UNRANKED = -1, 1 << 60

#: Table sizes; a full table is emptied and filled anew, which changes no result.
MAX_STATES = 400_000
MAX_PAIRS = 1_000_000
MAX_PIECES = 500_000
MAX_CHUNKS = 500_000

#: A single space before white space or at the end: only then do pre-tokens depend on the text across a space.
_UNSAFE_SPACE = re.compile(r" (?=\s|\Z)")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Bytes of one pre-token in, token ids out."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        #: beginnings of longer tokens
        self.prefixes = {token[:n] for token in ranks for n in range(len(token))}
        self.pairs: dict[tuple[int, int], bool] = {}
        #: tokens that their own bytes encode to; others occur only as a whole pre-token
        self.reachable = {token for token in ranks if len(token) == 1 or self.merge(token) == [token]}
        self._reset()

    def merge(self, piece: bytes) -> list[bytes]:
        """BPE by its definition: the lowest-ranked neighbouring pair first, the leftmost of equals."""
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        # of every neighbouring pair; only those beside a merge change
        pairs = [rank(piece[i : i + 2], UNRANKED) for i in range(len(piece) - 1)]
        while pairs and (lowest := min(pairs)) != UNRANKED:
            best = pairs.index(lowest)
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
            del pairs[best]
            if best < len(pairs):
                pairs[best] = rank(parts[best] + parts[best + 1], UNRANKED)
            if best:
                pairs[best - 1] = rank(parts[best - 1] + parts[best], UNRANKED)
        return parts

    def follows(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            first, second = self.tokens[left], self.tokens[right]
            known = self.pairs[left, right] = self.merge(first + second) == [first, second]
        return known

    # a configuration: (suffix, last id emitted, last ids of the positions after it); NONE stands for the start
    # of the pre-token and for positions where no live encoding ends
    def _reset(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.configurations: list[tuple] = []
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.finals: list[tuple[int, ...] | None] = []
        self.plans: dict[bytes, tuple] = {}
        self._number((b"", NONE, ()))

    def _number(self, configuration: tuple) -> int:
        number = self.numbers.get(configuration)
        if number is None:
            number = self.numbers[configuration] = len(self.configurations)
            self.configurations.append(configuration)
            self.steps.append({})
            self.finals.append(None)
        return number

    def _plan(self, read: bytes) -> tuple:
        """What depends on the suffix alone: tokens that end it (longest first), the suffix that remains, and how
        far before the end longer tokens can start."""
        tails = [read[i:] for i in range(len(read))]
        ending = tuple((self.ranks[t], len(t)) for t in tails if t in self.reachable)
        open_ends = tuple(len(t) for t in reversed(tails) if t in self.prefixes)
        return ending, read[len(read) - open_ends[-1] :] if open_ends else b"", open_ends

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        suffix, left, last = self.configurations[state]
        read = suffix + bytes((byte,))
        plan = self.plans.get(read)
        if plan is None:
            plan = self.plans[read] = self._plan(read)
        ending, suffix, open_ends = plan
        n = len(last) + 1  # positions after the last emitted id
        for token, size in ending:
            if size < n:
                before = last[n - size - 1]
                if before != NONE and self.follows(before, token):
                    break
            elif size == n and (left == NONE or self.follows(left, token)):
                break
        last, sizes = (*last, token), self.sizes
        # keep the chains of the positions that a longer token can start from; what all share is final
        kept, end = {n}, n
        while end:
            end -= sizes[last[end - 1]]
            kept.add(end)
        base = n
        for back in open_ends:
            end = n - back
            if end < 0 or (end and last[end - 1] == NONE):
                continue
            while end not in kept:
                kept.add(end)
                end -= sizes[last[end - 1]]
            if end < base:
                base = end
        emitted = self._back(last, base)
        if base:
            left = last[base - 1]
        rest = tuple([last[p - 1] if p in kept else NONE for p in range(base + 1, n + 1)])
        return self._number((suffix, left, rest)), emitted

    def _back(self, last: tuple[int, ...], end: int) -> tuple[int, ...]:
        ids = []
        while end:
            ids.append(last[end - 1])
            end -= self.sizes[last[end - 1]]
        return tuple(ids[::-1])

    def _final(self, state: int) -> tuple[int, ...]:
        last = self.configurations[state][2]
        return self._back(last, len(last))

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one pre-token; a pre-token that is itself a token gives that token."""
        if (known := self.ranks.get(piece)) is not None:
            return [known]
        if len(self.steps) > MAX_STATES:
            self._reset()
        ids: list[int] = []
        state = 0
        for byte in piece:
            move = self.steps[state].get(byte)
            if move is None:
                move = self.steps[state][byte] = self._step(state, byte)
            state, emitted = move
            if emitted:
                ids.extend(emitted)
        final = self.finals[state]
        if final is None:
            final = self.finals[state] = self._final(state)
        ids.extend(final)
        return ids


class Encoder:
    """Whole texts in, ids as little-endian 32-bit bytes out."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        # \s as Unicode's White_Space, as the pattern's usual engine reads it
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.chunks: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        out = []
        for piece in self.pieces.findall(text):
            ids = self.known.get(piece)
            if ids is None:
                if len(self.known) >= MAX_PIECES:
                    self.known.clear()
                ids = array("I", self.transducer.encode(piece.encode())).tobytes()
                if len(piece) <= 64:
                    self.known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def __call__(self, text: str) -> bytes:
        if _UNSAFE_SPACE.search(text):
            return self._encode(text)
        first, *rest = text.split(" ")
        chunks = self.chunks
        out = [None, *map(chunks.get, rest)]
        out[0] = self._encode(first)
        for at, chunk in enumerate(rest, 1):
            if out[at] is None:
                if len(chunks) >= MAX_CHUNKS:
                    chunks.clear()
                out[at] = ids = self._encode(" " + chunk)
                if len(chunk) <= 64:
                    chunks[chunk] = ids
        return b"".join(out)


class Utf8Machine:
    """Token ids in, text out; bytes of a character that is not complete yet are carried to the next token."""

    #: After a lead byte: range of the first continuation byte, and the number of continuation bytes.
    @staticmethod
    def lead(byte: int) -> tuple[int, int, int]:
        if byte < 0x80:
            return 0, 0, 0
        if 0xC2 <= byte <= 0xDF:
            return 0x80, 0xBF, 1
        if 0xE0 <= byte <= 0xEF:
            return 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF, 2
        if 0xF0 <= byte <= 0xF4:
            return 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF, 3
        return 1, 0, 0

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.moves: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}

    def feed(self, held: bytes, more: bytes) -> tuple[str, bytes]:
        """Complete characters of the bytes, and the start of a character at their end. A sequence that cannot
        be completed gives U+FFFD."""
        data, at, out = held + more, 0, []
        while at < len(data):
            low, high, missing = self.lead(data[at])
            end = at + 1
            if low > high:
                out.append("�")
                at = end
                continue
            while missing and end < len(data) and low <= data[end] <= high:
                end, missing, low, high = end + 1, missing - 1, 0x80, 0xBF
            if missing and end == len(data):
                return "".join(out), data[at:]
            out.append("�" if missing else data[at:end].decode())
            at = end
        return "".join(out), b""

    def decode(self, ids: Iterable[int]) -> str:
        out, held = [], b""
        moves = self.moves[b""]
        for token in ids:
            move = moves.get(token)
            if move is None:
                move = moves[token] = self.feed(held, self.tokens[token])
            text, after = move
            out.append(text)
            if after is not held:
                held = after
                moves = self.moves.setdefault(held, {})
        return "".join(out) + ("�" if held else "")


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def _machine(path: str) -> Utf8Machine:
    return Utf8Machine({rank: token for token, rank in read_ranks(path).items()})


def _lists(parts: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(docs: DataFrame, path: str, pattern: str, decode: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` of every text, by the ranks in the file ``path``; with ``decode`` also the text that
    the ids decode to, as ``decoded``.

    NULL texts count as empty and have no ids; other columns of ``docs`` are not read. One pass, no shuffle;
    repeated rows give repeated results. A worker holds tables of bounded size, never more than a slice of texts.
    """

    def make():
        encoder, machine = _encoder(path, pattern), _machine(path)

        def columns(texts: list) -> dict:
            parts = [encoder(text) if text else b"" for text in texts]
            made = {"ids": _lists(parts)}
            if decode:
                made["decoded"] = [machine.decode(np.frombuffer(p, "<u4").tolist()) for p in parts]
            return made

        return columns

    fields = [pa.field("doc_id", pa.int64()), pa.field("ids", pa.list_(pa.int32()))]
    kinds = "doc_id long, ids array<int>" + (", decoded string" if decode else "")
    schema = pa.schema(fields + [pa.field("decoded", pa.string())] * decode)
    return documents_only(docs).mapInArrow(over_texts(make, schema), kinds)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``decoded`` text of frames with ``doc_id`` and ``ids``; NULL ids give an empty text."""

    def run(batches):
        machine = _machine(path)
        for batch in batches:
            texts = [machine.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")
