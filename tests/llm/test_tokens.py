"""Byte-level BPE against tiktoken, word ids against tokenizers, token files by round trip, packing by its contract."""

import base64
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidewell.llm import byte_bpe, language, packing, token_files, word_ids
from tidewell.llm.word_ids import WordIds

BYTE_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = " \n\t\r  abcdethn'srl.,!?=-#* 　\x1c\x85éèñßÖΣσς中文字кириллица😀👍🏽́९İĲŁ²ªºµ"


@pytest.fixture(scope="module")
def reference():
    with open(BYTE_PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n, seed):
    draw = random.Random(seed)
    for k in range(n):
        text = "".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 50)))
        yield text + draw.choice(["=", "a", "ha", " ", " \n", "é", "中"]) * draw.randint(1, 80) if k % 3 == 0 else text


def test_a_merge_looks_only_at_the_pairs_beside_it():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    transducer = byte_bpe.Transducer({bytes((b,)): b for b in range(256)} | {b"aa": 256, b"aaaa": 257, b"ba": 258})
    transducer.ranks = Counted(transducer.ranks)
    assert transducer.merge(b"b" + b"a" * 403) == [b"b", *[b"aaaa"] * 100, b"aa", b"a"]
    assert Counted.asked <= 3 * 404


def test_byte_bpe_agrees_with_the_library(reference):
    encoder, machine = byte_bpe._encoder(BYTE_PATH, public_tokenizers.PATTERN), byte_bpe._machine(BYTE_PATH)
    for text in odd_texts(1500, 1):
        ids = np.frombuffer(encoder(text), "<u4").tolist()
        assert ids == reference.encode_ordinary(text), text
        assert machine.decode(ids) == text


def test_a_full_table_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_STATES", 50)
    monkeypatch.setattr(byte_bpe, "MAX_PAIRS", 20)
    monkeypatch.setattr(byte_bpe, "MAX_CHUNKS", 3)
    monkeypatch.setattr(byte_bpe, "MAX_PIECES", 3)
    encoder = byte_bpe.Encoder(byte_bpe.read_ranks(BYTE_PATH), public_tokenizers.PATTERN)
    for text in odd_texts(200, 2):
        assert np.frombuffer(encoder(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_utf8_machine_replaces_what_cannot_be_completed():
    machine = byte_bpe.Utf8Machine({i: bytes((i,)) for i in range(256)})
    draw = random.Random(3)
    for _ in range(500):
        data = bytes(draw.choice([0x41, 0xC3, 0xA9, 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0]) for _ in range(draw.randint(0, 12)))
        assert machine.decode(data) == data.decode(errors="replace")


def test_byte_bpe_over_awkward_documents(awkward, empty, reference):
    encoded = byte_bpe.encode(awkward, BYTE_PATH, public_tokenizers.PATTERN, decode=True)
    want = sorted((r.doc_id or -1, r.text or "") for r in awkward.collect())
    got = encoded.collect()
    assert sorted((r.doc_id or -1, r.decoded) for r in got) == want
    assert all(r.ids == reference.encode_ordinary(r.decoded) for r in got)
    again = byte_bpe.decode(encoded, BYTE_PATH)
    assert sorted(r.decoded for r in again.collect()) == sorted(t for _, t in want)
    assert byte_bpe.encode(empty, BYTE_PATH, public_tokenizers.PATTERN).count() == 0


def test_word_ids_agree_with_the_library():
    words, library = WordIds(WORD_PATH), Tokenizer.from_file(WORD_PATH)
    for text in [*odd_texts(1500, 4), "a<|endoftext|>b <|startoftext|>", "IT'S 12ab'LL x_y"]:
        assert np.frombuffer(words(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_batch_asks_the_memory_once_for_each_of_its_words():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    memory = word_ids._Memory(4)
    assert memory.recall(["a", "b"]) == ([None, None], ["a", "b"])
    memory.new.update(a=1, b=2)  # full: the next batch moves them to the older half
    memory.new = Counted(memory.new)
    assert memory.recall(["c", "b", "d"]) == ([None, 2, None], ["c", "d"])
    assert memory.new == {"b": 2} and Counted.asked == 3
    memory.new = Counted(memory.new, c=3)
    assert memory.recall(["c", "a"]) == ([3, None], ["a"])  # two halves ago


def test_word_ids_of_batches_with_a_small_memory(monkeypatch):
    monkeypatch.setattr(word_ids, "MAX_WORDS", 40)
    monkeypatch.setattr(word_ids, "MAX_PARTS", 20)
    monkeypatch.setattr(word_ids, "TOGETHER", 7)
    words, library = WordIds(WORD_PATH), Tokenizer.from_file(WORD_PATH)
    latin = "".join(chr(c) for c in range(0x250))  # with every control character and letter that is simple
    texts = [None, "", " ", *odd_texts(600, 5), *latin, latin, "x" * 65, "Ċ ĊĊ ċ\nƁƁ ȺȾ's", None]
    for at in range(0, len(texts), 50):
        batch = texts[at : at + 50]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in words.many(batch)] == [library.encode(t or "", add_special_tokens=False).ids for t in batch]
    assert words.many([]) == []


def test_new_words_are_merged_in_few_calls():
    words, passed = WordIds(WORD_PATH), []

    class Counted:
        def encode_batch_fast(self, texts, real=words.merges, **how):
            passed.extend(texts)
            return real.encode_batch_fast(texts, **how)

    words.merges = Counted()
    ids = words.many([" ".join(f"abc{chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(600))])
    assert len(ids[0]) > 4 * 600 and len(passed) == 1


def test_a_worker_holds_the_tables_of_one_operator():
    first = weakref.ref(word_ids.word_ids(WORD_PATH))
    assert word_ids.word_ids(WORD_PATH) is first()
    language._arrays(language.Model(("en",), bytes(4 * language.DIMENSIONS), bytes(4 * language.DIMENSIONS), (0,), (0.0,) * 5))
    assert first() is None


def test_simple8b_round_trip():
    draw = np.random.default_rng(0)
    for high in (1, 2, 10, 300, 50_000, 1 << 31, 1 << 62):
        for n in (0, 1, 59, 60, 61, 1000):
            values = draw.integers(0, high, n, dtype=np.uint64)
            if n > 5:
                values[draw.integers(0, n, 2)] = np.uint64(2**64 - 1)  # an escape
            assert (token_files.unpack(token_files.pack(values), n) == values).all()


def test_small_ids_share_words():
    assert len(token_files.pack(np.zeros(600, np.uint64))) == 10
    assert len(token_files.pack(np.full(600, 30_000, np.uint64))) == 150


def expected_ids(awkward):
    library = Tokenizer.from_file(WORD_PATH)
    return [(r.doc_id, np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")) for r in awkward.collect()]


def test_token_files_hold_all_documents_in_order(spark, awkward, empty, workspace, monkeypatch):
    token_files.write_tokens(awkward, WORD_PATH, workspace, 1)
    got = sorted(token_files.read_tokens(spark, workspace).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in awkward.collect()), key=lambda i: (i is not None, i or 0))
    want = expected_ids(awkward)
    assert sorted((r.doc_id or -1, zlib.crc32(r.ids)) for r in got) == sorted((i or -1, zlib.crc32(x.tobytes())) for i, x in want)
    start = 0
    for r in got:
        assert r.start == start
        start += len(r.ids) // 4
    token_files.write_tokens(empty, WORD_PATH, f"{workspace}-empty", 1)
    assert token_files.read_tokens(spark, f"{workspace}-empty").count() == 0


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    index = packing.hilbert_index(grid, 3)
    assert sorted(index.tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_packing_covers_every_id_once(awkward, empty, workspace):
    rows = packing.pack(awkward, WORD_PATH, workspace, 1).collect()
    by_sequence = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + len(r.ids) // 4
    assert max(by_sequence.values()) <= packing.LENGTH
    want = expected_ids(awkward)
    assert sum(by_sequence.values()) == sum(len(x) for _, x in want)
    unique = {i: x for i, x in want if i not in (3, None)}
    for doc_id, ids in unique.items():
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        assert b"".join(r.ids for r in own) == ids.tobytes() and {r.doc_tokens for r in own} == {len(ids)}
    assert packing.pack(empty, WORD_PATH, f"{workspace}-empty", 1).count() == 0
