"""Near-duplicate documents: an exact Jaccard join on word n-grams with prefix filtering.

Every document is the set of its distinct five-word shingles. All shingles have one order, rare ones first, so two
sets that overlap enough share a shingle among the first few of each: only these prefixes count. Nearly all prefix
shingles are in one set alone. So blocks of texts first send the fingerprints of theirs, sorted and Golomb-coded, to
the owners of the hash ranges and get back a bitmap of those that another block has too; only what may be shared is
then shuffled as rows. Pairs that share a shingle are held against the length, positional and suffix filters, and
verified once on the whole sets.

Copies are one set and joined once. Sets that are near each other in large numbers are not paired with one
another: in each group of a prefix shingle, sets are first held against one pivot, in a few rounds, and what a
round links is one component from then on. The last step pairs what no round has brought together, so no link
between components is missed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import documents_only, text_slices
from tidewell.llm.components import linked_groups, stored
from tidewell.llm.exact_dedup import golomb_decode, golomb_encode

#: Words of a shingle; two sets link from 4/5 of their union on.
WORDS = 5
#: Buckets of the table of shingle frequencies. Its size is fixed; more shingles make it coarser, which affects the
#: length of candidate lists only.
BUCKETS, CHUNK = 1 << 18, 1 << 12
#: Bits of the fingerprint of a shingle, and of the number of a set. Shingles that agree by chance are only shuffled.
PRINT_BITS, SET_BITS = 48, 63
#: A block ends after so many distinct sets or characters, whatever comes first; a task holds one block.
BLOCK_SETS, BLOCK_CHARS = 1 << 16, 16 << 20
#: Fingerprints that an owner gets on average; there are as many owners as that takes.
OWNED = 1 << 18
#: Bytes of sets that a task remembers while it verifies pairs.
REMEMBERED = 64 << 20
#: Bits of the bitmap of sets whose texts are wanted: 2 MB.
CELLS = 1 << 24
#: Parts of the hash space that the suffix filter compares.
PARTS = 32
#: Rounds of pivots before the remaining pairs are listed.
#: A set whose shared shingles come early has few of its own: it is near the middle of its group.
PIVOT_ROUNDS = 3
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    mixed = hashes[:n] * _ODD[0]
    for i in range(1, WORDS):
        mixed += hashes[i : i + n] * _ODD[i]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _set_id(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest()) >> (64 - SET_BITS)


def _bucket(own: np.ndarray) -> np.ndarray:
    return (own >> np.uint64(46)).astype(np.int64)


def _rows(names: str, kinds: list[pa.DataType], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names.split())


def _survey(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, then the task's shingle frequencies in chunks."""
    names, kinds = "doc_id set_id n chunk counts", [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    totals = np.zeros(BUCKETS, np.uint32)
    for batch, texts in text_slices(batches):
        sets = [shingles(t) for t in texts]
        totals += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS).astype(np.uint32)
        doc_ids = batch.column(batch.schema.get_field_index("doc_id"))
        yield _rows(names, kinds, doc_ids, [_set_id(s) if len(s) else None for s in sets], [len(s) for s in sets], [None] * len(sets), [None] * len(sets))
    for chunk in range(BUCKETS // CHUNK):
        own = totals[chunk * CHUNK : (chunk + 1) * CHUNK]
        if own.any():
            yield _rows(names, kinds, [None], [None], [0], [chunk], [own.tobytes()])


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            totals.setdefault(chunk, np.zeros(CHUNK, np.int64)).__iadd__(np.frombuffer(counts, "<u4"))
    yield _rows("chunk counts", [pa.int32(), pa.binary()], list(totals), [t.astype("<i8").tobytes() for t in totals.values()])


def prefix_length(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


class _Block:
    """The distinct sets of texts that follow each other in a task, with their prefixes in the common order."""

    def __init__(self):
        self.set_ids, self.sets, self.texts, self.prefixes, self.known, self.size = [], [], [], [], set(), 0

    def add(self, text: str, own: np.ndarray, order: np.ndarray) -> None:
        set_id = _set_id(own)
        if set_id in self.known:
            return
        self.known.add(set_id)
        self.set_ids.append(set_id)
        self.sets.append(own)
        self.texts.append(text)
        self.prefixes.append(own[np.lexsort((own, order[_bucket(own)]))[: prefix_length(len(own))]])
        self.size += len(text)

    def prints(self) -> np.ndarray:
        return (np.concatenate(self.prefixes) >> np.uint64(64 - PRINT_BITS)).astype(np.int64)

    def numbers(self) -> np.ndarray:
        return np.array(self.set_ids, np.int64)

    def name(self) -> str:
        """Blocks are addressed by content: should the second pass cut the texts otherwise, no bitmap fits."""
        return hashlib.sha256(np.sort(self.numbers()).tobytes()).hexdigest()[:40]


def _blocks(batches: Iterable[pa.RecordBatch], order: np.ndarray, most: int) -> Iterator[_Block]:
    block = _Block()
    for _, texts in text_slices(batches):
        for text in texts:
            own = shingles(text)
            if len(own):
                block.add(text, own, order)
            if len(block.sets) >= most or block.size >= BLOCK_CHARS:
                yield block
                block = _Block()
    if block.sets:
        yield block


def _send(frequencies, owner_bits: int, most: int):
    """For every block, its distinct fingerprints (kind 0) and set numbers (kind 1), by owner."""
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.binary()]

    def run(batches):
        for block in _blocks(batches, frequencies.value, most):
            name = block.name()
            for kind, values, bits in ((0, block.prints(), PRINT_BITS), (1, block.numbers(), SET_BITS)):
                values, shift = np.unique(values), bits - owner_bits
                owners, starts = np.unique(values >> shift, return_index=True)
                codes = [golomb_encode(part - (owner << shift)) for owner, part in zip(owners.tolist(), np.split(values, starts[1:]), strict=True)]
                yield _rows("kind owner block payload", kinds, [kind] * len(codes), owners, [name] * len(codes), codes)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Bitmaps to the blocks that sent something to an owner. Of fingerprints: another block has it too. Of set
    numbers: a block of a lesser name has the set."""
    kind, owner = table.column("kind")[0].as_py(), table.column("owner")[0].as_py()
    # blocks of one name have the same sets and get one answer
    sent = sorted(dict(zip(table.column("block").to_pylist(), table.column("payload").to_pylist(), strict=True)).items())
    received = [golomb_decode(payload) for _, payload in sent]
    everything = np.concatenate(received)
    _, first, place, counts = np.unique(everything, return_index=True, return_inverse=True, return_counts=True)
    bits = counts[place] > 1 if kind == 0 else first[place] != np.arange(len(everything))
    maps = [np.packbits(own).tobytes() for own in np.split(bits, np.cumsum([len(r) for r in received])[:-1])]
    return pa.table({"block": [b for b, _ in sent], "kind": pa.array([kind] * len(sent), pa.int32()), "owner": pa.array([owner] * len(sent), pa.int32()), "n": pa.array([len(r) for r in received], pa.int32()), "bitmap": pa.array(maps, pa.binary())})


def _keep(folder: str):
    """The bitmaps of a block as one file that has its name."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "owner", "n", "bitmap")), strict=True))
        bits = np.concatenate([np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n] for _, _, n, bitmap in rows])
        name = table.column("block")[0].as_py()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{root}/bitmaps", recursive=True)
        draft = f"{root}/bitmaps/draft-{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(np.packbits(bits).tobytes())
        store.move(draft, f"{root}/bitmaps/{name}")
        return pa.table({"block": [name]})

    return run


def _apply(frequencies, folder: str, most: int):
    """Rows of prefix shingles that may be shared, and the texts of their sets. A set comes from the first block
    that has it; without its bitmap a block gives all of its rows, which changes no result."""
    names, kinds = "shingle set_id n place parts text", [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.binary()]

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        pack = zstandard.ZstdCompressor(level=1)
        for block in _blocks(batches, frequencies.value, most):
            prints, numbers = block.prints(), block.numbers()
            distinct, place, counts = np.unique(prints, return_inverse=True, return_counts=True)
            shared, first = np.ones(len(distinct), bool), np.ones(len(numbers), bool)
            path = f"{root}/bitmaps/{block.name()}"
            if store.get_file_info(path).type == fs.FileType.File:
                with store.open_input_file(path) as file:
                    bits = np.unpackbits(np.frombuffer(file.readall(), np.uint8)).astype(bool)
                shared = bits[: len(distinct)] | (counts > 1)
                first = ~bits[len(distinct) :][np.searchsorted(np.sort(numbers), numbers)]
            lengths = np.array([len(p) for p in block.prefixes])
            sizes = np.array([len(s) for s in block.sets], np.int32)
            which = np.repeat(np.arange(len(numbers)), lengths)
            rows = np.flatnonzero(shared[place] & first[which])
            at = np.arange(len(which)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            hashes, of = np.concatenate(block.prefixes).view(np.int64), which[rows]
            if len(rows):
                empty = pa.nulls(len(rows))
                yield _rows(names, kinds, hashes[rows], numbers[of], sizes[of], at[rows].astype(np.int32), empty.cast(kinds[4]), empty.cast(kinds[5]))
            wanted = np.unique(of).tolist()
            for some in (wanted[i : i + 512] for i in range(0, len(wanted), 512)):
                parts = [np.bincount((block.sets[i] >> np.uint64(41)).astype(np.int64) & (PARTS - 1), minlength=PARTS).tolist() for i in some]
                yield _rows(names, kinds, [None] * len(some), numbers[some], sizes[some], [None] * len(some), parts, [pack.compress(block.texts[i].encode()) for i in some])

    return run


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shingle and set, those whose shingle is in several sets, one per set. Only the first row
    of the shingle that a batch ends with is carried on."""
    carried, told = None, False  # the last row seen of a shingle's first set; was it given out?
    last = (None, None)
    for batch in batches:
        shingle, set_id = (batch.column(i).to_numpy() for i in (0, 1))
        if not len(shingle):
            continue
        fresh_shingle = np.concatenate([[shingle[0] != last[0]], shingle[1:] != shingle[:-1]])
        fresh = fresh_shingle | np.concatenate([[set_id[0] != last[1]], set_id[1:] != set_id[:-1]])
        last = (shingle[-1], set_id[-1])
        rows = np.flatnonzero(fresh)
        if not len(rows):
            continue
        starts = fresh_shingle[rows]
        run = np.cumsum(starts)  # 0: belongs to the shingle carried on from before
        counts = np.bincount(run)
        several = counts[run] > 1
        several[run == 0] = True
        if run[0] == 0 and not told:
            yield carried
            told = True
        if starts.any():
            first_of_last = rows[np.flatnonzero(starts)[-1]]
            carried, told = batch.slice(int(first_of_last), 1), bool(counts[run[-1]] > 1)
        picked = rows[several]
        if len(picked):
            yield batch.take(pa.array(picked))


def _linked(batches):
    """The pairs that link, from their texts. Pairs of one ``a`` come together."""
    unpack, known, held = zstandard.ZstdDecompressor(), {}, 0
    for batch in batches:
        a, b, text_a, text_b = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "text_a", "text_b"))
        ids, keep = list(zip(a.to_pylist(), b.to_pylist(), strict=True)), []
        for row, pair in enumerate(ids):
            for own, texts in zip(pair, (text_a, text_b), strict=True):
                if own not in known:
                    known[own] = shingles(unpack.decompress(texts[row].as_py()).decode())
                    held += known[own].nbytes
            x, y = known[pair[0]], known[pair[1]]
            common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
            keep.append(9 * common >= 4 * (len(x) + len(y)))
            if held > REMEMBERED:
                known, held = {}, 0
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


#: Length and positional filter on two sets with a common shingle. At the first shingle that two sets have in
#: common, nothing before it is; so a pair that links passes there, and need not pass at later ones.
POSSIBLE = "5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n) and 9 * least(x.n - x.place, y.n - y.place) >= 4 * (x.n + y.n)"


def _likely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose ``set_id`` is among ``ids``, and a few others: a bitmap of hashed numbers goes to every task,
    where a semi join would shuffle all texts to drop most. Its size is fixed; more numbers let more others through."""
    bits = ids.select(F.expr(f"xxhash64(id) & {CELLS - 1}").alias("cell")).groupBy(F.expr("cell div 32768").alias("part")).agg(F.bitmap_construct_agg(F.expr("cell % 32768")).alias("bits"))
    cells = rows.withColumn("cell", F.expr(f"xxhash64(set_id) & {CELLS - 1}"))
    byte = "cast(conv(hex(substring(bits, cast(cell % 32768 div 8 + 1 as int), 1)), 16, 10) as int)"
    marked = cells.join(F.broadcast(bits), F.expr("cell div 32768") == F.col("part")).where(f"getbit({byte}, cast(cell % 8 as int)) = 1")
    return marked.select(*rows.columns)


def _verified(pairs: DataFrame, sets: DataFrame, path: str) -> DataFrame:
    """The pairs ``a``, ``b`` that link; the suffix filter looks at the sizes of parts before texts are moved, and
    only texts of pairs that pass it are."""
    sizes = sets.select("set_id", "n", "parts")
    side = lambda c: sizes.select(F.col("set_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("parts").alias(f"parts_{c}"))
    common = F.expr("aggregate(zip_with(parts_a, parts_b, (x, y) -> least(x, y)), 0, (s, x) -> s + x)")
    left = pairs.join(side("a"), "a").join(side("b"), "b").where(9 * common >= 4 * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    left = stored(left, path)
    whole = left
    for c in ("a", "b"):
        texts = _likely(sets.select("set_id", "text"), left.select(F.col(c).alias("id")))
        whole = whole.join(texts.select(F.col("set_id").alias(c), F.col("text").alias(f"text_{c}")), c)
    return whole.mapInArrow(_linked, "a long, b long")


def classes(docs: DataFrame, folder: str, block_sets: int = BLOCK_SETS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest ``doc_id`` that
    it reaches over links.

    NULL texts and texts without words have no shingles and stand alone; a text with fewer than five words is one
    shingle. NULL ids are never the smallest while there is another. Repeated rows share a set, so a result each;
    a very long text is one set that a task holds whole; an empty table gives no rows. Other columns are not read.
    ``folder`` must be shared by all executors.
    """
    spark, source = docs.sparkSession, documents_only(docs)
    survey = stored(source.mapInArrow(_survey, "doc_id long, set_id long, n int, chunk int, counts binary"), f"{folder}/survey")
    frequencies = np.zeros(BUCKETS, np.int64)
    chunks = survey.where("chunk is not null").select("chunk", "counts")
    for row in chunks.repartition("chunk").mapInArrow(_summed, "chunk int, counts binary").collect():  # of fixed size
        frequencies[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], "<i8")
    members = survey.where("chunk is null").select("doc_id", "set_id", "n")
    entries = members.agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0))).first()[0] // 5
    owner_bits = max(3, (entries // OWNED).bit_length())

    order = spark.sparkContext.broadcast(frequencies)
    sent = stored(source.select("text").mapInArrow(_send(order, owner_bits, block_sets), "kind int, owner int, block string, payload binary"), f"{folder}/sent")
    answers = sent.groupBy("kind", "owner").applyInArrow(_answer, "block string, kind int, owner int, n int, bitmap binary")
    answers.groupBy("block").applyInArrow(_keep(folder), "block string").write.mode("overwrite").parquet(f"{folder}/answered")
    found = stored(source.select("text").mapInArrow(_apply(order, folder, block_sets), "shingle long, set_id long, n int, place int, parts array<int>, text binary"), f"{folder}/found")
    shared = found.where("shingle is not null").select("shingle", "set_id", "n", "place")
    shared = shared.repartition("shingle").sortWithinPartitions("shingle", "set_id").mapInArrow(_shared, "shingle long, set_id long, n int, place int")
    shared = stored(shared, f"{folder}/shared")
    sets, turns = found.where("shingle is null").select("set_id", "n", "parts", "text"), count()

    groups = shared.select(F.col("shingle").alias("key"), F.col("set_id").alias("id"), "n", "place")
    labels = linked_groups(groups, POSSIBLE, lambda pairs: _verified(pairs, sets, f"{folder}/sized-{next(turns)}"), folder, PIVOT_ROUNDS, "place")
    own = members.join(labels, members.set_id == labels.id, "left").select("doc_id", "n", F.coalesce("label", "set_id").alias("label"))
    least = own.groupBy("label").agg(F.min("doc_id").alias("least"))
    n_shingles = F.col("n").cast("long").alias("n_shingles")
    alone = own.where("label is null").select("doc_id", n_shingles, F.col("doc_id").alias("component_id"))
    return own.join(least, "label").select("doc_id", n_shingles, F.col("least").alias("component_id")).union(alone)
