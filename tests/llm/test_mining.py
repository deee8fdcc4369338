"""Hard negatives, mixing and spelling variants, each beside a plain computation."""

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from tidewell.llm import hard_negatives, mixing, spelling

SF = "/root/testdata/sf0.001"


# ---- hard negatives -----------------------------------------------------------------------------


def plain_negatives(rows, positives=5, negatives=3):
    """The definition, over Python integers. ``rows``: id, label, vector."""
    usable = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable[i] = min(usable.get(i, (label, vector)), (label, vector))
    whole = {i: (label, [math.floor(256 * x) for x in vector]) for i, (label, vector) in usable.items()}
    score = lambda a, b: sum(x * y for x, y in zip(whole[a][1], whole[b][1]))
    out = []
    for a in (i for i in whole if i % 50 == 0):
        ranked = sorted((-score(a, i), i) for i in whole if i != a)
        for p, i in [(-s, i) for s, i in ranked if whole[i][0] == whole[a][0]][:positives]:
            fitting = [(-s, n) for s, n in ranked if whole[n][0] != whole[a][0] and 50 * p <= -100 * s <= 95 * p]
            out += [(a, i, rank, n, p, s) for rank, (s, n) in enumerate(fitting[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, folder, extra=""):
    data = spark.createDataFrame(rows, "id long, label int, vector array<double>")
    if extra:
        data = data.withColumns({c: F.lit(1) for c in extra.split()})
    return sorted(tuple(r) for r in hard_negatives.mine(data, F.col("id") % 50 == 0, folder).collect())


def clustered(n, seed, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [(int(i), int(rng.integers(3)), (centres[i % 5] + rng.normal(size=dims) * 0.4).round(2).tolist()) for i in range(n)]


def test_hard_negatives_by_definition(spark, workspace, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 40)  # many tiles, so that bounds decide between them
    rows = clustered(700, 1)
    assert mined(spark, rows, workspace) == plain_negatives(rows)


def test_hard_negatives_of_odd_rows(spark, workspace):
    rows = clustered(120, 2)
    rows += [(500, 1, [0.5] * 6), (501, 1, [0.5] * 6), (502, 2, [0.25] * 6), (503, 2, [0.25] * 6), (504, 2, [0.25] * 6), (505, 2, [0.25] * 6)]
    rows += [(500, 1, [0.5] * 6), (502, 0, [0.25] * 6)]  # a repeated row, and an id with two labels
    rows += [(None, 1, [1.0] * 6), (550, None, [1.0] * 6), (600, 1, None), (650, 1, [1.0, None]), (700, 1, [math.nan] * 6), (750, 0, [math.inf] * 6)]
    rows += [(800, 1, []), (801, 1, [0.3]), (850, 9, [0.1] * 6), (900, 0, [0.0] * 6)]
    assert mined(spark, rows, workspace, "anchor cell tile n score rank place low") == plain_negatives(rows)


def test_hard_negatives_of_large_components(spark, workspace):
    rows = [(i, i % 2, [float((i * 37) % 101) * 1e5, float((i * 53) % 97) * 1e5 + 0.125]) for i in range(60)]
    want = plain_negatives(rows)
    assert want and max(r[4] for r in want) > 1 << 53 and mined(spark, rows, workspace) == want


def test_many_equal_vectors(spark, workspace, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 50)
    rows = clustered(200, 3) + [(1000 + i, i % 3, [0.7, 0.1, 0.0, 0.2, 0.3, 0.1]) for i in range(300)]
    assert mined(spark, rows, workspace) == plain_negatives(rows)


def test_no_hard_negatives_without_rows(spark, workspace):
    assert mined(spark, [], workspace) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])], f"{workspace}/alone") == []


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10_000))
def test_bounds_hold_the_score(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(12, 5)) * 10.0 ** rng.integers(0, 4))
    x[rng.integers(12)] = 0
    x[3] = x[4] * 3  # the same direction
    references = hard_negatives._directions(x)
    norms = np.linalg.norm(x, axis=1)
    angles = np.arccos(np.clip(x @ references.T / np.where(norms > 0, norms, 1)[:, None], -1, 1)).astype("<f4").astype(float)
    below, above = hard_negatives.score_bounds(norms, angles, angles, angles, norms, norms)
    scores = hard_negatives.exact_scores(x, x)
    assert (below <= scores).all() and (scores <= above).all()


def test_bounds_leave_rows_out():
    """Rows near two far directions: scores within one group are far above those across."""
    x = np.floor(np.concatenate([np.random.default_rng(i).normal(size=(50, 8)) + 40 * np.eye(8)[i] for i in (0, 1)]) * 10)
    references = hard_negatives._directions(x)
    norms = np.linalg.norm(x, axis=1)
    angles = np.arccos(np.clip(x @ references.T / norms[:, None], -1, 1))
    _, above = hard_negatives.score_bounds(norms, angles, angles, angles, norms, norms)
    assert (above[:50, 50:] < hard_negatives.exact_scores(x, x)[:50, :50].min()).mean() > 0.95


# ---- mixing -------------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), min_size=1, max_size=5), st.floats(0, 1))
def test_no_choice_of_documents_fits_a_budget_better(counts, share):
    lengths, docs = np.array(sorted(counts)), np.array([counts[n] for n in sorted(counts)])
    budget = round(share * int(lengths @ docs))
    taken = mixing.fill(lengths, docs, budget)
    assert (0 <= taken).all() and (taken <= docs).all()
    sums = (int(np.dot(lengths, x)) for x in itertools.product(*(range(n + 1) for n in docs)))
    assert abs(int(lengths @ taken) - budget) == min(abs(s - budget) for s in sums)


def test_a_large_budget_is_met_to_the_word():
    rng = np.random.default_rng(5)
    lengths = np.unique(rng.integers(1, 20_000, 3_000))
    docs = rng.integers(1, 300, len(lengths))
    for share in (0.01, 0.37, 0.99):
        budget = int(share * int(lengths @ docs))
        taken = mixing.fill(lengths, docs, budget)
        assert int(lengths @ taken) == budget and (taken <= docs).all()
        long = docs >= 100  # every length gives its share
        assert np.abs(taken[long] / docs[long] - share).mean() < 0.05


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        free = total - sum(3 * sizes[s] for s in stopped)
        weights = sum(weight[s] for s in names if s not in stopped)
        share = {s: 3.0 * sizes[s] if s in stopped else free * weight[s] / weights for s in names}
        over = {s for s in names if share[s] > 3 * sizes[s]}
        if not over:
            return share
        stopped |= over


def plain_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def hold_to_contract(docs, rows):
    """``docs``: doc_id, text, source. ``rows``: the result."""
    source_size = defaultdict(int)
    for _, text, source in docs:
        source_size[source] += plain_size(text)
    want = plain_targets(source_size) if docs else {}
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in rows) == Counter((d, plain_size(t), s) for d, t, s in docs)
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == source_size[r["source"]] and r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[r["source"]] += r["taken"]
    return {s: taken[s] - want[s] for s in want}


def test_targets_share_all_words(spark, workspace, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 7)  # a frequent length is ranked in many slices
    rng = np.random.default_rng(7)
    docs = []
    for i in range(1500):
        source = [None, "a", "Z", "é", "z", "😀", "ﬀ", "tiny"][min(int(rng.exponential(1.5)), 6)]
        docs.append((i, " ".join(["w"] * (11 if i % 3 else int(rng.integers(0, 60)))), source))
    docs += [(9000, "one two", "tiny"), (9001, None, "tiny"), (9002, "", "without"), (9003, None, "without")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit(1) for c in ("size", "docs", "order", "slice", "target")})
    rows = mixing.mix(frame.repartition(5), f"{workspace}/a").collect()
    off = hold_to_contract(docs, rows)
    assert all(abs(x) <= 1 for x in off.values())
    again = mixing.mix(frame.repartition(3, "text"), f"{workspace}/b").collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    other = mixing.mix(frame, f"{workspace}/c", seed=2).collect()
    assert sorted(map(repr, rows)) != sorted(map(repr, other))


def test_mixing_awkward_rows(spark, awkward, empty, workspace):
    named = awkward.withColumn("source", F.col("lang"))
    docs = [(r["doc_id"], r["text"], r["source"]) for r in named.collect()]
    hold_to_contract(docs, mixing.mix(named, f"{workspace}/a").collect())
    assert mixing.mix(empty.withColumn("source", F.col("lang")), f"{workspace}/b").collect() == []


def test_mixing_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    source = {d: s for d, _, s in docs}
    result = entry.queries()["op12_mixing"](spark, SF)
    assert result.columns == ["doc_id", "size", "source_size", "target", "taken"]
    off = hold_to_contract(docs, [{**r.asDict(), "source": source[r["doc_id"]]} for r in result.collect()])
    assert all(abs(x) <= 50 for x in off.values())  # few documents a source: not every sum can be reached


# ---- spelling variants --------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n):
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def found_variants(spark, n, folder):
    rows = spelling.variants(spark.createDataFrame(sorted(n.items()), "word string, n long"), folder).collect()
    assert len(rows) == len(n)
    return {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in rows}


def random_words(seed, alphabet, count):
    rng = np.random.default_rng(seed)
    return {"".join(rng.choice(list(alphabet), int(rng.integers(5, 9)))): int(rng.geometric(0.05)) + 2 for _ in range(count)}


@pytest.mark.parametrize("alphabet", ["ea", "abz", "éèe", "ÀÉß×"])
def test_variants_by_definition(spark, workspace, alphabet):
    n = random_words(3, alphabet, 400)
    n |= {"a" * 5000: 3, "a" * 5001: 9, "a" * 2500 + "b" + "a" * 2499: 40}
    assert found_variants(spark, n, workspace) == plain_variants(n)


def test_variants_where_groups_are_cut(spark, workspace, monkeypatch):
    """Groups deeper than usual, and words that no level tells apart."""
    monkeypatch.setattr(spelling, "GROUP_WORDS", 20)
    n = random_words(4, "éèàù", 300) | random_words(5, "eainr", 300)
    assert found_variants(spark, n, workspace) == plain_variants(n)


def test_variants_without_words(spark, workspace):
    none = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(none, workspace).collect() == []


def test_search_reaches_every_near_word(monkeypatch):
    monkeypatch.setattr(spelling, "LEAF", 2)
    words = sorted(random_words(6, "eanzé", 500))
    own = spelling._Words(pa.table({"word": words, "n": [3] * len(words)}))
    one = np.ones(len(words), np.int64)
    reached, visits = set(), 0
    for leaf, alive in spelling._leaves(own, own, one, one, 0):
        reached |= {(int(q), int(w)) for q in alive for w in leaf}
        visits += len(leaf) * len(alive)
    want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if a != b and one_edit(a, b)}
    assert want <= reached and visits < len(words) ** 2 / 10


def test_occurrences(spark, awkward, empty):
    frame = awkward.withColumn("run", F.lit(1))
    want = Counter()
    for r in awkward.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    words = spelling.occurrences(frame, damage=3)
    assert Counter(r["word"] for r in words.collect()) == want
    kept = {r["word"]: r["n"] for r in spelling.vocabulary(words).collect()}
    assert kept == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert spelling.vocabulary(spelling.occurrences(empty)).collect() == []


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_spelling"])
def test_mining_query_matches_sql(spark, name):
    outcome = check.compare(spark, check.connect(SF), SF, name)
    assert outcome.startswith("ok") and "types" not in outcome and not outcome.startswith("ok 0"), outcome


def test_many_tiles_come_from_few_ranges(spark, monkeypatch):
    """Tiles follow the order, hold so many rows at most, and a task cuts several of them."""
    rows = spark.sql("select id, id % 3 as label, int(id % 5) as cell, id / 7.0D as angle from range(1000)")
    tiled = hard_negatives._in_tiles(rows, 1000, 100, ("label", "cell", "angle", "id"))
    ranges = -(-100 // hard_negatives.TILES_A_TASK)
    assert tiled.rdd.getNumPartitions() <= ranges < 100
    found = tiled.collect()
    by_tile = {}
    for r in found:
        by_tile.setdefault(r["tile"], []).append((r["label"], r["cell"], r["angle"], r["id"]))
    assert len(found) == 1000 and 100 <= len(by_tile) <= 100 + ranges and max(map(len, by_tile.values())) <= 10
    assert [x for t in sorted(by_tile) for x in sorted(by_tile[t])] == sorted(x for own in by_tile.values() for x in own)
