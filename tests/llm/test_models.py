"""Models by held-out accuracy and by what must hold exactly; base figures by brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tidewell.llm import bilinear_lm, fertility, language, queries, toxicity

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_of_held_out_texts(spark):
    rows = queries.op3_language(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").collect()
    held_out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.97 * len(held_out)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_language_over_awkward_documents(spark, awkward, empty):
    model = language.fit(awkward)
    rows = language.predict(awkward, model).collect()
    assert len(rows) == awkward.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 and by_id[i].rejected for i in (4, 5, 6))
    assert by_id[1].lang_pred == "en" and by_id[11].lang_pred == "xx"
    none = language.fit(empty)
    assert none.languages == () and {r.lang_pred for r in language.predict(awkward, none).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


def test_forty_languages(spark, workspace, monkeypatch):
    """Each from a task of its own; few rows a language, one with more than are taken."""
    monkeypatch.setattr(language, "MAX_ROWS", 30)
    letters = "abcdefghijklmnopqrstuvwxyz"
    draw = np.random.default_rng(2)
    words = {f"l{n:02d}": ["".join(draw.choice(list(letters), 5)) for _ in range(60)] for n in range(40)}
    rows = [(i * 100 + n, " ".join(draw.choice(own, 40)), name) for n, (name, own) in enumerate(words.items()) for i in range(200 if n == 7 else 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, workspace)
    assert model.languages == tuple(words) and len(model.owners) == 160
    taken = spark.read.parquet(f"{workspace}/rows").groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in taken} == {name: 30 if n == 7 else 15 for n, name in enumerate(words)}
    found = language.predict(docs, model).join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    # a class of lengths without rows has the floor of the nearest one that has some
    assert min(model.floors) > 0 and language.predict(spark.createDataFrame([(1, "%x9 zq0 " * 4)], "doc_id long, text string"), model).first().rejected


def test_a_million_equal_ngrams_are_learnt_as_such(spark):
    long = "ab " * 350_000
    docs = spark.createDataFrame([(1, long, "x"), (2, "cd ef gh " * 9, "y")], "doc_id long, text string, lang string")
    assert language.counts(long).max() > 1 << 16
    model = language.fit(docs)
    scored = {r.doc_id: (r.lang_pred, round(r.score, 5)) for r in language.predict(docs, model).collect()}
    assert scored == {1: ("x", 1.0), 2: ("y", 1.0)}


def test_floors_of_thin_classes():
    lengths = np.array([100] * 30 + [5000] * 40 + [10])
    floors = language._floors(np.concatenate([np.full(30, 0.5), np.full(40, 0.9), [0.1]]), lengths)
    assert floors == pytest.approx([0.5 * language.SLACK] * 3 + [0.9 * language.SLACK] * 2)


def marked(spark):
    """Texts of common words; the toxic ones hold words of their own."""
    rows = []
    for i in range(600):
        words = [f"plain{(i * 31 + j * j * 7) % 400}" for j in range(40)]
        if i % 5 == 0:
            for j in range(3):
                words[(i + 9 * j) % 40] = ["vilest", "rottenly", "grimward"][(i // 5 + j) % 3]
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_of_held_out_texts(spark, awkward, empty):
    docs = marked(spark)
    model = toxicity.fit(docs, docs.where("doc_id % 3 <> 1").select("doc_id", "toxic"))
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held_out = [i for i in scored if i % 3 == 1]
    right = sum((scored[i] >= 0.7) == (i % 5 == 0) for i in held_out)
    assert right >= 0.95 * len(held_out) and all(0 <= s <= 1 for s in scored.values())
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(r.score < 0.7 for r in rows)
    assert toxicity.score(empty, model).count() == 0
    without = toxicity.fit(docs, docs.where("toxic = 0").select("doc_id", "toxic"))
    assert max(r.score for r in toxicity.score(docs, without).collect()) < 0.01


def base_figures(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {at + j for at in range(len(words) - 2) if windows[tuple(words[at : at + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_base_figures_are_those_of_brute_force(spark, awkward, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").union(awkward.select("doc_id", "text", "lang"))
    measures = fertility.measure(docs, PIECES)
    want = sorted((str(r.doc_id), *base_figures(r.text)) for r in docs.collect())
    rows = fertility.judge(measures.checkpoint()).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    assert fertility.judge(fertility.measure(empty, PIECES)).count() == 0


def test_fertility_tells_junk_from_prose(spark):
    rows = queries.op10_fertility(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_scripts():
    assert fertility.script_of("abc") == "Latin" and fertility.script_of("12 !") == "other"
    assert fertility.script_of("кириллица ab") == "Cyrillic" and fertility.script_of("中文字 a") == "Han"


@pytest.fixture(scope="module")
def scored(spark):
    return queries.op5_bilinear_lm(spark, SF).collect()


def test_unigram_base_is_exact(spark, scored):
    texts = {r.doc_id: [*re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower()), None] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = Counter()
    for doc_id, words in texts.items():
        if zlib.crc32(str(doc_id).encode()) % 10:
            seen.update(words)
    total = sum(seen.values())
    for r in scored:
        words = texts[r.doc_id]
        want = sum(math.log10((seen[w] + 0.1) / (total + 0.1 * (len(seen) + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(seen[w] > 0 for w in words), total)
        assert math.isclose(r.base_score, want, rel_tol=1e-9)


def test_the_model_beats_the_unigrams_on_held_out_texts(scored):
    held_out = [r for r in scored if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_probabilities_sum_to_one():
    model = bilinear_lm.Model(np.array([5.0, 3.0, 0.0, 9.0]))
    draw = np.random.default_rng(0)
    for _ in range(20):
        model.step(*(draw.integers(0, 4, 64) for _ in range(3)), draw.integers(0, 4, 8))
    by_last, by_before, norms = model.tables()
    for last in range(5):
        for before in range(5):
            assert math.isclose(np.exp(by_last[last] + by_before[before] - norms[before, last]).sum(), 1, rel_tol=1e-4)


def test_model_over_awkward_documents(spark, awkward, empty, workspace):
    counts, statistics = bilinear_lm.gather(awkward, workspace)
    model = bilinear_lm.train(awkward, statistics)
    rows = bilinear_lm.score(awkward, counts, statistics, model, workspace).collect()
    assert len(rows) == awkward.count() and all(np.isfinite(r.score) and r.n_known == r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {1}
    assert bilinear_lm.score(empty, counts, statistics, model, f"{workspace}-e").count() == 0
    counts, statistics = bilinear_lm.gather(empty, f"{workspace}-none")
    untrained = bilinear_lm.train(empty, statistics)
    assert bilinear_lm.score(awkward, counts, statistics, untrained, f"{workspace}-none").count() == awkward.count()


def test_entropy_judges_texts_of_rare_lengths_and_groups(spark, workspace):
    def row(doc_id, n_tokens, entropy, lang="en"):
        return (doc_id, lang, n_tokens, 4 * n_tokens, 0, 0, 0, "Latin", n_tokens, 4.0 + doc_id % 5 / 100, 0.0, entropy)

    usual = [row(i, 2 ** (7 + i % 3) + i % 7, 6.0 + i % 3 + (i % 11 - 5) / 50) for i in range(120)]
    usual += [row(i, 4096, 11.0 + (i % 11 - 5) / 50) for i in range(200, 240)]
    # rare: between and above the usual lengths, and in languages of their own
    rare = [row(1000, 1200, 9.2), row(1001, 1200, 2.0), row(1002, 40_000, 11.0), row(1003, 40_000, 3.0), row(1004, 128, 6.0, "xx"), row(1005, 128, 1.0, "yy"), row(1006, 64, 5.0), row(1007, 64, 1.0)]
    kinds = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, script string, n_tokens long, chars_per_token double, byte_share double, entropy double"
    kept = {r.doc_id: r.kept for r in fertility.judge(spark.createDataFrame(usual + rare, kinds)).collect()}
    assert all(kept[r[0]] for r in usual)
    assert {i: kept[i] for i in range(1000, 1008)} == {1000: True, 1001: False, 1002: True, 1003: False, 1004: True, 1005: False, 1006: True, 1007: False}
