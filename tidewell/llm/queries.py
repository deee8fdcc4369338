"""The registered queries of the training-data operators, over the whole table of documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import bilinear_lm, byte_bpe, exact_dedup, fertility, hard_negatives, jaccard_join, language, line_dedup, mixing, packing, spelling, token_files, toxicity
from tidewell.llm.shipping import ship
from tidewell.session import new_workspace

#: Ends a document in the token files and in packed sequences.
END_ID = 1

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/documents.parquet")


def _remainder(parts: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op1_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(_documents(spark, sf), path, public_tokenizers.PATTERN, decode=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_workspace(spark, "token-files")
    token_files.write_tokens(_documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"), folder, END_ID)
    stored = token_files.read_tokens(spark, folder)
    return stored.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    model = language.fit(docs.where(_remainder(3) != 1))
    held_out = F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out")
    return language.predict(docs, model).select("doc_id", held_out, "lang_pred", "score", "rejected")


def op4_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.classes(_documents(spark, sf), new_workspace(spark, "jaccard-join"))


def op5_bilinear_lm(spark: SparkSession, sf: str) -> DataFrame:
    docs, folder = _documents(spark, sf), new_workspace(spark, "bilinear-lm")
    held_out = F.coalesce(_remainder(10) == 0, F.lit(False))
    training = docs.where(~held_out)
    counts, statistics = bilinear_lm.gather(training, folder)
    model = bilinear_lm.train(training, statistics)
    scored = bilinear_lm.score(docs, counts, statistics, model, folder)
    return scored.withColumns({"held_out": held_out, "train_tokens": F.lit(statistics.total).cast("long")})


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.classes(_documents(spark, sf), new_workspace(spark, "exact-dedup"))


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(_remainder(3) != 1)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "distance",
    )


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.line_classes(_documents(spark, sf), new_workspace(spark, "line-dedup")).drop("text_key")


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(_documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"), new_workspace(spark, "packing"), END_ID)
    length = (F.octet_length("ids") / 4).cast("long").alias("length")
    return pieces.select("doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_fertility(spark: SparkSession, sf: str) -> DataFrame:
    stored = f"{new_workspace(spark, 'fertility')}/measures"
    fertility.measure(_documents(spark, sf), public_tokenizers.path("piece_bpe_32k.model")).write.parquet(stored)
    return fertility.judge(spark.read.parquet(stored)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "chars_per_token",
        "byte_share",
        "entropy",
    )


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(rows, F.col("id") % 50 == 0, new_workspace(spark, "hard-negatives"))


def op12_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf), new_workspace(spark, "mixing"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    words = spelling.vocabulary(spelling.occurrences(_documents(spark, sf)))
    return spelling.variants(words, new_workspace(spark, "spelling"))


def queries() -> dict[str, Query]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_token_files": op2_token_files,
        "op3_language": op3_language,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_bilinear_lm": op5_bilinear_lm,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_toxicity": op7_toxicity,
        "op8_line_dedup": op8_line_dedup,
        "op9_packing": op9_packing,
        "op10_fertility": op10_fertility,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_mixing": op12_mixing,
        "op13_spelling": op13_spelling,
    }


#: White space that exact duplicates ignore and that separates words.
_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


#: One step of crc32 over a byte, for the table of its 256 remainders.
_CRC_BIT = "case when {c} & 1 = 1 then xor({c} >> 1, 3988292384) else {c} >> 1 end"
_CRC_TABLE = "select list_reduce([r, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: " + _CRC_BIT.format(c="c") + ") as t, r from (select unnest(range(256)) as r)"


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_dedup": f"""
            with d as (select doc_id, length(coalesce(text, '')) as n, sha256({_NORMAL}) as text_sha256 from documents)
            select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by text_sha256) as group_size,
                   doc_id = first_value(doc_id) over best as kept, text_sha256
            from d window best as (partition by text_sha256 order by n desc, doc_id)
        """,
        "op11_hard_negatives": """
            with v as (
                select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                       list_transform(embedding, lambda x: floor(256 * x::double)) as q
                from embeddings
                where vec_id is not null and label is not null and embedding is not null
                  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            ),
            s as (
                select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same, list_inner_product(a.q, v.q)::bigint as score
                from v a, v where a.vec_id % 50 = 0 and a.vec_id <> v.vec_id
            ),
            p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
            n as (
                select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
                       row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank
                from p join s on p.anchor_id = s.anchor_id and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
            )
            select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 3
        """,
        "op13_spelling": rf"""
            with recursive crc as (select list(t order by r) as t from ({_CRC_TABLE})),
            runs as (
                select coalesce(doc_id::varchar, '') as d,
                       unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run
                from documents
            ),
            per_doc as (select d, run, count(*) as k from runs where length(run) >= 5 group by all),
            bytes as (select d, run, k, hex(encode(d || ':' || run)) as x from per_doc),
            hashed as (
                select run, k, xor(4294967295, list_reduce(
                    list_prepend(4294967295::bigint, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::int, 2))::bigint)),
                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h
                from bytes, crc
            ),
            damaged as (
                select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, k
                from hashed
            ),
            words as materialized (select word, sum(k)::bigint as n from damaged where length(word) >= 5 group by word having sum(k) >= 3),
            cut as materialized (
                select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest
                from (select word, n, unnest(range(length(word)))::int as i from words)
            ),
            pairs as (
                select distinct c.word as a, w.word as b, w.n as b_n from cut c join words w on c.rest = w.word
                union select distinct w.word, c.word, c.n from cut c join words w on c.rest = w.word
                union select c.word, o.word, o.n from cut c join cut o on c.rest = o.rest and c.i = o.i and c.word <> o.word
            ),
            best as (select a, count(*) as n_near, first(b order by b_n desc, b) as b, max(b_n) as b_n from pairs group by a),
            forms as materialized (
                select word, n, coalesce(n_near, 0) as n_near, case when b_n >= 2 * n then b end as form, case when b_n >= 2 * n then b_n end as form_n
                from words left join best on word = a
            ),
            ways as (
                select word, word as stop from forms
                union all select w.word, f.form from ways w join forms f on w.stop = f.word where f.form is not null
            ),
            ends as (select w.word, w.stop from ways w join forms f on w.stop = f.word where f.form is null)
            select word, form, stop as root, n, n_near, form_n from forms join ends using (word)
        """,
    }
