"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tenura.llm import (
    alignment, bpe, html_text, language, lattice, minhash, packing, quality, resampling, substring,
    token_counts, token_files, topk,
)
from tenura.llm.common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, end_id=1, size=2048)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digest_documents(bpe.encode_documents(table(spark, sf_dir, "documents"), path), path)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, similarity=80)


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return found.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), path, end_id=2)
    return token_files.read_token_files(manifest).select(
        F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32"
    )


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256.0)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.toxic_quality_grades(table(spark, sf_dir, "labels")))
    return quality.grade_documents(docs, model)


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=50)


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "benchmark")
    return resampling.resample(table(spark, sf_dir, "documents"), target, percent=25, seed=7)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, limit=2048)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_path = public_tokenizers.path("byte_bpe_50k.json")
    piece_path = public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_documents(table(spark, sf_dir, "documents"), byte_path, piece_path)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_bpe": op2_bpe,
    "op3_minhash": op3_minhash,
    "op4_lattice": op4_lattice,
    "op5_language": op5_language,
    "op6_token_files": op6_token_files,
    "op7_topk": op7_topk,
    "op8_quality": op8_quality,
    "op9_substring": op9_substring,
    "op10_html": op10_html,
    "op11_resampling": op11_resampling,
    "op12_token_counts": op12_token_counts,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}
# DuckDB SQL where it can express the query.
ORACLES: dict[str, str] = {
    "op4_lattice": """
WITH RECURSIVE
linked AS (
    SELECT a.vec_id AS x, b.vec_id AS y
    FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.93),
reached AS (
    SELECT vec_id AS x, vec_id AS y FROM embeddings
    UNION SELECT r.x, l.y FROM reached r JOIN linked l ON r.y = l.x)
SELECT vec_id, (SELECT count(*) FROM linked WHERE x = vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM embeddings JOIN (SELECT x AS vec_id, min(y) AS component_id FROM reached GROUP BY x) USING (vec_id)""",
    "op7_topk": """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole q JOIN whole d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op9_substring": """
WITH split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                               lambda x: x <> '') AS words
    FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS s
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM split WHERE len(words) >= 50)),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i, unnest(range(0, 50)) AS k FROM hits)),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM split)
    ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)""",
}
