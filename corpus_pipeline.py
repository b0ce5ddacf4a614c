"""Corpus pipeline: from ``documents`` to packed training sequences.

Each stage is a function of (spark, docs, sf_dir) over all that the stage before kept. Every
stage's rows are written as Parquet and read again as the next one's documents. All but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import language, minhash, packing, quality, substring
from tenura.llm.common import table
from tenura.sources.shared import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A document goes if its words' languages are this unsure; texts in several languages are surer.
LEAST_LANGUAGE_SCORE = 0.4
# A document goes if it is more likely toxic or of low quality.
LEAST_QUALITY = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language: texts that are null or have no letters go."""
    found = language.identify(docs, language.train(docs), columns=COLUMNS[1:], sureness="sureness")
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("sureness") >= LEAST_LANGUAGE_SCORE)
    return found.where(known).select(COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely of the top grade: neither toxic nor of low quality.

    A null or empty text is graded by the thresholds alone.
    """
    grades = quality.toxic_quality_grades(table(spark, sf_dir, "labels"))
    model = quality.train(docs, grades)
    graded = quality.grade_documents(docs, model, keep=LEAST_QUALITY, columns=COLUMNS[1:])
    return graded.where("kept").select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows with a null id stay."""
    found = minhash.near_duplicates(docs, words=5, similarity=80)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 or more words of an earlier one.

    A text that loses words is its other words joined by one space; n_chars follows. A null or
    empty text stays as it is; other columns, of whatever name, are left out.
    """
    found = substring.remove_repeats(docs, window=50, with_text=True).where("n_removed > 0")
    found = found.select("doc_id", "words_sha256", "kept_text").dropDuplicates(["doc_id", "words_sha256"])
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select(COLUMNS).withColumn("words_sha256", F.sha2(F.concat_ws(" ", words), 256)).join(
        found, ["doc_id", "words_sha256"], "left"
    )
    text = F.coalesce("kept_text", "text")
    length = F.when(F.col("kept_text").isNotNull(), F.length("kept_text")).otherwise(F.col("n_chars"))
    return cut.select(
        "doc_id", text.alias("text"), "lang", "source", length.cast("long").alias("n_chars")
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, end_id=1, size=2048)


STAGES = [
    ("language", language_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("packing", packing_stage),
]
# The classifiers and the near-duplicate groups can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
