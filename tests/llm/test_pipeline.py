"""The pipeline's stages one by one, each against a plain version on the rows it got."""

import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenura.llm.pieces import load_tokenizer
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows of documents and of each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 34", "en", "s", 5)], docs.schema)
    docs = docs.unionByName(odd)
    frames = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = frames[name] = spark.read.parquet(str(folder / name))
    return frames


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(kept):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert kept[name].columns == corpus_pipeline.COLUMNS
        assert kept[name].schema == kept["documents"].schema


def test_language_keeps_texts_with_letters(kept):
    before, after = texts(kept["documents"]), texts(kept["language"])
    assert before.keys() - after.keys() == {10**6, 10**6 + 1}
    assert all(before[d] == t for d, t in after.items())


def test_language_keeps_a_text_in_three_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    parts = [next(r["text"] for r in docs.where((F.col("lang") == lang) & (F.length("text") > 600)).orderBy("doc_id").collect())
             for lang in ("de", "es", "fr")]
    mixed = " ".join(" ".join(p.split()[:60]) for p in parts)
    planted = spark.createDataFrame([(10**6 + 2, mixed, None, "s", len(mixed))], docs.schema)
    model = corpus_pipeline.language.train(docs)
    row = corpus_pipeline.language.identify(planted, model, sureness="sureness").first()
    assert row["score"] < corpus_pipeline.LEAST_LANGUAGE_SCORE < 0.8 < row["sureness"]
    kept = corpus_pipeline.language_stage(spark, docs.unionByName(planted), SF)
    assert kept.where(F.col("doc_id") == 10**6 + 2).first()["text"] == mixed


def test_quality_keeps_good_documents(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] == 0 and r["quality"] == 1 for r in labels.collect()}
    after = texts(kept["quality"])
    before = texts(kept["language"])
    rated = [d for d in before if d in truth]
    assert sum((d in after) == truth[d] for d in rated) >= 0.9 * len(rated)


def test_one_of_each_group_stays(kept):
    before = texts(kept["quality"])
    expected = brute.near_duplicates(sorted(before.items()), 5)
    assert texts(kept["near_duplicates"]) == {d: before[d] for d, v in expected.items() if v[2]}


def test_repeated_passages_go(kept):
    before = texts(kept["near_duplicates"])
    expected = brute.remove_repeats(sorted(before.items()))
    after = kept["substrings"].collect()
    assert {r["doc_id"]: r["text"] for r in after} == {
        d: expected[d][3] if expected[d][1] else t for d, t in before.items()
    }
    assert all(r["n_chars"] == len(r["text"]) for r in after if expected[r["doc_id"]][1])


def test_all_is_packed(kept):
    tokenizer = load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    counts = {d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in texts(kept["substrings"]).items()}
    packed = kept["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in packed} == counts


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_clashing_columns_do_not_matter_to_the_substring_stage(spark, rows):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = rows(
        "doc_id long, text string, lang string, source string, n_chars long, kept_text string, words_sha256 string, n_removed int",
        [(1, passage, "en", "s", len(passage), "x", "y", 5), (2, f"own {passage}", "en", "s", 1, None, None, 7), (3, None, None, None, None, "x", "y", 0)],
    )
    found = corpus_pipeline.substring_stage(spark, docs, "")
    assert found.columns == corpus_pipeline.COLUMNS
    assert sorted(tuple(r)[:2] for r in found.collect()) == [(1, passage), (2, "own"), (3, None)]
