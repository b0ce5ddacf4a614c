import os
import tracemalloc
import zlib

import numpy as np
import pytest

from tenura.llm import language

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string"


def test_posteriors_equal_one_step_at_a_time():
    random = np.random.default_rng(0)
    lengths = np.array([1, 5, 300, 129, 128, 700])
    scores, transitions = random.normal(size=(lengths.sum(), 3)) * 3, random.normal(size=(3, 3))
    got, at = language.posteriors(scores, lengths, transitions), 0
    for n in lengths:
        e, a = np.exp(scores[at : at + n]), np.exp(transitions)
        forward, backward, p = np.zeros((n, 3)), np.ones((n, 3)), np.ones(3) / 3
        for t in range(n):
            p = (p @ a) * e[t]
            p /= p.sum()
            forward[t] = p
        for t in range(n - 2, -1, -1):
            backward[t] = a @ (e[t + 1] * backward[t + 1])
            backward[t] /= backward[t].sum()
        both = forward * backward
        assert np.allclose(both / both.sum(1, keepdims=True), got[at : at + n])
        at += n


def test_words_of_mixed_text_are_labelled():
    xs, ys = (["abba", "babe", "baab", "abab"], ["xyzzy", "zyxy", "yzzx", "xxyz"])
    samples = [("a", xs * 4), ("x", ys * 4)] * 10
    model = language.fit(samples)
    mixed = xs * 3 + ys * 3
    found = language.posteriors(model.emissions(mixed), np.array([len(mixed)]), model.transitions)
    assert found.argmax(axis=1).tolist() == [0] * 12 + [1] * 12
    assert (np.diag(model.transitions) > model.transitions.mean()).all()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs, documents=400)
    found = language.identify(docs.drop("lang", "source"), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_texts_without_letters_and_odd_rows(spark, rows):
    data = [(i, "aa bb ab", "a") for i in range(20)] + [(i, "yy xx xy", "x") for i in range(20, 40)]
    odd = [(100, None, "a"), (101, "", "a"), (102, "123 ² !?", "x"), (103, "bb " * 30_000, None), (None, "xx", "x"), (104, "xx", "x"), (104, "xx", "x")]
    docs = rows(SCHEMA + ", score string", [(*d, "clash") for d in data + odd])
    model = language.train(docs)
    got = [(r["doc_id"], r["lang_pred"]) for r in language.identify(docs, model).where("doc_id is null or doc_id >= 100").collect()]
    assert sorted(got, key=str) == sorted(
        [(100, "und"), (101, "und"), (102, "und"), (103, "a"), (None, "x"), (104, "x"), (104, "x")], key=str
    )


def test_a_rare_language_is_in_the_sample(spark, rows):
    data = [(i, "aa bb ab ba", "a") for i in range(4_000)] + [(i, "yy xx xy yx", "x") for i in range(4_000, 4_012)]
    docs = rows(SCHEMA, data)
    sample = language.training_sample(docs, "doc_id", "text", "lang", 40, 10)
    assert len(sample) == 40 and sum(lang == "x" for lang, _ in sample) >= 6
    model = language.train(docs, documents=40)
    found = language.identify(rows(SCHEMA, [(1, "xx yx", None), (2, "ab ba", None)]), model).collect()
    assert sorted((r["doc_id"], r["lang_pred"]) for r in found) == [(1, "x"), (2, "a")]


def test_no_labels_and_empty_table(spark, rows):
    unlabelled = rows(SCHEMA, [(1, "abc", None)])
    assert language.train(unlabelled) is None
    assert [tuple(r) for r in language.identify(unlabelled, None).collect()] == [(1, "und", 0.0)]
    empty = rows(SCHEMA, [])
    assert language.identify(empty, language.train(empty)).count() == 0


def test_the_fit_sums_few_words_at_a_time():
    samples = [(f"l{i % 12}", [f"w{i}abcd{j}efg" for j in range(40)]) for i in range(600)]
    tracemalloc.start()
    try:
        language.fit(samples, rounds=1)
        assert tracemalloc.get_traced_memory()[1] < 150e6
    finally:
        tracemalloc.stop()
