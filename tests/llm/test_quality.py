import os
import random
import tracemalloc

import numpy as np
import pytest

from tenura.llm import quality

SF = "/root/testdata/sf0.01"


def sample(n=400, seed=1):
    r = random.Random(seed)
    words = [f"{a}{b}le" for a in "bcdfg" for b in "aeiou"]
    rows = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(3, 40))]
        grade = r.choice([0, 1, 2, 2])
        if grade == 0:
            text[r.randrange(len(text))] = r.choice(["nasty", "vile"])
        if grade == 1:
            text = [w.upper() + "!!" for w in text]
        rows.append((i, " ".join(text), grade))
    return rows


def test_thresholds_are_ordered_and_probabilities_add_up():
    tokens = quality.Tokens(tuple)
    data = [(g, np.array(sorted(quality.document_features(t, tokens)))) for _, t, g in sample()]
    model = quality.fit(data, 3)
    assert (np.diff(model.thresholds) > 0).all()
    below = model.at_most(np.linspace(-5, 5, 50))
    assert (np.diff(below, axis=1) >= 0).all() and (np.diff(below, axis=0) <= 0).all()


def test_held_out_grades(spark, rows):
    train, test = sample(600), sample(200, 2)
    docs = rows("doc_id long, text string, kept string", [(d, t, "clash") for d, t, _ in train])
    model = quality.train(docs, rows("doc_id long, grade int", [(d, g) for d, _, g in train]))
    got = quality.grade_documents(rows("doc_id long, text string", [(d, t) for d, t, _ in test]), model).collect()
    truth = {d: g for d, _, g in test}
    assert sum(r["kept"] == (truth[r["doc_id"]] == 2) for r in got) >= 0.95 * len(got)
    mean = {g: np.mean([r["expected_grade"] for r in got if truth[r["doc_id"]] == g]) for g in (0, 1, 2)}
    assert mean[0] < mean[2] and mean[1] < mean[2]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_test_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    grades = quality.toxic_quality_grades(labels)
    model = quality.train(docs, grades)
    found = quality.grade_documents(docs, model).join(grades, "doc_id").collect()
    assert sum(r["kept"] == (r["grade"] == 2) for r in found) >= 0.9 * len(found)


def test_odd_rows(spark, rows):
    train = sample(300)
    docs = rows("doc_id long, text string", [(d, t) for d, t, _ in train])
    ratings = rows("doc_id long, grade int", [(d, g) for d, _, g in train] + [(None, 1), (1, None), (2, 9), (-5, 0)])
    model = quality.train(docs, ratings, documents=100)
    odd = rows("doc_id long, text string", [(1, None), (2, ""), (None, "bale"), (3, "x"), (3, "x"), (4, "bale " * 50_000)])
    got = quality.grade_documents(odd, model).collect()
    assert len(got) == 6 and all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got)


def test_no_ratings_and_empty_table(spark, rows):
    docs, none = rows("doc_id long, text string", [(1, "a")]), rows("doc_id long, grade int", [])
    assert quality.train(docs, none) is None
    assert [tuple(r) for r in quality.grade_documents(docs, None).collect()] == [(1, None, None, True)]
    empty = rows("doc_id long, text string", [])
    assert quality.grade_documents(empty, quality.train(empty, none)).count() == 0


@pytest.mark.parametrize("token, kind", [("word", "a"), ("WORD,", "AA,"), ("THE!!", "AA!"), ("x***", "a*"), ("|", "|"), ("12-3", "0-0"), ("ABC", "AA")])
def test_shapes(token, kind):
    assert quality.shape(token) == kind


def test_the_fit_makes_no_copy_of_all_samples():
    random = np.random.default_rng(0)
    data = [(i % 3, np.unique(random.integers(0, quality.BUCKETS, 800))) for i in range(2000)]
    tracemalloc.start()
    try:
        quality.fit(data, 3, rounds=1)
        assert tracemalloc.get_traced_memory()[1] < 50e6
    finally:
        tracemalloc.stop()
