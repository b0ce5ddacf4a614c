import os
import random

import pytest

from tenura.llm import minhash
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def result(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def copies(n, seed=4):
    """Texts with groups of near copies, short texts, ties and repeats."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        base = [r.choice(words) for _ in range(r.choice([1, 2, 3, 8, 40, 120]))]
        for _ in range(r.choice([1, 1, 2, 4])):
            text = [r.choice(words) if r.random() < 0.02 else w for w in base]
            texts.append(" ".join(text))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("words", [2, 5])
def test_equals_comparing_all_pairs(spark, rows, words):
    texts = [*copies(70), None, "", " \t\n", "One", "ONE", "a b", "A  B"]
    docs = rows("doc_id long, text string, n_shingles int", [(i, t, 0) for i, t in enumerate(texts)])
    got = result(minhash.near_duplicates(docs, words=words))
    assert got == brute.near_duplicates(list(enumerate(texts)), words)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute.near_duplicates([tuple(r) for r in docs.select("doc_id", "text").collect()], 2)
    assert result(minhash.near_duplicates(docs, words=2)) == expected


def test_a_large_group_of_near_copies(spark, rows):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join([*base[: i % 100], f"x{i}", *base[i % 100 + 1 :]]) for i in range(300)]
    docs = rows("doc_id long, text string", list(enumerate(texts)))
    got = result(minhash.near_duplicates(docs, words=2))
    assert {v[1] for v in got.values()} == {0}


def test_null_and_repeated_ids(spark, rows):
    data = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (9, "a b c"), (9, "other words here")]
    got = sorted((tuple(r) for r in minhash.near_duplicates(rows("doc_id long, text string", data), words=2).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (3, 2, 3, True), (3, 2, 3, True), (9, 2, 3, False), (9, 2, 3, False)], key=str)


def test_empty_table(spark, rows):
    assert minhash.near_duplicates(rows("doc_id long, text string", [])).count() == 0


def loose_group(n, seed=11):
    """Texts around one base whose pairs lie below and above the limit, and two very long ones."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(f"x{r.random()}" if r.random() < 0.03 else w for w in base) for _ in range(n)]
    long = [f"l{i}" for i in range(60_000)]
    return [*texts, " ".join(long), " ".join([*long[:100], "other", *long[100:]])]


def test_small_blocks_find_all_links_of_a_loose_group(spark, rows, monkeypatch):
    monkeypatch.setattr(minhash, "PROBE_ROWS", 32)
    texts = loose_group(150)
    docs = rows("doc_id long, text string, key long, component string", [(i, t, i, "c") for i, t in enumerate(texts)])
    got = result(minhash.near_duplicates(docs, words=2, list_rows=16))
    expected = brute.near_duplicates(list(enumerate(texts)), 2)
    assert got == expected
    assert 3 < len({v[1] for v in expected.values()}) < len(texts) - 3


def test_a_block_returns_a_forest_of_its_links(spark, rows):
    signer = minhash.Signer(2)
    sets = [signer.shingles([b"w%d" % j for j in range(50 + i % 5)]).tobytes() for i in range(40)]
    colliding = rows(
        "key long, part int, slice int, probe int, doc long, n long, component long",
        [(1, 0, 0, probe, i, 49 + i % 5, i) for i in range(40) for probe in (0, 1)],
    )
    known = rows("doc long, n long, shingles binary", [(i, 49 + i % 5, bytearray(s)) for i, s in enumerate(sets)])
    assert minhash._confirm_blocks(colliding, known, 80).count() == 39


def test_set_index_counts_intersections():
    r = random.Random(3)
    sets = [minhash.np.unique(minhash.np.array(r.sample(range(60), r.randint(1, 40)), minhash.np.uint64)) for _ in range(30)]
    index = minhash._SetIndex(sets)
    for own in [*sets, minhash.np.array([99], minhash.np.uint64)]:
        assert index.shared(own).tolist() == [len(set(own.tolist()) & set(s.tolist())) for s in sets]
