import os
import random
import sys

import numpy as np
import pytest

from tenura.llm import substring
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def result(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


def passages(n, window, seed):
    """Texts that share passages, repeat themselves, or are copies."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    shared = [[r.choice(words) for _ in range(r.randint(window - 1, 3 * window))] for _ in range(6)]
    texts = []
    for _ in range(n):
        text = [r.choice(words) for _ in range(r.randint(0, 2 * window))]
        for _ in range(r.randint(0, 2)):
            part = r.choice(shared)
            start = r.randint(0, len(part) // 2)
            text += part[start : start + r.randint(1, len(part))] + [r.choice(words) for _ in range(r.randint(0, 5))]
        texts.append("  ".join(text) if r.random() < 0.1 else " ".join(text))
        if r.random() < 0.15:
            texts.append(texts[-1].replace(" ", "\t", 1))
    return texts


@pytest.mark.parametrize("window, anchor, shard", [(10, 5, 60), (50, 25, 400_000), (8, 3, 200)])
def test_equals_comparing_all_windows(spark, rows, window, anchor, shard):
    texts = [*passages(60, window, window), None, "", " \n"]
    docs = rows(SCHEMA + ", digest string", [(i, t, "clash") for i, t in enumerate(texts)])
    got = result(substring.remove_repeats(docs, window=window, anchor=anchor, shard_words=shard, shard_documents=7))
    assert got == {d: v[:3] for d, v in brute.remove_repeats(list(enumerate(texts)), window).items()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute.remove_repeats([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = {r["doc_id"]: r for r in substring.remove_repeats(docs, with_text=True).collect()}
    assert {d: (r["n_words"], r["n_removed"], r["kept_sha256"]) for d, r in got.items()} == {d: v[:3] for d, v in expected.items()}
    assert all(r["kept_text"] is None or r["kept_text"] == expected[d][3] for d, r in got.items())


def test_repeated_and_null_ids(spark, rows):
    text, other = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    data = [(4, text), (4, text), (6, text), (None, text), (6, other), (8, other)]
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in substring.remove_repeats(rows(SCHEMA, data)).collect())
    assert got == [("4", 0), ("4", 0), ("6", 0), ("6", 60), ("8", 60), ("None", 0)]


def test_empty_table(spark, rows):
    assert substring.remove_repeats(rows(SCHEMA, []), with_text=True).count() == 0


def test_grams_don_t_depend_on_their_place():
    grams = substring.Grams()
    words = [b"x", b"a", b"b", b"c", b"y", b"a", b"b", b"c"]
    found = grams.grams(grams.word_hashes(words), 3)
    assert found[1] == found[5] and len(np.unique(found)) == len(found) - 1


def test_automaton_tells_words_apart_by_all_symbols():
    # Many different words: their symbols agree in two places of three, and the alphabets stay small.
    words = [b"w%d" % i for i in range(3000)]
    automaton = substring.PassageAutomaton([(0, words)], 10, 5)
    assert automaton.radix**3 > len(words) and automaton.radix < 16
    assert automaton.shared(1, [b"x", *words[100:112], b"w1", *words[500:509]]) == [(1, 13)]
    assert automaton.shared(1, [words[i + automaton.radix] for i in range(50, 55)] + words[7:12]) == []
    assert automaton.shared(0, words[100:150]) == []


def test_only_words_around_anchors_go_to_a_shard(spark, rows):
    r = random.Random(3)
    noise = lambda n: [f"n{r.random()}" for _ in range(n)]
    passage = [f"p{i}" for i in range(60)]
    texts = [passage, noise(5000) + passage + noise(5000)]
    grams = substring.Grams()
    found = grams.grams(grams.word_hashes([w.encode() for w in passage]), 25).view(np.int64)
    targets = rows(
        "doc long, text string, targets array<struct<shard: long, part: int, anchors: array<long>>>",
        [(i, " ".join(t), [(0, 0, [int(found[20])])]) for i, t in enumerate(texts)],
    )
    got = {s["doc"]: (s["base"], bytes(s["words"]).decode().split()) for s in substring._segments(targets, 50, 25).collect()}
    assert got == {0: (0, passage), 1: (4995, texts[1][4995:5070])}


def test_segments_streamed_together_equal_each_alone(monkeypatch):
    r = random.Random(5)
    shared = [[f"w{r.randrange(40)}".encode() for _ in range(r.randint(12, 40))] for _ in range(8)]
    segments = [[b"x"] * r.randint(0, 3) + r.choice(shared)[r.randint(0, 6) :] + r.choice(shared) for _ in range(60)]
    docs = [r.randrange(12) for _ in segments]
    passages = list(enumerate(shared))
    automaton = substring.PassageAutomaton(passages, 10, 5)
    expected = []
    for doc, words in zip(docs, segments):
        runs = set()
        for source, passage in passages:
            for shift in range(-len(passage), len(words)):
                start = None
                for i in range(max(shift, 0), min(shift + len(passage), len(words)) + 1):
                    same = i < min(shift + len(passage), len(words)) and words[i] == passage[i - shift]
                    if same and start is None:
                        start = i
                    elif not same and start is not None:
                        if i - start >= 10 and source < doc:
                            runs.add((start, i))
                        start = None
        expected.append(sorted(runs))
    assert automaton.shared_of(docs, segments) == expected
    monkeypatch.setattr(substring, "_COMPARED", 7)  # hits and comparisons cut into many parts
    assert automaton.shared_of(docs, segments) == expected
    assert [automaton.shared(d, s) for d, s in zip(docs, segments)] == expected
    assert automaton.shared_of([], []) == []


def test_hits_are_compared_together():
    # 40 passages share a block with each of 200 segments: no step for each of the 8,000 hits.
    block = [b"b%d" % i for i in range(5)]
    passages = [(0, block + [b"p%d_%d" % (p, i) for i in range(10)]) for p in range(40)]
    automaton = substring.PassageAutomaton(passages, 10, 5)
    segments = [block + [b"s%d_%d" % (s, i) for i in range(10)] for s in range(200)]
    steps = []
    previous = sys.getprofile()
    sys.setprofile(lambda frame, event, function: steps.append(event) if event == "c_call" else None)
    try:
        found = automaton.shared_of([1] * 200, segments)
    finally:
        sys.setprofile(previous)
    assert found == [[]] * 200
    assert len(steps) < 8_000


def test_words_of_many_texts():
    texts = ["", " a  bc\td ", "\n", "\x00 a\x00 a ab abcdefgh abcdefghi " + "é" * 40 + "\x1c ", "a" * 64 + " " + "a" * 65, "a bc d"]
    words = substring.Words(texts)
    plain = [substring.words_of(t) for t in texts]
    assert words.counts.tolist() == [len(w) for w in plain]
    assert [words.joined(i) for i in range(len(texts))] == [b" ".join(w) for w in plain]
    assert words.joined(1, 1, 9) == b"bc d" and words.joined(3, 3, 5) == b"ab abcdefgh"
    hashes = words.hashes()
    flat = [w for own in plain for w in own]
    assert hashes.tolist() == substring.Grams().word_hashes(flat).tolist()
    assert len(set(hashes.tolist())) == len(set(flat))
    g = np.array([5, 3, 9, 4, 4, 8, 1], np.uint64)
    for window, anchor in [(10, 10), (9, 5), (5, 3), (4, 1), (20, 2)]:
        width = window - anchor + 1
        assert substring.anchors(g, window, anchor).tolist() == [min(g[i : i + width]) for i in range(len(g) - width + 1)]
