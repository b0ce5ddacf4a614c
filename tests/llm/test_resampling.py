import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tenura.llm.resampling import Features, bucket_counts, bucket_gains, checksums, resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_features(text, longest=2):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1)
            for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) for r in runs]


def brute(docs, target, percent=25, least_words=20, buckets=10_000):
    """Rows of (key, n_features, weight, score, rank) by plain counting and sorting."""
    s = Counter(c % buckets for _, t in docs for c in plain_features(t)[1])
    t = Counter(c % buckets for x in target for c in plain_features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    rows, eligible = [], []
    for key, text in docs:
        n_words, found = plain_features(text)
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
            for b in (c % buckets for c in found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None])
        if n_words >= least_words:
            eligible.append(rows[-1])
    eligible.sort(key=lambda r: (-r[3], r[0] is not None, r[0]))
    for rank, row in enumerate(eligible[: percent * len(eligible) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=str)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


def some_texts(count, seed=2):
    rng = random.Random(seed)
    words = ["the", "Of", "and", "Zürich", "é", "漢字", "x1", "42", "a", "bb"] + [f"w{i}" for i in range(60)]
    return [" ".join(rng.choices(words, k=rng.randrange(45))) for _ in range(count)]


def test_checksums():
    rng = random.Random(1)
    strings = [bytes(rng.choices(range(256), k=rng.choice([0, 1, 2, 3, 7, 40, 300]))) for _ in range(500)]
    flat = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings])
    assert checksums(flat, sizes).tolist() == [zlib.crc32(s) for s in strings]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_features_of_a_slice_of_texts(longest):
    rng = random.Random(3)
    texts = [None, "", "a", "AB ", " x"] + [
        "".join(rng.choices("abAZ09é漢 .,|'\n", k=rng.randrange(60))) for _ in range(800)
    ] + ["x" * 700 + " y", None]
    whole = pa.array(texts)
    for array, part in ((whole, texts), (whole.slice(3, 90), texts[3:93]), (pa.array([None], pa.string()), [None])):
        found = Features(array, longest, 977)
        for i, text in enumerate(part):
            n_words, crc = plain_features(text, longest)
            assert found.n_words[i] == n_words and found.n_features[i] == len(crc)
            assert sorted(found.bucket[found.owner == i].tolist()) == sorted(c % 977 for c in crc)


def test_bytes_under_a_null_are_no_text():
    hidden = pa.Array.from_buffers(
        pa.string(), 2, [pa.py_buffer(b"\x02"), pa.py_buffer(np.array([0, 3, 6], np.int32)), pa.py_buffer(b"abcdef")]
    )
    found = Features(hidden)
    assert found.n_words.tolist() == [0, 1]


def test_resampling_equals_brute_force(rows):
    texts = some_texts(400) + [None, "", "one two", "word " * 5000, "longword" * 50_000 + " a" * 30]
    data = [(i, t) for i, t in enumerate(texts)]
    data += [(i, "and the of a " * 8) for i in range(900, 940)]  # copies
    data += [(None, "and of the a " * 9), (3, texts[3]), (5, "other " * 25)]
    data += [(77, "the and of " * 10)] * 30  # one key of many rows
    target = some_texts(30, seed=9) + [None, ""]
    docs = rows("doc_id long, text string, score string, rank int",
                [(*d, "x", 1) for d in data]).repartition(5)
    wanted = rows("item_id long, text string", list(enumerate(target)))
    found = resample(docs, wanted)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.simpleString() for f in found.schema} == {"bigint"}
    assert collected(found) == brute(data, target)
    assert collected(resample(docs, wanted, percent=100, least_words=0)) == brute(data, target, 100, 0)
    assert collected(resample(docs, wanted, buckets=50, percent=3)) == brute(data, target, 3, 20, 50)


def test_empty_tables(rows):
    nothing = rows("doc_id long, text string", [])
    data = [(i, t) for i, t in enumerate(some_texts(40))]
    docs = rows("doc_id long, text string", data)
    assert resample(nothing, docs).collect() == []
    assert collected(resample(docs, nothing)) == brute(data, [])


def test_tasks_hand_on_counts_of_buckets(rows):
    docs = rows("doc_id long, text string", [(i, "a b c") for i in range(100)]).repartition(4)
    counts = {r["bucket"]: r["n"] for r in bucket_counts(docs, buckets=7).collect()}
    assert sum(counts.values()) == 500
    gains = bucket_gains(bucket_counts(docs, buckets=7), bucket_counts(docs, buckets=7), 7)
    assert gains.tolist() == [0] * 7
