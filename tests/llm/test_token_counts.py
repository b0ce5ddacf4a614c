import random

import numpy as np
import public_tokenizers
import pytest

from tenura.llm import token_counts
from tenura.llm.pieces import load_tokenizer
from tenura.llm.token_counts import LengthTable, TokenCounter, count_tokens, parts_at_spaces

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = list("aabbeesstdmrvl  ''''\n\t.,;:!-_<|>09éÉçßŉİıſǅ̀́​’あ漢😀ΣςΑ\x00\x1c\x85\xa0½²٣")
FIXED = [
    "", " ", "\n", "don't we'LL 'RE'd 's's ''s -'s", "<|endoftext|>", "<|ENDOFTEXT|> a", "a<|startoftext|>b",
    "1234567", "x" * 3000, "é" * 700 + "'s", "İstanbul", "café ́", " a　b",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = load_tokenizer(PATH)
    return lambda texts: [
        len(e.ids) for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)
    ]


def odd_texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS, k=rng.randrange(40))) for _ in range(count)] + FIXED


def test_counts_are_the_librarys(library):
    texts = odd_texts(4000)
    assert TokenCounter(PATH).counts(texts).tolist() == library(texts)


def test_table_and_small_memory_change_nothing(library, monkeypatch):
    texts = odd_texts(1500, seed=2)
    words = list(dict.fromkeys(w for t in texts for w in t.lower().split() if w.isascii() and w.isalpha()))
    counter = TokenCounter(PATH)
    table = LengthTable.build(words, counter.library(words))
    monkeypatch.setattr(token_counts, "REMEMBERED_CHARS", 200)
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", 30)
    assert TokenCounter(PATH, table).counts(texts).tolist() == library(texts)


def test_table_compares_characters():
    """Entries of another word under the same hash are no hits."""
    words = ["alpha", "beta", "gamma"]
    table = LengthTable.build(words, [1, 2, 3])
    codes = np.frombuffer("alpha beta delta gamma ".encode("utf-16-le"), np.uint16)
    starts, ends = np.array([0, 6, 11, 17]), np.array([5, 10, 16, 22])
    assert table.lookup(codes, starts, ends).tolist() == [1, 2, -1, 3]
    other = codes.copy()
    other[1] = ord("z")  # the hash is still that of alpha below
    hashes = token_counts.span_hashes(codes, starts, ends)
    patched = LengthTable(table.slots, table.hashes, table.codes, table.starts, table.sizes, table.tokens)
    original = token_counts.span_hashes
    token_counts.span_hashes = lambda *_: hashes
    try:
        assert patched.lookup(other, starts, ends).tolist() == [-1, 2, -1, 3]
    finally:
        token_counts.span_hashes = original


def test_parts_end_at_spaces():
    text = "ab cd\nefghijkl m"
    assert list(parts_at_spaces(text, 4)) == ["ab ", "cd\n", "efghijkl ", "m"]
    assert list(parts_at_spaces("abcdefgh", 3)) == ["abcdefgh"]
    for size in range(1, 20):
        assert "".join(parts_at_spaces(text, size)) == text


def test_documents(spark, rows, library):
    texts = [*odd_texts(300, seed=3), "word " * 3000, "verylongword" * 20_000, None, "same", "same"]
    data = [(i if i != 7 else None, t, 0, "x") for i, t in enumerate(texts)]
    data.append((0, texts[0], 1, "y"))
    docs = rows("doc_id long, text string, n_tokens int, key string", data)
    found = count_tokens(docs, PATH, limit=2048)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "bigint", "bigint", "boolean"]
    expected = sorted(
        ((d, len((t or "").encode()), n, n > 2048)
         for (d, t, _, _), n in zip(data, library([t or "" for _, t, _, _ in data]))), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    few = count_tokens(docs, PATH, words=3, sample_docs=5)
    assert sorted(map(tuple, few.collect()), key=str) == expected


def test_empty_table(rows):
    docs = rows("doc_id long, text string", [])
    assert count_tokens(docs, PATH).collect() == []


def test_no_shuffle_on_the_counting_path(rows):
    docs = rows("doc_id long, text string", [(1, "a b")])
    plan = count_tokens(docs, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
