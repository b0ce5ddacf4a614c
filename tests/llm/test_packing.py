import zlib

import numpy as np
import public_tokenizers
import pytest

from tenura.llm import packing
from tenura.llm.pieces import load_tokenizer
from tests.llm import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(30))
def test_cuts_cost_least(seed):
    random = np.random.default_rng(seed)
    size = int(random.choice([8, 16, 64]))
    documents = np.cumsum(random.integers(1, 3 * size, random.integers(1, 12)))
    total = int(documents[-1])
    sentences = np.unique(random.integers(1, total + 1, random.integers(0, 20)))
    costs = packing.Costs(1.0, 1.0, 1.5)
    cuts = packing.choose_cuts(total, documents, sentences, size, costs)
    lengths = np.diff([0, *cuts])
    assert cuts[-1] == total and lengths.min() > 0 and lengths.max() <= size
    cost = 0.0
    for start, cut in zip([0, *cuts], cuts):
        length, end = cut - start, cut in set(documents.tolist())
        cost += costs.sequence + (0 if end and length & (length - 1) == 0 else size - length)
        cost += 0 if end else costs.sentence if cut in sentences else costs.inside
    assert cost == pytest.approx(brute.pack_cost(total, documents, sentences, size, costs))


def check_pieces(rows, texts, size):
    tokenizer = load_tokenizer(PATH)
    ids = {d: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for d, t in texts.items()}
    covered, sequences = {}, {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        own = ids[r["doc_id"]]
        piece = own[r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"] and len(own) == r["doc_tokens"]
        assert sequences.get(r["sequence_id"], 0) == r["offset"]
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
        covered.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert max(sequences.values()) <= size
    assert set(covered) == set(texts)
    for d, parts in covered.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == len(ids[d])
    return sequences


def test_every_id_is_packed_once(spark, rows):
    texts = {1: "One two. Three", 2: None, 3: "", 4: "word " * 500, 5: "Hi <|endoftext|> there", 6: "ÀÉ ï. İ"}
    docs = rows("doc_id long, text string, start int", [(d, t, 0) for d, t in texts.items()])
    check_pieces(packing.pack_documents(docs, PATH, 1, size=64).collect(), texts, 64)


def test_little_padding(spark, rows):
    texts = {d: "Some words of a text. " * (d % 37) for d in range(400)}
    docs = rows("doc_id long, text string", list(texts.items())).coalesce(1)
    lengths = check_pieces(packing.pack_documents(docs, PATH, 1, size=256).collect(), texts, 256).values()
    padding = sum(256 - n for n in lengths if n & (n - 1))
    assert padding < 0.02 * sum(lengths)


def test_repeated_rows_null_ids_and_runs(spark, rows):
    docs = rows("doc_id long, text string", [(7, "a b c")] * 3 + [(None, "x")])
    found = packing.pack_documents(docs, PATH, 1, size=8, run_ids=4).collect()
    assert sum(r["length"] for r in found) == 3 * 4 + 2
    assert sum(r["doc_id"] is None for r in found) == 1


def test_empty_table(spark, rows):
    assert packing.pack_documents(rows("doc_id long, text string", []), PATH, 1).count() == 0
