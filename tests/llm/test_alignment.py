import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tenura.llm import alignment
from tenura.llm.alignment import align_documents, coalesced_groups, packed, unpacked

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    """(ids, token bytes) of a text under both tokenizers, by the libraries' own decoders."""
    import base64

    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(BYTES)
    byte_level.encode_special_tokens = True
    ranks = {}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        for token, number in map(bytes.split, file):
            ranks[int(number)] = base64.b64decode(token)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def of(text):
        a = byte_level.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        spelt = []
        for i in b:
            piece = model.id_to_piece(i)
            spelt.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        return (a, [ranks[i] for i in a]), (b, spelt)

    return of


def spans(parts):
    found, at = [], 0
    for p in parts:
        found.append((at, at + len(p)))
        at += len(p)
    return found


def brute(docs, tokens):
    rows, linked = [], []
    for key, text in docs:
        (a, a_bytes), (b, b_bytes) = tokens(text) if text else (([], []), ([], []))
        whole = (" " + (text or "")).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            rows.append((key, 0, 0, 0, 0, ""))
            linked.append([])
            continue
        sa, sb = spans(a_bytes), spans(b_bytes)
        links = [(x, y) for x, (s, e) in zip(a, sa) for y, (u, v) in zip(b, sb) if s < v and u < e]
        groups, low = [], 0
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        for cut in cuts:
            groups.append("|".join(
                ",".join(str(i) for i, (s, _) in zip(ids, at) if low <= s < cut) for ids, at in ((a, sa), (b, sb))))
            low = cut
        rows.append((key, len(a), len(b), len(cuts), len(links),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
        linked.append(links)
    docs_of = Counter(p for links in linked for p in set(links))
    best = defaultdict(int)
    for (a, _), n in docs_of.items():
        best[a] = max(best[a], n)
    return sorted(
        ((*r[:5], sum(docs_of[p] == best[p[0]] for p in links), sum(docs_of[p] for p in links), r[5])
         for r, links in zip(rows, linked)), key=str)


def texts_of(count, seed=4):
    rng = random.Random(seed)
    words = ["the", "Paris", "éléphant", "naïve", "漢字", "😀", "under_score", "3.14", "a", "  ", "\n", "\t",
             "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>", "don't", "Straße", "\x00", "▁", "ńΑ"]
    return ["".join(rng.choices(words + [" "] * 12, k=rng.randrange(25))) for _ in range(count)]


def test_documents_equal_brute_force(rows, tokens):
    texts = [*texts_of(250), "", None, " ", "x", "same text", "same text", "word " * 700, "abc" * 900]
    data = [(i if i != 9 else None, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    docs = rows("doc_id long, text string, block long, n_a string", [(*d, 1, "z") for d in data])
    expected = brute(data, tokens)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for links in (50, alignment.BLOCK_LINKS):
        found = align_documents(docs.repartition(3), BYTES, PIECES, block_links=links)
        assert found.columns == columns
        assert sorted(map(tuple, found.collect()), key=str) == expected
    assert sum(r[1] > 0 for r in expected) > 100


def test_no_tokens_anywhere(rows):
    docs = rows("doc_id long, text string", [(1, None), (2, ""), (3, "▁")])
    found = align_documents(docs, BYTES, PIECES)
    assert sorted(map(tuple, found.collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
    nothing = rows("doc_id long, text string", [])
    assert align_documents(nothing, BYTES, PIECES).collect() == []


def test_groups_of_intervals():
    a_starts, a_ends = np.array([0, 3, 5, 9]), np.array([3, 5, 9, 12])
    b_starts, b_ends = np.array([0, 1, 5, 7, 9, 10]), np.array([1, 5, 7, 9, 10, 12])
    order, group, a, b = coalesced_groups(a_starts, a_ends, b_starts, b_ends)
    assert order.tolist() == [0, 1, 4, 5, 2, 6, 7, 3, 8, 9]
    assert group.tolist() == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3), (3, 4), (3, 5)]


def test_long_digests_in_parts(rows, tokens, monkeypatch):
    monkeypatch.setattr(alignment, "DIGEST_TOKENS", 7)
    aligner = alignment._aligner(BYTES, PIECES)
    texts = ["one two three " * 30, "", "naïve words"]
    found, _, _ = aligner.align(texts)
    expected = brute([(i, t) for i, t in enumerate(texts)], tokens)
    assert [r[-1] for r in expected] == list(found["groups_sha256"])


def test_packed_numbers():
    values = np.array([0, 5, -3, 2**31 - 1])
    assert unpacked(packed(values), 4).tolist() == values.tolist()
    assert unpacked(packed(np.zeros(0)), 0).tolist() == []


def test_pieces_are_aligned_once(monkeypatch):
    aligner = alignment.Aligner(
        alignment.Side(alignment.ByteLevelTokens(BYTES)), alignment.Side(alignment.PieceTokens(PIECES)))
    aligner.known.remembered = 60
    learned = []
    align = aligner.align_pieces
    monkeypatch.setattr(aligner, "align_pieces", lambda pieces: learned.extend(pieces) or align(pieces))
    for seed in range(8):
        texts = ["the same\nwords, again.", *texts_of(9, seed), f"w{seed} é{seed}"]
        found, owner, pairs = aligner.align(texts)
        whole, *links = aligner.align_whole(texts)
        assert {n: list(v) for n, v in found.items()} == {n: list(v) for n, v in whole.items()}
        assert sorted(zip(owner.tolist(), pairs.tolist())) == sorted(zip(*(x.tolist() for x in links)))
        assert (np.diff(owner) >= 0).all()
    assert learned.count("\nwords,") == 1 and aligner.known.cleared > 1


def test_models_of_logarithms_are_aligned_whole():
    side = alignment.PieceTokens(PIECES)
    assert side.divides
    model, score = side.model, side.model.get_score
    side.model = type("Model", (), {"__getattr__": lambda _, name: getattr(model, name),
                                    "get_score": lambda _, n: score(n) - 0.5})()
    assert not side._ranked()
