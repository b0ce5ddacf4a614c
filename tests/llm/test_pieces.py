import public_tokenizers
import pyarrow as pa

from tenura.llm.common import chunks, slices
from tenura.llm.language import UNKNOWN, identify
from tenura.llm.pieces import (
    PieceIds, distinct_pieces, library_encoder, load_tokenizer, space_pieces, word_piece_text,
    word_pieces, worker_pieces,
)

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_special_strings_in_capitals_are_words():
    texts = ["hello <|ENDOFTEXT|> you", "<|endoftext|> A", "<|EndOfText|>", "a < B", "PLAIN Words"]
    tokenizer = load_tokenizer(WORDS)
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    found = PieceIds(library_encoder(WORDS), word_pieces, word_piece_text).ids_of(texts)
    assert [ids.tolist() for ids in found] == expected
    assert expected[0] != expected[1] and 49407 not in expected[0]


def test_a_worker_keeps_its_memory():
    first = worker_pieces(WORDS, word_pieces, word_piece_text)
    first.ids_of(["some words"])
    assert worker_pieces(WORDS, word_pieces, word_piece_text) is first and "some" in first.index
    cleared = first.cleared
    first.remembered = 1
    assert [ids.tolist() for ids in first.ids_of(["other words", "some"])] == [
        ids.tolist() for ids in PieceIds(library_encoder(WORDS), word_pieces, word_piece_text).ids_of(
            ["other words", "some"])]
    assert first.cleared > cleared


def test_batches_are_cut_by_their_bytes():
    texts = ["é" * 300, None, "", "x" * 1000, *["abc"] * 20]
    batch = pa.RecordBatch.from_pydict({"k": list(range(24)), "t": pa.array(texts)})
    parts = list(slices(batch, 1, 900))
    assert sum(p.num_rows for p, _ in parts) == 24 and all(s <= 900 or p.num_rows == 1 for p, s in parts)
    for limit in (1, 900, 10**6):
        rows = [r for c in chunks([batch, batch.slice(3, 5)], limit=limit) for r in c]
        assert [r[1] for r in rows] == [t or "" for t in texts + texts[3:8]]
    assert next(chunks([batch], nulls=True))[1] == (1, None)


def test_text_may_be_kept_and_names_may_clash(rows):
    docs = rows("doc_id long, text string, _text string, c1 int", [(1, None, "x", 5), (2, "a", None, 6)])
    found = identify(docs, None, columns=["_text", "text", "c1"])
    assert found.columns == ["doc_id", "_text", "text", "c1", "lang_pred", "score"]
    assert sorted(map(tuple, found.collect())) == [(1, "x", None, 5, UNKNOWN, 0.0), (2, None, "a", 6, UNKNOWN, 0.0)]


TEXTS = [
    "", " ", "a  b", "plain words.\nand, more", "\x00x y", "tail ", "\n\nx", "x\ty z", "é x", "\u2003a b",
    "The the THE", "ªµß Straße's", "İstanbul ıx ǅ ﬁ", "don't Ünïcode日本語 word", "e\u0301a áb cd",
]


def test_distinct_pieces_are_those_of_the_split():
    for split in (space_pieces, word_pieces):
        for texts in (TEXTS, TEXTS[:1], TEXTS[3:4], [], TEXTS[::-1] * 2):
            distinct, which, counts = distinct_pieces(texts, split)
            expected = [split(t) for t in texts]
            assert len(set(distinct)) == len(distinct)
            assert counts.tolist() == [len(p) for p in expected]
            assert [distinct[i] for i in which] == [piece for pieces in expected for piece in pieces]


def test_words_of_letters_have_the_ids_of_the_whole_library():
    words = ["the", "Thlyouble", "ciónñí", "ǅ", "ß", "ª", "İx", "ſt", "kΑ", "日本", "x²", "it's", "éa", "a1"]
    for path in (WORDS, BYTES):
        tokenizer, encode = load_tokenizer(path), library_encoder(path)
        for texts in (words, [" " + w for w in words], ["\n" + w for w in words], ["", " "]):
            flat, lengths = encode(texts)
            expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
            assert lengths.tolist() == [len(ids) for ids in expected]
            assert flat.tolist() == [i for ids in expected for i in ids]


def test_frequent_pieces_are_learned_once():
    tokenizer = load_tokenizer(BYTES)
    known, learned = PieceIds(library_encoder(BYTES), remembered=40), []
    learn = known._learn
    known._learn = lambda pieces: learned.extend(pieces) or learn(pieces)
    for i in range(30):
        texts = [f"w{i} often, again.\nand again x{i}y é{i}. z{i}", f"often {i}"]
        expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids.tolist() for ids in known.ids_of(texts)] == expected
        assert len(known.index) == len(known.keys) <= 50 and known.index[known.keys[-1]] == len(known.keys) - 1
    assert known.cleared > 3 and learned.count("again") == learned.count("often,") == 1
