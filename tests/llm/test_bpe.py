import hashlib
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tenura.llm import bpe
from tenura.llm.pieces import PieceIds, library_encoder, load_tokenizer, word_piece_text, word_pieces
from tenura.llm.transducer import Lexicon, compile_lexicon

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD_PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ü", "1", "²", "Ⅷ", "!", ".", ",", "<|endoftext|>", "<|end",
    "\x1c", "\x85", "\xa0", "the", "\x00", "中", "😀", "́", "\r", "ing", "İ", "ſ", "Σ", "A", "<|startoftext|>",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def texts(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 12))) for _ in range(n)]


def test_transducer_finds_words_and_shares_suffixes():
    words = sorted({b"walking", b"talking", b"walk", b"talk", b"a", b"", b"walked", b"talked"})
    data = compile_lexicon((w, [i, i + 1]) for i, w in enumerate(words))
    lexicon = Lexicon(data)
    assert lexicon.ranks([*words, b"w", b"walkings", b"zz", b"alk"]).tolist() == [*range(len(words)), -1, -1, -1, -1]
    assert [lexicon.ids_of(i) for i in range(len(words))] == [[i, i + 1] for i in range(len(words))]
    # "alking", "alked", "alk" are kept once for both first letters.
    assert len(lexicon.final) < len(b"walkinged") + 5
    with pytest.raises(ValueError):
        compile_lexicon([(b"b", [1]), (b"a", [2])])


def test_empty_transducer():
    assert Lexicon(compile_lexicon([])).ranks([b"a", b""]).tolist() == [-1, -1]


def test_ids_equal_the_library(vocabulary):
    library = load_tokenizer(PATH)
    some = sorted({b" the", b"ing", b"a", b" a", "é".encode()})
    own = PieceIds(bpe.WordEncoder(vocabulary, Lexicon(compile_lexicon((w, vocabulary.merge(w)) for w in some))))
    other = PieceIds(library_encoder(PATH), remembered=50)
    for text in texts(3000):
        expected = library.encode(text, add_special_tokens=False).ids
        assert own.ids_of([text])[0].tolist() == expected
        assert other.ids_of([text])[0].tolist() == expected


def test_word_ids_equal_the_library():
    library = load_tokenizer(WORD_PATH)
    own = PieceIds(library_encoder(WORD_PATH), word_pieces, word_piece_text)
    every = texts(3000, 5)
    for text, ids in zip(every, own.ids_of(every)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_merging_many_words_equals_one_by_one(vocabulary):
    r = random.Random(1)
    words = [bytes(r.choice(b"abcdeinrst ") for _ in range(r.randint(0, 60))) for _ in range(400)]
    ids, lengths = bpe.Merger(vocabulary)(words)
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    assert [p.tolist() for p in parts] == [vocabulary.merge(w) for w in words]


def test_long_words_equal_rescanning_and_end(vocabulary):
    def rescanned(word):
        ids = [vocabulary.single[b] for b in word]
        while ranked := [(vocabulary.ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in vocabulary.ranks]:
            (_, both), i = min(ranked)
            ids[i : i + 2] = [both]
        return ids

    random.seed(5)
    for letters in ("ab", "aeinrst", "=-", "thequickbrown", "éß日"):
        for size in (0, 1, 2, 3, 60, 400):
            word = "".join(random.choice(letters) for _ in range(size)).encode()
            assert vocabulary.merge(word) == rescanned(word)
    word = "".join(random.choice("aeinrst") for _ in range(1_000_000))
    started = time.process_time()
    ids = vocabulary.merge(word.encode())
    assert time.process_time() - started < 60
    assert b"".join(vocabulary.bytes_of[i] for i in ids) == word.encode()


def test_decoding_equals_the_library(vocabulary):
    library, decoder, r = load_tokenizer(PATH), bpe.Decoder(vocabulary), random.Random(2)
    for _ in range(500):
        ids = [r.randrange(50257) if r.random() < 0.5 else r.randrange(300) for _ in range(r.randint(0, 8))]
        assert decoder.text(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)


def test_documents(spark, rows):
    library = load_tokenizer(PATH)
    every = [*texts(200), None, "", "same", "same", "long " * 20_000]
    docs = rows("doc_id long, text string, ids string", [(i, t, "clash") for i, t in enumerate(every)])
    for lexicon in (None, bpe.build_lexicon(docs, PATH, size=3), bpe.build_lexicon(docs, PATH, sample_bytes=2_000)):
        encoded = bpe.encode_documents(docs, PATH, lexicon=lexicon)
        got = {r["doc_id"]: tuple(r)[1:] for r in bpe.digest_documents(encoded, PATH).collect()}
        for i, t in enumerate(every):
            ids = library.encode(t or "", add_special_tokens=False).ids
            assert got[i] == (
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest(),
            )


def test_empty_table_and_null_keys(spark, rows):
    empty = rows("doc_id long, text string", [])
    assert bpe.digest_documents(bpe.encode_documents(empty, PATH), PATH).count() == 0
    one = rows("doc_id long, text string", [(None, "a"), (None, "a")])
    assert bpe.digest_documents(bpe.encode_documents(one, PATH), PATH).count() == 2


def test_lexicon_counts_the_words_of_all_documents(spark):
    # 80 MB, each document with a word of its own.
    own = F.concat(F.lit("zq"), F.translate(F.lpad(F.col("id").cast("string"), 2, "0"), "0123456789", "abcdefghij"))
    docs = spark.range(80).select(F.concat(F.repeat(F.lit("word and "), 111_000), own).alias("text"))
    words = [f" zq{a}{b}".encode() for a in "abcdefgh" for b in "abcdefghij"]
    assert (Lexicon(bpe.build_lexicon(docs, PATH)).ranks(words) >= 0).all()


def test_counted_words_equal_those_of_whole_texts(spark, rows, vocabulary):
    every = [*texts(100), "plain Words, é and 12 don't\n\nend.", "a", ""]
    docs = rows("text string", [(t,) for t in every])
    wanted = Counter(w.encode() for t in every for w in vocabulary.words(t))
    assert {bytes(r["word"]): r["n"] for r in bpe.word_counts(docs, PATH).collect()} == wanted
