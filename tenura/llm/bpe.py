"""Byte-level BPE encoding by a transducer of frequent words, and decoding.

The words of all documents are counted; the ids of the frequent ones are
compiled into a minimal acyclic transducer (see transducer), which every executor maps into memory. Each
distinct word of a batch is looked up there; a word that it lacks is merged pair by pair,
which gives the same ids. So the results don't depend on which words the lexicon holds.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.common import chunks, to_batch
from tenura.llm.pieces import (
    PieceIds, distinct_pieces, flat_ids, gather, space_piece_text, space_pieces,
)
from tenura.llm.transducer import Lexicon, compile_lexicon
from tenura.sources.shared import materialize, shared_folder

# Words in the transducer, by descending count. Bounds what the driver and each executor hold.
LEXICON_WORDS = 200_000
SEED = 7
# Distinct pieces of text that one task counts before it passes the counts on.
COUNTED = 200_000
# Fixed value: how the vocabulary's format splits text into words.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_letters() -> dict[str, int]:
    """The vocabulary's letter for each byte: printable ones stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids and merge ranks of a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters = byte_letters()
        text = lambda token: bytes(letters[c] for c in token)
        self.ids = {text(t): i for t, i in data["model"]["vocab"].items() if all(c in letters for c in t)}
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.ids = {t: i for t, i in self.ids.items() if i not in self.special.values()}
        self.ranks = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = (text(p) for p in (pair.split(" ") if isinstance(pair, str) else pair))
            a, b, both = self.ids[left], self.ids[right], self.ids[left + right]
            self.ranks[a, b] = (rank, both)
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self._split = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ) if self.special else None

    def words(self, text: str) -> list[str]:
        """Words of a text; special tokens are words of their own."""
        if self._split is None or not self._split.search(text):
            return WORDS.findall(text)
        found: list[str] = []
        for i, part in enumerate(self._split.split(text)):
            found += [part] if i % 2 else WORDS.findall(part)
        return found

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the pair of lowest rank is joined, the first of equal ones."""
        ids = [self.single[b] for b in word]
        ranks, size = self.ranks, len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        # (rank, place of the left id, both ids); entries whose ids have changed are skipped.
        heap = [(ranks[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= size or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = ranks[pair][1], -1
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                if (new := (ids[i], ids[k])) in ranks:
                    heapq.heappush(heap, (ranks[new][0], i, new))
            if (h := before[i]) >= 0 and (new := (ids[h], ids[i])) in ranks:
                heapq.heappush(heap, (ranks[new][0], h, new))
        return [i for i in ids if i >= 0]

    def decode_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all ids in a row, and where each id's start and how many they are."""
        most = max(self.bytes_of) + 1
        parts = [self.bytes_of.get(i, b"") for i in range(most)]
        lengths = np.array([len(p) for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths


class Merger:
    """Merges many words at once: in each step, every word's pair of lowest rank is joined."""

    NONE = np.int32(2**31 - 1)
    LONGEST = 48  # longer words are merged one by one

    def __init__(self, vocabulary: Vocabulary, bits: int = 19):
        self.vocabulary = vocabulary
        self.single = np.array(vocabulary.single, np.int64)
        pairs = np.array([(a << 32 | b, r, m) for (a, b), (r, m) in vocabulary.ranks.items()], np.int64)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, self.NONE, np.int32)
        self.merged = pairs[np.argsort(pairs[:, 1]), 2] if len(pairs) else np.zeros(0, np.int64)
        slots = self._slot(pairs[:, 0]) if len(pairs) else np.zeros(0, np.int64)
        left = np.arange(len(pairs))
        while len(left):  # each free slot takes one of the pairs that want it
            wanted, one = np.unique(slots[left], return_index=True)
            free = self.keys[wanted] == -1
            wanted, one = wanted[free], left[one[free]]
            self.keys[wanted], self.ranks[wanted] = pairs[one, 0], pairs[one, 1]
            left = np.setdiff1d(left, one)
            slots[left] = (slots[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def rank(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        found = self.keys[slots]
        ranks = np.where(found == keys, self.ranks[slots], self.NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            ranks[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return ranks

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        parts: list = [None] * len(words)
        order = np.argsort(lengths, kind="stable")
        for i in np.flatnonzero((lengths > self.LONGEST) | (lengths == 0)).tolist():
            parts[i] = self.vocabulary.merge(words[i])
        order = order[(lengths[order] <= self.LONGEST) & (lengths[order] > 0)]
        for at in range(0, len(order), 8192):
            own = order[at : at + 8192]
            for i, ids in zip(own.tolist(), self._merge([words[j] for j in own], lengths[own])):
                parts[i] = ids
        return flat_ids(parts)

    def _merge(self, words: list[bytes], lengths: np.ndarray) -> list[list[int]]:
        n, width = len(words), int(lengths.max())
        inside = np.arange(width) < lengths[:, None]
        grid = np.full((n, width), -1, np.int64)
        grid[inside] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        rows, work, counts = np.arange(n), grid.copy(), lengths.copy()
        while width > 1 and len(rows):
            pairs = work[:, :-1] << 32 | work[:, 1:]
            ranks = np.full(pairs.shape, self.NONE, np.int32)
            real = work[:, 1:] >= 0
            ranks[real] = self.rank(pairs[real])
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(rows)), best]
            done = rank == self.NONE
            grid[rows[done], : work.shape[1]] = work[done]
            keep = ~done
            rows, work, best, rank = rows[keep], work[keep], best[keep], rank[keep]
            if not len(rows):
                break
            counts[rows] -= 1
            column = np.arange(work.shape[1] - 1)
            shifted = np.take_along_axis(work, column + (column > best[:, None]), axis=1)
            shifted[np.arange(len(rows)), best] = self.merged[rank]
            work = shifted
            width = work.shape[1]
        grid[rows, : work.shape[1]] = work
        return [row[:c] for row, c in zip(grid.tolist(), counts.tolist())]


class WordEncoder:
    """Ids of pieces: distinct words by the transducer, missing words by merging."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon, self.merger = vocabulary, lexicon, Merger(vocabulary)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words_of = [self.vocabulary.words(t) for t in texts]
        numbers: dict[str, int] = {}
        for words in words_of:
            for word in words:
                numbers.setdefault(word, len(numbers))
        distinct = list(numbers)
        coded = [w.encode() for w in distinct]
        ranks = self.lexicon.ranks(coded)
        for i, word in enumerate(distinct):
            if word[:1] == "<" and word in self.vocabulary.special:
                ranks[i] = -2
        known, missing = np.flatnonzero(ranks >= 0), np.flatnonzero(ranks == -1)
        special = np.flatnonzero(ranks == -2)
        begin = self.lexicon.starts[ranks[known]].astype(np.int64)
        size = self.lexicon.starts[ranks[known] + 1].astype(np.int64) - begin
        merged, counts = self.merger([coded[i] for i in missing])
        own = np.array([self.vocabulary.special[distinct[i]] for i in special], np.uint32)
        flat = np.concatenate([gather(self.lexicon.ids, begin, size), merged, own])
        lengths = np.zeros(len(distinct), np.int64)
        order = np.concatenate([known, missing, special])
        lengths[order] = np.concatenate([size, counts, np.ones(len(special), np.int64)])
        starts = np.zeros(len(distinct), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]

        per_piece = np.fromiter(map(len, words_of), np.int64, len(words_of))
        used = np.fromiter(
            map(numbers.__getitem__, chain.from_iterable(words_of)), np.int64, int(per_piece.sum())
        )
        upto = np.concatenate([[0], np.cumsum(lengths[used])])
        ends = upto[np.cumsum(per_piece)]
        return gather(flat, starts[used], lengths[used]), np.diff(ends, prepend=0)


def word_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """How often each word occurs in the whole texts: word (binary), n."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)

        def flush(pieces: Counter) -> pa.RecordBatch:
            words: Counter = Counter()
            for piece, n in pieces.items():
                if piece.isalpha() and piece.isascii():  # one word with its space
                    words[" " + piece] += n
                    continue
                for word in vocabulary.words(space_piece_text(piece)):
                    words[word] += n
            return to_batch(schema, [[w.encode() for w in words], list(words.values())])

        pieces: Counter = Counter()
        for rows in chunks(batches, 0):
            distinct, which, _ = distinct_pieces([r[0] for r in rows], space_pieces)
            for piece, n in zip(distinct, np.bincount(which, minlength=len(distinct)).tolist()):
                pieces[piece] += n
            if len(pieces) > COUNTED:
                yield flush(pieces)
                pieces = Counter()
        yield flush(pieces)

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(
    docs: DataFrame,
    path: str,
    text: str = "text",
    size: int = LEXICON_WORDS,
    sample_bytes: int | None = None,
) -> bytes:
    """The compiled transducer of at most ``size`` frequent words.

    They are counted in all documents; a caller may have documents of about ``sample_bytes``
    counted instead, a share of all rows taken by chance. Words are taken from a least count on, the smallest that leaves at most
    ``size`` of them; so there is no sort, and no task gathers the words of the others.
    """
    vocabulary = Vocabulary(path)
    rows = docs.select(text)
    if sample_bytes is not None:
        total = rows.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
        rows = rows.sample(sample_bytes / total, seed=SEED) if total > sample_bytes else rows
    counts = materialize(word_counts(rows, path, text).where(F.length("word") > 0), "bpe-words")
    # The counts that occur are few: their sum is at most the number of words.
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()
    least, taken = None, 0
    for row in sorted(histogram, key=lambda r: -r["n"]):
        taken += row["words"]
        if taken > size:
            break
        least = row["n"]
    frequent = counts.where(F.col("n") >= least) if least else counts.limit(0)
    words = sorted(bytes(r["word"]) for r in frequent.select("word").toLocalIterator())
    ids, lengths = Merger(vocabulary)(words)
    return compile_lexicon(zip(words, map(np.ndarray.tolist, np.split(ids, np.cumsum(lengths)[:-1]))))


def share_file(spark: SparkSession, data: bytes, name: str) -> str:
    """Write bytes to the shared folder and have Spark give every executor a copy.

    Returns the name to look up with SparkFiles on an executor.
    """
    folder = shared_folder(spark)
    own = f"{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{folder}/tenura/{own}")
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place)
    for i in range(0, len(data), 1 << 24):
        out.write(bytearray(data[i : i + (1 << 24)]))
    out.close()
    spark.sparkContext.addFile(str(place.toString()))
    return own


def encode_documents(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    lexicon: bytes | None = None,
) -> DataFrame:
    """Ids of every whole text, as columns of the key and ``ids`` (little-endian u32 bytes).

    ``path`` is a byte-level vocabulary file. A null text is empty and has no ids; the text
    of a special token is that token. All rows are kept, also repeated ones and null keys.
    """
    spark = docs.sparkSession
    if lexicon is None:
        lexicon = build_lexicon(docs, path, text)
    shared = share_file(spark, lexicon, "lexicon")
    kind = docs.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, ids binary"

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceIds(WordEncoder(Vocabulary(path), Lexicon.mapped(SparkFiles.get(shared))))
        for rows in chunks(batches):
            ids = encoder.ids_of([r[1] for r in rows])
            keys = pa.array([r[0] for r in rows], type=_arrow(kind))
            found = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, found], names=[key, "ids"])

    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(encode, schema)


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class Decoder:
    """Texts of ids. Bytes that aren't UTF-8 become U+FFFD, as in the library."""

    def __init__(self, vocabulary: Vocabulary):
        self.flat, self.starts, self.lengths = vocabulary.decode_table()

    def text(self, ids: np.ndarray) -> str:
        inside = ids[ids < len(self.lengths)].astype(np.int64)
        data = gather(self.flat, self.starts[inside], self.lengths[inside])
        return data.tobytes().decode("utf-8", "replace")


def digest_documents(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Decode each row's ids and describe both: key, n_tokens, ids_sha256, decoded_sha256.

    The ids' digest is of their decimal numbers joined by commas, the text's of its UTF-8.
    """
    kind = encoded.schema[key].dataType

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        decoder = Decoder(vocabulary)
        numbers = [str(i) for i in range(max(vocabulary.bytes_of) + 1)]
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                n, ids_hash, text_hash = [], [], []
                for raw in part.column(1):
                    ids = np.frombuffer(raw.as_buffer(), "<u4")
                    decimal = ",".join(map(numbers.__getitem__, ids.tolist()))
                    n.append(len(ids))
                    ids_hash.append(hashlib.sha256(decimal.encode()).hexdigest())
                    text_hash.append(hashlib.sha256(decoder.text(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = (
        f"`{key}` {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return encoded.select(key, "ids").mapInArrow(digest, schema)
