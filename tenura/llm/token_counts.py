"""Tokens of each text, counted where the text lies: a broadcast table, then worker caches.

Texts are cut into pre-tokens by array operations on their code points. The lengths (in
tokens) of frequent pre-tokens are looked up in a compact hash table that every task
holds; only the others are given to the tokenizers library, each once per worker memory.
No pre-token is ever shuffled. The table speeds up the count and never changes it: each
hit is compared character by character.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from tenura.llm.common import chunks, to_batch
from tenura.llm.pieces import gather, load_tokenizer

# Pre-tokens of the table, and documents and tasks that they are learnt from.
TABLE_WORDS = 32_768
SAMPLE_DOCS = 2_000
SAMPLE_TASKS = 8
# A longer pre-token isn't put into the table, which bounds what is broadcast: at most
# 32,768 words of 64 bytes, with 14 bytes each and 65,536 slots of 4 bytes, about 3 MB.
TABLE_CHARS = 32
# Characters worked on at a time, and characters of pre-tokens that a worker remembers.
CHUNK_CHARS = 500_000
REMEMBERED_CHARS = 8_000_000
SEED = 5

# Below this code point a character is its own canonical composition, its class does not
# depend on its neighbours, and it has a lower case of one character, but for U+0130.
_NARROW = 0x250
_DOTTED_I = "İ"
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
# Odd multiplier of the rolling hash, and of the spread over slots.
_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _is_narrow(text: str) -> bool:
    return text.isascii() or (max(text) < chr(_NARROW) and _DOTTED_I not in text)


def character_kinds(tokenizer) -> np.ndarray:
    """Class of each narrow character, found by splitting it between letters and doubled."""

    def parts(text: str) -> int:
        normal = tokenizer.normalizer.normalize_str(text)
        return len(tokenizer.pre_tokenizer.pre_tokenize_str(normal))

    kinds = np.full(_NARROW, _OTHER, np.uint8)
    for code in range(_NARROW):
        c = chr(code)
        alone = parts(f"a{c}a")
        if alone == 1:
            kinds[code] = _LETTER
        elif alone == 2:
            kinds[code] = _SPACE
        elif parts(f"a{c}{c}a") == 4:
            kinds[code] = _DIGIT
    return kinds


def pre_token_spans(codes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of lower-case code points that end in a space.

    A pre-token is a run of letters, a single digit or a run of other characters; a run of
    others that starts with an apostrophe before s, t, m, d, re, ve or ll is that ending.
    """
    kind = kinds[codes]
    before = np.concatenate([[_SPACE], kind[:-1]])
    start = (kind != _SPACE) & ((kind != before) | (kind == _DIGIT))
    marks = np.flatnonzero(start & (codes == ord("'")))
    if len(marks):
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        first, second = padded[marks + 1], padded[marks + 2]
        short = np.isin(first, [ord(c) for c in "stmd"])
        long = np.zeros(len(marks), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (first == ord(a)) & (second == ord(b))
        start[marks[short | long] + 1] = False
        after = np.concatenate([marks[short] + 2, marks[long] + 3])
        start[after] = kind[after] != _SPACE
    stops = np.flatnonzero(start | (kind == _SPACE))
    opens = start[stops]
    return stops[opens], stops[np.flatnonzero(opens) + 1]


class Powers:
    """Powers of the hash's base and of its inverse, modulo 2**64, grown when needed."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def until(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, CHUNK_CHARS + 1)
            self.up, self.down = (self._powers(b, size) for b in (_BASE, pow(_BASE, -1, 2**64)))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)


_POWERS = Powers()


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each span, the same wherever it lies."""
    up, down = _POWERS.until(len(codes))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up, dtype=np.uint64)])
    return (upto[ends] - upto[starts]) * down[starts]


@dataclass(frozen=True)
class LengthTable:
    """Open-addressing hash table from pre-tokens to their numbers of tokens, as flat arrays."""

    slots: np.ndarray
    hashes: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray

    @staticmethod
    def build(words: list[str], tokens: list[int]) -> LengthTable:
        """Table of words and their tokens; those longer than ``TABLE_CHARS`` are left out."""
        short = [(w, n) for w, n in zip(words, tokens) if len(w) <= TABLE_CHARS]
        words, tokens = [w for w, _ in short], [n for _, n in short]
        codes = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        hashes = span_hashes(codes, ends - sizes, ends)
        bits = max(2, (2 * len(words) - 1).bit_length())
        slots = np.full(1 << bits, -1, np.int32)
        place = (hashes * _SPREAD) >> np.uint64(64 - bits)
        known = set()
        for i, (at, h) in enumerate(zip(place.tolist(), hashes.tolist())):
            if h in known:
                continue
            known.add(h)
            while slots[at] >= 0:
                at = (at + 1) & (len(slots) - 1)
            slots[at] = i
        return LengthTable(
            slots, hashes, codes, (ends - sizes).astype(np.uint32), sizes.astype(np.uint8),
            np.array(tokens, np.uint8),
        )

    def lookup(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of tokens of each span, -1 where the table lacks it."""
        found = np.full(len(starts), -1, np.int64)
        hashes = span_hashes(codes, starts, ends)
        mask = len(self.slots) - 1
        place = ((hashes * _SPREAD) >> np.uint64(64 - mask.bit_length())).astype(np.int64)
        seeking = np.arange(len(starts))
        while len(seeking):
            entry = self.slots[place[seeking]]
            seeking, entry = seeking[entry >= 0], entry[entry >= 0]
            hit = self.hashes[entry] == hashes[seeking]
            found[seeking[hit]] = entry[hit]
            seeking = seeking[~hit]
            place[seeking] = (place[seeking] + 1) & mask
        at = np.flatnonzero(found >= 0)
        entry = found[at]
        sizes = ends[at] - starts[at]
        alike = self.sizes[entry] == sizes
        found[at[~alike]] = -1
        at, entry, sizes = at[alike], entry[alike], sizes[alike]
        ours = gather(codes, starts[at], sizes)
        theirs = gather(self.codes, self.starts[entry].astype(np.int64), sizes)
        unlike = np.flatnonzero(ours != theirs)
        found[at] = self.tokens[entry]
        if len(unlike):
            found[at[np.searchsorted(np.cumsum(sizes), unlike, "right")]] = -1
        return found


class TokenCounter:
    """Numbers of tokens of whole texts: table first, then remembered lengths, then the library."""

    def __init__(self, path: str, table: LengthTable | None = None):
        self.tokenizer = load_tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kinds = character_kinds(self.tokenizer)
        self.table = table or LengthTable.build([], [])
        self.known: dict[str, int] = {}
        self.known_chars = 0

    def library(self, texts: list[str]) -> list[int]:
        found = []
        for i in range(0, len(texts), 4096):
            part = self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)
            found += [len(e) for e in part]
        return found

    def remembered(self, words: list[str]) -> list[int]:
        """Tokens of words that stand alone, each encoded once for the worker's memory."""
        new = list({w for w in words if w not in self.known})
        if new:
            size = sum(map(len, new))
            if self.known_chars + size > REMEMBERED_CHARS:
                self.known, self.known_chars = {}, 0
                new = list(set(words))
                size = sum(map(len, new))
            self.known.update(zip(new, self.library(new)))
            self.known_chars += size
        found = [self.known[w] for w in words]
        if self.known_chars > REMEMBERED_CHARS:  # a few words longer than the memory
            self.known, self.known_chars = {}, 0
        return found

    def spans(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Joined lower-case text, its code points, pre-token starts and ends, ends of texts."""
        joined = "".join(f"{t} " for t in texts).lower()
        codes = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
        starts, ends = pre_token_spans(codes, self.kinds)
        upto = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        return joined, codes, starts, ends, upto

    def _narrow(self, texts: list[str]) -> np.ndarray:
        joined, codes, starts, ends, upto = self.spans(texts)
        found = self.table.lookup(codes, starts, ends)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            words = [joined[a:b] for a, b in zip(starts[missing].tolist(), ends[missing].tolist())]
            found[missing] = self.remembered(words)
        total = np.concatenate([[0], np.cumsum(found)])
        return np.diff(total[np.searchsorted(starts, upto)], prepend=0)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text.

        Long texts are cut at spaces, where no pre-token goes on. A part that holds a special
        token goes to the library as it is. Of a part with other than narrow characters, the
        stretches between spaces that have them are remembered as if they were words.
        """
        total = np.zeros(len(texts), np.int64)
        narrow: list[str] = []
        owner: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal narrow, owner, size
            if narrow:
                np.add.at(total, owner, self._narrow(narrow))
            narrow, owner, size = [], [], 0

        for i, text in enumerate(texts):
            for part in parts_at_spaces(text, CHUNK_CHARS):
                if "<" in part and any(s in part for s in self.special):
                    total[i] += self.library([part])[0]
                    continue
                if not _is_narrow(part):
                    stretches = part.replace("\n", " ").split(" ")
                    wide = [s for s in stretches if not _is_narrow(s)]
                    total[i] += sum(self.remembered(wide))
                    part = " ".join(s for s in stretches if _is_narrow(s))
                narrow.append(part)
                owner.append(i)
                size += len(part)
                if size >= CHUNK_CHARS:
                    flush()
        flush()
        return total


def parts_at_spaces(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, each cut after a space or line end."""
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(" ", start, start + size), text.rfind("\n", start, start + size))
        if cut < start:
            after = [p for p in (text.find(" ", start + size), text.find("\n", start + size)) if p >= 0]
            if not after:
                break
            cut = min(after)
        yield text[start : cut + 1]
        start = cut + 1
    if start < len(text):
        yield text[start:]


def learn_lengths(
    docs: DataFrame,
    path: str,
    text: str = "text",
    words: int = TABLE_WORDS,
    sample_docs: int = SAMPLE_DOCS,
) -> LengthTable:
    """Table of the most frequent pre-tokens of about ``sample_docs`` documents.

    The sample is a share of all rows taken by chance, so that copies don't fill it. A few
    tasks count its pre-tokens and hand at most ``words`` each to the driver.
    """
    rows = docs.select(F.col(text).cast("string").alias("text"))
    share = min(1.0, sample_docs / max(rows.count(), 1))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(path)
        seen: Counter[str] = Counter()
        for chunk in chunks(batches, text=0, limit=CHUNK_CHARS):
            parts = [p for (t,) in chunk for p in parts_at_spaces(t, CHUNK_CHARS) if _is_narrow(p)]
            if parts:
                joined, _, starts, ends, _ = counter.spans(parts)
                seen.update(
                    joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())
                    if b - a <= TABLE_CHARS
                )
                if len(seen) > 16 * words:
                    seen = Counter(dict(seen.most_common(4 * words)))
        best = seen.most_common(words)
        if best:
            yield pa.RecordBatch.from_pydict(
                {"word": [w for w, _ in best], "n": [n for _, n in best]},
                schema=pa.schema([("word", pa.string()), ("n", pa.int64())]),
            )

    sampled = rows if share == 1.0 else rows.sample(share, seed=SEED)
    found: Counter[str] = Counter()
    for row in sampled.repartition(SAMPLE_TASKS).mapInArrow(count, "word string, n long").collect():
        found[row["word"]] += row["n"]
    frequent = sorted(found, key=lambda w: (-found[w], w))[:words]
    tokens = TokenCounter(path).library(frequent)
    return LengthTable.build(frequent, tokens)


_COUNTERS: dict[str, TokenCounter] = {}


def _counter(run_id: str, path: str, shared: Broadcast) -> TokenCounter:
    """The worker's counter: its table and memory stay from one task of a run to the next."""
    if run_id not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[run_id] = TokenCounter(path, shared.value)
    return _COUNTERS[run_id]


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = 2048,
    key: str = "doc_id",
    text: str = "text",
    words: int = TABLE_WORDS,
    sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """Bytes and tokens of every text: key, n_bytes, n_tokens, over_limit, one row per row.

    Tokens are those of the tokenizers library for the vocabulary at ``path``, which drops
    white space and case, without added special tokens; special strings inside texts are
    single tokens, as by its default. Counts are of whole texts of any length, without
    truncation. A null or empty text has 0 bytes and tokens; null and repeated keys keep
    their rows; other columns of any name are not read. An empty table gives no rows.
    """
    table = learn_lengths(docs, path, text, words, sample_docs)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    run_id = uuid.uuid4().hex
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).cast("string").alias("text"),
    )
    schema = StructType([rows.schema["key"], rows.schema["n_bytes"], StructField("n_tokens", LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(run_id, path, shared)
        out = to_arrow_schema(schema)
        for chunk in chunks(batches, text=2, limit=CHUNK_CHARS):
            keys, sizes, texts = zip(*chunk)
            yield to_batch(out, [keys, sizes, pa.array(counter.counts(list(texts)))])

    found = rows.mapInArrow(run, schema)
    return found.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
