"""Removes passages that already occur in an earlier document, by automata of passages.

A window is WINDOW consecutive words; a word is removed if a window that covers it also
starts in a document of a smaller id. Steps, each a distributed job:

1. Documents of equal words are one unit, the one of the smallest id.
2. Anchors: in every window the ANCHOR-word gram of least hash is chosen, which depends on
   the window alone. Windows that recur share their anchor, so only documents with anchors
   of two or more units go on.
3. Windows around such anchors are counted by their hashes. Those of two or more documents
   are joined, where they occur first, into passages.
4. Passages are dealt to shards of bounded size, like ones together. A document's words
   around an anchor, as far as a window with it reaches, go to those shards whose passages
   have that anchor; so what all shards read of a document is about its length. Each shard
   compiles an Aho-Corasick automaton of its passages' blocks of ANCHOR words (every window
   of a passage holds one whole), streams these segments through it, many at a time, and
   extends all hits together word by word. So what is removed has been compared word for
   word. Shards of many documents are split, with a copy of the automaton for each part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import CHUNK_CHARS, chunks, to_batch
from tenura.sources.shared import materialize

WINDOW = 50
ANCHOR = 25
# Words of passages in one automaton, and documents streamed through one copy of it; one of
# which a shard gets only some anchors counts by their share.
SHARD_WORDS = 400_000
SHARD_DOCUMENTS = 1_000
# Words of segments streamed at a time, and words compared at a time; bound a task's memory.
_STREAMED = 200_000
_COMPARED = 1_000_000
# Longer words are hashed one by one.
_LONG = 64
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_U64 = np.uint64
_EMPTY = hashlib.sha256(b"").hexdigest()


def words_of(text: str) -> list[bytes]:
    """Words between the white space of ``[\\x20\\x09-\\x0D]+``, unchanged."""
    return text.encode().split()


class Words:
    """The words of several texts, as places in one buffer of their bytes."""

    def __init__(self, texts: Sequence[str]):
        data = [t.encode() for t in texts]
        self.buffer = b"".join([b" ", b" ".join(data), b" " * 8])
        codes = np.frombuffer(self.buffer, np.uint8)
        space = _SPACE[codes]
        self.starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        self.ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        offsets = np.cumsum([1, *(len(d) + 1 for d in data)])
        # Number of the first word of each text, and of all words.
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        odd = (self.starts[1:] - self.ends[:-1] != 1) | (codes[self.ends[:-1]] != 0x20)
        self.odd = np.concatenate([np.zeros(1, np.int64), np.cumsum(odd)])

    def joined(self, text: int, start: int = 0, end: int | None = None) -> bytes:
        """Words of a text, joined by one space."""
        first = int(self.first[text]) + start
        last = int(self.first[text + 1] if end is None else min(self.first[text] + end, self.first[text + 1])) - 1
        if last < first:
            return b""
        own = self.buffer[int(self.starts[first]) : int(self.ends[last])]
        return own if self.odd[last] == self.odd[first] else b" ".join(own.split())

    def hashes(self) -> np.ndarray:
        return hash_words(self.buffer, self.starts, self.ends - self.starts)


def hash_words(buffer: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each word, eight bytes at a time; at least 8 bytes follow the last one."""
    wide = np.ndarray(len(buffer) - 7, "<u8", buffer, strides=(1,))
    found = _mixed(lengths.astype(np.uint64))
    live = np.flatnonzero(lengths <= _LONG)
    done = 0
    while len(live):
        left = lengths[live] - done
        found[live] = _mixed(found[live] ^ (wide[starts[live] + done] & _MASKS[np.minimum(left, 8)]))
        live = live[left > 8]
        done += 8
    for i in np.flatnonzero(lengths > _LONG).tolist():
        found[i] = xxhash.xxh3_64_intdigest(buffer[int(starts[i]) : int(starts[i] + lengths[i])])
    return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(29))) * _U64(0x9E3779B97F4A7C15)
    return x ^ (x >> _U64(32))


class Grams:
    """Hashes of word grams, by sums of powers that are divided out again."""

    def __init__(self):
        self.base, self.inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        lengths = np.array([len(w) for w in words], np.int64)
        return hash_words(b"".join([*words, b" " * 8]), np.cumsum(lengths) - lengths, lengths)

    def grams(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n words from each position."""
        count = len(hashes)
        if len(self.powers) <= count:
            longest = max(2 * count, 4096)
            steps = np.full(longest, self.base, np.uint64)
            back = np.full(longest, self.inverse, np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(steps), np.cumprod(back)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.powers[:count])])
        return _mixed((upto[n:] - upto[:-n]) * self.inverses[: max(count - n + 1, 0)])


def anchors(grams: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """For each window, the least hash of its grams."""
    width = window - anchor + 1
    count = max(len(grams) - width + 1, 0)
    least, reach = grams, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return np.minimum(least[:count], least[width - reach :][:count])


def _describe(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("digest", pa.binary()),
         ("anchors", pa.list_(pa.int64()))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for rows in chunks(batches):
            words = Words([text for _, text in rows])
            chosen = anchors(grams.grams(words.hashes(), anchor), window, anchor).view(np.int64)
            found = []
            for first, count in zip(words.first.tolist(), words.counts.tolist()):
                own = chosen[first : first + max(count - window + 1, 0)]
                found.append(np.unique(own[np.diff(own, prepend=own[:1] + 1) != 0]))
            upto = np.cumsum([0, *map(len, found)])
            digests = [hashlib.sha256(words.joined(i)).digest() for i in range(len(rows))]
            lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(np.concatenate(found)))
            yield to_batch(schema, [[doc for doc, _ in rows], words.counts, digests, lists])

    return docs.mapInArrow(run, "doc_id long, n_words long, digest binary, anchors array<long>")


def _windows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """Windows with a recurring anchor: hash in two parts, doc, position, anchor."""
    names = ["h", "h2", "doc", "at", "anchor"]
    schema = pa.schema([(n, pa.int32() if n in ("h2", "at") else pa.int64()) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for rows in chunks(batches):
            docs, texts, recurring = zip(*rows)
            words = Words(texts)
            hashes = words.hashes()
            chosen = anchors(grams.grams(hashes, anchor), window, anchor).view(np.int64)
            windows = np.maximum(words.counts - window + 1, 0)
            places = spans(words.first[:-1], windows)
            # Neighbours mostly have one anchor; an anchor that recurs does so for every text.
            own = chosen[places]
            starts = np.flatnonzero(np.diff(own, prepend=own[:1] + 1))
            wanted = np.isin(own[starts], np.fromiter(chain.from_iterable(recurring), np.int64))
            kept = np.repeat(wanted, np.diff(starts, append=len(own)))
            places = places[kept]
            number = np.repeat(np.arange(len(docs)), windows)[kept]
            h = grams.grams(hashes, window)[places].view(np.int64)
            other = grams.grams(hashes ^ (hashes >> _U64(17)), window)[places]
            h2 = (other & _U64(0x7FFFFFFF)).astype(np.int32)
            at = (places - words.first[number]).astype(np.int32)
            yield to_batch(schema, [h, h2, np.array(docs, np.int64)[number], at, own[kept]])

    return texts.mapInArrow(run, "h long, h2 int, doc long, `at` int, anchor long")


def _passages(texts: DataFrame, firsts: DataFrame, window: int) -> DataFrame:
    """Runs of windows that recur: doc, words (joined by one space), n_words, anchors, kin.

    ``kin`` is the least of a run's anchors, so runs of like words mostly have the same.
    """
    schema = pa.schema(
        [("doc", pa.int64()), ("words", pa.binary()), ("n_words", pa.int64()),
         ("anchors", pa.list_(pa.int64())), ("kin", pa.int64())]
    )
    places = firsts.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("at", "anchor"))).alias("p"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches):
            found = []
            for doc, text, at, anchor in rows:
                words = words_of(text)
                at, first = np.unique(np.array(at, np.int64), return_index=True)
                anchor = np.array(anchor, np.int64)[first]
                inside = at + window <= len(words)
                at, anchor = at[inside], anchor[inside]
                cuts = np.flatnonzero(np.diff(at) > 1) + 1
                for part, own in zip(np.split(at, cuts), np.split(anchor, cuts)):
                    if len(part):
                        text_of = words[part[0] : part[-1] + window]
                        own = np.unique(own)
                        found.append((doc, b" ".join(text_of), len(text_of), own.tolist(), int(own[0])))
            yield to_batch(schema, list(zip(*found)) if found else [[]] * 5)

    rows = texts.select("doc", "text").join(places, "doc").select("doc", "text", "p.at", "p.anchor")
    return rows.mapInArrow(
        run, "doc long, words binary, n_words long, anchors array<long>, kin long"
    )


def _segments(targets: DataFrame, window: int, anchor: int) -> DataFrame:
    """The words of every window with an anchor of a shard: shard, part, doc, digest, base, words.

    ``targets`` has doc, text and an array of (shard, part, anchors). ``base`` is the number
    of words before the segment.
    """
    schema = pa.schema(
        [("shard", pa.int64()), ("part", pa.int32()), ("doc", pa.int64()), ("digest", pa.binary()),
         ("base", pa.int32()), ("words", pa.binary())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for rows in chunks(batches):
            found, held = [], 0
            words = Words([text for _, text, _ in rows])
            hashes = grams.grams(words.hashes(), anchor).view(np.int64)
            for i, (doc, _, shards) in enumerate(rows):
                count = int(words.counts[i])
                if count < window:
                    continue  # another text of the same id
                digest = hashlib.sha256(words.joined(i)).digest()
                g = hashes[words.first[i] :][: count - anchor + 1]
                order = np.argsort(g, kind="stable")
                ascending = g[order]
                for shard in shards:
                    wanted = np.array(shard["anchors"], np.int64)
                    first = np.searchsorted(ascending, wanted, "left")
                    count = np.searchsorted(ascending, wanted, "right") - first
                    at = np.sort(order[spans(first, count)])
                    for part in np.split(at, np.flatnonzero(np.diff(at) > 2 * window - anchor) + 1):
                        if len(part):
                            # From the first window with the first place to the last with the last.
                            base = max(0, int(part[0]) - (window - anchor))
                            own = words.joined(i, base, int(part[-1]) + window)
                            found.append((shard["shard"], shard["part"], doc, digest, base, own))
                            held += len(own) + 100
                            if held >= CHUNK_CHARS:
                                yield to_batch(schema, list(zip(*found)))
                                found, held = [], 0
            yield to_batch(schema, list(zip(*found)) if found else [[]] * 6)

    return targets.mapInArrow(
        run, "shard long, part int, doc long, digest binary, base int, words binary"
    )


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _parts(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Slices of neighbours whose sizes add up to about ``limit``, or of one."""
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // limit)) + 1
    edges = [0, *cuts.tolist(), len(sizes)]
    return (slice(a, b) for a, b in zip(edges, edges[1:]) if a < b)


class PassageAutomaton:
    """Finds every stretch of ``window`` or more words that a text shares with a passage.

    A state's moves are searched one after the other, so each word is three symbols of small
    alphabets, one for each place: no state has more moves than the cube root of the words.
    """

    def __init__(self, passages: list[tuple[int, list[bytes]]], window: int, block: int):
        self.window, self.block = window, block
        self.numbers: dict[bytes, int] = {}
        texts = []
        blocks: dict[bytes, list] = {}
        for number, (_, words) in enumerate(passages):
            numbers = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int64)
            for at in range(0, len(numbers) - block + 1, block):
                blocks.setdefault(numbers[at : at + block].tobytes(), []).append((number, at))
            texts.append(numbers)
        self.radix = 1
        while self.radix**3 <= len(self.numbers):
            self.radix += 1
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for i, key in enumerate(blocks):
            self.automaton.add_word(self._symbols(np.frombuffer(key, np.int64)), i)
        self.automaton.make_automaton()
        # Where each block is: ``counts`` places from ``firsts`` on, each a passage and a word in it.
        self.counts = np.array([len(places) for places in blocks.values()], np.int64)
        self.firsts = np.cumsum(self.counts) - self.counts
        self.places = np.array(list(chain.from_iterable(blocks.values())), np.int64).reshape(-1, 2)
        self.sources = np.array([doc for doc, _ in passages], np.int64)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.words = np.concatenate([*texts, np.zeros(0, np.int64)])

    def _symbols(self, numbers: np.ndarray) -> tuple[int, ...]:
        radix = self.radix
        symbols = np.empty((len(numbers), 3), np.int64)
        symbols[:, 0] = numbers // radix**2
        symbols[:, 1] = numbers // radix % radix + radix
        symbols[:, 2] = numbers % radix + 2 * radix
        return tuple(symbols.ravel().tolist())

    def shared(self, doc: int, words: list[bytes]) -> list[tuple[int, int]]:
        """Stretches (start, end) of the words that passages of smaller documents hold."""
        return self.shared_of([doc], [words])[0]

    def shared_of(self, docs: Sequence[int], segments: Sequence[list[bytes]]) -> list[list[tuple[int, int]]]:
        """``shared`` of many segments, which are streamed as one text with a strange word after each."""
        found: list[list[tuple[int, int]]] = [[] for _ in segments]
        sizes = np.array([len(words) + 1 for words in segments], np.int64)
        begins = np.cumsum(sizes) - sizes
        each = chain.from_iterable(chain(words, (b"",)) for words in segments)
        text = np.fromiter(map(self.numbers.get, each, repeat(0)), np.int64, int(sizes.sum()))
        hits = list(self.automaton.iter(self._symbols(text)))
        if not hits:
            return found
        last, key = np.array(hits, np.int64).T
        for part in _parts(self.counts[key], _COMPARED):
            pairs = self._beside(last[part] // 3 - self.block + 1, key[part], np.array(docs, np.int64), begins, sizes)
            for some in _parts(pairs[-1], _COMPARED):
                for own, begin, end in self._equal(text, *(values[some] for values in pairs)):
                    found[own].append((begin - int(begins[own]), end - int(begins[own])))
        return [sorted(set(stretches)) for stretches in found]

    def _beside(
        self, start: np.ndarray, key: np.ndarray, docs: np.ndarray, begins: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """Passages of smaller documents laid beside segments, once for all hits that agree on the place.

        For each: segment, place in the text, place in ``words``, number of words.
        """
        counts = self.counts[key]
        segment = np.repeat(np.searchsorted(begins, start, "right") - 1, counts)
        number, at = self.places[spans(self.firsts[key], counts)].T
        place = np.repeat(start, counts) - at
        known = self.sources[number] < docs[segment]
        segment, number, place = segment[known], number[known], place[known]
        order = np.lexsort((place, number, segment))
        segment, number, place = segment[order], number[order], place[order]
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(segment) != 0) | (np.diff(number) != 0) | (np.diff(place) != 0)
        segment, number, place = segment[new], number[new], place[new]
        low = np.maximum(place, begins[segment])
        length = np.minimum(place + self.lengths[number], begins[segment] + sizes[segment] - 1) - low
        enough = length >= self.window
        return tuple(v[enough] for v in (segment, low, self.begins[number] + low - place, length))

    def _equal(
        self, text: np.ndarray, segment: np.ndarray, low: np.ndarray, beside: np.ndarray, length: np.ndarray
    ) -> Iterator[tuple[int, int, int]]:
        """Runs of ``window`` or more equal words of text and passage: segment, start, end."""
        upto = np.cumsum(length + 1)
        same = np.zeros(int(upto[-1]) + 1, bool)
        # Before each pair is a place where nothing is equal.
        same[spans(upto - length, length)] = text[spans(low, length)] == self.words[spans(beside, length)]
        edges = np.flatnonzero(same[1:] != same[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.window
        starts, ends = starts[long], ends[long]
        pair = np.searchsorted(upto, starts, "left")
        begin = starts - (upto - length)[pair] + low[pair]
        yield from zip(segment[pair].tolist(), begin.tolist(), (begin + ends - starts).tolist())


def _locate(segments: DataFrame, passages: DataFrame, window: int, block: int) -> DataFrame:
    """doc, digest, starts, ends of the stretches found in each segment."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            known = [(d, w.split(b" ")) for d, w in zip(right["doc"], right["words"])]
            automaton = PassageAutomaton(known, window, block)
            size = np.array([w.count(b" ") + 1 for w in left["words"]], np.int64)
            for part in _parts(size, _STREAMED):
                own = left.iloc[part]
                found = automaton.shared_of(own["doc"].tolist(), [w.split(b" ") for w in own["words"]])
                for doc, digest, base, stretches in zip(own["doc"], own["digest"], own["base"].tolist(), found):
                    if stretches:
                        starts, ends = zip(*stretches)
                        rows.append((doc, digest, [base + s for s in starts], [base + e for e in ends]))
        return pd.DataFrame(rows, columns=["doc", "digest", "starts", "ends"])

    groups = segments.groupBy("shard", "part").cogroup(passages.groupBy("shard", "part"))
    return groups.applyInPandas(run, "doc long, digest binary, starts array<int>, ends array<int>")


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    shard_words: int = SHARD_WORDS,
    shard_documents: int = SHARD_DOCUMENTS,
    with_text: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document.

    ``with_text`` adds words_sha256 (of all its words joined by one space) and kept_text.

    Whole texts are judged, as they came in. A null text has no words. ``kept_sha256`` is
    of the kept words joined by one space. Rows with one doc_id don't take from each other;
    a row with a null id loses nothing, and nothing is removed because of it. kept_text is
    null where nothing was removed.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = materialize(_describe(rows, window, anchor), "substring-documents")
    long = described.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    firsts = long.groupBy("digest").agg(F.min("doc_id").alias("first"))
    units = long.join(firsts, "digest").where("doc_id = first").dropDuplicates(["digest"])

    every = units.select(F.col("doc_id").alias("doc"), F.explode("anchors").alias("anchor"))
    recurring = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    of_doc = every.join(recurring, "anchor").groupBy("doc").agg(F.collect_set("anchor").alias("anchors"))
    texts = rows.where("doc_id is not null").withColumnRenamed("doc_id", "doc").join(of_doc, "doc")
    texts = materialize(texts.select("doc", "text", "anchors"), "substring-texts")

    recurs = (
        _windows(texts, window, anchor).groupBy("h", "h2")
        .agg(F.min(F.struct("doc", "at", "anchor")).alias("first"), F.max("doc").alias("last"))
        .where("last > first.doc").select("first.doc", "first.at", "first.anchor")
    )
    recurs = materialize(recurs, "substring-windows")
    passages = materialize(_passages(texts, recurs, window), "substring-passages")

    total = passages.agg(F.sum("n_words")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).alias("shard")
    routes = passages.select(
        F.explode("anchors").alias("anchor"), shard("kin"), F.col("doc").alias("source")
    ).groupBy("anchor", "shard").agg(F.min("source").alias("source"))
    asked = texts.select("doc", F.size("anchors").alias("all"), F.explode("anchors").alias("anchor"))
    wanted = asked.join(routes, "anchor").where("source < doc").groupBy("doc", "shard").agg(
        F.collect_set("anchor").alias("anchors"), F.max("all").alias("all")
    )
    wanted = materialize(wanted, "substring-routes")
    share = F.sum(F.size("anchors") / F.col("all"))
    load = wanted.groupBy("shard").agg(F.ceil(share / shard_documents).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64(F.lit(1), "doc"), F.col("parts")).cast("int").alias("part")
    targets = wanted.join(load, "shard").select("doc", F.struct("shard", part, "anchors").alias("t"))
    targets = texts.select("doc", "text").join(
        targets.groupBy("doc").agg(F.collect_list("t").alias("targets")), "doc"
    )
    segments = _segments(targets, window, anchor)
    dealt = passages.select("doc", "words", shard("kin")).join(load, "shard").select(
        "doc", "words", "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    stretches = _locate(segments, dealt, window, anchor).groupBy("doc", "digest").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")
    )
    removed = materialize(_cut(texts, stretches, with_text), "substring-removed")

    out = described.drop("anchors").join(firsts, "digest", "left").join(
        removed.withColumnRenamed("doc", "doc_id"), ["doc_id", "digest"], "left"
    )
    whole = (F.col("first") < F.col("doc_id")) & (F.col("n_words") >= window)
    columns = [
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(_EMPTY)).otherwise(F.coalesce("sha", F.lower(F.hex("digest")))).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.lower(F.hex("digest")).alias("words_sha256"))
        columns.append(F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept_text"))
    return out.select(columns)


def _cut(texts: DataFrame, stretches: DataFrame, with_text: bool) -> DataFrame:
    """doc, digest, n_removed, sha, kept (the text, or null) of documents that lose words."""
    schema = pa.schema(
        [("doc", pa.int64()), ("digest", pa.binary()), ("n_removed", pa.int64()), ("sha", pa.string()),
         ("kept", pa.string())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches):
            found = {}
            for doc, text, digest, starts, ends in rows:
                words = words_of(text)
                if hashlib.sha256(b" ".join(words)).digest() != digest:
                    continue  # another text of the same id
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, ends, -1)
                keep = np.cumsum(edges)[:-1] == 0
                left = b" ".join([w for w, k in zip(words, keep) if k])
                found[doc, digest] = (
                    doc, digest, len(words) - int(keep.sum()), hashlib.sha256(left).hexdigest(),
                    left.decode() if with_text else None,
                )
            yield to_batch(schema, list(zip(*found.values())) if found else [[]] * 5)

    rows = texts.select("doc", "text").join(stretches, "doc").select("doc", "text", "digest", "starts", "ends")
    cut = rows.mapInArrow(run, "doc long, digest binary, n_removed long, sha string, kept string")
    return cut.dropDuplicates(["doc", "digest"])
