"""Packs documents into training sequences of bounded length, in order.

Documents are one stream of ids in key order. A dynamic program chooses the cuts between
sequences: at document ends (free), sentence ends (a small penalty), or, where that saves
padding, inside a sentence (a larger penalty). A sequence of L ids costs ``size - L`` of
padding, or nothing if L is a power of two. With f(j) the least cost of the ids before
cut j,

    f(j) = penalty(j) + min(min over i within size before j of f(i) + i + size - j,
                            min over powers of two p of f(j - p)),  the latter at document ends.

The first inner minimum is over a sliding window and kept in a monotone queue, so each cut
is pushed and popped once. Cuts inside sentences are those a full sequence after another
cut, which is where such a cut leaves no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import chunks, to_batch
from tenura.llm.pieces import word_piece_text, word_pieces, worker_pieces

# Ids that are packed together; a stream is closed at the first document end beyond it.
RUN_IDS = 1_000_000
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, `offset` long"
)


@dataclass(frozen=True)
class Costs:
    """In ids of padding: of each sequence, a cut at a sentence end, a cut inside one."""

    sequence: float = 4.0
    sentence: float = 1.0
    inside: float = 20.0


def choose_cuts(
    total: int, documents: np.ndarray, sentences: np.ndarray, size: int, costs: Costs = Costs()
) -> list[int]:
    """Ends of the sequences that a stream of ``total`` ids is cut into.

    ``documents`` and ``sentences`` are positions after the last id of a document or
    sentence, in any order and with repeats.
    """
    if not total:
        return []
    kind = np.zeros(total + 1, np.int8)  # of each place: 3 document end, 2 sentence end, 1 inside
    kind[sentences] = 2
    kind[documents] = 3
    kind[[0, total]] = 3
    bounds = np.flatnonzero(kind)
    # A cut inside is worth it if no sentence ends so little before.
    longest = int(np.diff(bounds).max())
    for k in range(1, longest // size + 2):
        inside = bounds + size * k
        inside = inside[inside < total]
        nearest = bounds[np.searchsorted(bounds, inside, side="right") - 1]
        kind[inside[inside - nearest > costs.inside - costs.sentence]] = 1
    cuts = np.flatnonzero(kind)
    kinds = kind[cuts]
    place, is_end = cuts.tolist(), (kinds == 3).tolist()
    penalties = (np.array([0.0, costs.inside, costs.sentence, 0.0])[kinds] + costs.sequence).tolist()
    powers = [1 << k for k in range(size.bit_length()) if 1 << k <= size]

    # Of each cut i: f(i) + i, and the cut before it.
    values, came = [0.0], [0]
    # The first cut that a sequence up to each cut can start at.
    firsts = np.searchsorted(cuts, cuts - size).tolist()
    number = dict(zip(place, range(len(place))))
    # Numbers of the window's cuts with f(i) + i rising; a new one is never below the first.
    queue, head, j = [0], 0, 0
    for first, penalty, ends in zip(firsts[1:], penalties[1:], is_end[1:]):
        j += 1
        while queue[head] < first:
            head += 1
        source = queue[head]
        value = values[source] + size
        if ends:
            here = place[j]
            for p in powers:
                i = number.get(here - p)
                if i is not None and values[i] + p < value:
                    value, source = values[i] + p, i
        value += penalty
        values.append(value)
        came.append(source)
        while values[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    ends, j = [], len(place) - 1
    while j:
        ends.append(place[j])
        j = came[j]
    return ends[::-1]


def _cut_documents(
    keys: list, docs: list[np.ndarray], sentences: np.ndarray, size: int, costs: Costs, sequence: int
) -> tuple[list[tuple], int]:
    """Pieces of one run of documents, and the number of the next sequence."""
    ends = np.cumsum([len(d) for d in docs])
    cuts = choose_cuts(int(ends[-1]), ends, sentences, size, costs)
    rows = []
    start_of_sequence, c = 0, 0
    for key, ids, end in zip(keys, docs, ends.tolist()):
        begin = end - len(ids)
        at = begin
        while at < end:
            while cuts[c] <= at:
                start_of_sequence = cuts[c]
                c += 1
            stop = min(end, cuts[c])
            piece = ids[at - begin : stop - begin]
            crc = zlib.crc32(piece.astype("<u4").tobytes())
            rows.append(
                (key, at - begin, stop - at, crc, len(ids), sequence + c, at - start_of_sequence)
            )
            at = stop
    return rows, sequence + len(cuts)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    size: int = 2048,
    key: str = "doc_id",
    text: str = "text",
    costs: Costs = Costs(),
    run_ids: int = RUN_IDS,
) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``size`` ids.

    ``tokenizer`` is the path of a vocabulary of the tokenizers library that drops white
    space; ``end_id`` closes each document. Columns: doc_id, start, length, ids_crc32 (of the
    little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset. Every id is in
    exactly one piece; pieces lie in their sequence in key order without gaps. Whole texts
    are packed; a null or empty text is its end id. Rows with equal keys are all packed, by
    text order; null keys come first. Sequence ids are unique, rise with the key, and are
    the same when a task is repeated.
    """

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_pieces(tokenizer, word_pieces, word_piece_text)
        end = np.array([end_id], np.uint32)
        names = [f.split()[0].strip("`") for f in PIECES.split(", ")]
        schema = pa.schema([(n, pa.int64()) for n in names])
        sequence = TaskContext.get().partitionId() << 40
        keys: list = []
        ids: list[np.ndarray] = []
        sentences: list[np.ndarray] = []
        total = 0
        closes, known = np.zeros(0, bool), None  # whether a piece ends a sentence
        for rows in chunks(batches):
            numbers, counts = encoder.pieces([r[1] for r in rows])
            if known != (encoder.cleared, len(encoder.keys)):
                if known is None or known[0] != encoder.cleared:
                    closes = np.zeros(0, bool)
                known = (encoder.cleared, len(encoder.keys))
                new = [k.endswith((".", "!", "?")) for k in encoder.keys[len(closes) :]]
                closes = np.concatenate([closes, np.array(new, bool)])
            upto = np.concatenate([[0], np.cumsum(encoder.lengths[numbers])])
            flat = encoder.ids(numbers)
            last = np.cumsum(counts)
            for row, first, stop in zip(rows, last - counts, last):
                own = numbers[first:stop]
                ids.append(np.concatenate([flat[upto[first] : upto[stop]], end]))
                marks = upto[first + 1 : stop + 1][closes[own]] - upto[first]
                sentences.append(marks + total)
                keys.append(row[0])
                total += len(ids[-1])
                if total >= run_ids:
                    found, sequence = _cut_documents(
                        keys, ids, np.concatenate(sentences), size, costs, sequence
                    )
                    yield to_batch(schema, list(zip(*found)))
                    keys, ids, sentences, total = [], [], [], 0
        if keys:
            found, _ = _cut_documents(keys, ids, np.concatenate(sentences), size, costs, sequence)
            yield to_batch(schema, list(zip(*found)))

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    return ordered.mapInArrow(pack, PIECES)
