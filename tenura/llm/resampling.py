"""Importance resampling of documents towards a target: hashed n-gram gains, Gumbel draws.

Features are runs of words, hashed by CRC-32 into buckets. A task works on the bytes of
many texts at once: distinct features are laid into one two-dimensional byte array for
each length, the checksums of a whole array advance column by column, and the buckets are
scattered back to the places of the features. Only counts of buckets and one narrow row
per document ever leave a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from tenura.llm.common import slices, to_batch
from tenura.llm.pieces import gather
from tenura.sources.shared import materialize

BUCKETS = 10_000
WORDS_PER_FEATURE = 2
# A longer feature gets its checksum alone: a byte array of its length would have few rows.
MATRIX_BYTES = 256
# Bytes of text worked on at a time.
CHUNK_BYTES = 1_000_000

# Fixed value: the reversed polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320


def crc_steps() -> np.ndarray:
    """What each byte value contributes to a CRC-32, from the polynomial."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(_POLYNOMIAL), steps >> 1)
    return steps.astype(np.uint32)


_STEPS = crc_steps()


def checksums(flat: np.ndarray, sizes: np.ndarray, longest: int = MATRIX_BYTES) -> np.ndarray:
    """CRC-32 of byte strings that lie one after the other in ``flat``.

    Strings of one length form the rows of a matrix, whose columns are worked off in turn.
    """
    starts = np.cumsum(sizes) - sizes
    found = np.zeros(len(sizes), np.uint32)
    order = np.argsort(sizes, kind="stable")
    lengths, first = np.unique(sizes[order], return_index=True)
    for length, group in zip(lengths.tolist(), np.split(order, first[1:])):
        if length > longest:
            for i in group.tolist():
                found[i] = zlib.crc32(flat[starts[i] : starts[i] + length].tobytes())
            continue
        matrix = flat[starts[group][:, None] + np.arange(length)]
        crc = np.full(len(group), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            crc = (crc >> np.uint32(8)) ^ _STEPS[(crc & np.uint32(0xFF)) ^ column]
        found[group] = ~crc
    return found


def word_bytes() -> np.ndarray:
    """Lower-case form of each byte of a word (ASCII letters, digits, all others), 0 between words."""
    to = np.arange(256, dtype=np.uint8)
    to[ord("A") : ord("Z") + 1] += 32
    inside = np.zeros(256, bool)
    inside[ord("0") : ord("9") + 1] = True
    inside[ord("a") : ord("z") + 1] = True
    inside[0x80:] = True
    return np.where(inside[to], to, 0).astype(np.uint8)


_WORD_BYTES = word_bytes()


class Features:
    """Feature buckets of the texts of one Arrow string array.

    ``n_words`` and ``n_features`` are per text; ``bucket`` and ``owner`` (number of the
    text) per feature. A null text has none.
    """

    def __init__(
        self, texts: pa.Array, longest: int = WORDS_PER_FEATURE, buckets: int = BUCKETS
    ):
        texts = texts.cast(pa.large_binary())
        count = len(texts)
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + count + 1]
        low, high = int(ends[0]), int(ends[-1])
        raw = np.frombuffer(data, np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
        ends = ends - low
        if texts.null_count:  # bytes under a null are no text
            empty = np.flatnonzero(texts.is_null().to_numpy(zero_copy_only=False))
            raw = raw.copy()
            for i in empty.tolist():
                raw[ends[i] : ends[i + 1]] = 0
        lower = _WORD_BYTES[raw]
        inside = lower != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = ends[1:-1][ends[1:-1] < len(raw)]
        begins[edges] = inside[edges]  # words of two texts never join
        starts = np.flatnonzero(begins)
        flat = lower[inside]
        at = (np.cumsum(inside) - 1)[starts]
        sizes = np.diff(at, append=len(flat))
        text_of = np.searchsorted(ends, starts, "right") - 1
        codes, distinct = _distinct_words(flat, at, sizes)
        word_flat, word_sizes = distinct
        word_starts = np.cumsum(word_sizes) - word_sizes

        self.n_words = np.bincount(text_of, minlength=count)
        found, owners = [], []
        run = codes.astype(np.int64)  # number of the run of words that starts at each word
        run_flat, run_starts, run_sizes = word_flat, word_starts, word_sizes
        owner = text_of
        for n in range(1, longest + 1):
            if n > 1:
                same = text_of[n - 1 :] == text_of[: len(text_of) - n + 1]
                pair = run[: len(same)][same] * len(word_sizes) + codes[n - 1 :][same]
                pair, number = np.unique(pair, return_inverse=True)
                left, right = pair // max(len(word_sizes), 1), pair % max(len(word_sizes), 1)
                run_flat, run_sizes = _joined(
                    run_flat, run_starts[left], run_sizes[left],
                    word_flat, word_starts[right], word_sizes[right],
                )
                run_starts = np.cumsum(run_sizes) - run_sizes
                whole = np.zeros(len(same), np.int64)
                whole[same] = number
                run, owner, here = whole, text_of[: len(same)][same], number
            else:
                here = run
            bucket = checksums(run_flat, run_sizes) % np.uint32(buckets)
            found.append(bucket[here].astype(np.int64))
            owners.append(owner)
        self.bucket = np.concatenate(found)
        self.owner = np.concatenate(owners)
        self.n_features = np.bincount(self.owner, minlength=count)

    def totals(self, value_of_bucket: np.ndarray) -> np.ndarray:
        """Sum of whole values of buckets over the features of each text."""
        total = np.zeros(len(self.n_features), np.int64)
        np.add.at(total, self.owner, value_of_bucket[self.bucket])
        return total


def _distinct_words(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Number of each word among the distinct ones, and these as bytes and lengths."""
    offsets = np.append(starts, len(flat)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]
    ).dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False)
    distinct = words.dictionary
    if not len(distinct):
        return codes, (np.zeros(0, np.uint8), np.zeros(0, np.int64))
    _, ends, data = distinct.buffers()
    ends = np.frombuffer(ends, np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
    return codes, (np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], np.diff(ends))


def _joined(a, a_starts, a_sizes, b, b_starts, b_sizes):
    """Bytes and lengths of pairs of strings with one space between."""
    both = np.concatenate([a, b, np.full(1, 0x20, np.uint8)])
    count = len(a_sizes)
    starts = np.stack(
        [a_starts, np.full(count, len(both) - 1), len(a) + b_starts], axis=1
    ).ravel()
    sizes = np.stack([a_sizes, np.ones(count, np.int64), b_sizes], axis=1).ravel()
    return gather(both, starts.astype(np.int64), sizes), a_sizes + b_sizes + 1


def bucket_counts(
    docs: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = WORDS_PER_FEATURE
) -> DataFrame:
    """Features of all texts per bucket: bucket, n. Each task hands on one row per bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece, _ in slices(batch, 0, CHUNK_BYTES):
                found = Features(piece.column(0), longest, buckets)
                total += np.bincount(found.bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]})

    rows = docs.select(F.col(text).cast("string").alias("text"))
    partial = rows.mapInArrow(run, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths: log ratio of its smoothed target and source shares.

    Takes the results of ``bucket_counts``; the driver sees ``buckets`` numbers.
    """
    t = target.select("bucket", F.col("n").alias("t"), F.lit(0).cast("long").alias("s"))
    s = source.select("bucket", F.lit(0).cast("long").alias("t"), F.col("n").alias("s"))
    per_bucket = t.unionAll(s).groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("s").alias("s"))
    found = {r["bucket"]: (r["t"], r["s"]) for r in per_bucket.collect()}
    all_t = float(sum(t for t, _ in found.values()) + buckets)
    all_s = float(sum(s for _, s in found.values()) + buckets)
    both = np.array([found.get(b, (0, 0)) for b in range(buckets)], np.float64)
    ratio = (both[:, 0] + 1) * all_s / ((both[:, 1] + 1) * all_t)
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def document_weights(
    docs: DataFrame,
    gains: np.ndarray,
    key: str = "doc_id",
    text: str = "text",
    longest: int = WORDS_PER_FEATURE,
) -> DataFrame:
    """key, n_words, n_features and weight: the floored mean gain of a document's features."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    names = ("n_words", "n_features", "weight")
    schema = StructType([rows.schema["key"], *(StructField(n, LongType()) for n in names)])
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = to_arrow_schema(schema)
        for batch in batches:
            for piece, _ in slices(batch, 1, CHUNK_BYTES):
                found = Features(piece.column(1), longest, len(shared.value))
                weight = found.totals(shared.value) // np.maximum(found.n_features, 1)
                yield to_batch(out, [piece.column(0), found.n_words, found.n_features, weight])

    return rows.mapInArrow(run, schema)


def gumbel(key: Column, seed: int) -> Column:
    """Whole Gumbel noise in thousandths, from the SHA-256 of ``<seed>:<key>``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    longest: int = WORDS_PER_FEATURE,
) -> DataFrame:
    """Draws a share of documents by importance: key, n_features, weight, score, rank.

    Of the N documents with at least ``least_words`` words, floor(percent * N / 100) with
    the highest weight plus Gumbel noise are drawn, without replacement; ``rank`` counts
    them from 1, ties to the smaller key (a null key first), undrawn ones are null. Equal
    rows of one key share its noise and are separate documents. A null or empty text has no
    features and weight 0. An empty target or empty documents give gains of the smoothing
    alone. Other columns of any name are not read.

    Ranks need no global sort: scores are whole numbers in a bounded range, so the rows above
    each score are known from a count per score, and only rows of one score are ordered among
    themselves. The noise spreads equal weights over thousands of scores, and rows alike in
    everything are first counted per input split, so that one key may hold most rows.
    """
    gains = bucket_gains(
        bucket_counts(docs, text, buckets, longest),
        bucket_counts(target, target_text, buckets, longest),
        buckets,
    )
    weighed = document_weights(docs, gains, key, text, longest)
    score = (F.col("weight") + gumbel(F.col("key"), seed)).cast("long")
    scored = materialize(weighed.withColumn("score", score), "resampling")

    # One row per score: at most the span of gains and noise, well below 200,000 rows.
    per_score = scored.where(F.col("n_words") >= least_words).groupBy("score").agg(
        F.count(F.lit(1)).alias("n")
    )
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    placed = per_score.select(
        "score",
        F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above"),
        F.floor(F.sum("n").over(every) * percent / 100).alias("drawn"),
    ).where("above < drawn")
    with_place = scored.join(F.broadcast(placed), "score", "left")
    eligible = (F.col("n_words") >= least_words) & F.col("above").isNotNull()
    alike = ["score", "above", "drawn", "key", "n_features", "weight"]
    counted = (
        with_place.where(eligible).select(*alike, F.spark_partition_id().alias("part"))
        .groupBy(*alike, "part").agg(F.count(F.lit(1)).alias("n"))
    )
    before = Window.partitionBy("score").orderBy("key", "n_features", "weight", "part")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    drawn = counted.withColumn(
        "first", F.col("above") + F.coalesce(F.sum("n").over(before), F.lit(0))
    ).withColumn("rank", F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("n"))))
    rank = F.when(F.col("rank") <= F.col("drawn"), F.col("rank"))
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    rest = with_place.where(~F.coalesce(eligible, F.lit(False)))
    return drawn.select(*columns, rank.cast("long").alias("rank")).unionAll(
        rest.select(*columns, F.lit(None).cast("long").alias("rank"))
    )
