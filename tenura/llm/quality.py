"""Quality of documents by ordinal cumulative-link regression on graded ratings.

One set of hashed-text weights gives a document a score s; ordered thresholds t_k turn it
into P(grade <= k) = logistic(t_k - s). So the expected grade and the probability of each
tail come from the same weights.

Features are the document's distinct words and their beginnings, the shapes of its tokens
by their share (letters, capitals, digits and signs, repeats cut short), and how often it
repeats itself. Each is hashed to a weight. Only features whose occurrence depends on the
grade in the fitted sample, by a likelihood-ratio test, and that lie mostly below the top
grade get one; all others are zero, so unseen text doesn't disturb the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tenura.llm.common import chunks, kept_columns, keyed_texts, to_batch

# Bound of the labelled documents that the model is fitted on.
TRAIN_DOCUMENTS = 6_000
BUCKETS = 1 << 18
# A feature gets a weight if so many documents of the sample have it, its likelihood ratio
# against independence of the grade is so large, and so large a share of its documents is
# below the top grade. So ordinary words, which lean only a little, get none.
LEAST_DOCUMENTS = 3
LEAST_RATIO = 10.0
LEAST_SHARE = 0.8
# Shares are rounded down to these levels.
LEVELS = (0.0, 0.02, 0.1, 0.25, 0.5, 0.8)
_WORD = re.compile(r"[^\W\d_]+")
_CAPITALS, _SMALL, _DIGITS = re.compile("[A-Z]+"), re.compile("[^\\W\\d_]+"), re.compile("[0-9]+")
_REPEAT = re.compile(r"([^\w\s])\1+")
_REMEMBERED = 150_000


def shape(token: str) -> str:
    """What a token looks like: A capitals, a letters, 0 digits, other signs once each."""
    if token.isalpha() and len(token) > 1 and token.upper() == token and token.lower() != token:
        return "AA"
    letters = _SMALL.sub("a", token)
    if letters != token and any(c.isalpha() for c in token) and token.upper() == token:
        letters = letters.replace("a", "AA")
    return _REPEAT.sub(r"\1", _DIGITS.sub("0", letters))[:8]


def _bucket(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) % BUCKETS


def word_buckets(token: str) -> list[int]:
    """Buckets of the words in a token and of their beginnings."""
    found = []
    for word in _WORD.findall(token.lower()):
        found.append(_bucket("w" + word))
        found += [_bucket(f"{n}{word[:n]}") for n in (4, 5, 6) if len(word) > n]
    return found


def level(share: float) -> int:
    return sum(share >= at for at in LEVELS)


class Tokens(dict):
    """Of each token: its shape and a value of its words, remembered."""

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, token: str) -> tuple:
        if len(self) > _REMEMBERED:
            self.clear()
        found = self[token] = (shape(token), self.value(word_buckets(token)))
        return found


def form_features(counts: Counter, shapes: dict[str, int]) -> list[int]:
    """Buckets of the shapes by their share, and of the share of repeated tokens."""
    total = sum(counts.values())
    found = [_bucket(f"s{kind} {level(n / total)}") for kind, n in shapes.items() if n >= 0.02 * total]
    top = max(counts.values()) / total
    found.append(_bucket(f"t{level(top)}"))
    if total >= 20:
        found.append(_bucket(f"d{level(len(counts) / total)}"))
    return found


def document_features(text: str, tokens: Tokens) -> set[int]:
    """Distinct buckets of a document."""
    counts = Counter(text.split())
    if not counts:
        return set()
    shapes: dict[str, int] = {}
    found: set[int] = set()
    for token, n in counts.items():
        kind, own = tokens[token]
        shapes[kind] = shapes.get(kind, 0) + n
        if own:
            found.update(own)
    found.update(form_features(counts, shapes))
    return found


def telling(samples: list[tuple[int, np.ndarray]], grades: int) -> np.ndarray:
    """Buckets that depend on the grade; samples are counted one by one, nothing is put together."""
    seen = np.zeros((BUCKETS, grades))
    for grade, own in samples:
        seen[own, grade] += 1  # a document's buckets are distinct
    buckets = np.flatnonzero(seen.any(axis=1))
    seen = seen[buckets]
    y = np.array([g for g, _ in samples])
    of_grade = np.bincount(y, minlength=grades).astype(float)
    n, total = seen.sum(axis=1, keepdims=True), of_grade.sum()
    ratio = np.zeros(len(buckets))
    for have, expected in ((seen, n * of_grade / total), (of_grade - seen, (total - n) * of_grade / total)):
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio += 2 * np.where(have > 0, have * np.log(have / expected), 0).sum(axis=1)
    below = (n[:, 0] - seen[:, -1]) / n[:, 0]
    return buckets[(n[:, 0] >= LEAST_DOCUMENTS) & (ratio >= LEAST_RATIO) & (below >= LEAST_SHARE)]


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades

    def at_most(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each score and k below the top grade."""
        return 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds, -60, 60)))


def fit(samples: list[tuple[int, np.ndarray]], grades: int, rounds: int = 200, rate: float = 0.1, decay: float = 3e-4) -> Model:
    """Fit weights and thresholds to (grade, buckets) samples by gradient steps.

    Thresholds are a first one and positive distances, so they stay in order.
    """
    used = telling(samples, grades)
    place = np.full(BUCKETS, -1, np.int64)
    place[used] = np.arange(len(used))
    kept = [place[own][place[own] >= 0] for _, own in samples]
    flat = np.concatenate(kept)
    owner = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
    y = np.array([g for g, _ in samples])
    weights, steps = np.zeros(len(used)), np.zeros(grades - 1)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, steps)]
    for step in range(1, rounds + 1):
        thresholds = steps[0] + np.concatenate([[0], np.cumsum(np.exp(steps[1:]))])
        s = np.bincount(owner, weights[flat], len(y))
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        upper = 1 / (1 + np.exp(np.clip(s - edges[y + 1], -60, 60)))
        lower = 1 / (1 + np.exp(np.clip(s - edges[y], -60, 60)))
        chance = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_score = (up - low) / len(y)
        by_edge = np.zeros(grades + 1)
        np.add.at(by_edge, y + 1, -up / len(y))
        np.add.at(by_edge, y, low / len(y))
        by_edge = by_edge[1:-1]
        tails = np.cumsum(by_edge[::-1])[::-1]
        by_step = np.concatenate([[tails[0]], tails[1:] * np.exp(steps[1:])])
        slope = np.bincount(flat, by_score[owner], len(used)) + decay * weights
        for parameter, gradient, (mean, square) in zip((weights, steps), (slope, by_step), moments):
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient * gradient - square)
            parameter -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    full = np.zeros(BUCKETS, np.float32)
    full[used] = weights
    return Model(full, steps[0] + np.concatenate([[0], np.cumsum(np.exp(steps[1:]))]))


def train(
    docs: DataFrame,
    ratings: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    grade: str = "grade",
    grades: int = 3,
    documents: int = TRAIN_DOCUMENTS,
) -> Model | None:
    """Fit on a bounded sample of rated documents, chosen by a hash of their ids.

    ``ratings`` has the key and a grade from 0 to ``grades - 1``; others and nulls are left
    out. None if fewer than two grades occur among the documents.
    """
    rated = ratings.where(F.col(grade).between(0, grades - 1) & F.col(key).isNotNull()).select(
        key, F.col(grade).cast("int").alias("_grade"), F.xxhash64(F.lit(9), key).alias("_h")
    )
    rated = rated.join(docs.select(key).distinct(), key, "left_semi")
    chosen = rated.orderBy("_h", "_grade").limit(documents)
    rows = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(chosen), key)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64()), ("grade", pa.int32()), ("buckets", pa.binary())])
        tokens = Tokens(tuple)
        for part in chunks(batches, 2):
            found = [
                (h, g, np.array(sorted(document_features(t, tokens)), "<u4").tobytes()) for h, g, t in part
            ]
            yield to_batch(schema, list(zip(*found)))

    made = rows.select("_h", "_grade", "_text").mapInArrow(features, "h long, grade int, buckets binary")
    found = sorted((r["h"], r["grade"], bytes(r["buckets"])) for r in made.toLocalIterator())[:documents]
    samples = [(g, np.frombuffer(b, "<u4")) for _, g, b in found]
    if len({g for g, _ in samples}) < 2:
        return None
    return fit(samples, grades)


def grade_documents(
    docs: DataFrame,
    model: Model | None,
    key: str = "doc_id",
    text: str = "text",
    keep: float = 0.5,
    columns: Sequence[str] = (),
) -> DataFrame:
    """key, expected_grade, tail_probability, kept for every whole text, and other ``columns``.

    ``tail_probability`` is that of the top grade; rows with at least ``keep`` are kept. A
    null text or one without tokens has no features, so its score is 0. Without a model
    both numbers are null and every row is kept.
    """
    found = [("expected_grade", DoubleType()), ("tail_probability", DoubleType()), ("kept", BooleanType())]
    same = docs.select(key, *columns).schema
    schema = StructType([*same, *(StructField(*f) for f in found)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        out = to_arrow_schema(schema)
        weights = model.weights.tolist() if model else []
        # Most tokens have no bucket with a weight.
        tokens = Tokens(lambda own: tuple(b for b in own if weights[b]))
        for rows in chunks(batches, nulls=True):
            same = kept_columns(rows, text, columns)
            if model is None:
                n = len(rows)
                yield to_batch(out, [*same, [None] * n, [None] * n, [True] * n])
                continue
            scores = np.array([
                sum(map(weights.__getitem__, sorted(document_features(r[1] or "", tokens)))) for r in rows
            ])
            below = model.at_most(scores)
            tail = 1 - below[:, -1]
            yield to_batch(out, [*same, (1 - below).sum(axis=1), tail, tail >= keep])

    return keyed_texts(docs, key, text, columns).mapInArrow(run, schema)


def toxic_quality_grades(labels: DataFrame) -> DataFrame:
    """Grades of labelled documents: 0 toxic, 1 of low quality, 2 neither."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).where("grade is not null")
