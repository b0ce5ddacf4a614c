"""Language of documents by a linear-chain conditional random field over their words.

Every word is labelled: its score for a language sums weights of its affixes and inner
character n-grams (hashed; word ends are marked, so n-grams at them are the affixes) and of
the word itself if the lexicon has it; learned transitions link neighbouring words.
Forward-backward gives each word's probabilities, so parts in another language are labelled
as such; a document's language is the one with the largest mean probability.

Long texts are cut into segments whose transfer matrices are multiplied in parallel, which
gives the probabilities of the whole chain.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tenura.llm.common import chunks, kept_columns, keyed_texts, to_batch

UNKNOWN = "und"
# Bounds of what the model is fitted on: labelled documents, and words of each.
TRAIN_DOCUMENTS = 1_500
TRAIN_WORDS = 60
# Every language has this many of them, if it has as many documents and they fill half at most.
TRAIN_LEAST = 100
# Hashed n-gram weights for each language, and words in the lexicon.
BUCKETS = 1 << 16
LEXICON = 20_000
# Words whose features are summed at a time when the model is fitted, on the driver.
FIT_WORDS = 10_000
SEGMENT = 128
_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 200_000


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in a row, and how many each word has."""
    marked = [f"\x02{w}\x03" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    owners, numbers = [], []
    for n in (2, 3, 4):
        if len(codes) < n:
            break
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            h = (h ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        inside = owner[: len(h)] == owner[n - 1 :]
        owners.append(owner[: len(h)][inside])
        numbers.append((h[inside] % np.uint64(BUCKETS)).astype(np.int64))
    known = [(i, BUCKETS + lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    owners.append(np.array([i for i, _ in known], np.int64))
    numbers.append(np.array([f for _, f in known], np.int64))
    owner, number = np.concatenate(owners), np.concatenate(numbers)
    order = np.argsort(owner, kind="stable")
    return number[order], np.bincount(owner, minlength=len(words))


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray  # feature by language
    transitions: np.ndarray  # language by language, logarithms

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each word for each language."""
        numbers, counts = word_features(words, self.lexicon)
        upto = np.zeros((len(numbers) + 1, len(self.languages)))
        np.cumsum(self.weights[numbers], axis=0, out=upto[1:])
        ends = np.cumsum(counts)
        return upto[ends] - upto[ends - counts]


def posteriors(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probabilities of the labels of words in chains that lie one after the other.

    ``scores``: a row of label scores for each word; ``lengths``: words of each chain, at
    least one. Before a chain all labels are alike.
    """
    labels = scores.shape[1]
    steps = np.exp(transitions - transitions.max())
    pieces = -(-lengths // SEGMENT)
    chain_of = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(chain_of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(np.cumsum(lengths) - lengths, pieces) + nth * SEGMENT
    size = np.minimum(lengths[chain_of] - nth * SEGMENT, SEGMENT)
    order = np.argsort(-size, kind="stable")  # the segments at work at a step come first
    first_o, size_o = first[order], size[order]
    potential = np.exp(scores - scores.max(axis=1, keepdims=True))
    active = [int(np.searchsorted(-size_o, -t, side="left")) for t in range(SEGMENT)]

    transfer = np.broadcast_to(np.eye(labels), (len(order), labels, labels)).copy()
    for t, n in enumerate(active):
        if n:
            moved = (transfer[:n] @ steps) * potential[first_o[:n] + t][:, None, :]
            transfer[:n] = moved / moved.max(axis=(1, 2), keepdims=True)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    transfer = transfer[back]

    before = np.full((len(nth), labels), 1.0 / labels)
    after = np.full((len(nth), labels), 1.0)
    by_turn = [np.flatnonzero(nth == k) for k in range(int(pieces.max()))]
    for own in by_turn[1:]:
        moved = (before[own - 1][:, None, :] @ transfer[own - 1])[:, 0]
        before[own] = moved / moved.sum(axis=1, keepdims=True)
    last = nth == pieces[chain_of] - 1
    for own in by_turn[::-1]:
        inner = own[~last[own]]
        moved = (transfer[inner + 1] @ after[inner + 1][:, :, None])[:, :, 0]
        after[inner] = moved / moved.max(axis=1, keepdims=True)

    found = np.empty_like(scores)
    forward = before[order]
    for t, n in enumerate(active):
        if n:
            at = first_o[:n] + t
            moved = (forward[:n] @ steps) * potential[at]
            forward[:n] = moved / moved.sum(axis=1, keepdims=True)
            found[at] = forward[:n]
    backward = after[order]
    for t in range(SEGMENT - 1, -1, -1):
        n = active[t]
        if n:
            at = first_o[:n] + t
            both = found[at] * backward[:n]
            found[at] = both / both.sum(axis=1, keepdims=True)
            moved = (backward[:n] * potential[at]) @ steps.T
            backward[:n] = moved / moved.max(axis=1, keepdims=True)
    return found


def fit(samples: list[tuple[str, list[str]]], rounds: int = 25, rate: float = 0.25, decay: float = 1e-4) -> Model:
    """Fit the weights to (language, words) samples by gradient steps on the likelihood.

    Samples are halved, and halves of different samples are joined to chains as well, so
    that changes of language are learned along with its keeping.
    """
    languages = sorted({language for language, _ in samples})
    number = {language: i for i, language in enumerate(languages)}
    chains: list[list[tuple[str, int]]] = []
    for i, (language, words) in enumerate(samples):
        other, more = samples[(i * 7 + 1) % len(samples)]
        half = max(1, len(words) // 2)
        chains.append([(w, number[language]) for w in words])
        mixed = [(w, number[language]) for w in words[:half]]
        chains.append(mixed + [(w, number[other]) for w in more[len(more) // 2 :]])
    counts = Counter(w for _, words in samples for w in words)
    frequent = sorted(counts, key=lambda w: (-counts[w], w))[:LEXICON]
    lexicon = {w: i for i, w in enumerate(w for w in frequent if counts[w] > 1)}
    words = sorted(counts)
    place = {w: i for i, w in enumerate(words)}
    numbers, sizes = word_features(words, lexicon)
    owner = np.repeat(np.arange(len(words)), sizes)
    of_word = np.array([place[w] for c in chains for w, _ in c])
    truth = np.array([label for c in chains for _, label in c])
    lengths = np.array([len(c) for c in chains])
    starts = np.cumsum(lengths) - lengths
    inner = np.setdiff1d(np.arange(len(of_word)), starts)

    labels, features = len(languages), BUCKETS + len(lexicon)
    target = np.eye(labels)[truth]
    model = Model(languages, lexicon, np.zeros((features, labels)), np.zeros((labels, labels)))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.weights, model.transitions)]
    kept = np.zeros((labels, labels))
    np.add.at(kept, (truth[inner - 1], truth[inner]), 1)
    for step in range(1, rounds + 1):
        parts = (model.emissions(words[i : i + FIT_WORDS]) for i in range(0, len(words), FIT_WORDS))
        scores = np.concatenate(list(parts))[of_word]
        found = posteriors(scores, lengths, model.transitions)
        gap = np.zeros((len(words), labels))
        for k in range(labels):
            gap[:, k] = np.bincount(of_word, (found - target)[:, k], len(words))
        slope = np.stack([np.bincount(numbers, gap[owner, k], features) for k in range(labels)], axis=1)
        # Expected changes: neighbours' probabilities with the transition between them. Their sum
        # over all words is a matrix product, so no word's own matrix is made.
        potential = np.exp(scores - scores.max(axis=1, keepdims=True))[inner]
        moves = np.exp(model.transitions)
        reach = potential @ moves.T
        before = found[inner - 1] / np.maximum(reach, 1e-30)
        before /= (before * reach).sum(axis=1, keepdims=True)
        changes = moves * (before.T @ potential) - kept
        for parameter, gradient, (mean, square) in zip(
            (model.weights, model.transitions), (slope, changes), moments
        ):
            gradient = gradient / len(lengths) + decay * parameter
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient * gradient - square)
            parameter -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return model


def training_sample(
    docs: DataFrame, key: str, text: str, lang: str, documents: int, words: int
) -> list[tuple[str, list[str]]]:
    """A bounded sample of labelled documents: by hash of the id, a stretch of words of each.

    Some of each language come first, the most frequent ``documents`` languages if there are
    more; the smallest hashes of all fill the rest.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).where(
        F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) != 2
    ).select(F.xxhash64(F.lit(3), key).alias("h"), F.col(text).alias("text"), F.col(lang).alias("lang"))

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("words", pa.string())])
        best: list[tuple] = []
        for part in chunks(batches):
            for h, body, language in part:
                best.append((h, language, body))
            best = _spread(best, documents, least)
        found = []
        for h, language, body in best:
            every = words_of(body)
            start = h % max(1, len(every) - words + 1)
            if every:
                found.append((h, language, " ".join(every[start : start + words])))
        yield to_batch(schema, list(zip(*found)) if found else [[]] * 3)

    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(documents).collect()
    if not counts:
        return []
    least = max(1, min(TRAIN_LEAST, documents // (2 * len(counts))))
    # Each task keeps its share of the sample; the smallest hashes of all are most of it.
    limit = rows.select("h").orderBy("h").limit(documents).agg(F.max("h")).first()[0]
    there = dict(rows.where(F.col("h") <= limit).groupBy("lang").count().collect())
    rare = [r["lang"] for r in counts if there.get(r["lang"], 0) < min(r["count"], least)]
    inside = F.col("h") <= limit
    if rare:
        order = Window.partitionBy("lang").orderBy("h")
        first = rows.where(F.col("lang").isin(rare)).select("lang", "h").withColumn("n", F.row_number().over(order))
        limits = first.where(F.col("n") <= least).groupBy("lang").agg(F.max("h")).collect()
        own = F.create_map(*[F.lit(x) for row in limits for x in row])
        inside |= F.coalesce(F.col("h") <= F.try_element_at(own, F.col("lang")), F.lit(False))
    chosen = rows.where(inside).mapInArrow(pick, "h long, lang string, words string")
    found = _spread([(r["h"], r["lang"], r["words"]) for r in chosen.collect()], documents, least)
    return [(language, text.split(" ")) for _, language, text in found]


def _spread(sample: list[tuple], documents: int, least: int) -> list[tuple]:
    """Rows of the smallest hashes: ``least`` of each language, and up to ``documents`` in all."""
    seen: Counter = Counter()
    first, rest = [], []
    for row in sorted(sample):
        (first if seen[row[1]] < least else rest).append(row)
        seen[row[1]] += 1
    return sorted(first + rest[: max(0, documents - len(first))])


def identify(
    docs: DataFrame,
    model: Model | None,
    key: str = "doc_id",
    text: str = "text",
    columns: Sequence[str] = (),
    sureness: str | None = None,
) -> DataFrame:
    """key, lang_pred, score for every whole text, and other ``columns`` as they are.

    ``sureness`` names one more column: the mean over all words of each word's largest
    probability, which is also high in a text of several languages.

    A null text and one without letters are ``und`` with score 0, and so is everything if
    there is no model. Equal means go to the language that sorts first.
    """
    same = docs.select(key, *columns).schema
    schema = StructType([*same, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    if sureness is not None:
        schema = schema.add(sureness, DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        out = to_arrow_schema(schema)
        index: dict[str, int] = {}
        table = np.zeros((0, len(model.languages) if model else 1))
        for rows in chunks(batches, nulls=True):
            every = [[w for w in words_of(r[1] or "")] if model else [] for r in rows]
            distinct = set(chain.from_iterable(every))
            new = [w for w in distinct if w not in index]
            if len(index) + len(new) > _REMEMBERED:
                index, new, table = {}, list(distinct), table[:0]
            if new:
                index.update(zip(new, range(len(index), len(index) + len(new))))
                table = np.concatenate([table, model.emissions(new)])
            lengths = np.fromiter(map(len, every), np.int64, len(every))
            has = np.flatnonzero(lengths > 0)
            languages, score, sure = [UNKNOWN] * len(rows), np.zeros(len(rows)), np.zeros(len(rows))
            if len(has):
                numbers = np.fromiter(
                    map(index.__getitem__, chain.from_iterable(every)), np.int64, int(lengths.sum())
                )
                found = posteriors(table[numbers], lengths[has], model.transitions)
                starts = np.cumsum(lengths[has]) - lengths[has]
                mean = np.add.reduceat(found, starts, axis=0) / lengths[has][:, None]
                best = mean.argmax(axis=1)
                score[has] = np.clip(mean[np.arange(len(has)), best], 0.0, 1.0)
                if sureness is not None:
                    sure[has] = np.clip(np.add.reduceat(found.max(axis=1), starts) / lengths[has], 0.0, 1.0)
                for i, b in zip(has.tolist(), best.tolist()):
                    # A run of numerals such as "²" counts as a word, but has no letter.
                    if any(c.isalpha() for w in every[i] for c in w):
                        languages[i] = model.languages[b]
                    else:
                        score[i] = sure[i] = 0.0
            more = [sure] if sureness is not None else []
            yield to_batch(out, [*kept_columns(rows, text, columns), languages, score, *more])

    return keyed_texts(docs, key, text, columns).mapInArrow(run, schema)


def train(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    documents: int = TRAIN_DOCUMENTS,
    words: int = TRAIN_WORDS,
) -> Model | None:
    """Fit on a bounded sample of labelled documents that aren't held out; None without any.

    Held out are documents whose ``crc32(id as text) mod 4`` is 2.
    """
    samples = training_sample(docs, key, text, lang, documents, words)
    return fit(samples) if samples else None
