"""Exact top-k search by integer inner product, with block-at-a-time pruning.

Vectors are dealt to parts by a hash of their ids. A part puts its documents in an order
that keeps vectors of the same leading dimensions together, and cuts it into blocks; a
block is a forward index (its documents' vectors) with the largest and smallest value of
each dimension. For a query, the sum of the larger of ``q * max`` and ``q * min`` bounds
every score of the block. Blocks are scored in descending order of their bounds, until the
bounds fall below the query's kth score in the part; what is left out can't be a result.
The parts' results meet in one window per query.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import to_batch
from tenura.llm.vectors import is_whole

# Documents in a part and in a block.
PART_ROWS = 32_768
BLOCK_ROWS = 64
_EXACT = float(1 << 53)
# Components and scores beyond a long count as the largest or smallest of these.
LARGEST = (1 << 63) - 1


class BlockIndex:
    """Blocks of documents of one vector length, and their bounds."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, rows: int = BLOCK_ROWS):
        order = np.lexsort((ids,) + self._leading(values))
        self.ids, self.values = ids[order], values[order]
        self.starts = np.arange(0, len(ids), rows)
        self.ends = np.minimum(self.starts + rows, len(ids))
        self.high = np.maximum.reduceat(self.values, self.starts, axis=0)
        self.low = np.minimum.reduceat(self.values, self.starts, axis=0)
        self.most = float(np.abs(self.values).max(initial=0))
        self.repeated = len(np.unique(ids)) < len(ids)

    @staticmethod
    def _leading(values: np.ndarray) -> tuple[np.ndarray, ...]:
        """Sort keys, last one first: sign and place of the largest components."""
        size = np.abs(values)
        rows = np.arange(len(values))
        first = size.argmax(axis=1)
        positive = values[rows, first] > 0
        size[rows, first] = -1
        return (size.argmax(axis=1), positive, first)

    def search(self, query: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best ids other than the query, ties to smaller ids."""
        bounds = _held(np.maximum(q * self.high, q * self.low).sum(axis=1))
        order = np.argsort(-bounds, kind="stable")
        bounds = bounds[order]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, self.values.dtype)
        at, wave = 0, 4
        while at < len(order):
            if len(ids) == k:
                # A block whose bound equals the kth score may hold a smaller id.
                left = int(np.searchsorted(-bounds, -scores[-1], side="right"))
                if at >= left:
                    break
                wave = min(wave, left - at)
            chosen = order[at : at + wave]
            at, wave = at + wave, wave * 2
            rows = (self.starts[chosen][:, None] + np.arange(self.ends[0])).ravel()
            rows = rows[rows < len(self.ids)] if chosen.max() == len(self.starts) - 1 else rows
            found = _held(self.values[rows] @ q)
            own = self.ids[rows]
            if len(ids) == k:
                better = found >= scores[-1]
                own, found = own[better], found[better]
            keep = own != query
            ids, scores = np.concatenate([ids, own[keep]]), np.concatenate([scores, found[keep]])
            if self.repeated:
                ids, scores = _best_of_each(ids, scores)
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores


def _held(scores: np.ndarray) -> np.ndarray:
    """Python's integers within a long; doubles stand for exact ones below 2**53."""
    return scores if scores.dtype != object else np.minimum(np.maximum(scores, -LARGEST), LARGEST)


def _best_of_each(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every id once, with its best score."""
    order = np.lexsort((-scores, ids))
    ids, scores = ids[order], scores[order]
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    return ids[first], scores[first]


def _unlike_before(ids: np.ndarray, values: np.ndarray, last_id, last_values) -> np.ndarray:
    """Which rows differ in id or vector from the row before; the first one's is given."""
    new = np.ones(len(ids), bool)
    new[0] = last_id is None or ids[0] != last_id or bool((values[0] != last_values).any())
    same = np.flatnonzero(ids[1:] == ids[:-1]) + 1
    new[same] = (values[same] != values[same - 1]).any(axis=1)
    return new


def _search(rows: DataFrame, k: int, block: int) -> DataFrame:
    """rows: part, length, is_query, id, values; sorted so that documents come first, equal ones together."""
    names = ["query_id", "vec_id", "score"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts, index = None, [], [], None
        for batch in batches:
            part, length, kind, own = (np.asarray(batch.column(i)) for i in range(4))
            flat = np.asarray(batch.column(4).flatten(), np.int64)
            lengths = np.asarray(batch.column(4).value_lengths())
            begin = np.cumsum(lengths) - lengths
            change = np.zeros(batch.num_rows, bool)
            for c in (part, length, kind):
                change[1:] |= c[1:] != c[:-1]
            cuts = np.flatnonzero(change).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                if (part[a], length[a]) != key:
                    key, ids, parts, index = (part[a], length[a]), [], [], None
                values = flat[begin[a] : begin[a] + (b - a) * int(length[a])].reshape(b - a, -1)
                if not kind[a]:
                    new = _unlike_before(own[a:b], values, ids[-1][-1] if ids else None, parts[-1][-1] if ids else None)
                    if new.any():
                        ids.append(own[a:b][new])
                        parts.append(values[new])
                    continue
                if not ids:
                    continue
                if index is None:
                    index = _index(np.concatenate(ids), np.concatenate(parts), block)
                out: list[list] = [[], [], []]
                for query, q in zip(own[a:b].tolist(), values):
                    found, scores = _exact_search(index, query, q, k)
                    out[0] += [query] * len(found)
                    out[1] += found
                    out[2] += scores
                yield to_batch(schema, out)

    return rows.mapInArrow(run, "query_id long, vec_id long, score long")


def _index(ids: np.ndarray, values: np.ndarray, block: int) -> BlockIndex:
    return BlockIndex(ids, values.astype(np.float64) if np.abs(values).max() < _EXACT else values.astype(object), block)


def _exact_search(index: BlockIndex, query: int, q: np.ndarray, k: int) -> tuple[list, list]:
    """Doubles hold every sum below 2**53; beyond it Python's integers are used."""
    if index.values.dtype == np.float64:
        if index.most * float(np.abs(q).max()) * len(q) < _EXACT:
            ids, scores = index.search(query, q.astype(np.float64), k)
            return ids.tolist(), [int(s) for s in scores]
        index = BlockIndex(index.ids, index.values.astype(np.int64).astype(object), int(index.ends[0]))
    ids, scores = index.search(query, q.astype(object), k)
    return ids.tolist(), [int(s) for s in scores]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: float = 256.0,
    part_rows: int = PART_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other vectors of every query.

    A component x counts as floor(``scale`` * x). Ties go to the smaller id; a query with
    fewer others has all of them. Vectors that are null, empty or hold null or non-finite
    components, and null ids, take no part; vectors of other lengths than the query's are
    not compared with it. A row with the query's own id is no result. Rows that share an
    id count as one, with the best of their scores. Scaled components and scores beyond
    2**63 - 1 or its negative count as these, and tie with each other.
    """

    def whole(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        rows = rows.where(F.col("id").isNotNull() & is_whole(F.col("v")))
        # A double beyond a long becomes the largest or smallest one.
        limit = float(1 << 63)

        def component(x):
            scaled = F.floor(F.greatest(F.least(x * F.lit(scale), F.lit(limit)), F.lit(-limit)))
            return F.greatest(scaled.cast("long"), F.lit(-LARGEST))

        values = F.transform("v", component)
        return rows.select("id", F.size("v").alias("length"), values.alias("v"))

    documents = whole(vectors)
    count = documents.count()
    parts = max(1, -(-count // part_rows))
    dealt = documents.select(
        F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "length", F.lit(0).alias("q"), "id", "v"
    )
    asked = whole(queries).dropDuplicates(["id", "v"]).select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "length", F.lit(1).alias("q"), "id", "v"
    )
    rows = dealt.unionByName(asked).repartition("part").sortWithinPartitions("part", "length", "q", "id", "v")
    found = _search(rows, k, block_rows)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
