"""Helpers that several operators share: input columns, batches of rows, components of links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.sources.shared import materialize

# Text of this many characters is worked on at a time, which bounds a task's memory.
CHUNK_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(
    batches: Iterable[pa.RecordBatch], text: int = 1, limit: int = CHUNK_CHARS, nulls: bool = False
) -> Iterator[list[tuple]]:
    """Rows as tuples, in lists of about ``limit`` bytes in column ``text``.

    A null text becomes empty unless ``nulls`` are to be kept.

    Batches are cut before they become Python values, so that no task holds more than one
    list of them; a longer text is a list alone.
    """
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for piece, length in slices(batch, text, limit):
            if rows and size + length > limit:
                yield rows
                rows, size = [], 0
            columns = [c.to_pylist() for c in piece.columns]
            if not nulls:
                columns[text] = [t or "" for t in columns[text]]
            rows += zip(*columns)
            size += length
            if size >= limit:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def slices(
    batch: pa.RecordBatch, text: int = 1, limit: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Parts of a batch of at most ``limit`` bytes in a text column, or one row, and their size."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(sizes.astype(np.int64) + 100)
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, before + limit, "right")))
        yield batch.slice(start, stop - start), int(upto[stop - 1] - before)
        start = stop


def keyed_texts(docs: DataFrame, key: str, text: str, columns: Sequence[str]) -> DataFrame:
    """Key, text and the other ``columns`` under names of their own, the text only once."""
    named = [key, text, *(c for c in columns if c != text)]
    return docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(named)))


def kept_columns(rows: Sequence[tuple], text: str, columns: Sequence[str]) -> list[Sequence]:
    """Key and ``columns`` of rows of ``keyed_texts``."""
    whole = list(zip(*rows))
    others = iter(whole[2:])
    return [whole[0], *(whole[1] if c == text else next(others) for c in columns)]


def to_batch(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def connected_components(nodes: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Smallest node reachable from each node, as columns node, component.

    ``links`` has long columns a and b, without nulls. Alternating large-star and
    small-star steps: each reduces the links to stars around smaller nodes, so the number
    of rounds grows with the logarithm of the longest chain, and no component is gathered
    anywhere. Every round is a written table, so a lost executor repeats one round.
    """
    links = links.select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    ).where("hi <> lo").distinct()
    links = materialize(links, f"{name}-links")
    state = _checksum(links)
    while state[0]:
        both = links.unionAll(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
        large = (
            both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .where("hi <> lo").distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), "m")
        small = small.unionAll(least).select("hi", F.col("m").alias("lo")).distinct()
        links = materialize(small, f"{name}-links")
        before, state = state, _checksum(links)
        if before == state:
            break
    return nodes.join(links.withColumnRenamed("hi", "node"), "node", "left").select(
        "node", F.coalesce("lo", "node").alias("component")
    )


def _checksum(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)")),
        F.sum(F.col("lo").cast("decimal(20,0)")),
    ).first()
    return tuple(row)
