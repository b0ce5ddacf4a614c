"""Token ids in binary files of patched frame-of-reference blocks (see pfor).

Files are written in ascending key order, one or more by each task. A file holds its
blocks, then the table of its documents (key, whether the key is null, ids before it) and
the index of block starts, then a footer. Tasks write under names of their own, and only
files in the committed manifest count, so a task that is repeated does no harm.

File layout: ``TENPFOR1``; blocks; u64 block offsets; i64 keys; u8 null flags; u64 ids
before each document, and in all; footer of u64 blocks, documents, ids, offset of the
block offsets, then ``TENPFOR1``.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm import pfor
from tenura.llm.common import chunks, to_batch
from tenura.llm.pieces import worker_pieces
from tenura.sources.shared import materialize, new_path

MAGIC = b"TENPFOR1"
FOOTER = struct.Struct("<4Q8s")
# A task starts a new file after so many ids.
FILE_IDS = 64_000_000
# Blocks read at a time.
READ_BLOCKS = 4096
MANIFEST = "path string, part long, file long, n_docs long, n_ids long"


class TokenFileWriter:
    """Writes one file block by block; holds less than a run of blocks in memory."""

    def __init__(self, path: str):
        filesystem, place = fs.FileSystem.from_uri(path)
        filesystem.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.path, self.out = path, filesystem.open_output_stream(place)
        self.out.write(MAGIC)
        self.at = len(MAGIC)
        self.offsets: list[np.ndarray] = []
        self.keys: list[int | None] = []
        self.lengths: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= 2048 * pfor.BLOCK:
            self._flush(self.n_waiting // pfor.BLOCK * pfor.BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        data, starts = pfor.pack(ids[:n])
        self.out.write(data)
        self.offsets.append(starts + self.at)
        self.at += len(data)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def close(self) -> tuple:
        self._flush(self.n_waiting)
        offsets = np.concatenate(self.offsets).astype("<u8")
        nulls = np.array([k is None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        before = np.concatenate([[0], np.cumsum(self.lengths)]).astype("<u8")
        for array in (offsets, keys, nulls, before):
            self.out.write(array.tobytes())
        self.out.write(FOOTER.pack(len(offsets), len(keys), self.n_ids, self.at, MAGIC))
        self.out.close()
        return self.path, len(keys), self.n_ids


def read_documents(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(key, ids before it in the file, ids) of every document of a file."""
    filesystem, place = fs.FileSystem.from_uri(path)
    with filesystem.open_input_file(place) as file:
        size = file.size()
        footer = file.read_at(FOOTER.size, size - FOOTER.size)
        n_blocks, n_docs, n_ids, tables, magic = FOOTER.unpack(footer)
        if magic != MAGIC:
            raise ValueError(f"{path} is not a complete token file")
        table = file.read_at(size - FOOTER.size - tables, tables)
        offsets = np.frombuffer(table, "<u8", n_blocks).astype(np.int64)
        keys = np.frombuffer(table, "<i8", n_docs, 8 * n_blocks)
        nulls = np.frombuffer(table, np.uint8, n_docs, 8 * (n_blocks + n_docs))
        before = np.frombuffer(table, "<u8", n_docs + 1, 8 * n_blocks + 9 * n_docs)
        before = before.astype(np.int64)
        ends = np.append(offsets[1:], tables)
        held, base, block = np.zeros(0, np.uint32), 0, 0
        for d in range(n_docs):
            parts, have = [held], base + len(held)
            while have < before[d + 1]:
                last = min(block + READ_BLOCKS, n_blocks)
                start = int(offsets[block])
                data = file.read_at(int(ends[last - 1]) - start, start)
                parts.append(pfor.unpack(data, offsets[block:last] - start))
                have, block = have + len(parts[-1]), last
            if len(parts) > 1:
                held = np.concatenate(parts)[before[d] - base :]
                base = int(before[d])
            first = before[d] - base
            yield (
                None if nulls[d] else int(keys[d]),
                int(before[d]),
                held[first : first + before[d + 1] - before[d]],
            )


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode whole texts and write their ids, each document closed by ``end_id``.

    ``tokenizer`` is the path of a byte-level vocabulary of the tokenizers library.
    Returns the manifest: path, part and file (their order), n_docs, n_ids, a written table. A
    null text is empty, so it has the end id alone; rows with equal keys are all kept, in
    the order of their texts; a null key comes first. Without rows there are no files.
    """
    folder = folder or new_path(docs.sparkSession, "token-files")
    if "://" not in folder:
        folder = folder.replace("file:", "file://") if folder.startswith("file:") else f"file://{folder}"

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_pieces(tokenizer)
        end = np.array([end_id], np.uint32)
        writer = None
        done = []
        for rows in chunks(batches):
            for row, ids in zip(rows, encoder.ids_of([r[1] for r in rows])):
                if writer is None:
                    writer = TokenFileWriter(f"{folder}/ids-{uuid.uuid4().hex}.tpf")
                writer.add(row[0], np.concatenate([ids, end]))
                if writer.n_ids >= file_ids:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        part = TaskContext.get().partitionId()
        found = [(path, part, i, docs, ids) for i, (path, docs, ids) in enumerate(done)]
        names = ["path", "part", "file", "n_docs", "n_ids"]
        schema = pa.schema([(n, pa.string() if n == "path" else pa.int64()) for n in names])
        yield to_batch(schema, list(zip(*found)) if found else [[]] * 5)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key").sortWithinPartitions("key", "text")
    return materialize(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Documents of all files: key, start (ids of all documents before it), n_ids, ids_crc32.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers. Files are read
    in parallel; only the manifest, a row for each file, is put in order.
    """
    order = Window.orderBy("part", "file")
    placed = manifest.withColumn(
        "base", F.coalesce(F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "start", "n_ids", "ids_crc32"]
        schema = pa.schema([(n, pa.int64()) for n in names])
        for batch in batches:
            for path, base in zip(*(batch.column(i).to_pylist() for i in range(2))):
                found = []
                for key, before, ids in read_documents(path):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    found.append((key, base + before, len(ids), crc))
                    if len(found) >= 50_000:
                        yield to_batch(schema, list(zip(*found)))
                        found = []
                if found:
                    yield to_batch(schema, list(zip(*found)))

    files = placed.select("path", "base").repartition(
        int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path"
    )
    return files.mapInArrow(read, "key long, start long, n_ids long, ids_crc32 long")
