"""Alignment of the tokens of two tokenizers over the same texts, and their linked ids.

Both token sequences of a text cover the same bytes. All tokens of many texts are sorted by
where they start; a running maximum of their ends shows where no token reaches across, which
closes a group, and inside groups the overlapping tokens are linked. Tokens of neither side
reach across a single space or newline between two other characters, so groups and links of the
piece between two of them are found once and remembered; only texts for which that isn't sure are
aligned whole. Texts are worked on in blocks of bounded size. A block is written once, with its linked id pairs counted per
document; only these pairs are shuffled to count documents over the whole table, and each
block gets its own pairs' counts back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType
from pyspark.sql.types import StructField, StructType

from tenura.llm.common import chunks, to_batch
from tenura.llm.pieces import (
    PieceIds, flat_ids, library_encoder, load_tokenizer, space_piece_text, space_pieces,
)
from tenura.sources.shared import materialize

# Characters tokenized at a time, and links of a block: what a task holds at most beyond one
# document. A block's pairs take 8 bytes each while it is made.
CHUNK_CHARS = 1_000_000
BLOCK_LINKS = 3_000_000
# Pieces whose links a worker remembers before it forgets the rarer ones.
REMEMBERED = 300_000
_ODD_START = re.compile(r"\s|\x00")
# Parts of a document that become text for its digest at a time.
DIGEST_TOKENS = 100_000
_COUNTED = ("n_a", "n_b", "n_groups", "n_links")


def byte_of_character() -> dict[str, int]:
    """The byte that each character stands for in byte-level vocabularies.

    Printable bytes stand for themselves, the others, in order, are characters from U+0100.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


def spaced_pieces(text: str) -> list[str]:
    """Pieces of a space and the text, see ``space_pieces``: the first follows the space."""
    pieces = space_pieces(text)
    if text[:1] in ("", " ", "\n") or _ODD_START.match(text):
        return space_pieces(" " + text)
    pieces[0] = pieces[0][1:]
    return pieces


class ByteLevelTokens:
    """Ids and token bytes of a byte-level vocabulary of the tokenizers library.

    Ids of pieces between spaces are remembered for texts that are aligned whole. A text that holds a special string goes to the library whole, as plain text.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.tokenizer.encode_special_tokens = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        encode = library_encoder(path)
        self.known = PieceIds(encode, spaced_pieces, space_piece_text, REMEMBERED // 3)
        self.fresh = PieceIds(encode, spaced_pieces, space_piece_text)
        self.known.closing = self.fresh.closing = "\x00"
        byte = byte_of_character()
        vocabulary = self.tokenizer.get_vocab()
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.pieces[number] = bytes(byte[c] for c in token if c in byte)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = [self.apart(t) for t in texts]
        found = iter(self.known.ids_of([t for t, p in zip(texts, plain) if p]))
        whole = [" " + t for t, p in zip(texts, plain) if not p]
        encoded = iter(self.tokenizer.encode_batch_fast(whole, add_special_tokens=False))
        ids = [next(found) if p else np.array(next(encoded).ids, np.uint32) for p in plain]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), lengths

    def apart(self, text: str) -> bool:
        """Whether the ids of the text are those of its pieces."""
        return not ("<" in text and any(s in text for s in self.special))

    def piece_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct ``spaced_pieces``; nothing is remembered."""
        self.fresh._clear()
        numbers = self.fresh._learn(pieces)
        return self.fresh.ids(numbers), self.fresh.lengths[numbers]


class PieceTokens:
    """Ids and token bytes of a sentencepiece model, which adds the first space itself.

    Merges of a model of ranked merges depend on the characters they join only. If no token
    of its vocabulary goes on with a space or newline after other characters, none is formed
    across the start of a piece, so the ids of a text are those of its pieces.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            if self.model.is_byte(number):
                self.pieces.append(bytes([int(piece[3:5], 16)]))
            else:
                self.pieces.append(piece.replace("▁", " ").encode())
        self.space = self.model.piece_to_id("▁")
        self.divides = self._ranked() and not any(
            " " in p.lstrip() or "\n" in p[1:]
            for p in (self.model.id_to_piece(n).replace("▁", " ") for n in range(len(self.pieces)))
        )

    def _ranked(self) -> bool:
        """Scores of merges are their ranks, those of other models are logarithms."""
        model = self.model
        plain = [n for n in range(len(self.pieces)) if not (
            model.is_byte(n) or model.is_control(n) or model.is_unknown(n) or model.is_unused(n))]
        return all(s <= 0 and s == int(s) for s in map(model.get_score, plain))

    def piece_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``spaced_pieces``; one that starts with a newline has no space before it.

        None for those marked as a text's first, as the model would add a space.
        """
        found = self.model.encode(pieces, num_threads=1)
        for i, piece in enumerate(pieces):
            if piece[:1] == "\n" and found[i][:1] == [self.space]:
                del found[i][0]
            elif piece[:1] == "\x00":
                found[i] = []
        return flat_ids(found)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat_ids(self.model.encode(texts, num_threads=1))


class Side:
    """One tokenizer, with the bytes of its tokens as one array and their texts for digests."""

    def __init__(self, tokens):
        self.tokens = tokens
        self.sizes = np.fromiter(map(len, tokens.pieces), np.int64, len(tokens.pieces))
        self.text = np.array([str(i) for i in range(len(tokens.pieces))], dtype=object)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, how many each has, and whether its bytes are space+text."""
        return self._compared(*self.tokens.ids(texts), [b" " + t.encode() for t in texts])

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of pieces, see ``spaced_pieces``."""
        return self._compared(*self.tokens.piece_ids(pieces), [space_piece_text(p).encode() for p in pieces])

    def _compared(
        self, ids: np.ndarray, counts: np.ndarray, expected: list[bytes]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = ids.astype(np.int64)
        ends = np.cumsum(counts)
        spelt = list(map(self.tokens.pieces.__getitem__, ids.tolist()))
        upto = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        sizes = np.fromiter(map(len, expected), np.int64, len(expected))
        same = upto[ends] - upto[ends - counts] == sizes
        if not same.all() or b"".join(spelt) != b"".join(expected):
            for i, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
                same[i] = b"".join(spelt[a:b]) == expected[i]
        return ids, counts, same


def coalesced_groups(
    a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups of overlapping intervals of two kinds.

    Returns the order of all intervals by (group, kind, start), in which numbers from
    ``len(a_starts)`` on are of the second kind; the group of each interval in that order;
    and the linked pairs (a, b) of the overlapping ones. No interval may be empty.
    """
    starts = np.concatenate([a_starts, b_starts])
    ends = np.concatenate([a_ends, b_ends])
    kind = np.repeat([0, 1], [len(a_starts), len(b_starts)])
    by_start = np.lexsort((kind, starts))
    reached = np.maximum.accumulate(ends[by_start])
    breaks = np.ones(len(by_start), bool)
    breaks[1:] = starts[by_start][1:] >= reached[:-1]
    group = np.empty(len(by_start), np.int64)
    group[by_start] = np.cumsum(breaks) - 1
    order = np.lexsort((starts, kind, group))
    # An interval overlaps those of the other kind from the first that ends after its start.
    first = np.searchsorted(b_ends, a_starts, "right")
    last = np.searchsorted(b_starts, a_ends, "left")
    many = last - first
    a = np.repeat(np.arange(len(a_starts)), many)
    b = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(a))
    return order, group[order], a, b


def _spelt(
    left: Side, right: Side, ids: np.ndarray, kinds: np.ndarray, groups: np.ndarray, last: np.ndarray
) -> np.ndarray:
    """``a1,a2|b1;a3|b2`` in parts, one for each id; ids in order of group and kind.

    No sign follows the ids at ``last``.
    """
    texts = np.where(kinds == 0, left.text[np.where(kinds == 0, ids, 0)],
                     right.text[np.where(kinds == 1, ids, 0)])
    mark = np.full(len(ids), ",", dtype=object)
    mark[:-1][kinds[1:] != kinds[:-1]] = "|"
    mark[:-1][groups[1:] != groups[:-1]] = ";"
    mark[last] = ""
    return texts + mark


def _digest(parts: Sequence[str], joint: str) -> str:
    """SHA-256 of all parts with ``joint`` between them; empty without parts."""
    digest = hashlib.sha256()
    for i in range(0, len(parts), DIGEST_TOKENS):
        digest.update(((joint if i else "") + joint.join(parts[i : i + DIGEST_TOKENS])).encode())
    return digest.hexdigest() if len(parts) else ""


class Aligner:
    """Token groups and links of texts under two tokenizers."""

    def __init__(self, left: Side, right: Side):
        self.left, self.right = left, right
        # A pair of ids as one number.
        self.right_ids = len(right.sizes)
        self.known = PieceLinks(self)

    def align(self, texts: list[str]) -> tuple[dict[str, Sequence], np.ndarray, np.ndarray]:
        """Per text n_a, n_b, n_groups, n_links, groups_sha256; links as (text, pair of ids).

        A text that is empty, or that either tokenizer doesn't give back byte by byte, has
        no tokens.
        """
        divides = self.right.tokens.divides
        apart = np.array([t != "" and divides and self.left.tokens.apart(t) for t in texts], bool)
        sure, found, *links = self.known.align([t for t, p in zip(texts, apart) if p])
        apart[apart] = sure
        if apart.all():
            return found, *links
        rest = np.flatnonzero(~apart)
        other, *others = self.align_whole([texts[i] for i in rest.tolist()])
        order = np.argsort(np.concatenate([np.flatnonzero(apart), rest]), kind="stable")
        both = {n: np.concatenate([np.asarray(found[n]), np.asarray(other[n])])[order] for n in _COUNTED}
        digests = [*found["groups_sha256"], *other["groups_sha256"]]
        both["groups_sha256"] = [digests[i] for i in order.tolist()]
        owner = np.concatenate([np.flatnonzero(apart)[links[0]], rest[others[0]]])
        pairs = np.concatenate([links[1], others[1]])
        by_text = np.argsort(owner, kind="stable")
        return both, owner[by_text], pairs[by_text]

    def align_whole(self, texts: list[str]) -> tuple[dict[str, Sequence], np.ndarray, np.ndarray]:
        """Like ``align``, by the tokens of whole texts."""
        filled = np.fromiter(map(bool, texts), bool, len(texts))
        found, spelt, ends, owner, pairs = self._linked(
            self.left.encode(texts), self.right.encode(texts), filled)
        starts = np.concatenate([[0], ends])
        found["groups_sha256"] = [
            _digest(spelt[a:b], "") for a, b in zip(starts.tolist(), ends.tolist())
        ]
        return found, owner, pairs

    def align_pieces(self, pieces: list[str]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray]:
        """Counts of pieces, their groups as text, and their links in a row as pairs of ids.

        A piece that either tokenizer doesn't give back byte by byte has no groups.
        """
        found, spelt, ends, _, pairs = self._linked(
            self.left.encode_pieces(pieces), self.right.encode_pieces(pieces), np.ones(len(pieces), bool))
        spelt = spelt.tolist()
        starts = np.concatenate([[0], ends])
        return found, ["".join(spelt[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pairs

    def _linked(self, of_left: tuple, of_right: tuple, filled: np.ndarray) -> tuple:
        """Counts of each text, groups as text for each id, where each text's end; links."""
        sides = [of_left, of_right]
        good = sides[0][2] & sides[1][2] & filled
        tokens = []
        for side, (ids, counts, _) in zip((self.left, self.right), sides):
            ids = ids[np.repeat(good, counts)]
            ends = np.cumsum(side.sizes[ids])
            starts = ends - side.sizes[ids]
            keep = ends > starts
            tokens.append((ids[keep], starts[keep], ends[keep]))
        owner = []
        for (ids, counts, _) in sides:
            owner.append(np.repeat(np.flatnonzero(good), counts[good]))
        (a_ids, a_starts, a_ends), (b_ids, b_starts, b_ends) = tokens
        order, group, a, b = coalesced_groups(a_starts, a_ends, b_starts, b_ends)
        ids = np.concatenate([a_ids, b_ids])[order]
        kinds = np.repeat([0, 1], [len(a_ids), len(b_ids)])[order]
        text_of = np.concatenate(owner)[order]
        count = len(filled)
        breaks = np.ones(len(group), bool)
        breaks[1:] = group[1:] != group[:-1]
        found = {
            "n_a": np.bincount(owner[0], minlength=count),
            "n_b": np.bincount(owner[1], minlength=count),
            "n_groups": np.bincount(text_of[breaks], minlength=count),
            "n_links": np.bincount(owner[0][a], minlength=count),
        }
        ends = np.searchsorted(text_of, np.arange(count), "right")
        spelt = _spelt(self.left, self.right, ids, kinds, group, np.unique(ends[ends > 0]) - 1)
        return found, spelt, ends, owner[0][a], a_ids[a] * self.right_ids + b_ids[b]


class PieceLinks(PieceIds):
    """Groups and links of texts by way of their pieces; ``ids`` are pairs of linked ids here."""

    def __init__(self, aligner: Aligner, remembered: int = REMEMBERED):
        self.aligner = aligner
        super().__init__(None, spaced_pieces, space_piece_text, remembered)

    def _clear(self) -> None:
        super()._clear()
        self.counts = np.zeros((3, 0), np.int64)
        self.spelt: list[str] = []

    def _forget(self) -> np.ndarray:
        counts, spelt = self.counts, self.spelt
        kept = super()._forget()
        self.counts, self.spelt = counts[:, kept], [spelt[i] for i in kept.tolist()]
        return kept

    def _learn(self, pieces: list[str]) -> np.ndarray:
        numbers = len(self.keys) + np.arange(len(pieces))
        found, spelt, pairs = self.aligner.align_pieces(pieces)
        self._add(pieces, pairs, found["n_links"])
        own = np.stack([found[n] for n in ("n_a", "n_b", "n_groups")])
        self.counts = np.concatenate([self.counts, own], axis=1)
        self.spelt += spelt
        return numbers

    def align(self, texts: list[str]) -> tuple[np.ndarray, dict[str, Sequence], np.ndarray, np.ndarray]:
        """Which texts' pieces both tokenizers give back; of these, what the aligner returns.

        Pieces marked as a text's first that no space comes before are not among them.
        """
        numbers, many = self.pieces(texts)
        unsure = self.counts[2] == 0
        sure = np.bincount(np.repeat(np.arange(len(texts)), many), unsure[numbers], len(texts)) == 0
        numbers, many = numbers[np.repeat(sure, many)], many[sure]
        ends = np.cumsum(many)
        starts = ends - many

        def per_text(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[ends] - total[starts]

        n_links = per_text(self.lengths[numbers])
        found = dict(zip(_COUNTED, [*(per_text(own[numbers]) for own in self.counts), n_links]))
        parts = list(map(self.spelt.__getitem__, numbers.tolist()))
        found["groups_sha256"] = [
            _digest(parts[a:b], ";") for a, b in zip(starts.tolist(), ends.tolist())
        ]
        return sure, found, np.repeat(np.arange(len(many)), n_links), self.ids(numbers)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2**31, compressed."""
    return pa.compress(np.ascontiguousarray(values, np.int32), codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int) -> np.ndarray:
    plain = pa.decompress(data, 4 * count, codec="zstd", asbytes=True)
    return np.frombuffer(plain, np.int32)


_BLOCK_COLUMNS = [
    StructField("block", LongType()),
    StructField("n_a", ArrayType(LongType())),
    StructField("n_b", ArrayType(LongType())),
    StructField("n_groups", ArrayType(LongType())),
    StructField("n_links", ArrayType(LongType())),
    StructField("groups_sha256", ArrayType(StringType())),
    # Distinct pairs of each document as steps of their numbers in the block, and how often.
    StructField("n_pairs", ArrayType(LongType())),
    StructField("steps", BinaryType()),
    StructField("times", BinaryType()),
    StructField("a_id", ArrayType(IntegerType())),
    StructField("b_id", ArrayType(IntegerType())),
    StructField("n_docs", ArrayType(IntegerType())),
]
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(byte_path: str, piece_path: str) -> Aligner:
    """The worker's tokenizers, loaded once."""
    key = (byte_path, piece_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(Side(ByteLevelTokens(byte_path)), Side(PieceTokens(piece_path)))
    return _ALIGNERS[key]


class _Block:
    """Documents gathered until their distinct pairs are enough for a row."""

    def __init__(self, right_ids: int):
        self.right_ids = right_ids
        self.keys: list = []
        self.columns: dict[str, list] = {n: [] for n in (*_COUNTED, "groups_sha256")}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.links = 0

    def add(self, keys: list, found: dict, owner: np.ndarray, pairs: np.ndarray) -> None:
        for name, column in self.columns.items():
            column.extend(found[name].tolist() if name in _COUNTED else found[name])
        # Distinct pairs per document; both as one number sort fast.
        span = int(pairs.max()) + 1 if len(pairs) else 1
        both = np.sort(owner * span + pairs)
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        at = np.flatnonzero(new)
        times = np.diff(at, append=len(both))
        owner, pairs = np.divmod(both[at], span)
        self.parts.append((owner + len(self.keys), pairs, times))
        self.links += len(at)
        self.keys.extend(keys)

    def row(self, number: int) -> list:
        owner, pairs, times = (np.concatenate(p) for p in zip(*self.parts))
        distinct, numbers, docs = np.unique(pairs, return_inverse=True, return_counts=True)
        n_pairs = np.bincount(owner, minlength=len(self.keys))
        before = np.concatenate([[0], numbers[:-1]])
        before[(np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]] = 0
        return [
            [number],
            *([self.columns[n]] for n in (*_COUNTED, "groups_sha256")),
            [n_pairs.tolist()],
            [packed(numbers - before)],
            [packed(times)],
            [(distinct // self.right_ids).astype(np.int32)],
            [(distinct % self.right_ids).astype(np.int32)],
            [docs.astype(np.int32)],
        ]


def align_documents(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    key: str = "doc_id",
    text: str = "text",
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """Token groups and links of every document under two tokenizers, one row per row.

    Columns: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. A is the
    byte-level vocabulary at ``byte_path``, applied to a space and the text, B the
    sentencepiece model at ``piece_path``, which adds that space; special strings are plain
    text. Byte offsets where tokens of both end part the groups; tokens that overlap are
    linked. A pair of ids counts the documents of the whole table in which it is linked:
    ``count_sum`` adds these counts over a document's links, ``n_best`` counts links whose
    pair has the highest count of its A id (ties included).

    Texts that are null, empty, or that a tokenizer doesn't give back exactly have no tokens:
    zeros and an empty digest. Repeated rows are documents of their own; null keys keep their
    rows; other columns of any name are not read. An empty table gives no rows.

    A block has at most ``block_links`` (document, pair) entries beyond one document, so
    handing its counts back takes a bounded group; nothing is gathered per id or key.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    key_type = rows.schema["key"].dataType
    schema = StructType([StructField("keys", ArrayType(key_type)), *_BLOCK_COLUMNS])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_path, piece_path)
        out = to_arrow_schema(schema)
        first = TaskContext.get().partitionId() << 32
        block, number = _Block(aligner.right_ids), 0
        for chunk in chunks(batches, limit=CHUNK_CHARS):
            keys, texts = zip(*chunk)
            block.add(list(keys), *aligner.align(list(texts)))
            if block.links >= block_links:
                yield to_batch(out, [[block.keys], *block.row(first + number)])
                block, number = _Block(aligner.right_ids), number + 1
        if block.keys:
            yield to_batch(out, [[block.keys], *block.row(first + number)])

    blocks = materialize(rows.mapInArrow(run, schema), "alignment")
    pairs = blocks.select(
        "block", F.posexplode(F.arrays_zip("a_id", "b_id", "n_docs")).alias("at", "pair")
    ).select("block", "at", "pair.*")
    counts = pairs.groupBy("a_id", "b_id").agg(F.sum("n_docs").alias("docs"))
    # An A id meets at most as many B ids as the second vocabulary has.
    highest = F.max("docs").over(Window.partitionBy("a_id"))
    counts = counts.select("a_id", "b_id", "docs", (F.col("docs") == highest).alias("best"))
    numbered = pairs.select(F.col("block").alias("of_block"), "at", "a_id", "b_id")
    told = numbered.join(counts, ["a_id", "b_id"]).select(
        "of_block", "at", "docs", "best"
    )

    names = [*_COUNTED, "n_best", "count_sum"]
    result = StructType(
        [StructField("key", key_type), *(StructField(n, LongType()) for n in names),
         StructField("groups_sha256", StringType())]
    )

    def finish(own: pa.Table, found: pa.Table) -> pa.Table:
        at = found.column("at").to_numpy()
        docs_of = np.zeros(len(at), np.int64)
        best = np.zeros(len(at), np.int64)
        docs_of[at] = found.column("docs").to_numpy()
        best[at] = found.column("best").to_numpy().astype(np.int64)
        row = {n: own.column(n)[0] for n in own.column_names}
        n_pairs = np.array(row["n_pairs"].as_py(), np.int64)
        entries = int(n_pairs.sum())
        numbers = unpacked(row["steps"].as_py(), entries).astype(np.int64)
        times = unpacked(row["times"].as_py(), entries).astype(np.int64)
        # Steps start anew with each document.
        upto = np.cumsum(numbers)
        starts = np.cumsum(n_pairs) - n_pairs
        base = np.concatenate([[0], upto])[starts]
        numbers = upto - np.repeat(base, n_pairs)

        def per_document(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[starts + n_pairs] - total[starts]

        columns = [row["keys"].values, *(row[n].values for n in _COUNTED)]
        columns += [pa.array(per_document(times * best[numbers])),
                    pa.array(per_document(times * docs_of[numbers])), row["groups_sha256"].values]
        return pa.Table.from_arrays(columns, schema=to_arrow_schema(result))

    own = blocks.drop("a_id", "b_id", "n_docs")
    done = own.groupBy("block").cogroup(told.groupBy("of_block")).applyInArrow(finish, result)
    return done.withColumnRenamed("key", key)
