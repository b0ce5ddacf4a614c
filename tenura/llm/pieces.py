"""Splits of a text at which a tokenizer's words never join, and ids remembered per piece.

A tokenizer's cost is paid once for each distinct piece of a task's memory; whole texts are
put together from piece ids in numpy. Splits are exact: the ids are those of the text as a
whole, for any input.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces remembered by one task before it forgets the rarer ones; bounds its memory.
REMEMBERED = 400_000
_WIDE = re.compile("[^\x00-\u012f\u0131-\u024f]")
_ODD = ["\x00", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def space_joined(text: str) -> str | None:
    """The pieces of ``space_pieces`` with a space after each but the last, if none holds one."""
    plain = not (
        "  " in text or "\n " in text or " \n" in text or "\n\n" in text
        or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or any(c in text for c in _ODD)
    )
    return "\x00" + text.replace("\n", " \n") if plain else None


def space_pieces(text: str) -> list[str]:
    """Pieces for byte-level vocabularies, whose words may start with one space.

    A single space or newline between two other characters always starts a word there. A
    piece stands for itself with a space before it; one that starts with a newline stands
    for itself; the first is marked with a NUL character. Other white space stays inside
    pieces.
    """
    joined = space_joined(text)
    if joined is not None:
        return joined.split(" ")
    if "\x00" in text:
        return ["\x00" + text]
    parts = _SINGLE_SPACE.split(text)
    parts[0] = "\x00" + parts[0]
    return parts


def space_piece_text(piece: str) -> str:
    if piece[0] == "\x00":
        return piece[1:]
    return piece if piece[0] == "\n" else " " + piece


def word_joined(text: str) -> str:
    """The pieces of ``word_pieces`` with a space after each but the last."""
    if "<" not in text and (text.isascii() or not _WIDE.search(text)):
        text = text.lower()
    return text.replace("\n", " ")


def word_pieces(text: str) -> list[str]:
    """Pieces for vocabularies that drop white space and case.

    Not in lower case: texts whose lower case may depend on the library's tables, and those
    that might become a special string by it.
    """
    return word_joined(text).split(" ")


def word_piece_text(piece: str) -> str:
    return piece


def load_tokenizer(path: str):
    """The library's tokenizer, in one thread, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def flat_ids(found: list) -> tuple[np.ndarray, np.ndarray]:
    """Id lists as one array and their lengths."""
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths


def library_encoder(path: str, together: int = 1024) -> Encoder:
    """Encodes many pieces with the library: their ids in a row, and how many each has.

    Pieces are passed ``together`` in one text, which saves most of the cost of a call for
    each; words don't join where one piece meets the next. The bytes of the tokens tell
    where each piece ends. Pieces of which the library may change the length in other ways
    than lower case, or that hold special tokens, are passed one by one. Pieces that are one
    word of letters go to the library's model, as its other steps leave them whole.
    """
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import CharDelimiterSplit

    from tenura.llm.bpe import byte_letters

    tokenizer = load_tokenizer(path)
    word_end = tokenizer.model.end_of_word_suffix or ""
    vocabulary = tokenizer.get_vocab()
    width = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, number in vocabulary.items():
        width[number] = len(token) - (len(word_end) if word_end and token.endswith(word_end) else 0)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    joint = " " if word_end else ""
    lead = "" if word_end else " "
    shown = {byte: letter for letter, byte in byte_letters().items()}
    head, skip = lead.translate(shown), len(lead)
    alone = Tokenizer(tokenizer.model)  # the model only, its words between spaces
    alone.pre_tokenizer = CharDelimiterSplit(" ")

    def word(text: str) -> str | None:
        """What the model is given of a text that is one word of letters up to U+024F."""
        letters = text[len(lead) :]
        if not letters.isalpha() or text[: len(lead)] != lead:
            return None
        if word_end and letters != letters.lower():
            return None
        if letters.isascii():
            return head + letters
        return text.encode().decode("latin-1").translate(shown) if max(letters) < "\u0250" else None

    def passed(text: str) -> list[tuple]:
        normal = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        return [t for t, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    probe = lead + "a\u00ed\u00f1\u0142"
    direct = tokenizer.pre_tokenizer is not None and passed(probe) == [word(probe)]
    direct = direct and not any(t.strip().isalpha() for t in special)

    def joins(text: str) -> bool:
        if word_end:
            sure = text != "" and (text.isascii() or max(text) < "\u0250")
        else:
            sure = text[:1] in (" ", "\n") and len(text) > 1
        return sure and not ("<" in text and any(t in text for t in special))

    def encode_all(texts: list[str], by=tokenizer) -> list[list[int]]:
        return [e.ids for e in by.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_joined(
        texts: list[str], joint: str, size_of: Callable[[str], int], by=tokenizer
    ) -> tuple[np.ndarray, np.ndarray]:
        flats, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for group in (texts[i : i + together] for i in range(0, len(texts), together)):
            ids = np.array(encode_all([joint.join(group)], by)[0], np.uint32)
            ends = np.cumsum(width[ids])
            upto = np.cumsum(np.fromiter(map(size_of, group), np.int64, len(group)))
            last = np.searchsorted(ends, upto)
            if not len(ends) or ends[-1] != upto[-1] or (ends[last] != upto).any():
                ids, lengths = flat_ids(encode_all(group, by))
            else:
                lengths = np.diff(last, prepend=-1)
            flats.append(ids)
            counts.append(lengths)
        return np.concatenate(flats), np.concatenate(counts)

    def encode_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sure = np.fromiter(map(joins, texts), bool, len(texts))
        plain = [t for t, j in zip(texts, sure) if j]
        size_of = (lambda t: len(t.lower().encode())) if word_end else (lambda t: len(t.encode()))
        found = encode_joined(plain, joint, size_of)
        if len(plain) == len(texts):
            return found
        return in_order(sure, found, flat_ids(encode_all([t for t, j in zip(texts, sure) if not j])))

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if direct:
            # Most are in ASCII; those of a vocabulary without case are in lower case already.
            words = [
                head + t[skip:] if t.isascii() and t[skip:].isalpha() and t[:skip] == lead
                and (skip or t.islower()) else word(t) for t in texts
            ]
        else:
            words = [None] * len(texts)
        others = [t for t, w in zip(texts, words) if w is None]
        if len(others) == len(texts):
            return encode_pieces(texts)
        found = encode_joined([w for w in words if w is not None], " ", len, alone)
        if not others:
            return found
        return in_order(np.array([w is not None for w in words]), found, encode_pieces(others))

    return encode


def in_order(
    first: np.ndarray, these: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and lengths of pieces put together: ``these`` where ``first`` holds, else ``others``."""
    flat, lengths = (np.concatenate(pair) for pair in zip(these, others))
    order = np.empty(len(first), np.int64)
    order[np.concatenate([np.flatnonzero(first), np.flatnonzero(~first)])] = np.arange(len(first))
    starts = np.cumsum(lengths) - lengths
    return gather(flat, starts[order], lengths[order]), lengths[order]


def distinct_pieces(
    texts: list[str], split: Callable[[str], list[str]]
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces of all texts, which of them each piece is, and how many each text has."""
    joined = [_JOINED[split](t) if split in _JOINED else None for t in texts]
    plain = np.array([j is not None for j in joined], bool)
    lists = pc.split_pattern(pa.array([j for j in joined if j is not None], pa.large_string()), " ")
    odd = [split(t) for t, j in zip(texts, joined) if j is None]
    counts = np.empty(len(texts), np.int64)
    counts[plain] = pc.list_value_length(lists).to_numpy()
    counts[~plain] = [len(o) for o in odd]
    every = [lists.flatten(), pa.array(list(chain.from_iterable(odd)), pa.large_string())]
    coded = pa.concat_arrays(every).dictionary_encode()
    which = coded.indices.to_numpy()
    if odd:  # the pieces of the others come first
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        starts = np.empty(len(texts), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        which = gather(which, starts, counts)
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), which, counts


_JOINED = {space_pieces: space_joined, word_pieces: word_joined}


class _Closed(dict):
    """Whether a piece with these two last characters is a word and a comma or full stop."""

    def __missing__(self, end: str) -> bool:
        found = self[end] = end[1:] in (".", ",") and end[0] < "\u0130" and end[0].isalpha()
        return found


_CLOSED = _Closed()


class PieceIds:
    """Ids of texts by way of their pieces.

    Beyond ``remembered`` pieces those met in several calls are kept, the most frequent half
    at most, and the others forgotten.
    """

    def __init__(
        self,
        encode: Encoder,
        split: Callable[[str], list[str]] = space_pieces,
        text_of: Callable[[str], str] = space_piece_text,
        remembered: int = REMEMBERED,
    ):
        self.encode, self.split, self.text_of = encode, split, text_of
        # How a piece begins that stands for its text without a space.
        self.closing = "\x00" if split is space_pieces else ""
        self.remembered = remembered
        self._clear()

    def _clear(self) -> None:
        # A piece keeps its number until this changes.
        self.cleared = getattr(self, "cleared", 0) + 1
        self.index: dict[str, int] = {}
        self.keys: list[str] = []
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.calls = np.zeros(0, np.int32)  # in which a piece was met, fewer for older ones

    def _forget(self) -> np.ndarray:
        """Keeps the frequent pieces; returns their former numbers."""
        kept = np.flatnonzero(self.calls > 1)
        most = self.remembered // 2
        if len(kept) > most:
            kept = np.sort(kept[np.argsort(-self.calls[kept], kind="stable")[:most]])
        keys, calls, lengths = [self.keys[i] for i in kept.tolist()], self.calls[kept], self.lengths[kept]
        flat = gather(self.flat, self.starts[kept], lengths)
        self._clear()
        self._add(keys, flat, lengths)
        self.calls = (calls + 1) // 2
        return kept

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Numbers of distinct new pieces.

        A letter and a last comma or full stop are words apart, so they are put together.
        """
        closes = [_CLOSED[p[-2:]] for p in pieces]
        plain = [p for p, c in zip(pieces, closes) if not c]
        closed = [p for p, c in zip(pieces, closes) if c]
        numbers = np.empty(len(pieces), np.int64)
        of_plain = len(self.keys) + np.arange(len(plain))
        new = plain
        if closed:
            parts = [p[:-1] for p in closed] + [self.closing + ".", self.closing + ","]
            new = list(dict.fromkeys(chain(plain, (p for p in parts if p not in self.index))))
        self._add(new, *self.encode([self.text_of(p) for p in new]))
        if closed:
            both = np.empty(2 * len(closed), np.int64)
            both[::2] = self._known(parts[:-2])
            both[1::2] = self._known([self.closing + p[-1] for p in closed])
            first = len(self.keys)
            self._add(closed, self.ids(both), self.lengths[both].reshape(-1, 2).sum(axis=1))
            closes = np.array(closes, bool)
            numbers[closes] = first + np.arange(len(closed))
            numbers[~closes] = of_plain
            return numbers
        return of_plain

    def _add(self, new: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.index.update(zip(new, range(len(self.keys), len(self.keys) + len(new))))
        self.keys += new
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat])
        self.calls = np.concatenate([self.calls, np.zeros(len(new), np.int32)])

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts in a row, and how many each text has."""
        distinct, which, counts = distinct_pieces(texts, self.split)
        numbers = self._known(distinct)
        missing = np.flatnonzero(numbers < 0)
        if len(missing) and len(self.index) + len(missing) > self.remembered:
            self._forget()
            numbers = self._known(distinct)
            if len(self.index) + np.count_nonzero(numbers < 0) > self.remembered:
                self._clear()
                numbers[:] = -1
            missing = np.flatnonzero(numbers < 0)
        if len(missing):
            numbers[missing] = self._learn([distinct[i] for i in missing.tolist()])
        self.calls[numbers] += 1
        return numbers[which], counts

    def _known(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.starts[numbers], self.lengths[numbers])

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        numbers, counts = self.pieces(texts)
        ids = self.ids(numbers)
        upto = np.concatenate([[0], np.cumsum(self.lengths[numbers])])
        ends = upto[np.cumsum(counts)]
        return np.split(ids, ends[:-1]) if len(texts) else []


_REMEMBERING: dict[tuple, PieceIds] = {}


def worker_pieces(
    path: str,
    split: Callable[[str], list[str]] = space_pieces,
    text_of: Callable[[str], str] = space_piece_text,
) -> PieceIds:
    """The ids that this worker process remembers of a vocabulary, from one task to the next.

    Workers run one task at a time and are used again, so each learns a piece once, not
    once for every task; the bound of ``REMEMBERED`` pieces holds for the worker.
    """
    key = (path, split.__name__)
    if key not in _REMEMBERING:
        _REMEMBERING.clear()
        _REMEMBERING[key] = PieceIds(library_encoder(path), split, text_of)
    return _REMEMBERING[key]


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` at ``starts``, one after the other."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]
