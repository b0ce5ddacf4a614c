"""Minimal acyclic transducer from words to id lists, kept in flat arrays that can be mapped.

Words that end alike share their last states. Each transition carries the number of words
that sort before those it leads to, so the outputs along a word add up to its rank, and the
rank is the word's place in the table of id lists. Many words are looked up at once: one
array step for each byte position.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

MAGIC = b"TENLEX01"
_NAMES = ("edges", "targets", "outputs", "final", "starts", "ids")


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The transducer of (word, ids) entries, which are in strictly ascending word order."""
    register: dict[tuple, int] = {}
    size_of: list[int] = []  # words that start at each state
    states: list[tuple] = []  # (final, ((byte, state), ...)) of each

    def close(node: list) -> int:
        shape = (node[0], tuple(node[1]))
        number = register.get(shape)
        if number is None:
            number = register[shape] = len(states)
            states.append(shape)
            size_of.append(node[0] + sum(size_of[s] for _, s in node[1]))
        return number

    # Open states along the last word; each is [final, closed transitions].
    path: list[list] = [[0, []]]
    last = b""
    starts, ids = [0], []
    for word, own in entries:
        if word <= last and (word or len(starts) > 1):
            raise ValueError("words must be in strictly ascending order")
        shared = 0
        for a, b in zip(word, last):
            if a != b:
                break
            shared += 1
        for at in range(len(last), shared, -1):
            number = close(path.pop())
            path[-1][1].append((last[at - 1], number))
        path += [[0, []] for _ in range(len(word) - shared)]
        path[-1][0] = 1
        last = word
        ids += own
        starts.append(len(ids))
    for at in range(len(last), 0, -1):
        number = close(path.pop())
        path[-1][1].append((last[at - 1], number))
    root = close(path[0])

    edges, targets, outputs = [], [], []
    for number, (final, moves) in enumerate(states):
        before = final
        for byte, state in moves:
            edges.append(number << 8 | byte)
            targets.append(state)
            outputs.append(before)
            before += size_of[state]
    final = [s[0] for s in states]
    arrays = {
        "edges": np.array(edges, "<u4"),
        "targets": np.array(targets, "<u4"),
        "outputs": np.array(outputs, "<u4"),
        "final": np.array(final, "<u4"),
        "starts": np.array(starts, "<u4"),
        "ids": np.array(ids, "<u4"),
    }
    head = np.array([root] + [len(arrays[n]) for n in _NAMES], "<u8")
    return MAGIC + head.tobytes() + b"".join(arrays[n].tobytes() for n in _NAMES)


class Lexicon:
    """A compiled transducer, read from a mapped file or bytes."""

    def __init__(self, data):
        raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        if raw[:8].tobytes() != MAGIC:
            raise ValueError("not a lexicon")
        at = 8 + 8 * (1 + len(_NAMES))
        head = raw[8:at].view("<u8").astype(np.int64)
        self.root = int(head[0])
        for name, length in zip(_NAMES, head[1:]):
            setattr(self, name, raw[at : at + 4 * length].view("<u4"))
            at += 4 * int(length)

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, np.uint8, "r"))

    def ranks(self, words: Sequence[bytes]) -> np.ndarray:
        """Rank of each word, -1 if the lexicon lacks it."""
        n = len(words)
        ranks = np.zeros(n, np.int64)
        if not n or not len(self.final):
            return ranks - 1
        lengths = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        first = np.cumsum(lengths) - lengths
        state = np.full(n, self.root, np.int64)
        alive = np.arange(n)
        for at in range(int(lengths.max())):
            going = alive[lengths[alive] > at]
            if not len(going):
                break
            edge = (state[going] << 8 | flat[first[going] + at]).astype(np.uint32)
            spot = np.searchsorted(self.edges, edge)
            spot[spot == len(self.edges)] = 0
            known = self.edges[spot] == edge if len(self.edges) else np.zeros(len(edge), bool)
            state[going[~known]] = -1
            going, spot = going[known], spot[known]
            state[going] = self.targets[spot]
            ranks[going] += self.outputs[spot]
            alive = going
        ended = np.flatnonzero(state >= 0)
        ended = ended[self.final[state[ended]] == 1]
        found = np.full(n, -1, np.int64)
        found[ended] = ranks[ended]
        return found

    def ids_of(self, rank: int) -> list[int]:
        return self.ids[self.starts[rank] : self.starts[rank + 1]].tolist()
