"""Patched frame-of-reference blocks of unsigned 32-bit ids, packed and unpacked in numpy.

A block holds BLOCK ids. Its minimum is subtracted; the rest is packed at the bit width
that a percentile of its ids needs. Ids that need more bits are exceptions: their low bits
are packed like the others, and their positions and high bits follow the packed words.

Block layout, little-endian: minimum u32, ids u16, exceptions u16, width u8, three zero
bytes; ``4 * width`` packed u64 words; high bits u32 for each exception; positions u8 for
each exception; zero bytes up to a multiple of 8.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
HEAD = np.dtype(
    [("low", "<u4"), ("count", "<u2"), ("patches", "<u2"), ("width", "u1"), ("zero", "u1", 3)]
)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each value below 2**53."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def pack(ids: np.ndarray, percentile: float = 90.0) -> tuple[bytes, np.ndarray]:
    """Blocks of ``ids`` as bytes, and the offset of each block in them."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return b"", np.zeros(0, np.int64)
    counts = np.full(blocks, BLOCK, np.int64)
    counts[-1] = len(ids) - BLOCK * (blocks - 1)
    grid = np.empty(blocks * BLOCK, np.uint64)
    grid[: len(ids)] = ids
    grid[len(ids) :] = ids[BLOCK * (blocks - 1) :].min()
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1)
    grid -= low[:, None]

    bits = _bits(grid)
    rank = min(BLOCK - 1, int(np.ceil(percentile / 100 * BLOCK)) - 1)
    widths = np.partition(bits, rank, axis=1)[:, rank].astype(np.int64)
    row, at = np.nonzero(bits > widths[:, None])
    patches = np.bincount(row, minlength=blocks)
    high = (grid[row, at] >> widths[row].astype(np.uint64)).astype("<u4")

    used = HEAD.itemsize + 32 * widths + 5 * patches
    sizes = -(-used // 8) * 8
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)

    head = np.zeros(blocks, HEAD)
    head["low"], head["count"], head["patches"], head["width"] = low, counts, patches, widths
    out[starts[:, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(blocks, -1)
    for width in np.unique(widths[widths > 0]):
        own = np.flatnonzero(widths == width)
        words = _pack_width(grid[own].T.copy(), int(width))
        spot = starts[own] + HEAD.itemsize
        out[spot[:, None] + np.arange(32 * width)] = words.view(np.uint8).reshape(len(own), -1)
    if len(row):
        nth = np.arange(len(row)) - (np.cumsum(patches) - patches)[row]
        tail = starts[row] + HEAD.itemsize + 32 * widths[row]
        out[(tail + 4 * nth)[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
        out[tail + 4 * patches[row] + nth] = at
    return out.tobytes(), starts


def _pack_width(columns: np.ndarray, width: int) -> np.ndarray:
    """columns: value j of every block. Returns a row of little-endian words for each block."""
    words = np.zeros((4 * width, columns.shape[1]), np.uint64)
    columns &= np.uint64((1 << width) - 1)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        words[word] |= columns[j] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False)


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks; ``starts`` are their offsets in ``data``."""
    blocks = len(starts)
    if not blocks:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    head = raw[starts[:, None] + np.arange(HEAD.itemsize)].reshape(-1).view(HEAD)
    widths, patches = head["width"].astype(np.int64), head["patches"].astype(np.int64)
    grid = np.zeros((blocks, BLOCK), np.uint64)
    for width in np.unique(widths[widths > 0]):
        own = np.flatnonzero(widths == width)
        spot = starts[own] + HEAD.itemsize
        words = raw[spot[:, None] + np.arange(32 * width)].view("<u8")
        grid[own] = _unpack_width(np.ascontiguousarray(words.T), int(width)).T
    if patches.sum():
        row = np.repeat(np.arange(blocks), patches)
        nth = np.arange(len(row)) - (np.cumsum(patches) - patches)[row]
        tail = starts[row] + HEAD.itemsize + 32 * widths[row]
        high = raw[(tail + 4 * nth)[:, None] + np.arange(4)].reshape(-1).view("<u4")
        at = raw[tail + 4 * patches[row] + nth]
        grid[row, at] |= high.astype(np.uint64) << widths[row].astype(np.uint64)
    grid += head["low"].astype(np.uint64)[:, None]
    inside = np.arange(BLOCK) < head["count"][:, None]
    return grid[inside].astype(np.uint32)


def _unpack_width(words: np.ndarray, width: int) -> np.ndarray:
    values = np.empty((BLOCK, words.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        values[j] = value & mask
    return values
