"""Simple-8b: integers packed into 64-bit words, each led by a four-bit selector.

A selector names how many values of how many bits the other sixty bits hold. Values go in blocks of
``BLOCK``; each block starts at a word of its own, and a segment lists these starts, so any block
can be found at once and all words of one selector are unpacked together. A value of more than
sixty bits is escaped: selector 0, then the value as a plain word.

A segment is little-endian: ``n_values``, ``n_words`` and ``n_blocks`` as unsigned 32-bit
integers, the block starts as unsigned 32-bit word numbers, then the words.
"""

from __future__ import annotations

import numpy as np

#: Count and bits of a packing, by selector. Selector 0 is the escape.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
BLOCK = 128

_N = np.array(COUNTS, np.int64)
_SMALL = np.array([int(v).bit_length() for v in range(1 << 16)], np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < 1 << 16:
        return _SMALL[values]
    width, rest = np.zeros(len(values), np.uint8), values.copy()
    for step in (32, 16):
        big = rest >= np.uint64(1) << np.uint64(step)
        width[big] += step
        rest[big] >>= np.uint64(step)
    return width + _SMALL[rest]


def _window_max(width: np.ndarray, count: int) -> np.ndarray:
    """The largest width among each position and the ``count - 1`` after it, in its row."""
    reach, out = 1, width
    while reach < count:
        step = min(reach, count - reach)
        out = np.maximum(out, np.pad(out[:, step:], ((0, 0), (0, step))))
        reach += step
    return out


def pack(values: np.ndarray) -> bytes:
    """One segment of unsigned 64-bit values."""
    values = np.ascontiguousarray(values, np.uint64)
    n, blocks = len(values), -(-len(values) // BLOCK)
    grid = np.zeros((blocks, BLOCK), np.uint64)
    grid.reshape(-1)[:n] = values
    width = _widths(grid.reshape(-1)).reshape(blocks, BLOCK)
    # A larger count never has more bits, so the packings that fit a position are the last ones.
    choice = np.full((blocks, BLOCK), 16, np.uint8)
    for selector in range(15, 0, -1):
        choice -= _window_max(width, COUNTS[selector]) <= BITS[selector]
    choice[choice == 16] = 0
    length = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    starts, live, at = np.zeros((blocks, BLOCK), bool), np.arange(blocks), np.zeros(blocks, np.int64)
    while len(live):
        starts[live, at] = True
        at = at + _N[choice[live, at]]
        more = at < length[live]
        live, at = live[more], at[more]
    where = np.flatnonzero(starts)
    selectors = choice.reshape(-1)[where].astype(np.int64)
    size = np.where(selectors == 0, 2, 1)
    slot = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    flat = np.concatenate([grid.reshape(-1), np.zeros(BLOCK, np.uint64)])
    for selector in np.unique(selectors):
        own = np.flatnonzero(selectors == selector)
        first, to = where[own], slot[own]
        if selector == 0:
            words[to + 1] = flat[first]
            continue
        word = np.full(len(own), np.uint64(selector) << np.uint64(60))
        end = first // BLOCK * BLOCK + BLOCK
        for j in range(COUNTS[selector] if BITS[selector] else 0):
            part = np.where(first + j < end, flat[first + j], 0) if COUNTS[selector] > 1 else flat[first]
            word |= part.astype(np.uint64) << np.uint64(j * BITS[selector])
        words[to] = word
    offsets = slot[np.searchsorted(where, BLOCK * np.arange(blocks))]
    head = np.array([n, len(words), blocks], "<u4").tobytes()
    return head + offsets.astype("<u4").tobytes() + words.astype("<u8").tobytes()


def unpack(segment: bytes) -> np.ndarray:
    """The values of a segment, as unsigned 64-bit integers."""
    n, n_words, blocks = (int(x) for x in np.frombuffer(segment, "<u4", 3))
    offsets = np.frombuffer(segment, "<u4", blocks, 12).astype(np.int64)
    words = np.frombuffer(segment, "<u8", n_words, 12 + 4 * blocks)
    if not n:
        return np.zeros(0, np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    plain = np.zeros(n_words, bool)
    if (selectors == 0).any():
        plain = _plain(selectors)
    counts = np.where(plain, 0, _N[selectors])
    before = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(blocks), np.diff(np.append(offsets, n_words)))
    place = before - before[offsets][owner]
    out = np.zeros(blocks * BLOCK, np.uint64)
    for selector in np.unique(selectors[~plain]):
        own = np.flatnonzero((selectors == selector) & ~plain)
        base, at = owner[own] * BLOCK, place[own]
        if selector == 0:
            out[base + at] = words[own + 1]
            continue
        mask = (np.uint64(1) << np.uint64(BITS[selector])) - np.uint64(1)
        for j in range(COUNTS[selector] if BITS[selector] else 0):
            value = (words[own] >> np.uint64(j * BITS[selector])) & mask
            inside = at + j < BLOCK
            out[(base + at + j)[inside]] = value[inside]
    return out[:n]


def _plain(selectors: np.ndarray) -> np.ndarray:
    """Which words are the plain values after an escape, as their top bits may look like anything."""
    plain = np.zeros(len(selectors), bool)
    for i in np.flatnonzero(selectors == 0):
        if not plain[i]:
            plain[i + 1] = True
    return plain
