"""Vectorised word hashing of many texts at once, in NumPy."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Space and the five control characters that separate words.
SPACE = b" \t\n\x0b\x0c\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCK = 1 << 21

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE)] = True
_BYTE = np.random.default_rng(20_240_229).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_ROLL = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


class Words(NamedTuple):
    hash: np.ndarray  # 64-bit hash of each word
    first: np.ndarray  # index of the first word of each text, and the number of words
    start: np.ndarray  # byte positions in the joined buffer
    end: np.ndarray
    offset: np.ndarray  # where each text starts in the joined buffer, and its length
    buffer: bytes


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, min(BLOCK, 2 * len(self.up)))  # as short as the texts allow: a worker keeps them
            up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 2**64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up, self.down


_POWERS = _Powers()


def _block_words(arr: np.ndarray, space: np.ndarray):
    """Starts, ends and hashes of the words of one block that begins and ends at word boundaries."""
    n = len(arr)
    flips = np.flatnonzero(space[1:] != space[:-1]) + 1
    if n and not space[0]:
        flips = np.concatenate(([0], flips))
    if len(flips) % 2:
        flips = np.concatenate((flips, [n]))
    start, end = flips[::2], flips[1::2]
    up, down = _POWERS.get(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[arr] * up[:n], out=sums[1:])
    return start, end, mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def hash_words(texts: list[bytes], lower: bool = True) -> Words:
    """Words (runs of bytes that are no white space) of all texts. Long buffers are worked off in blocks cut between
    words; a single word longer than a block makes its block longer."""
    buffer = b"\n".join(texts) + b"\n"
    if lower:
        buffer = buffer.translate(LOWER)
    offset = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    arr = np.frombuffer(buffer, np.uint8)
    space = _IS_SPACE[arr]
    starts, ends, hashes, lo = [], [], [], 0
    while lo < len(arr):
        hi = min(len(arr), lo + BLOCK)
        if hi < len(arr):
            back = np.flatnonzero(space[lo:hi])
            if len(back):
                hi = lo + int(back[-1]) + 1
            else:
                hi += int(np.argmax(space[hi:])) + 1
        s, e, h = _block_words(arr[lo:hi], space[lo:hi])
        starts.append(s + lo), ends.append(e + lo), hashes.append(h)
        lo = hi
    start, end, h = (np.concatenate(x) for x in (starts, ends, hashes))
    return Words(h, np.searchsorted(start, offset), start, end, offset, buffer)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words, whatever text they belong to; up to 9 words."""
    n = len(h) - k + 1
    if n <= 0:
        return h[:0]
    total = h[:n].copy()
    for j in range(1, k):
        total += h[j : j + n] * _ROLL[j - 1]
    return mix(total)


def whole(h: np.ndarray) -> np.ndarray:
    """One hash for a text of fewer words than a window."""
    return mix(np.array([int(np.sum(h[: len(_ROLL)] * _ROLL[: len(h)])) + len(h) & (2**64 - 1)], np.uint64))
