"""Word shingles of texts as sets of 64-bit numbers, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

CACHE_WORDS = 500_000
# Odd multipliers, one per place in a shingle, and those of the final mix (fixed values).
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                    0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(33))


class Shingler:
    """A text's different shingles of ``size`` words (``size`` at most 8), sorted, with their lengths in bytes.

    A-Z are folded, and words are what stands between ASCII white space.  A text of fewer words, but not none, is one
    shingle.  Shingles are told apart by 64 bits: within the two sets of a compared pair, that is one false match in
    about 10^13 pairs.
    """

    def __init__(self, size: int) -> None:
        self.size, self.hashes = size, _Hashes()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        word = np.fromiter(map(self.hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        size = min(self.size, len(words))
        last = len(words) - size + 1
        whole = np.full(last, size, dtype=np.uint64)  # a short text is no shingle of a longer one
        total = np.zeros(last, dtype=np.int64)
        for i in range(size):
            whole += word[i:i + last] * _PLACES[i]
            total += length[i:i + last]
        shingles, first = np.unique(_mixed(whole), return_index=True)
        return shingles, total[first]


def identity(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the whole set, as two signed numbers."""
    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), dtype="<i8")
    return int(digest[0]), int(digest[1])


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the set's counts in 2n to 4n cells.

    Two sketches, folded to one size, differ in no more cells than the sets have members of one side only: the map keeps
    or shortens distances, so what is far by the sketch is far.
    """
    cells = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Cells in which two sketches differ, at the smaller one's size."""
    x, y = np.frombuffer(a, dtype="<u8"), np.frombuffer(b, dtype="<u8")
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def common(a: bytes, b: bytes) -> int:
    """How many members two sorted sets share."""
    x, y = np.frombuffer(a, dtype="<u8"), np.frombuffer(b, dtype="<u8")
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int(np.count_nonzero(y[at] == x))
