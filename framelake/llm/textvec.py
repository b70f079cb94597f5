"""Word machinery on Arrow string buffers: boundaries and 64-bit hashes by numpy, without a Python object for each word.

Every function works on whole texts. A batch is cut between documents into slices of about SLICE bytes, so memory is
bounded by the slice or by the longest single text. Words are runs of bytes that a table marks; both word classes used
here (`SPACE`: anything but ASCII white space, `ALNUM`: ASCII letters and digits, and every code point above 0x7F)
break at ASCII only, so bytes of UTF-8 give the same runs as code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20

_WHITE = [0x20, 9, 10, 11, 12, 13]
SPACE = np.ones(256, bool)
SPACE[_WHITE] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
LINE = np.ones(256, bool)
LINE[10] = False

_rng = np.random.Generator(np.random.PCG64(20240607))
#: A random value for each byte, one set with case kept and one with A-Z as a-z.
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
LOWER = BYTE.copy()
LOWER[0x41:0x5B] = BYTE[0x61:0x7B]
_M = np.uint64(0x9E3779B97F4A7C15)
_MI = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_K = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_pow = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _pow["n"] < n:
        m = max(n, 2 * SLICE + 1)
        with np.errstate(over="ignore"):
            up, down = np.full(m, _M), np.full(m, _MI)
            up[0] = down[0] = 1
            up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if m > 2 * SLICE + 1:  # of one very long text: not kept
            return up, down
        _pow.update(n=m, up=up, down=down)
    return _pow["up"], _pow["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit values (the public murmur finaliser)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


class Text:
    """A slice of texts as one byte array with document offsets."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, first: int):
        self.buf, self.offs, self.first = buf, offs, first
        self.n = len(offs) - 1
        self._kept: tuple[np.ndarray, np.ndarray] | None = None

    def bytes(self, i: int) -> bytes:
        return self.buf[self.offs[i] : self.offs[i + 1]].tobytes()

    def runs(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of marked bytes; none spans two documents."""
        inside = table[self.buf]
        n = len(inside)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        before, after = np.empty(n, bool), np.empty(n, bool)
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        cut = self.offs[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        before[cut] = False
        after[cut - 1] = False
        return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offs, at, "right") - 1

    def bounds(self, starts: np.ndarray) -> np.ndarray:
        """For each document, where its words begin in starts; n + 1 values."""
        return np.searchsorted(starts, self.offs, "left")

    def _sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of the weighed bytes; kept for the last table of values."""
        if self._kept is None or self._kept[0] is not values:
            sums = np.empty(len(self.buf) + 1, np.uint64)
            sums[0] = 0
            with np.errstate(over="ignore"):
                np.cumsum(values[self.buf] * _powers(len(self.buf) + 1)[0][: len(self.buf)], out=sums[1:])
            self._kept = values, sums
        return self._kept[1]

    def hashes(self, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE) -> np.ndarray:
        """A 64-bit hash of each byte range, equal for equal content wherever it stands."""
        sums, down = self._sums(values), _powers(len(self.buf) + 1)[1]
        with np.errstate(over="ignore"):
            h = (sums[ends] - sums[starts]) * down[starts]
        return mix(h + (ends - starts).astype(np.uint64))

    def hashes_without(self, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, values: np.ndarray = BYTE) -> np.ndarray:
        """The hashes that the byte ranges would have without their byte `at`."""
        sums, down = self._sums(values), _powers(len(self.buf) + 1)[1]
        with np.errstate(over="ignore"):
            h = (sums[at] - sums[starts]) * down[starts] + (sums[ends] - sums[at + 1]) * down[starts + 1]
        return mix(h + (ends - starts - 1).astype(np.uint64))


def texts(column: pa.Array | pa.ChunkedArray, most: int = SLICE) -> Iterator[Text]:
    """Slices of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        j = min(j, n)
        yield Text(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], i)
        i = j


def grams(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of every k consecutive word hashes, across documents too; len(h) - k + 1 values."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = h[:n] * _K[salt % 8]
        for i in range(1, k):
            out += h[i : i + n] * _K[(salt + i) % 64] if k <= 56 else (h[i : i + n] ^ np.uint64(i)) * _K[(salt + i) % 64]
    return mix(out)


def long_grams(h: np.ndarray, k: int) -> np.ndarray:
    """As grams, by prefix sums: the cost doesn't depend on k."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(h) + 1)
    with np.errstate(over="ignore"):
        sums = np.empty(len(h) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(h * up[: len(h)], out=sums[1:])
        return mix((sums[k:] - sums[:n]) * down[:n])


def inside(bounds: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of the n - k + 1 windows of k words lie in one document."""
    ok = np.zeros(max(0, n - k + 1), bool)
    for_starts, for_ends = bounds[:-1], bounds[1:] - k + 1
    mark = np.zeros(len(ok) + 1, np.int32)
    some = for_ends > for_starts
    np.add.at(mark, for_starts[some], 1)
    np.add.at(mark, for_ends[some], -1)
    ok[:] = np.cumsum(mark[:-1])[: len(ok)] > 0
    return ok


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
