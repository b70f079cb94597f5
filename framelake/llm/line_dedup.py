"""Fuzzy line dedup: SimHash, pigeonhole blocks, edit similarity, one occurrence kept for each connected group.

A line is what stands between line feeds. Its normal form is its words (ASCII letters, digits, code points above 0x7F;
A-Z as a-z) joined by one space; lines without a word always stay. Lines with one normal form are one group. Two normal
forms link if they meet in a bucket, their 64-bit SimHashes (of pairs of neighbouring words, and of lines of up to 8 words
also of the words) differ in at most the bucket's REACH bits, and their edit similarity, 1 - distance / length of the longer, is SIMILARITY or more. Of each
connected group the occurrence with the least (doc_id, line) stays; the others go.

Buckets: the SimHash has 5 blocks, and lines meet by each of the 10 pairs of blocks; of 5 blocks, 3 bits leave two
alone, so that all pairs within DISTANCE bits meet. Few pairs of that edit similarity are so close in SimHash (one changed word moves about ten bits of a line of twelve), so the query and the
stage also let lines meet by wide keys (`Lines.wide`): lines of up to 3 words with one letter left out, of up to 8 words
with one or two words left out, and longer lines by 8 minima of their 2- or 3-word hashes.

1. `meet`: a task packs its distinct lines' entries (bucket, size, SimHash, key) into one page for each part of the
   bucket hash, so a shuffle moves a few large rows. A part's entries are sorted; buckets of one line end there. In the
   others, lines follow leaders: each line joins the first earlier one that it may link to. A bucket with HOT lines in
   one task is led there, and only its leaders go on.
2. Followers are verified against leaders by their texts, and links joined to groups.
3. `across`: blocks' buckets with pairs that no leader covers, and whose lines aren't in one group, are compared again,
   the largest group's lines against the others' in tiles of BLOCK lines. At most `most` pairs between two groups come
   from a block and round; rounds go on until none is left out. So all pairs within DISTANCE bits are tried.
   Wide keys give only pairs of a line and its leaders: all pairs of lines that are near by SimHash but not by edit
   similarity would grow with the square of a group. No bucket is capped.

Cases: null texts have no lines; null doc_ids neither lose lines nor take them from others; rows with one doc_id and one
text are one document, but different texts under a doc_id are documents of their own (of equal (doc_id, line), the one
with the lesser hash of its text stays); an empty table gives none; extra columns stay in the stage whatever their names,
and are ignored by the query.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from framelake.llm import spread
from framelake.llm import textvec as V

DISTANCE, SIMILARITY = 3, 0.8
PAIRS = 4
#: Minima of a long line, and the bits in which SimHashes of lines that share one may differ. Unrelated lines differ in
#: 32 +- 4 bits, so 2 in 1,000 of them pass.
MINIMA, WIDE = 8, 20
#: Bits up to which one shared minimum is enough; beyond, a line must follow its leader in two buckets.
CLOSE = 14
#: By the kind in a bucket's low two bits (blocks, minima, words or letters left out): bits in which SimHashes may differ.
REACH = (DISTANCE, WIDE, 64)
#: Bit ranges of the 5 blocks.
BLOCKS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
#: Lines of a bucket in one task from which they are led there; lines compared at a time; entries packed at a time.
HOT, BLOCK, FLUSH = 512, 4096, 1 << 20
#: Entry bytes, about the entries a line has, and about the bytes a part should have.
ENTRY, ENTRIES, PART = 24, 20, 32 << 20


class Lines:
    """Lines with a word of a slice: document, number, span, hash of the normal form, SimHash."""

    def __init__(self, t: V.Text, hashed: bool = True):
        ws, we = t.runs(V.ALNUM)
        ls, le = t.runs(V.LINE)
        first, last = np.searchsorted(ws, ls), np.searchsorted(ws, le)
        some = last > first
        self.starts, self.ends, first, last = ls[some], le[some], first[some], last[some]
        self.doc = t.doc_of(self.starts)
        feeds = np.flatnonzero(t.buf == 10)
        self.line = np.searchsorted(feeds, self.starts) - np.searchsorted(feeds, t.offs[self.doc])
        n = len(self.starts)
        if not n:
            self.key, self.sim, self.size = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        self._at = t, ws, we, first, last
        h = self._words = t.hashes(ws, we, V.LOWER)
        up, down = V._powers(len(h) + 1)
        with np.errstate(over="ignore"):
            sums = np.append(np.uint64(0), np.cumsum(h * up[: len(h)]))
            self.key = V.mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
        if not hashed:
            return
        with np.errstate(over="ignore"):
            pair = V.mix(h + np.append(h[1:], np.uint64(0)) * V._K[9])
        chars = np.append(0, np.cumsum(V.ALNUM[t.buf] & ((t.buf & 0xC0) != 0x80)))
        self.size = chars[we[last - 1]] - chars[ws[first]] + last - first - 1  # characters of the normal form
        # pairs of neighbours, and of short lines the words, too: of long lines, the commonest words would make all alike
        length = last - first
        ones, count = np.zeros((n, 64), np.int32), np.maximum(length - 1, 0)
        two, short = length > 1, length <= 8
        if two.any():
            ones[two] = _bit_counts(pair, first[two], last[two] - 1)
        if short.any():
            ones[short] += _bit_counts(h, first[short], last[short])
            count[short] += length[short]
        self.sim = np.packbits(2 * ones > count[:, None], axis=1).view(np.uint64).reshape(-1)

    def buckets(self, wide: bool) -> tuple[np.ndarray, np.ndarray]:
        """(line, bucket) of all lines; a bucket's low two bits are its kind."""
        n = len(self.starts)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        block = [self.sim >> np.uint64(a) & np.uint64((1 << (b - a)) - 1) for a, b in BLOCKS]
        own = [V.mix((block[i] << np.uint64(16) | block[j]) + V._K[48 + k]) & ~np.uint64(3) for k, (i, j) in enumerate(combinations(range(5), 2))]
        row, key = np.tile(np.arange(n), len(own)), np.concatenate(own)
        if wide:
            more, keys = self.wide()
            kind = np.where((self._at[4] - self._at[3])[more] > 8, 1, 2).astype(np.uint64)
            row, key = np.append(row, more), np.append(key, keys & ~np.uint64(3) | kind)
        return row, key

    def wide(self) -> tuple[np.ndarray, np.ndarray]:
        """(line, wide key); a long line's key k is its least word hash by the k-th order."""
        t, ws, we, first, last = self._at
        h, size = self._words, last - first
        rows, keys = [], []
        with np.errstate(over="ignore"):
            for some, k in ((np.flatnonzero((size > 8) & (size < 12)), 2), (np.flatnonzero(size >= 12), 3)):
                if len(some):
                    g = V.grams(h, k)
                    edges = np.stack([first[some], last[some] - k + 1], 1).reshape(-1)
                    for b in range(MINIMA):
                        least = np.minimum.reduceat(np.append(g * V._K[16 + b], np.uint64(0)), edges)[::2]
                        rows.append(some)
                        keys.append(V.mix(least + V._K[b]))
            for m in range(1, 9):  # whole lines, with the places of their words weighed
                some = np.flatnonzero(size == m)
                if not len(some):
                    continue
                words = h[first[some][:, None] + np.arange(m)]
                ways = [()] + ([(i,) for i in range(m)] if m > 3 else []) + (list(combinations(range(m), 2)) if m > 4 else [])
                for out in ways:
                    rows.append(some)
                    keys.append(_in_order(words[:, [i for i in range(m) if i not in out]]))
                for w in range(m if m <= 3 else 0):
                    i, j = ws[first[some] + w], we[first[some] + w]
                    line = np.repeat(np.arange(len(some)), j - i)
                    at = np.arange(len(line)) - np.repeat(np.cumsum(j - i) - (j - i), j - i) + i[line]
                    less = words[line]
                    less[:, w] = t.hashes_without(i[line], j[line], at, V.LOWER)
                    rows.append(some[line])
                    keys.append(_in_order(less))
        return np.concatenate(rows), np.concatenate(keys)


def _in_order(words: np.ndarray) -> np.ndarray:
    """A hash of each row of word hashes."""
    with np.errstate(over="ignore"):
        out = np.full(len(words), words.shape[1], np.uint64)
        for i in range(words.shape[1]):
            out = V.mix(out * V._M + words[:, i])
    return out


#: A byte's bits, the highest first, as eight one-byte counters in a 64-bit number.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).reshape(-1).view(np.uint64)


def _bit_counts(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each range (not empty, in order), how many values have each of the 64 bits; summed in parts of up to 255 values."""
    parts = -(-(last - first) // 255)
    head = np.cumsum(parts) - parts
    start = np.repeat(first, parts) + 255 * (np.arange(parts.sum()) - np.repeat(head, parts))
    stop = np.minimum(start + 255, np.repeat(last, parts))
    edges = np.stack([start, stop], 1).reshape(-1)
    one = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    out = np.empty((len(start), 8, 8), np.uint8)
    for k in range(8):
        lanes = np.append(_SPREAD[one[k]], np.uint64(0))
        out[:, k] = np.ascontiguousarray(np.add.reduceat(lanes, edges)[::2]).view(np.uint8).reshape(-1, 8)
    return np.add.reduceat(out.reshape(-1, 64), head, axis=0, dtype=np.int32)


def normal(line: str) -> str:
    raw = line.encode()
    return b" ".join(raw.translate(_FOLD).split()).decode()


_FOLD = bytes((i + 32 if 65 <= i <= 90 else i) if V.ALNUM[i] else 32 for i in range(256))


def edit_similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    """Whether 1 - edit distance / longer length >= least."""
    return bool(similar([a], [b], least)[0])


def _common(a: str, b: str) -> int:
    """Length of the start that a and b have in common; a is not longer."""
    low, high = 0, len(a)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def similar(xs: list[str], ys: list[str], least: float = SIMILARITY) -> np.ndarray:
    """Which pairs are edit_similar. Ends in common are cut; what is near enough word by word is near enough; the others
    go through Myers' bit vectors, in numpy for many pairs at once, or, if they are long, one by one."""
    out, left = np.zeros(len(xs), bool), []
    for k, (a, b) in enumerate(zip(xs, ys, strict=True)):
        if len(a) > len(b):
            a, b = b, a
        most = int((1 - least) * len(b) + 1e-9)
        if len(b) - len(a) > most:
            continue
        i = _common(a, b)
        j = _common(a[:i - 1 if i else None:-1], b[:i - 1 if i else None:-1])
        a, b = a[i : len(a) - j], b[i : len(b) - j]
        if len(b) <= most:
            out[k] = True
        elif a:
            x, y = a.split(" "), b.split(" ")
            if len(x) == len(y) and sum(max(len(p), len(q)) for p, q in zip(x, y, strict=True) if p != q) <= most:
                out[k] = True
            elif len(a) > 256 and _at_most(x, y) <= most:
                out[k] = True
            elif len(a) > 64 * WORDS:
                out[k] = _near_enough(a, b, most)
            else:
                left.append((-(-len(a) // 64), len(b), k, a, b, most))
    left.sort()
    start = 0
    while start < len(left):
        words, stop = left[start][0], start
        while stop < len(left) and left[stop][0] == words and stop - start < max(1, 4096 // words):
            stop += 1
        part = left[start:stop]
        if len(part) < 50 * words:
            for _, _, k, a, b, most in part:
                out[k] = _near_enough(a, b, most)
            start = stop
            continue
        out[[x[2] for x in part]] = _distances([x[3] for x in part], [x[4] for x in part], words) <= np.array([x[5] for x in part])
        start = stop
    return out


#: Words of 64 code points up to which pairs are compared in numpy.
WORDS = 32


def _distances(xs: list[str], ys: list[str], words: int) -> np.ndarray:
    """Edit distances of pairs, each x being of `words` words of 64 code points and not longer than y."""
    n, m, size = len(xs), np.array(list(map(len, xs))), np.array(list(map(len, ys)))
    points = lambda texts: np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    spread_ = lambda k: (np.repeat(np.arange(n), k), np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))
    letters, code = np.unique(points(xs), return_inverse=True)
    row, at = spread_(m)
    match = np.zeros((n * (len(letters) + 1), words), np.uint64)  # the last letter stands for all that x hasn't
    np.bitwise_or.at(match, (row * (len(letters) + 1) + code, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    y = points(ys)
    code = np.minimum(np.searchsorted(letters, y), len(letters) - 1)
    code = np.where(letters[code] == y, code, len(letters))
    row, at = spread_(size)
    columns = np.full((int(size.max()), n), len(letters))
    columns[at, row] = code
    columns += np.arange(n) * (len(letters) + 1)
    up, down = np.full((words, n), ~np.uint64(0)), np.zeros((words, n), np.uint64)
    score, last, one, top = m.copy(), ((m - 1) & 63).astype(np.uint64), np.uint64(1), np.uint64(63)
    for j, column in enumerate(columns):
        more, less = np.ones(n, np.uint64), np.zeros(n, np.uint64)  # by which the row above grows or shrinks
        for w in range(words):
            eq, pv, mv = match[column, w], up[w], down[w]
            xv = eq | mv
            eq = eq | less
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            if w == words - 1:
                step = ((ph >> last) & one).astype(np.int64) - ((mh >> last) & one).astype(np.int64)
                score += np.where(j < size, step, 0)
            ph, more = (ph << one) | more, ph >> top
            mh, less = (mh << one) | less, mh >> top
            up[w], down[w] = mh | ~(xv | ph), ph & xv
    return score


def _at_most(x: list[str], y: list[str]) -> int:
    """An upper bound of the edit distance of two texts by words: between words that both have once, in like order."""
    once = lambda words: {w: i for i, w in enumerate(words)} if len(set(words)) == len(words) else {w: i for (w, n), i in zip(Counter(words).items(), _first(words), strict=True) if n == 1}
    place, ends, tails, back = once(y), [], [], {}
    for w, i in once(x).items():
        if (j := place.get(w)) is None:
            continue
        k = bisect_left(ends, j)
        back[j] = (i, tails[k - 1] if k else None)
        ends[k : k + 1], tails[k : k + 1] = [j], [j]
    path, j = [], tails[-1] if tails else None
    while j is not None:
        path.append((back[j][0], j))
        j = back[j][1]
    total, i, j = 0, 0, 0
    for p, q in [*reversed(path), (len(x), len(y))]:
        a, b = " ".join(x[i:p]), " ".join(y[j:q])
        # the space beside an empty part counts, too
        total += 0 if a == b and (p - i) == (q - j) else max(len(a), len(b)) + 1
        i, j = p + 1, q + 1
    return total


def _first(words: list[str]) -> list[int]:
    """Where each different word comes first, in order."""
    seen: dict[str, int] = {}
    for i, w in enumerate(words):
        seen.setdefault(w, i)
    return list(seen.values())


def _near_enough(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is `most` or less, by bit vectors of a's length."""
    place: dict[str, int] = {}
    for k, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << k
    m = len(a)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    for k, c in enumerate(b):
        eq = place.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        score += bool(ph & top) - bool(mh & top)
        if score - (len(b) - 1 - k) > most:
            return False
        if k % 32 == 31 and k > most and m > 64:  # the least distance of any start of a to this start of b never falls
            bits = [np.unpackbits(np.frombuffer(v.to_bytes(-(-m // 8), "little"), np.uint8), bitorder="little", count=m) for v in (pv, mv)]
            if k + min(0, int(np.cumsum(bits[0].astype(np.int64) - bits[1]).min())) > most:
                return False
        ph, mh = (ph << 1 | 1) & full, (mh << 1) & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
    return score <= most


def _entries(docs: DataFrame, wide: bool, parts: int) -> DataFrame:
    """Rows (part, page) of packed entries; and of hot buckets' lines, rows (bucket, a, b, sim, size) as `meet` makes them."""
    kind = np.dtype([("bucket", np.uint64), ("sim", np.uint64), ("key", np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, sim, size, row, bucket = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            # a line that comes again is one line here
            lines = np.zeros(len(key), bool)
            order = np.argsort(key)
            lines[order[np.append(True, key[order[1:]] != key[order[:-1]])[: len(key)]]] = True
            own = lines[row]
            row, bucket = row[own], bucket[own]
            order = np.argsort(bucket)
            row, bucket = row[order], bucket[order]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            many = np.flatnonzero(np.diff(np.append(cut, len(bucket))) >= HOT)
            flag, stays = np.zeros(len(row), np.uint64), np.ones(len(row), bool)
            for i, j in zip(cut[many].tolist(), np.append(cut, len(bucket))[many + 1].tolist(), strict=True):
                x = row[i:j][np.argsort(key[row[i:j]])]
                row[i:j] = x
                lead = _lead(REACH[int(bucket[i]) & 3], sim[x], size[x])
                stays[i:j], flag[i:j] = lead < 0, 1
                narrow = np.full(j - i, not int(bucket[i]) & 3)
                yield _rows(np.full(j - i, int(bucket[i]) & _LOW, np.int64), key[x], key[x[lead]], lead >= 0, sim[x], sim[x[lead]], size[x], narrow)
            row, bucket, flag = row[stays], bucket[stays], flag[stays]
            page = np.empty(len(row), kind)
            page["bucket"] = (bucket << np.uint64(16)) | (flag << np.uint64(15)) | np.minimum(size[row], 0x7FFF).astype(np.uint64)
            page["sim"], page["key"] = sim[row], key[row]
            part = ((bucket >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
            cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(part)]  # sorted by bucket, so by part
            pages = [page[i:j].tobytes() for i, j in zip(cut.tolist(), np.append(cut[1:], len(part))[: len(cut)].tolist(), strict=True)]
            m = len(pages)
            none = [pa.nulls(m, pa.int64()) for _ in range(5)]
            yield pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array(pages, pa.binary()), *none, pa.nulls(m, pa.int32())], _FIELDS)

        for batch in batches:
            for t in V.texts(batch.column(0)):
                x = Lines(t)
                row, bucket = x.buckets(wide)
                base = sum(len(h[0]) for h in held)
                held.append((V.signed(x.key), x.sim, x.size, row + base, bucket))
                n += len(row)
                if n >= FLUSH:
                    yield from flush()
                    n = 0
        if held:
            yield from flush()

    return docs.select("text").mapInArrow(run, "part int, page binary, bucket long, a long, b long, sim long, size long, apart int")


_FIELDS = ["part", "page", "bucket", "a", "b", "sim", "size", "apart"]
_LOW = (1 << 48) - 1


def _rows(bucket: np.ndarray, a: np.ndarray, b: np.ndarray, follows: np.ndarray, sim: np.ndarray, led: np.ndarray, size: np.ndarray, book: np.ndarray) -> pa.RecordBatch:
    """Lines of buckets: the line `a`, and its leader `b` if it follows one, whose SimHash `led` is `apart` bits away if that
    counts (0 but by minima); `bucket` if the line's bucket needs `across`."""
    n = len(a)
    apart = np.where(bucket & 3 == 1, np.bitwise_count(sim ^ led), 0).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array((a % 1021).astype(np.int32)), pa.nulls(n, pa.binary()), pa.array(bucket, mask=~book), pa.array(a), pa.array(b, mask=~follows), pa.array(V.signed(sim)), pa.array(size.astype(np.int64)), pa.array(apart)], _FIELDS)


def _alike(x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray, reach: int) -> np.ndarray:
    """Whether SimHashes x and y are within `reach` bits, and lengths m and n allow for the edit similarity."""
    return (np.bitwise_count(x ^ y) <= reach) & (np.abs(m - n) <= (1 - SIMILARITY) * np.maximum(m, n) + 1e-9)


def _lead(reach: int, sim: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each line, the place of the first leader that it is _alike, or -1 if it leads. In blocks."""
    lead = np.full(len(sim), -1)
    for start in range(0, len(sim), BLOCK):
        rest = np.arange(start, min(start + BLOCK, len(sim)))
        while len(rest) > 1:
            x, rest = rest[0], rest[1:]
            near = _alike(sim[rest], sim[x], size[rest], size[x], reach)
            lead[rest[near]] = x
            rest = rest[~near]
    return lead


def meet(docs: DataFrame, wide: bool, parts: int) -> DataFrame:
    """Rows (bucket, a, b, sim, size) of lines that meet: `a` follows `b`, or leads (null); `bucket` is null unless some
    pair of the bucket that may link has no leader in it."""

    def page(found: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(found) < 2:
            return
        bucket = found["bucket"] >> np.uint64(16)
        order = np.argsort(bucket)
        same = bucket[order[1:]] == bucket[order[:-1]]
        found = found[order[np.append(same, False) | np.append(False, same)]]
        if not len(found):
            return
        found = found[np.lexsort((found["key"], found["bucket"] >> np.uint64(16)))]
        bucket, key = found["bucket"] >> np.uint64(16), found["key"]
        found = found[np.append(True, (bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1]))]
        bucket, key, sim = (found["bucket"] >> np.uint64(16)).astype(np.int64), found["key"], found["sim"]
        size, flag = (found["bucket"] & np.uint64(0x7FFF)).astype(np.int64), (found["bucket"] & np.uint64(0x8000)) > 0
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        count = np.diff(np.append(cut, len(bucket)))
        lead, book, named = np.full(len(key), -1), np.zeros(len(key), bool), bucket.copy()
        two = cut[count == 2]
        near = _alike(sim[two], sim[two + 1], size[two], size[two + 1], np.array(REACH)[bucket[two] & 3])
        lead[two[near] + 1] = two[near]
        narrow = bucket & 3 == 0
        book[two] = book[two + 1] = (flag[two] | flag[two + 1]) & narrow[two]
        # of the buckets of a few lines, only those with two lines that may link are looked into
        some = count > 16
        for m in range(3, 17):
            at = np.flatnonzero(count == m)
            p, q = np.triu_indices(m, 1)
            for x in range(0, len(at), 1 << 14):
                part = at[x : x + (1 << 14)]
                i, j = cut[part][:, None] + p, cut[part][:, None] + q
                some[part] = (_alike(sim[i], sim[j], size[i], size[j], np.array(REACH)[bucket[cut[part]] & 3][:, None])).any(1) | np.bitwise_or.reduceat(flag, cut)[part]
        for i, m in zip(cut[some].tolist(), count[some].tolist(), strict=True):
            s, z, reach = sim[i : i + m], size[i : i + m], REACH[bucket[i] & 3]
            if m > 64:
                got = _lead(reach, s, z)
                book[i : i + m] = narrow[i] and ((got >= 0).any() or flag[i : i + m].any())
            else:
                may = np.triu(_alike(s[:, None], s[None], z[:, None], z[None], reach), 1)
                got = np.full(m, -1)
                for x in range(m):
                    if got[x] < 0:
                        follow = may[x] & (got < 0)
                        got[follow] = x
                        may[x, follow] = False
                if not narrow[i]:
                    pass
                elif flag[i : i + m].any():
                    book[i : i + m] = True
                elif may.any():  # pairs that no leader covers: these lines, under a name that equal sets of lines share
                    some = may.any(0) | may.any(1)
                    book[i : i + m] = some
                    named[i : i + m] = int(np.bitwise_xor.reduce(key[i : i + m][some])) & ~3 | int(bucket[i]) & 3
            lead[i : i + m] = np.where(got >= 0, got + i, -1)
        follows = lead >= 0
        keep = follows | book
        lead = np.maximum(lead, 0)
        yield _rows(named[keep], key[keep], key[lead][keep], follows[keep], sim[keep], sim[lead][keep], size[keep], book[keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype([("bucket", np.uint64), ("sim", np.uint64), ("key", np.int64)])
        pages: list[bytes] = []
        for batch in batches:
            some = batch.column(1).is_valid()
            pages += batch.column(1).filter(some).to_pylist()
            yield batch.filter(pa.array(~some.to_numpy(zero_copy_only=False))).select(_FIELDS[2:])
        found = np.frombuffer(b"".join(pages), kind)
        pages.clear()
        # a part of a part at a time, if it is larger than planned: buckets stay whole
        steps = max(1, len(found) * ENTRY // (2 * PART))
        which = (found["bucket"] >> np.uint64(16)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33) if steps > 1 else None
        for k in range(steps):
            for out in page(found if which is None else found[which % np.uint64(steps) == k]):
                yield out.select(_FIELDS[2:])

    dealt = _entries(docs, wide, parts).repartitionById(parts, F.pmod("part", F.lit(parts)).cast("int"))
    return dealt.mapInArrow(run, "bucket long, a long, b long, sim long, size long, apart int")


def occurrences(docs: DataFrame) -> DataFrame:
    """Rows (key, doc_id, text_hash, line) of every line with a word, of (doc_id, text_hash, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(c).to_numpy() for c in (0, 1))
            for t in V.texts(batch.column(2)):
                x = Lines(t, False)
                yield pa.RecordBatch.from_arrays([pa.array(V.signed(x.key)), pa.array(ids[t.first + x.doc]), pa.array(hashes[t.first + x.doc]), pa.array(x.line.astype(np.int32))], ["key", "doc_id", "text_hash", "line"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, "key long, doc_id long, text_hash long, line int")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, norm): normal forms of the wanted (key, doc_id, text_hash, line)."""
    at = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("line", "key")).alias("at"))
    rows = spread.split_by(docs, wanted.select("doc_id"))[0].join(at.hint("shuffle_hash"), ["doc_id", "text_hash"]).select("text", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, norms = [], []
            for i, at in enumerate(batch.column(1)):
                lines = (batch.column(0)[i].as_py() or "").split("\n")
                for x in at.as_py():
                    keys.append(x["key"])
                    norms.append(normal(lines[x["line"]]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(norms, pa.string())], ["key", "norm"])

    return rows.mapInArrow(run, "key long, norm string")


def _verify(docs: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose normal forms are similar."""
    wanted = lines.join(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", "left_semi").select("key", "doc_id", "text_hash", "line")
    texts = spread.stash(_texts(docs, wanted).dropDuplicates(["key"]))
    met = pairs.join(texts.select(F.col("key").alias("a"), F.col("norm").alias("x")), "a").join(texts.select(F.col("key").alias("b"), F.col("norm").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = similar(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep))

    return met.mapInArrow(run, "a long, b long")


def _tiles(marked: DataFrame) -> DataFrame:
    """Lines of buckets with several groups, dealt to tiles: each block of lines outside the largest group meets all blocks."""
    groups = marked.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = groups.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("groups")).where("groups > 1")
    mixed = spread.stash(mixed.selectExpr("bucket", "most.component AS largest", f"CAST(ceil(most.n / {BLOCK}) AS bigint) AS kl", f"CAST(ceil((n - most.n) / {BLOCK}) AS bigint) AS kr"))
    rows = marked.join(mixed, "bucket").withColumn("large", F.col("component") == F.col("largest"))
    rows = rows.withColumn("block", F.expr("pmod(xxhash64(key), IF(large, kl, kr))"))
    tile = """IF(large, transform(sequence(0L, kr - 1), i -> named_struct('tile', i * (kl + kr) + kr + block, 'side', 1)),
        concat(transform(sequence(0L, kl - 1), j -> named_struct('tile', block * (kl + kr) + kr + j, 'side', 0)),
               transform(sequence(0L, kr - 1), x -> named_struct('tile', least(block, x) * (kl + kr) + greatest(block, x), 'side', IF(block <= x, 0, 1)))))"""
    return rows.withColumn("t", F.explode(F.expr(tile))).select("bucket", "t.tile", "t.side", "key", "sim", "size", "component")


def across(rows: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b, left) of different groups in a tile that may link; at most `most` of two groups in a block of a tile,
    and whether there are more."""

    def compare(reach: int, side: np.ndarray, key: np.ndarray, sim: np.ndarray, size: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        p, q = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        one = not len(q)
        q = p if one else q
        for a in range(0, len(p), 1024):
            for b in range(a if one else 0, len(q), 1024):
                i, j = p[a : a + 1024], q[b : b + 1024]
                x, y = np.nonzero(_alike(sim[i][:, None], sim[j][None], size[i][:, None], size[j][None], reach) & (group[i][:, None] != group[j][None]))
                i, j = i[x], j[y]
                if one:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                lo, hi = np.minimum(group[i], group[j]), np.maximum(group[i], group[j])
                order = np.lexsort((hi, lo))
                i, j, lo, hi = i[order], j[order], lo[order], hi[order]
                first = np.flatnonzero(np.append(True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
                count = np.diff(np.append(first, len(i)))
                keep = np.arange(len(i)) - np.repeat(first, count) < most
                yield np.minimum(key[i], key[j])[keep], np.maximum(key[i], key[j])[keep], np.repeat(count > most, count)[keep]

    def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, tile, *rest = (table.column(c).to_numpy() for c in ("bucket", "tile", "side", "key", "sim", "size", "component"))
        rest[2] = rest[2].view(np.uint64)
        cut = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])))
        for i, j in zip(cut.tolist(), np.append(cut[1:], len(bucket)).tolist(), strict=True):
            if j - i > 1:
                for got in compare(REACH[int(bucket[i]) & 3], *(x[i:j] for x in rest)):
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, got)), ["a", "b", "left"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            b, t = (batch.column(c).to_numpy() for c in (0, 1))
            table = None
            if (b[0], t[0]) != (b[-1], t[-1]) or (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != (b[-1], t[-1]):
                table = pa.Table.from_batches(held)
                last = int(np.flatnonzero((b == b[-1]) & (t == t[-1]))[0]) + len(table) - len(batch)
                yield from flush(table.slice(0, last))
                held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    return rows.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile", "side", "key").mapInArrow(run, "a long, b long, left boolean")


def ledger(docs: DataFrame, wide: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, gone array<int>): the lines each document loses; and (key, component) of the linked normal
    forms. `wide` lets lines meet by wide keys, too; without it, only those within DISTANCE bits are sure to."""
    spark = docs.sparkSession
    spread.small_batches(spark)
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    seen = Observation()
    found = spread.stash(occurrences(docs).observe(seen, F.count(F.lit(1)).alias("n")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(seen.get["n"] or 0) * ENTRIES * ENTRY // PART))
    lines = spread.stash(found.groupBy("key").agg(F.min(F.struct("doc_id", "line", "text_hash")).alias("at"), F.count("*").alias("n")).select("key", "at.doc_id", "at.line", "at.text_hash", "n"))
    met = spread.stash(meet(docs, wide, parts))
    offers = met.where("b IS NOT NULL").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("apart").alias("apart"), F.count("*").alias("buckets"))
    offers = spread.stash(offers.where(f"apart <= {CLOSE} OR buckets > 1").select("a", "b"))
    book = met.where("bucket IS NOT NULL").select("bucket", F.col("a").alias("key"), "sim", "size").distinct()
    comp = spread.stash(spread.components(spread.stash(_verify(docs, lines, offers))))
    tried, most = offers, PAIRS
    while True:
        marked = book.join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
        rest = spread.stash(across(_tiles(marked), most))
        pairs = spread.stash(rest.groupBy("a", "b").agg(F.max("left").alias("left")).join(tried, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            break
        tried = tried.union(pairs.select("a", "b"))
        comp = spread.merged(comp, spread.stash(_verify(docs, lines, pairs.select("a", "b"))))
        if pairs.where("left").isEmpty():
            break
        most *= 8
    comp = comp.withColumnRenamed("node", "key")
    group = lines.join(comp, "key", "left").where("n > 1 OR component IS NOT NULL").withColumn("component", F.coalesce("component", "key"))
    keep = group.groupBy("component").agg(F.min(F.struct("doc_id", "line", "text_hash")).alias("keep"))
    keep = group.select("key", "component").join(keep, "component").select("key", "keep")
    gone = found.join(keep, "key").where("doc_id <> keep.doc_id OR line <> keep.line OR text_hash <> keep.text_hash")
    return spread.stash(gone.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("gone"))), comp


_worded = re.compile("[0-9A-Za-z\x80-\U0010ffff]").search


def op1_line_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines (with a word), n_removed, kept_sha256 (of the kept lines joined by line feeds)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    rows, gone = spread.attach(docs, ledger(docs, wide=True)[0], "gone", by_text=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k, sha = [], [], []
            for text, gone in zip(batch.column(1), batch.column(2), strict=True):
                lines, drop = (text.as_py() or "").split("\n"), set(gone.as_py() or ())
                n.append(sum(_worded(x) is not None for x in lines))
                k.append(len(drop))
                sha.append(hashlib.sha256("\n".join(x for i, x in enumerate(lines) if i not in drop).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_lines", "n_removed", "kept_sha256"])

    return rows.select("doc_id", "text", gone).mapInArrow(run, "doc_id long, n_lines long, n_removed long, kept_sha256 string")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with their kept lines; `n_chars` is set anew. A document that loses lines and has no line with a word left goes."""
    names = docs.columns
    text = names.index("text")
    rows, gone = spread.attach(docs, ledger(docs, wide=True)[0], "gone", by_text=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = [], []
            for x, gone in zip(batch.column(text), batch.column(len(names)), strict=True):
                x, drop = x.as_py(), set(gone.as_py() or ())
                if drop:
                    lines = [y for i, y in enumerate(x.split("\n")) if i not in drop]
                    keep.append(any(map(_worded, lines)))
                    x = "\n".join(lines)
                else:
                    keep.append(True)
                texts.append(x)
            cols = [pa.array(texts, batch.schema.field(c).type) if c == text else batch.column(c) for c in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(keep, pa.bool_()))

    out = rows.select(*names, gone).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
