"""N-gram Jaccard join with signature trees.

A document's set holds the 64-bit hashes of its distinct k-word shingles; two documents link when 100 * |A and B| >=
percent * |A or B|. The result is the least doc_id of each document's connected group. Every link between different
sets is honoured; no bucket, partner list or candidate list is capped.

Steps, each one's rows in proportion to the corpus:

1. Frequent shingles (at least 1 in EPSILON of all occurrences; so at most EPSILON of them, however large the corpus).
2. Per document: set size, set fingerprint, bitmap, and its prefix: the rarest shingles (frequent ones last, then by
   hash) that any linked set must share one of. Equal sets collapse to the least doc_id.
3. Prefix rows are dealt by shingle; those without another set of a near enough size under their shingle are dropped. Of
   shingles with the same documents (near copies share many) only the least stays: it has all their pairs.
4. Close copies: documents with the same least shared prefix shingle follow leaders by their bitmaps, and each is compared
   with its leader, exactly, which merges the large groups without all their pairs and moves no other text; shingles of
   more than BLOCK documents are dealt to several tasks.
5. Every shared prefix shingle whose documents aren't in one group yet: a signature tree over their bitmaps; its nodes
   hold OR-combined bitmaps, size ranges and group ranges. A dual traversal prunes node pairs of one group, and pairs
   whose greatest possible overlap is too small. Bitmaps of large sets hold a sample by hash, whose bound fails for a
   linked pair with a probability under 1e-15. A pair comes from the bucket of the least of the FIRST shingles that it
   shares, not from all. What remains is verified on exact sets. Each round offers at most PAIRS pairs of a group with
   lesser groups in a bucket, so a bucket's offers grow with its groups and not with their square; buckets with more go
   into the next round, when most are in one group, until none is left, so nothing is lost.

Cases: null or wordless texts have the empty set and link with nothing; null doc_ids are groups of their own (null
component); rows that share a doc_id are one node; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import spread
from framelake.llm import textvec as V

EPSILON = 1_000_000
BITS = 2048
#: A bitmap holds at most this many shingles: all of a smaller set's, else those with a hash in the first 2**-level of the
#: range, the same for all sets of a level. Overlaps of samples are held to SIGMAS standard deviations under their mean.
SAMPLE, SIGMAS = 700, 9
GROUP = 2_000_000  # occurrences counted at a time
PAIRS = 8
FIRST = 4  # least shared shingles that a row carries, so that a pair is offered in one bucket
BLOCK = 4096  # members of a bucket in one tree; larger buckets are joined block by block

_LOWERED = V.BYTE.copy()
_LOWERED[0x41:0x5B] = V.BYTE[0x61:0x7B]


def sets(t: V.Text, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a slice."""
    s, e = t.runs(V.SPACE)
    b = t.bounds(s)
    h = t.hashes(s, e, _LOWERED)
    g = V.grams(h, k)
    out = []
    for i, j in zip(b[:-1].tolist(), b[1:].tolist(), strict=True):
        if j - i >= k:
            out.append(np.unique(g[i : j - k + 1]))
        elif j > i:
            out.append(V.grams(np.concatenate([h[i:j], np.zeros(k - (j - i), np.uint64)]), k)[:1])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _least_overlap(n: int, percent: int) -> int:
    """Shared shingles that a set of n has at least with any linked set: ceil(percent / 100 * n)."""
    return -(-percent * n // 100)


def _level(n: int) -> int:
    return max(0, (-(-n // SAMPLE) - 1).bit_length())


def _bitmap(a: np.ndarray, level: int) -> tuple[bytes, int, int]:
    """Bitmap and size of a set's sample at a level, and the sample's size at the next. The sorted hashes' first part is
    the sample, and its bits are in that order: the bitmap's first half, coarser, is the next level's."""
    part, less = (a[: np.searchsorted(a, np.uint64(1) << np.uint64(64 - x))] if x else a for x in (level, level + 1))
    bits = np.zeros(BITS, bool)
    bits[part >> np.uint64(64 - level - (BITS.bit_length() - 1))] = True
    return np.packbits(bits).tobytes(), len(part), len(less)


def _next_level(bits: np.ndarray) -> np.ndarray:
    """Bitmaps at the next level, from rows of BITS // 64 numbers: each bit of the first half stands for two."""
    half = np.unpackbits(np.ascontiguousarray(bits[:, : BITS // 128]).view(np.uint8), axis=1)
    return np.packbits(np.repeat(half, 2, axis=1), axis=1).view(np.uint64)


def frequent(docs: DataFrame, k: int) -> np.ndarray:
    """Shingles with a share of 1 / EPSILON of the occurrences, by lossy counting: each GROUP offers those with that share in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            all_ = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held.clear()
            g, n = np.unique(all_, return_counts=True)
            keep = (n * EPSILON >= len(all_)) & (n > 1)
            return pa.RecordBatch.from_arrays([pa.array(np.append(V.signed(g[keep]), 0)), pa.array(np.append(n[keep], 0)), pa.array(np.append(np.zeros(keep.sum(), np.int64), len(all_)))], ["g", "n", "total"])

        for batch in batches:
            for t in V.texts(batch.column(0)):
                held += sets(t, k)
                if sum(map(len, held)) >= GROUP:
                    yield flush()
        yield flush()

    found = spread.stash(docs.select("text").mapInArrow(run, "g long, n long, total long").groupBy("g").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    total = found.agg(F.sum("total")).first()[0] or 0
    hot = found.where((F.col("n") * EPSILON >= total) & (F.col("n") > 1)).select("g").toArrow()
    return np.sort(hot.column(0).to_numpy().view(np.uint64))


def signatures(docs: DataFrame, k: int, percent: int, hot: np.ndarray) -> DataFrame:
    """doc_id, n, set fingerprint f1 and f2, prefix shingles, level, bitmap, and sample sizes at the level and at the next."""
    held = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = held.value
        for batch in batches:
            for t in V.texts(batch.column(1)):
                n, f1, f2, prefix, maps = [], [], [], [], []
                for a in sets(t, k):
                    n.append(len(a))
                    f1.append(int(a.sum(dtype=np.uint64)))
                    f2.append(int(V.mix(a ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64)))
                    length = len(a) - _least_overlap(len(a), percent) + 1 if len(a) else 0
                    if len(hot) and len(a):
                        common = hot[np.minimum(np.searchsorted(hot, a), len(hot) - 1)] == a
                        order = np.concatenate([a[~common], a[common]])[:length]
                    else:
                        order = a[:length]
                    prefix.append(V.signed(order))
                    level = _level(len(a))
                    maps.append((level, *_bitmap(a, level)))
                level, b0, s0, s1 = zip(*maps, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, t.n), pa.array(n, pa.int64()), pa.array(V.signed(np.array(f1, np.uint64))), pa.array(V.signed(np.array(f2, np.uint64))), pa.array(prefix, pa.list_(pa.int64())), pa.array(level, pa.int64()), pa.array(b0, pa.binary()), pa.array(s0, pa.int64()), pa.array(s1, pa.int64())],
                    ["doc_id", "n", "f1", "f2", "prefix", "level", "b0", "s0", "s1"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, f1 long, f2 long, prefix array<long>, level long, b0 binary, s0 long, s1 long")


def _shared(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (g, n, doc_id) with a g of another row whose size allows for a link; dealt by g and sorted by size, so that
    runs stream by and neighbours tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, told = None, False  # the last row so far; whether the one before it is near
        names = ["g", "n", "doc_id"]
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in range(3)]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.append(x, y) for x, y in zip(held, cols, strict=True)]
            g, n = cols[0], cols[1]
            near = (g[1:] == g[:-1]) & (percent * n[1:] <= 100 * n[:-1])
            keep = np.append(near, False) | np.append(told, near)
            told, held = bool(keep[-1]), [x[-1:] for x in cols]
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep[:-1]]) for x in cols], names)
        if held is not None and told:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, held)), names)

    return rows.repartition("g").sortWithinPartitions("g", "n", "doc_id").mapInArrow(run, "g long, n long, doc_id long")


def _first_of_equal(rows: DataFrame) -> DataFrame:
    """(g): of the shingles whose documents are the same ones, by their number and two 64-bit hashes, the least."""
    sets_ = rows.groupBy("g").agg(F.count("*").alias("members"), F.expr("bit_xor(xxhash64(doc_id))").alias("x"), F.expr("bit_xor(xxhash64(doc_id, 1))").alias("y"))
    return sets_.groupBy("members", "x", "y").agg(F.min("g").alias("g")).select("g")


def _fits(most: np.ndarray, total: np.ndarray, least: np.ndarray, sampled: bool | np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap of at most `most` is enough for sizes that sum to `total`, the lesser being `least`."""
    need = percent * total / (100 + percent)
    return most >= np.where(sampled, need - SIGMAS * np.sqrt(least * 0.25 * (1 - percent / 100) * 2 + 1) - 1, need - 1e-6)


class Tree:
    """A signature tree over members sorted by group and size: arrays by level, the leaves first.

    Each holds bitmaps, sizes of the sets (least, most), slack (shingles beyond one a bit), groups (least, most), sizes of the samples (least, most).
    """

    FAN = 8

    def __init__(self, bits: np.ndarray, slack: np.ndarray, n: np.ndarray, size: np.ndarray, group: np.ndarray):
        level = (bits, n, n, slack, group, group, size, size)
        self.levels = [level]
        while len(level[1]) > 1:
            cut = np.arange(0, len(level[1]), self.FAN)
            by = (np.bitwise_or, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum, np.minimum, np.maximum)
            level = tuple(f.reduceat(x, cut) for f, x in zip(by, level, strict=True))
            self.levels.append(level)


def _may(u: tuple, i: np.ndarray, v: tuple, j: np.ndarray, sampled: bool, percent: int) -> np.ndarray:
    """Whether some pair under nodes i of level u and j of level v may link: by groups, sizes and greatest overlap."""
    one = (u[4][i] == u[5][i]) & (v[4][j] == v[5][j]) & (u[4][i] == v[4][j])
    sizes = (percent * u[1][i] <= 100 * v[2][j]) & (percent * v[1][j] <= 100 * u[2][i])
    ok = np.flatnonzero(~one & sizes)
    i2, j2 = i[ok], j[ok]
    most = np.bitwise_count(u[0][i2] & v[0][j2]).sum(1, dtype=np.int64) + np.minimum(u[3][i2], v[3][j2])
    most = np.minimum(most, np.minimum(u[7][i2], v[7][j2]))
    out = np.zeros(len(i), bool)
    out[ok[_fits(most, u[6][i2] + v[6][j2], np.minimum(u[7][i2], v[7][j2]), sampled, percent)]] = True
    return out


def traverse(a: Tree, b: Tree, sampled: bool, percent: int, same: bool, step: int = 1 << 10) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs that may link, by dual traversal from the roots; at most `step` node pairs are expanded at a time."""
    stack = [(len(a.levels) - 1, len(b.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        x, y, i, j = stack.pop()
        ok = _may(a.levels[x], i, b.levels[y], j, sampled, percent)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if not x and not y:
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        nx, ny = max(x - 1, 0), max(y - 1, 0)
        fx, fy = (Tree.FAN if x else 1), (Tree.FAN if y else 1)
        for s in range(0, len(i), step):
            p, q = i[s : s + step], j[s : s + step]
            ci = (p[:, None] * fx + np.arange(fx))[:, :, None].repeat(fy, 2).reshape(-1)
            cj = (q[:, None] * fy + np.arange(fy))[:, None, :].repeat(fx, 1).reshape(-1)
            real = (ci < len(a.levels[nx][1])) & (cj < len(b.levels[ny][1]))
            if same and x == y:
                real &= ci <= cj
            stack.append((nx, ny, ci[real], cj[real]))


class Members:
    """Rows of buckets as arrays; `first` has each row's least shared shingles, of all buckets."""

    def __init__(self, table: pa.Table):
        self.n, self.component, self.side, self.doc, self.level = (table.column(c).to_numpy() for c in ("n", "component", "side", "doc_id", "level"))
        self.size = np.stack([table.column(c).to_numpy() for c in ("s0", "s1")])
        self.bits = np.frombuffer(b"".join(table.column("b0").to_pylist()), np.uint64).reshape(-1, BITS // 64)
        if "g" in table.column_names:
            self.g, self.first = table.column("g").to_numpy(), [table.column(f"h{x}").to_numpy() for x in range(FIRST)]

    def maps(self, rows: np.ndarray, up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps and slack of rows, `up` levels (0 or 1) above their own. A coarser bitmap has no bound of its own: its slack is its size."""
        bits = self.bits[rows]
        slack = self.size[up, rows] - np.where(up == 0, np.bitwise_count(bits).sum(1, dtype=np.int64), 0)
        some = np.flatnonzero(up)
        if len(some):
            bits[some] = _next_level(bits[some])
        return bits, slack

    def met(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the rows of a bucket share a lesser shingle, in the bucket of which the pair is offered."""
        out = np.zeros(len(i), bool)
        for x in self.first:
            for y in self.first:
                out |= (x[i] == y[j]) & (x[i] < self.g[i])
        return out

    def leaf(self, i: np.ndarray, j: np.ndarray, percent: int, step: int = 1 << 15) -> np.ndarray:
        """Which pairs may link; the test of two leaves, at the greater level of the two."""
        ok = (self.component[i] != self.component[j]) & (percent * np.maximum(self.n[i], self.n[j]) <= 100 * np.minimum(self.n[i], self.n[j]))
        at = np.flatnonzero(ok)
        for s in range(0, len(at), step):
            part = at[s : s + step]
            p, q = i[part], j[part]
            level = np.maximum(self.level[p], self.level[q])
            kp, kq = level - self.level[p], level - self.level[q]
            (a, x), (b, y) = self.maps(p, kp), self.maps(q, kq)
            sp, sq = self.size[kp, p], self.size[kq, q]
            most = np.minimum(np.bitwise_count(a & b).sum(1, dtype=np.int64) + np.minimum(x, y), np.minimum(sp, sq))
            ok[part] = _fits(most, sp + sq, np.minimum(sp, sq), level > 0, percent)
        return ok

    def tree_pairs(self, start: int, stop: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a large bucket, level by level: rows of a level, and those of the level below that may be as large."""
        rows = np.arange(start, stop)
        for level in np.unique(self.level[start:stop]).tolist() + [int(self.level[start:stop].max()) + 1]:
            sides = []
            for side in (0, 1):
                own = rows[(self.level[rows] == level) & (self.side[rows] == side)]
                below = rows[(self.level[rows] == level - 1) & (self.side[rows] == side)]
                at, k = np.concatenate([own, below]), np.concatenate([np.zeros(len(own), int), np.ones(len(below), int)])
                if side and not len(at):
                    break
                order = np.lexsort((self.n[at], self.component[at]))
                at, k = at[order], k[order]
                sides.append((at, k, Tree(*self.maps(at, k), self.n[at], self.size[k, at], self.component[at]) if len(at) else None))
            (a, ka, ta), (b, kb, tb) = sides[0], sides[-1]
            if ta is None or tb is None or (ka.all() and kb.all()):
                continue
            for i, j in traverse(ta, tb, level > 0, percent, len(sides) == 1):
                new = (ka[i] == 0) | (kb[j] == 0)
                if new.any():
                    yield a[i[new]], b[j[new]]


def _led(keyed: DataFrame, percent: int) -> DataFrame:
    """(doc_id, rep) of rows with a `key`, by their bitmaps: in each key the first row leads all that may link to it, then
    the first of the others does, and so on. Leaders of some row have themselves as rep; others have no row."""

    def flush(table: pa.Table) -> pa.RecordBatch:
        m, key = Members(table), table.column("key").to_numpy()
        rest, lead = np.arange(len(key)), np.full(len(key), -1)
        while len(rest) > 1:
            head = np.append(True, key[rest[1:]] != key[rest[:-1]])
            first = rest[head][np.cumsum(head) - 1]
            rest, first = rest[~head], first[~head]
            near = m.leaf(first, rest, percent)
            lead[rest[near]] = first[near]
            rest = rest[~near]
        follows = np.flatnonzero(lead >= 0)
        rep = np.unique(lead[follows])
        return pa.RecordBatch.from_arrays([pa.array(m.doc[np.append(follows, rep)]), pa.array(m.doc[np.append(lead[follows], rep)])], ["doc_id", "rep"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            key = batch.column(0).to_numpy()
            if held[0].column(0)[0].as_py() == key[-1]:
                continue  # one key goes on; it has about BLOCK rows
            table = pa.Table.from_batches(held)
            n = len(table) - len(batch) + int(np.flatnonzero(key == key[-1])[0])
            yield flush(table.slice(0, n))
            held = table.slice(n).combine_chunks().to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))

    rows = keyed.select("key", "doc_id", "n", F.col("doc_id").alias("component"), F.lit(0).alias("side"), "level", "b0", "s0", "s1")
    return rows.repartition("key").sortWithinPartitions("key", "doc_id").mapInArrow(run, "doc_id long, rep long")


def _close(docs: DataFrame, signs: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified edges between documents with one least shared shingle: bitmaps tell the leader that each may link to, and
    the texts of leaders and followers, and of no others, are compared. A shingle with more than BLOCK documents is dealt
    to several keys; what that misses is left to the trees."""
    sizes = signs.groupBy("h0").agg(F.count("*").alias("members")).where("members > 1").selectExpr("h0", f"CAST(ceil(members / {BLOCK}) AS bigint) AS salts")
    keyed = signs.join(spread.stash(sizes), "h0").withColumn("key", F.expr("xxhash64(h0, pmod(xxhash64(doc_id), salts))"))
    led = spread.stash(_led(keyed, percent).distinct())
    rows = spread.split_by(docs, led.select("doc_id"))[0].join(led.hint("shuffle_hash"), "doc_id").select("rep", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, held = None, []
        for batch in batches:
            reps, ids, a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], []
            for t in V.texts(batch.column(2)):
                for i, own in enumerate(sets(t, k), t.first):
                    if reps[i] != rep:
                        rep, held = reps[i], []
                    if ids[i] == rep:
                        held.append(own)
                    elif any(len(own) and _linked(own, x, percent) for x in held):
                        a.append(ids[i])
                        b.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.repartition("rep").sortWithinPartitions("rep", F.col("doc_id") != F.col("rep"), "doc_id").mapInArrow(run, "a long, b long")


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (g, a, b, left) that may link, of rows (g, tile, side, doc_id, n, component, ...) dealt by (g, tile).

    Buckets of one leaf are tested together; larger ones by their trees. At most `most` pairs of a group with lesser ones come
    from a bucket; `left` says that there are more, for a later round.
    """

    def offer(m: Members, i: np.ndarray, j: np.ndarray, bucket: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
        new = ~m.met(i, j)
        i, j, bucket = i[new], j[new], bucket[new]
        lo, hi = np.minimum(m.component[i], m.component[j]), np.maximum(m.component[i], m.component[j])
        order = np.lexsort((lo, hi, bucket))
        i, j, hi, bucket = i[order], j[order], hi[order], bucket[order]
        new = np.append(True, (hi[1:] != hi[:-1]) | (bucket[1:] != bucket[:-1]))[: len(i)]
        first = np.flatnonzero(new)
        place = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
        more = np.repeat(np.diff(np.append(first, len(i))) > most, np.diff(np.append(first, len(i))))
        keep = place < most
        a, b = m.doc[i[keep]], m.doc[j[keep]]
        return m.g[i[keep]], np.minimum(a, b), np.maximum(a, b), more[keep]

    def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
        m, most = Members(table), int(table.column("most")[0].as_py())
        g, t = table.column("g").to_numpy(), table.column("tile").to_numpy()
        cut = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (t[1:] != t[:-1])))
        size = np.diff(np.append(cut, len(g)))
        # large buckets, one by one; pairs are offered in parts, so a part's limit only shortens what a round offers
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in np.flatnonzero(size > Tree.FAN).tolist():
            held, n = [], 0
            for i, j in m.tree_pairs(int(cut[k]), int(cut[k] + size[k]), percent):
                held.append((i, j))
                n += len(i)
                if n > 1 << 18:
                    i, j = (np.concatenate(x) for x in zip(*held, strict=True))
                    yield batch(*offer(m, i, j, np.zeros(len(i), np.int64), most))
                    held, n = [], 0
            if held:
                i, j = (np.concatenate(x) for x in zip(*held, strict=True))
                parts.append((i, j, np.full(len(i), k)))
        for s in range(2, Tree.FAN + 1):
            at = np.flatnonzero(size == s)
            p, q = np.triu_indices(s, 1)
            for c in range(0, len(at), max(1, (1 << 17) // len(p))):
                some = at[c : c + max(1, (1 << 17) // len(p))]
                i, j = (cut[some][:, None] + p[None]).reshape(-1), (cut[some][:, None] + q[None]).reshape(-1)
                ok = m.leaf(i, j, percent)
                parts.append((i[ok], j[ok], np.repeat(some, len(p))[ok]))
        if parts:
            i, j, bucket = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield batch(*offer(m, i, j, bucket, most))

    def batch(*cols: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(map(pa.array, cols)), ["g", "a", "b", "left"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not len(b):
                continue
            held.append(b)
            g, t = b.column(0).to_numpy(), b.column(1).to_numpy()
            if held[0] is not b and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) == (g[-1], t[-1]):
                continue  # one bucket's tile goes on; it has at most two blocks of rows
            table = pa.Table.from_batches(held)
            other = len(table) - len(b) + np.flatnonzero((g != g[-1]) | (t != t[-1]))
            n = int(other[-1]) + 1 if len(other) else len(table) - len(b)
            if n:
                yield from flush(table.slice(0, n))
            held = table.slice(n).combine_chunks().to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    rows = rows.repartition("g", "tile").sortWithinPartitions("g", "tile")
    return rows.select("g", "tile", "side", "doc_id", "n", "component", "level", "b0", "s0", "s1", *(f"h{x}" for x in range(FIRST)), "most").mapInArrow(run, "g long, a long, b long, left boolean")


def _tiles(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of a bucket, for trees: one tile for a bucket of up to BLOCK rows; else each row goes to the tiles of its block with all blocks."""
    rows = rows.join(sizes, "g").withColumn("blocks", F.expr(f"CAST(ceil(members / {BLOCK}) AS int)"))
    rows = rows.withColumn("block", F.expr("CAST(pmod(xxhash64(doc_id), blocks) AS int)"))
    tile = F.expr("IF(blocks = 1, array(named_struct('tile', 0L, 'side', 0)), transform(sequence(0, blocks - 1), x -> named_struct('tile', CAST(least(x, block) AS bigint) * blocks + greatest(x, block), 'side', IF(x = block, 0, IF(block < x, 0, 1)))))")
    return rows.withColumn("t", F.explode(tile)).select("*", "t.tile", "t.side").drop("t", "blocks", "block", "members")


def _verify(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, on exact sets: each pair's two texts, which take less room than their sets, meet under the pair."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("doc_id"))
    rows = spread.split_by(docs, ends.select("doc_id"))[0].select("doc_id", "text")
    met = rows.join(ends.hint("shuffle_hash"), "doc_id").groupBy("a", "b").agg(F.collect_list("text").alias("texts"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            at = texts.offsets.to_numpy() - (texts.offsets[0].as_py() if len(texts) else 0)
            own = [x for t in V.texts(texts.flatten()) for x in sets(t, k)]
            keep = [any(_linked(own[p], own[q], percent) for p in range(i, j) for q in range(i, p)) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(test, "a long, b long")


def groups(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs."""
    spread.small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    known = docs.where("doc_id IS NOT NULL")
    sig = spread.stash(signatures(docs, k, percent, frequent(docs, k)), "zstd")
    sizes = spread.stash(sig.select("doc_id", "n"))
    some = sig.where("n > 0 AND doc_id IS NOT NULL")
    # equal sets are linked to their least doc_id; with rows that share a doc_id, that is an edge as any other
    same = some.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    same = spread.stash(some.select("doc_id", "n", "f1", "f2").join(same, ["n", "f1", "f2"]).where("doc_id <> rep").distinct())
    maybe, clear = spread.split_by(some, same.select("doc_id"))
    reps = maybe.join(same.drop("rep").hint("shuffle_hash"), ["doc_id", "n", "f1", "f2"], "left_anti").select(*some.columns).union(clear).drop("f1", "f2")
    near = spread.stash(_shared(reps.select(F.explode("prefix").alias("g"), "n", "doc_id"), percent).drop("n").distinct())
    rows = spread.stash(near.join(_first_of_equal(near), "g", "left_semi"))
    least = spread.stash(rows.groupBy("doc_id").agg(F.slice(F.array_sort(F.collect_list("g")), 1, FIRST).alias("h")))
    signs = spread.split_by(reps.drop("prefix"), least.select("doc_id"))[0].join(least.hint("shuffle_hash"), "doc_id")
    signs = spread.stash(signs.select(*reps.drop("prefix").columns, *(F.coalesce(F.get("h", F.lit(x)), F.lit((1 << 63) - 1)).alias(f"h{x}") for x in range(FIRST))), "zstd")
    edges = same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comp = spread.stash(spread.components(edges.union(spread.stash(_close(known, signs, k, percent)))))
    spread.drop(sig, near, same, least)  # the largest tables; what came of them is written
    tried, most = None, PAIRS
    while True:
        labelled = spread.stash(rows.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")))
        mixed = spread.stash(labelled.groupBy("g").agg(F.count("*").alias("members"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("g", "members"))
        tiles = _tiles(labelled, mixed).join(signs, "doc_id").withColumn("most", F.lit(most))
        offers = spread.stash(_candidates(tiles, percent))
        spread.drop(labelled, mixed)
        rows = rows.join(offers.where("left").select("g").distinct(), "g", "left_semi")  # the other buckets are done
        pairs = offers.select("a", "b").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = spread.stash(pairs)
        tried = pairs if tried is None else tried.union(pairs)
        comp = spread.merged(comp, spread.stash(_verify(known, pairs, k, percent)))
        if not offers.where("left").limit(1).count():
            break
        most *= 8
    return sizes.select("doc_id", F.col("n").alias("n_shingles")).join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op4_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the group's least doc_id. Sets of five words, similarity 0.8.

    Documents without words, or with a null doc_id, stay.
    """
    gone = spread.stash(groups(docs, k=5, percent=80).where("component_id <> doc_id").select("doc_id").distinct())
    maybe, clear = spread.split_by(docs, gone)
    return maybe.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns).union(clear)
