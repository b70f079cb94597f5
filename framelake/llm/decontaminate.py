"""Benchmark decontamination by a generalised suffix automaton of normalised benchmark items.

Normalised words: A-Z as a-z, runs of ASCII letters, digits and code points above 0x7F. The automaton accepts every run
of words of every item. Documents stream through it; after each word it holds the length of the longest run of words
that ends there and occurs in an item. Where that length reaches `window` words, the last `window` words are a window of
some item, and the state that holds them (the automaton's, or one up its suffix links) is marked with the items that have
it; an item with fewer words is one window as a whole, marked at the state of its length.

A whole-array filter goes before: only words of the items, in runs whose neighbouring pairs are all pairs of an item,
can carry a match, and only runs of the shortest window's length or more are streamed. It loses no match.

Size: the automaton has under two states for each benchmark word. `max_items_bytes` is the checked bound of one
automaton's items, which are broadcast; each worker builds it once. A larger benchmark is cut into shards of items, whose
passes over the documents run one after another and write their hits, which are merged.

Cases: null texts, and texts without words, have no words and are clean; null or wordless items have no window; items
that repeat are each reported; null doc_ids stay; an empty benchmark leaves all documents clean; repeated document rows
give repeated result rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from framelake.llm import spread
from framelake.llm import textvec as V

WINDOW = 10
#: Bytes of benchmark text in one automaton, which takes about 120 times as much memory in each Python worker.
MAX_ITEMS_BYTES = 2 << 20


class SuffixAutomaton:
    """Generalised over sequences of word ids. Lists by state: next (dict), link, length."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        twin = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        self.link[q] = twin
        return twin

    def add(self, words: list[int]) -> None:
        last = 0
        for c in words:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            last = new

    def walk(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length of the longest match that ends here), for each word."""
        nxt, link, length = self.next, self.link, self.length
        at, n = 0, 0
        for c in words:
            to = nxt[at].get(c)
            while to is None and at:
                at = link[at]
                n = length[at]
                to = nxt[at].get(c)
            if to is not None:
                at, n = to, n + 1
            yield at, n


class Benchmark:
    """The automaton of some items, and what is needed to read windows off its states."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.window = window
        self.ids = [str(i) for i, _ in items]
        parts = []
        for t in V.texts(pa.array([x for _, x in items], pa.string()), 1 << 62):
            s, e = t.runs(V.ALNUM)
            h, b = t.hashes(s, e, V.LOWER), t.bounds(s)
            parts = [h[b[i] : b[i + 1]] for i in range(t.n)]
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.vocab = np.unique(words)
        seqs = [np.searchsorted(self.vocab, p).tolist() for p in parts]
        pairs = [V.grams(p, 2) for p in parts]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        lengths = [len(s) for s in seqs if s]
        self.least = min([window, *lengths]) if lengths else 0
        self.auto = SuffixAutomaton()
        for s in seqs:
            self.auto.add(s)
        # windows are read off the states: each length's state by state, and the items that have a window there
        short = {len(s) for s in seqs if 0 < len(s) < window}
        self.lengths = sorted(short | ({window} if any(n >= window for n in lengths) else set()))
        self.at = {m: self._suffixes(m) for m in self.lengths}
        self.items: dict[int, dict[int, list[int]]] = {m: {} for m in self.lengths}
        for i, s in enumerate(seqs):
            m = min(len(s), window)
            own: set[int] = set()
            for state, n in self.auto.walk(s):
                if 0 < m <= n and (q := self.at[m][state]) not in own:
                    own.add(q)
                    self.items[m].setdefault(q, []).append(i)

    def _suffixes(self, m: int) -> list[int]:
        """For each state, the one that holds the last m words of its longest run; -1 if that is shorter."""
        link, length = self.auto.link, self.auto.length
        out = [-1] * len(length)
        for q in sorted(range(1, len(length)), key=length.__getitem__):
            out[q] = -1 if length[q] < m else q if length[link[q]] < m else out[link[q]]
        return out

    def stream(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit word ranges of a run of word ids, and the items with windows in it."""
        found, items = [], set()
        for k, (state, n) in enumerate(self.auto.walk(ids), 1):
            for m in self.lengths:
                if m > n:
                    break
                own = self.items[m].get(self.at[m][state])
                if own:
                    items.update(own)
                    start = k - m
                    while found and found[-1][1] >= start:
                        start = min(start, found.pop()[0])
                    found.append((start, k))
        return found, items

    def scan(self, t: V.Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]], list[set[int]]]:
        """For a slice: word starts, ends, document bounds in words; hit ranges (in words of the slice); items by document."""
        s, e = t.runs(V.ALNUM)
        b = t.bounds(s)
        hits: list[tuple[int, int]] = []
        items: list[set[int]] = [set() for _ in range(t.n)]
        if not len(s) or not self.least:
            return s, e, b, hits, items
        h = t.hashes(s, e, V.LOWER)
        ids = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        known = self.vocab[ids] == h
        # a word goes on a run if it and the word before are known, of one document, and a pair of some item
        go = np.zeros(len(s), bool)
        if len(self.pairs) and len(s) > 1:
            both = np.flatnonzero(known[1:] & known[:-1])
            with np.errstate(over="ignore"):
                p = V.mix(h[both] * V._K[0] + h[both + 1] * V._K[1])
            go[both[self.pairs[np.minimum(np.searchsorted(self.pairs, p), len(self.pairs) - 1)] == p] + 1] = True
            go[b[:-1][b[:-1] < len(s)]] = False
        first = np.flatnonzero(known & ~go)
        # a run ends before the next word that doesn't go on
        stops = np.append(np.flatnonzero(~go), len(s))
        last = stops[np.searchsorted(stops, first, "right")]
        long = last - first >= self.least
        for i, j in zip(first[long].tolist(), last[long].tolist(), strict=True):
            got, own = self.stream(ids[i:j].tolist())
            if got:
                hits += [(i + x, i + y) for x, y in got]
                items[int(np.searchsorted(b, i, "right")) - 1] |= own
        return s, e, b, hits, items


def item_shards(benchmark: DataFrame, max_items_bytes: int = MAX_ITEMS_BYTES) -> Iterator[list[tuple[str, str]]]:
    """Items in shards of at most max_items_bytes of text, so each automaton's size is bounded. One is held at a time."""
    shard, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("x")).where("x IS NOT NULL").toLocalIterator():
        if size and size + len(r.x) > max_items_bytes:
            yield shard
            shard, size = [], 0
        shard.append((r.i, r.x))
        size += len(r.x)
    yield shard


def _sha(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


#: Automata of this worker process, by the id of their broadcast; one is kept.
_built: dict[int, Benchmark] = {}


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_items_bytes: int = MAX_ITEMS_BYTES, name: str = "_scan") -> DataFrame:
    """Every row of docs with a last column `name`, a struct `n_words long, hit_from array<long>, hit_to array<long>,
    hit_items array<string>`: ranges of hit words (end exclusive), disjoint for each shard of the benchmark.

    One pass and no shuffle for the first shard. The hits of further shards are written, one shard after another, once for
    each text (by 128 bits of hash), and joined to the rows that have any.
    """
    spread.small_batches(docs.sparkSession)
    more, h1, h2, n = spread.unused([*docs.columns, name], "more", "h1", "h2", "n")
    hashed = {h1: F.xxhash64("text"), h2: F.xxhash64(F.lit(1), "text")}
    rest: DataFrame | None = None
    for k, items in enumerate(item_shards(benchmark, max_items_bytes)):
        if not k:
            out = _one(docs, items, window, name)
            continue
        got = _one(docs.where("text IS NOT NULL").select("text"), items, window, "scan").where("size(scan.hit_from) > 0").withColumns(hashed)
        hits = spread.stash(got.groupBy(h1, h2).agg(F.first("scan").alias("scan"), F.count(F.lit(1)).alias(n)))
        rest = hits if rest is None else rest.union(hits)
    if rest is None:
        return out
    joined = lambda c: F.flatten(F.collect_list(f"scan.{c}")).alias(c)
    merged = rest.groupBy(h1, h2).agg(F.max(n).alias(n), joined("hit_from"), joined("hit_to"), joined("hit_items")).select(h1, h2, n, F.struct("hit_from", "hit_to", "hit_items").alias(more))
    out = spread.facts(out.withColumns(hashed), spread.stash(merged), [h1, h2], n, more)
    both = [F.concat(F.col(f"{name}.{c}"), F.coalesce(F.col(f"{more}.{c}"), F.array().cast(f"array<{kind}>"))).alias(c) for c, kind in (("hit_from", "bigint"), ("hit_to", "bigint"), ("hit_items", "string"))]
    return out.withColumn(name, F.struct(F.col(f"{name}.n_words").alias("n_words"), *both)).drop(more, h1, h2)


_SCAN = pa.struct([("n_words", pa.int64()), ("hit_from", pa.list_(pa.int64())), ("hit_to", pa.list_(pa.int64())), ("hit_items", pa.list_(pa.string()))])


def _one(docs: DataFrame, items: list[tuple[str, str]], window: int, name: str) -> DataFrame:
    """docs with the hits of one shard of items."""
    names, at = docs.columns, docs.columns.index("text")
    field = StructField(name, StructType([StructField("n_words", LongType()), StructField("hit_from", ArrayType(LongType())), StructField("hit_to", ArrayType(LongType())), StructField("hit_items", ArrayType(StringType()))]))
    held = docs.sparkSession.sparkContext.broadcast(items)
    key = uuid.uuid4().int

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _built:
            _built.clear()
            _built[key] = Benchmark(held.value, window)
        bench = _built[key]
        for batch in batches:
            for t in V.texts(batch.column(at)):
                _, _, b, hits, items = bench.scan(t)
                rows = [{"n_words": n, "hit_from": [], "hit_to": [], "hit_items": sorted(bench.ids[x] for x in own)} for n, own in zip(np.diff(b).tolist(), items, strict=True)]
                for i, j in hits:
                    d = int(np.searchsorted(b, i, "right")) - 1
                    rows[d]["hit_from"].append(i - int(b[d]))
                    rows[d]["hit_to"].append(j - int(b[d]))
                yield pa.RecordBatch.from_arrays([*batch.slice(t.first, t.n).columns, pa.array(rows, _SCAN)], [*names, name])

    return docs.mapInArrow(spread.tidied(run), StructType([*docs.schema.fields, field]))


def covered(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Union of ranges, in order."""
    out: list[tuple[int, int]] = []
    for i, j in sorted(zip(starts, ends, strict=True)):
        if out and i <= out[-1][1]:
            out[-1] = (out[-1][0], max(j, out[-1][1]))
        else:
            out.append((i, j))
    return out


def op5_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    found = find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text")
    # ranges of one shard are disjoint; several shards may overlap, so the count is of the union
    union = F.aggregate(
        F.array_sort(F.arrays_zip("_scan.hit_from", "_scan.hit_to")),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(x["hit_to"] - F.greatest(x["hit_from"], acc["end"]), F.lit(0))).cast("long").alias("n"), F.greatest(acc["end"], x["hit_to"]).cast("long").alias("end")),
    )["n"]
    ids = F.array_sort("_scan.hit_items")
    return found.select(
        "doc_id", F.col("_scan.n_words").alias("n_words"), union.alias("n_hit"), F.size("_scan.hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (F.size("_scan.hit_from") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_items_bytes: int = MAX_ITEMS_BYTES, max_coverage: float = 0.5) -> DataFrame:
    """docs without the spans of words that windows cover; a document with a larger share of hit words than max_coverage goes.

    A span runs from its first word to its last, and is replaced by one space; `n_chars`, where there is one, is set anew.
    Documents without a hit, also those without words, stay as they are.
    """
    names = docs.columns
    (scan_,) = spread.unused(names, "scan")
    found = find(docs, benchmark, window, max_items_bytes, scan_)
    at = found.columns.index(scan_)
    text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scans = batch.column(at)
            hit = np.array([len(x["hit_from"]) > 0 for x in scans.to_pylist()], bool) if len(batch) else np.zeros(0, bool)
            if not hit.any():
                yield pa.RecordBatch.from_arrays(batch.columns[: len(names)], names)
                continue
            texts, keep = batch.column(text).to_pylist(), np.ones(len(batch), bool)
            for i in np.flatnonzero(hit).tolist():
                scan = scans[i].as_py()
                spans = covered(scan["hit_from"], scan["hit_to"])
                if sum(j - k for k, j in spans) > max_coverage * scan["n_words"]:
                    keep[i] = False
                    continue
                raw = texts[i].encode()
                t = next(V.texts(pa.array([texts[i]], pa.string()), 1 << 62))
                s, e = t.runs(V.ALNUM)
                parts, end = [], 0
                for k, j in spans:
                    parts.append(raw[end : int(s[k])].decode())
                    end = int(e[j - 1])
                parts.append(raw[end:].decode())
                texts[i] = " ".join(parts)
            cols = [pa.array(texts, batch.schema.field(text).type) if c == text else batch.column(c) for c in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(keep))

    out = found.mapInArrow(spread.tidied(run), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)
