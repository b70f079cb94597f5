"""Substring dedup with repeated-phrase automata.

A window is `window` consecutive words of a document. A word is removed if a window that covers it also starts, word for
word, in a document with a smaller doc_id.

1. Anchors: in every window, winnowing picks the `gram`-word phrase with the least hash. Equal windows pick equal
   anchors, so a window that recurs has an anchor that recurs. Anchors of two different texts are recurring phrases.
2. Automata: documents with a recurring phrase, but for later copies of a text, are dealt to shards of about SHARD bytes by hash. Of a shard's documents
   with a phrase one gives it; these phrases are compiled into the shard's Aho-Corasick automaton over one character a
   word, and all the shard's documents stream through it, which locates every occurrence. Only its matches are used.
3. Windows whose anchor is at such an occurrence are confirmed by 128-bit hashes of all their words: within the shard at
   once, so that of equal windows the shard hands on only those of its least document, then across shards, by the least
   doc_id of each window. So a passage that a third of all documents have reaches the shuffle once a shard.
4. Removed word ranges go back to their documents, which are joined anew.

A text that a smaller doc_id has in full needs no windows: all its words go, if there are `window` of them.

Cases: null texts have no words; a null doc_id is neither smaller nor larger than another (its text stays, and removes
nothing); rows that share a doc_id don't remove from each other, whether their texts differ or not, and repeated rows give repeated
results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import spread
from framelake.llm import textvec as V

WINDOW, GRAM = 50, 10
SHARD = 1 << 20


class Words:
    """Words of a slice, their hashes, and the anchor of each window that lies in one document."""

    def __init__(self, t: V.Text, window: int, gram: int):
        self.starts, self.ends = t.runs(V.SPACE)
        self.b = t.bounds(self.starts)
        self.h = t.hashes(self.starts, self.ends)
        n = len(self.h)
        self.at = np.flatnonzero(V.inside(self.b, n, window))
        if len(self.at):
            g = V.grams(self.h, gram)
            views = np.lib.stride_tricks.sliding_window_view(g, window - gram + 1)
            self.anchor = np.empty(len(self.at), np.int64)
            for i in range(0, len(self.at), 1 << 16):
                part = self.at[i : i + (1 << 16)]
                self.anchor[i : i + len(part)] = part + views[part].argmin(1)
            self.grams = g
        else:
            self.anchor, self.grams = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def doc(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.b, words, "right") - 1

    def codes(self) -> np.ndarray:
        """A code point beyond the basic plane for each word."""
        return (np.uint64(0x10000) + (self.h >> np.uint64(44))).astype(np.uint32)


def anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows (key, doc_id, text_hash, at): each distinct anchor of a document with its first word; with at = -1, one of the text's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(c).to_numpy() for c in (0, 1))
            for t in V.texts(batch.column(2)):
                w = Words(t, window, gram)
                first = np.unique(w.grams[w.anchor] ^ V.mix(w.doc(w.anchor).astype(np.uint64)), return_index=True)[1]
                pick = w.anchor[np.sort(first)]
                d = w.doc(pick)
                long = np.flatnonzero(np.diff(w.b) >= window)
                key = np.append(V.signed(w.grams[pick]), hashes[t.first + long])
                at = np.append(pick - w.b[d], np.full(len(long), -1))
                d = t.first + np.append(d, long)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[d]), pa.array(hashes[d]), pa.array(at.astype(np.int32))], ["key", "doc_id", "text_hash", "at"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, "key long, doc_id long, text_hash long, at int")


def recurring(found: DataFrame, shards: int) -> DataFrame:
    """doc_id, text_hash, `whole` (a smaller doc_id has the text), `shard`, `at`: first words of the recurring phrases that
    this document gives to its shard's automaton. Of a shard's documents with a phrase, one gives it."""
    # written first, so that the joins have shuffles of their own on both sides, of which Spark can split the hot keys
    phrases = spread.stash(found.where("at >= 0").groupBy("key").agg(F.min("text_hash").alias("t0"), F.max("text_hash").alias("t1")).where("t0 <> t1").select("key"))
    texts = spread.stash(found.where("at < 0").groupBy("text_hash").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("text_hash", "least"))
    whole = spread.stash(found.where("at < 0").join(texts, "text_hash").where("doc_id > least").select("doc_id", "text_hash").distinct())
    # a text that goes as a whole isn't streamed, so it can't give phrases either
    rows = found.where("at >= 0").join(phrases, "key").join(whole.hint("shuffle_hash"), ["doc_id", "text_hash"], "left_anti").withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(shards)))
    given = rows.groupBy("key", "shard").agg(F.min(F.struct("doc_id", "text_hash", "at")).alias("x"), F.min("doc_id").alias("d"))
    given = given.select("x.*", "shard", F.lit(True).alias("own"))
    # every document that has a recurring phrase is streamed, whether it gives one or not
    all_ = given.union(rows.select("doc_id", "text_hash", F.lit(-1).alias("at"), "shard", F.lit(False).alias("own")).distinct())
    parts = all_.groupBy("doc_id", "text_hash", "shard").agg(F.collect_list(F.when(F.col("own"), F.col("at"))).alias("at"))
    parts = parts.join(whole.withColumn("whole", F.lit(True)), ["doc_id", "text_hash"], "full_outer")
    return parts.select("doc_id", "text_hash", F.coalesce("whole", F.lit(False)).alias("whole"), "shard", "at")


def compile_phrases(codes: list[str], at: list[list[int]], gram: int) -> ahocorasick.Automaton | None:
    auto = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for text, places in zip(codes, at, strict=True):
        for p in places:
            auto.add_word(text[p : p + gram])
    if not len(auto):
        return None
    auto.make_automaton()
    return auto


def locate(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """From (shard, doc_id, text_hash, text, at): rows (w1, w2, doc_id, text_hash, at, gone) of the windows whose anchor is a
    phrase of the shard's automaton. gone: a smaller doc_id of the same shard has the window."""

    def handle(ids: np.ndarray, hashes: np.ndarray, texts: pa.Array, places: list[list[int]]) -> pa.RecordBatch:
        t = next(V.texts(texts, 1 << 62))
        w = Words(t, window, gram)
        codes = w.codes()
        text = [codes[i:j].tobytes().decode("utf-32-le") for i, j in zip(w.b[:-1].tolist(), w.b[1:].tolist(), strict=True)]
        auto = compile_phrases(text, places, gram)
        hit = np.zeros(len(w.h) + 1, bool)
        if auto is not None:
            for d, x in enumerate(text):
                ends = np.fromiter((e for e, _ in auto.iter(x)), np.int64)
                hit[ends - (gram - 1) + w.b[d]] = True
        at = w.at[hit[w.anchor]]
        w1, w2 = V.long_grams(w.h, window)[at], V.long_grams(V.mix(w.h ^ np.uint64(0x51ED270B)), window)[at]
        d = w.doc(at)
        doc = ids[d]
        order = np.lexsort((doc, w2, w1))
        w1, w2, at, doc, d = w1[order], w2[order], at[order], doc[order], d[order]
        first = np.flatnonzero(np.append(True, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]))) if len(w1) else np.zeros(0, np.int64)
        least = np.repeat(doc[first], np.diff(np.append(first, len(w1))))
        return pa.RecordBatch.from_arrays([pa.array(V.signed(w1)), pa.array(V.signed(w2)), pa.array(doc), pa.array(hashes[d]), pa.array((at - w.b[d]).astype(np.int32)), pa.array(doc > least)], ["w1", "w2", "doc_id", "text_hash", "at", "gone"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            shard = table.column(0).to_numpy()
            cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            for i, j in zip(cut.tolist(), np.append(cut[1:], len(shard)).tolist(), strict=True):
                part = table.slice(i, j - i)
                yield handle(part.column(1).to_numpy(), part.column(2).to_numpy(), part.column(3).combine_chunks(), part.column(4).to_pylist())

        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            shard = batch.column(0).to_numpy()
            if held[0].column(0)[0].as_py() != shard[-1]:
                table = pa.Table.from_batches(held)
                n = len(table) - len(batch) + int(np.searchsorted(shard, shard[-1]))
                yield from flush(table.slice(0, n))
                held = table.slice(n).combine_chunks().to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))

    dealt = docs.select("shard", "doc_id", "text_hash", "text", "at").repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "w1 long, w2 long, doc_id long, text_hash long, at int, gone boolean")


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """doc_id, text_hash, `cut`: whether all words go, and the first words of the windows that a smaller doc_id also has.
    Each text of a doc_id once."""
    spread.small_batches(docs.sparkSession)
    known = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    shards = max(1, -(-int(known.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard))
    again = spread.stash(recurring(spread.stash(anchors(known, window, gram)), shards))
    parts = again.where("NOT whole AND shard IS NOT NULL").drop("whole")
    # a text that repeats is one text here: its least doc_id stands for it; repeated rows are one
    rows = spread.split_by(known, parts.select("doc_id"))[0].join(parts.hint("shuffle_hash"), ["doc_id", "text_hash"])
    found = spread.stash(locate(rows, window, gram))
    open_ = found.where("NOT gone")
    least = spread.stash(open_.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("w1", "w2", "least"))
    later = open_.join(least, ["w1", "w2"]).where("doc_id > least").select("doc_id", "text_hash", "at")
    at = later.union(found.where("gone").select("doc_id", "text_hash", "at")).groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("at")).select("doc_id", "text_hash", F.struct(F.lit(False).alias("whole"), "at").alias("cut"))
    whole = again.where("whole").select("doc_id", "text_hash", F.struct(F.lit(True).alias("whole"), F.array().cast("array<int>").alias("at")).alias("cut"))
    return spread.stash(at.union(whole))


def _kept(raw: bytes, whole: bool, at: list[int] | None, window: int) -> tuple[int, int, bytes]:
    words = raw.split()
    n = len(words)
    if whole and n >= window:
        return n, n, b""
    if at is None or not len(at):
        return n, 0, b" ".join(words)
    cover = np.zeros(n + 1, np.int32)
    a = np.asarray(at)
    np.add.at(cover, a, 1)
    np.add.at(cover, a + window, -1)
    gone = np.cumsum(cover[:n]) > 0
    return n, int(gone.sum()), b" ".join([x for x, g in zip(words, gone.tolist(), strict=True) if not g])


def _apply(docs: DataFrame, found: DataFrame, window: int, schema: str, make) -> DataFrame:
    """make(n, removed, kept words) for each document with its removals. Documents without one aren't shuffled."""
    rows, cut = spread.attach(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), found, "cut", by_text=True)
    names, kinds = zip(*(c.split() for c in schema.split(",")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, c in zip(batch.column(1), batch.column(2), strict=True):
                c = c.as_py() or {"whole": False, "at": None}
                out.append(make(*_kept((x.as_py() or "").encode(), c["whole"], c["at"], window)))
            cols = list(zip(*out, strict=True)) or [()] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, {"long": pa.int64(), "string": pa.string()}[k]) for c, k in zip(cols, kinds[1:], strict=True))], list(names))

    return rows.select("doc_id", "text", cut).mapInArrow(run, schema)


def op7_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return _apply(docs, removals(docs), WINDOW, "doc_id long,n_words long,n_removed long,kept_sha256 string", lambda n, gone, kept: (n, gone, hashlib.sha256(kept).hexdigest()))


def dedup(docs: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """doc_id, n_words, n_removed, text: kept words joined by one space."""
    return _apply(docs, removals(docs, window, shard=shard), window, "doc_id long,n_words long,n_removed long,text string", lambda n, gone, kept: (n, gone, kept.decode()))
