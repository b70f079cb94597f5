"""SentencePiece encoding and decoding by a prefix table over merge-type (BPE) vocabularies.

For a merge-type vocabulary, the encoding of every prefix of a string has one last piece, and it is the only piece that
matches at the prefix's end and is compatible with the last piece of what stands before it; two pieces are compatible
if their joined text encodes to the two. The table of last pieces is filled from left to right with Aho-Corasick
matches and memoised pair tests, in time linear in the text, and the ids are read off backwards.

Pieces hold the space mark only at their start (checked when the vocabulary is loaded), and the runs of space marks
merge after everything else, so a text is cut at spaces and line feeds into chunks, whose ids are cached.

Memory: the caches are emptied at `CACHE` entries; longer chunks than LONG code points aren't cached. Works on whole
texts, in one pass without a shuffle. Cases: null texts are empty ones and have only the end id; null doc_ids stay;
repeated rows give repeated results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import spread

CACHE, LONG = 250_000, 64
SPACE = "▁"
_CHUNK = re.compile(r" +[^ \n]*|\n|[^ \n]+")
#: The same, and cut between letters and others.
_CUT = re.compile(r" *[^\W\d_]+| *(?:(?![^\W\d_])[^ \n])+|\n| +")


class _Filled(dict):
    """A dict that makes missing values; emptied when full. Long keys aren't kept."""

    def __init__(self, make, most: int = CACHE):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= 8 * LONG:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class PieceCodec:
    """Encoder and decoder for a merge-type SentencePiece model with byte fallback and no text normalisation."""

    def __init__(self, model: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.eos = sp.eos_id()
        skip = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.hidden = {i for i in skip if not sp.is_unknown(i)}
        self.id_of = {p: i for i, p in enumerate(self.pieces) if i not in skip and i not in self.byte_of}
        self.score = {p: sp.get_score(i) for p, i in self.id_of.items()}
        runs = [p for p in self.id_of if len(p) > 1 and not p.strip(SPACE)]
        words = [p for p in self.id_of if len(p) > 1 and p.strip(SPACE)]
        if len(self.byte_ids) != 256 or any(SPACE in p[1:] or "\n" in p for p in words) or "\n" in self.id_of:
            raise ValueError("not a model this codec can cut into chunks")
        if runs and max(self.score[p] for p in runs) >= min(self.score[p] for p in words):
            raise ValueError("runs of spaces must merge last")
        # of each word piece: its rank, the two pieces that merge into it last, and whether it is built in order of rank
        self.rank = {p: k for k, p in enumerate(sorted((p for p in self.id_of if len(p) > 1 and p.strip(SPACE)), key=lambda p: -self.score[p]))}
        if len({self.score[p] for p in words}) != len(words):
            raise ValueError("word pieces must differ in score")
        self.halves, self.ordered, self.born = {}, {p for p in self.id_of if len(p) == 1}, {}
        for p in sorted(words, key=len):
            made: list[tuple[str, str]] = []
            if self.merged(p, made) == [p]:
                self.halves[p] = a, b = made[-1]
                if a in self.ordered and b in self.ordered and max(self.rank.get(a, -1), self.rank.get(b, -1)) < self.rank[p]:
                    self.ordered.add(p)
                    self.born[p] = self.rank[p]
        # code points outside the vocabulary get ids from `size` on, as they come
        self.text_of, self.plain = list(self.pieces), [p.replace(SPACE, " ") for p in self.pieces]
        self.other: dict[str, int] = {}
        self.auto = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if (len(p) == 1 or p.strip(SPACE)) and self.merged(p) == [p]:
                self.auto.add_word(p, (len(p), i))
        self.auto.make_automaton()
        # where no piece holds the two code points of a border, nothing merges across: text is cut there
        mixed = {(x, y) for p in words for x, y in zip(p, p[1:]) if x != SPACE and x.isalpha() != y.isalpha()}
        self.cut = not mixed
        self.words_from = 1 + max(self.hidden | set(self.byte_of))
        self.fits: dict[int, bool] = {}
        self.runs: dict[int, list[int]] = {}
        self.ids_text = _Filled(lambda w: " ".join(map(str, self.chunk(w))))
        self.texts = _Filled(lambda s: self.decode_part(list(map(int, s.split()))))
        self.chunks = _CUT if self.cut else _CHUNK

    def merged(self, text: str, made_from: list[tuple[str, str]] | None = None) -> list[str]:
        """Pieces by merging the best-scored neighbours, the leftmost first: the definition, for the tables and runs of spaces."""
        left, right, part = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1)), list(text)
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(text) and (s := self.score.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (-s, i, j, part[i] + part[j]))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, made = heapq.heappop(heap)
            if not part[i] or not part[j] or right[i] != j or part[i] + part[j] != made:
                continue
            if made_from is not None:
                made_from.append((part[i], part[j]))
            part[i], part[j] = made, ""
            right[i] = right[j]
            if right[i] < len(text):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in part if p]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the joined text of two pieces encodes to the two."""
        if len(self.fits) > 4 * CACHE:
            self.fits.clear()
        x, y = self.text_of[a], self.text_of[b]
        got = self.fits[a << 32 | b] = self._meet(x, y) if x in self.ordered and y in self.ordered else self.merged(x + y) == [x, y]
        return got

    def _meet(self, a: str, b: str) -> bool:
        """Whether a and b, both built in order of rank, stay apart side by side.

        Goes back in time from the finished pieces. Of the two symbols at the border the younger is undone, which gives
        the border before; had its two symbols a merge that ranks before the one just undone, they would have merged.
        """
        rank, born = self.rank, self.born
        end_a = end_b = 1 << 40
        while True:
            r = rank.get(a + b)
            # at equal rank the leftmost goes first: a merge inside the left piece, but not one inside the right piece
            if r is not None and r < end_a and r <= end_b:
                return False
            age_a, age_b = born.get(a, -1), born.get(b, -1)
            if age_a < 0 and age_b < 0:
                return True
            if age_a > age_b:
                end_a, a = age_a, self.halves[a][1]
            else:
                end_b, b = age_b, self.halves[b][0]

    def table(self, text: str) -> list[int]:
        """The id of the last piece of each prefix but the empty one. A code point outside the vocabulary is a piece of its own."""
        last = [-1] * len(text)
        fits, done = self.fits, 0
        for end, (n, piece) in self.auto.iter(text):
            if last[end] < 0:
                start = end - n
                if start < 0:
                    last[end] = piece
                    continue
                before = last[start]
                if before < 0:
                    self._fill(text, last, start)
                    before = last[start]
                ok = fits.get(before << 32 | piece)
                if ok is None:
                    ok = self.compatible(before, piece)
                if ok:
                    last[end] = piece
        if -1 in last:
            for i in range(len(text)):
                if last[i] < 0:
                    self._fill(text, last, i)
        return last

    def _fill(self, text: str, last: list[int], end: int) -> None:
        while end >= 0 and last[end] < 0:
            c = text[end]
            i = self.other.get(c)
            if i is None:
                i = self.other[c] = len(self.text_of)
                self.text_of.append(c)
            last[end] = i
            end -= 1

    def split(self, text: str) -> list[int]:
        """Ids of a text without line feeds and with at most one space mark, at its start; ids of self.other stay."""
        last, out, at, text_of = self.table(text), [], len(text), self.text_of
        while at:
            piece = last[at - 1]
            out.append(piece)
            at -= len(text_of[piece])
        out.reverse()
        return out

    def final(self, ids: list[int]) -> list[int]:
        """Byte ids in place of those of self.other."""
        size = len(self.pieces)
        if max(ids, default=0) < size:
            return ids
        return [j for i in ids for j in ((i,) if i < size else (self.byte_ids[b] for b in self.text_of[i].encode()))]

    def space_run(self, n: int) -> list[int]:
        got = self.runs.get(n)
        if got is None:
            got = [self.id_of[p] for p in self.merged(SPACE * n)]
            if n <= LONG:
                self.runs[n] = got
        return got

    def chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk: a run of spaces and the word after it, or a line feed."""
        if chunk == "\n":
            return [self.byte_ids[10]]
        word = chunk.lstrip(" ")
        n = len(chunk) - len(word)
        if not word:
            return self.space_run(n)
        ids = self.split(SPACE + word if n else word)
        if n and ids[0] == self.id_of[SPACE]:
            return self.space_run(n) + self.final(ids[1:])
        return (self.space_run(n - 1) if n > 1 else []) + self.final(ids)

    def _parts(self, text: str) -> list[str]:
        if not text:
            return []
        return list(map(self.ids_text.__getitem__, self.chunks.findall(" " + text.replace(SPACE, " "))))

    def encode(self, text: str) -> list[int]:
        return [*(int(i) for p in self._parts(text) for i in p.split()), self.eos]

    def decode_part(self, ids: list[int]) -> str:
        if min(ids, default=0) >= self.words_from:
            return "".join([self.plain[i] for i in ids])
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.hidden:
                out.append(self.pieces[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        text = self.decode_part(ids)
        return text[1:] if text[:1] == " " else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, hash of the ids, hash of the decoded text, without a list of all ids."""
        parts = self._parts(text)
        ids = " ".join([*parts, str(self.eos)])
        decoded = "".join(map(self.texts.__getitem__, parts))
        if decoded[:1] == " ":
            decoded = decoded[1:]
        return ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


_loaded: dict[str, PieceCodec] = {}


def codec(model: str) -> PieceCodec:
    """One for each worker process and model file."""
    if model not in _loaded:
        _loaded.clear()
        _loaded[model] = PieceCodec(model)
    return _loaded[model]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _groups(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with about so many bytes of text."""
    offset, n = 0, len(batch)
    step = max(1, int(n * most / max(1, batch.column(column).nbytes)))
    while offset < n:
        part = batch.slice(offset, step)
        yield part, ["" if x is None else x for x in part.column(column).to_pylist()]
        offset += step


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    spread.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for part, texts in _groups(batch, 1):
                n, ids, decoded = zip(*map(c.digest, texts), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(spread.tidied(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and `ids array<int>`, the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for part, texts in _groups(batch, 1, 1 << 20):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(c.encode, texts), pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: str) -> DataFrame:
    """doc_id and `text` from doc_id and ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def op9_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model())


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(docs, default_model())
