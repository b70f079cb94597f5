"""Token counts by a trie over distinct pre-tokens.

A pre-token is a run without ASCII white space, with the space mark before it. Its tokens are those of the segmentation
with the greatest unigram score (of equals, the one with the fewest tokens), where a piece's score is the logarithm of
its share under Zipf's law by its rank in the vocabulary, in whole thousandths; a code point outside the vocabulary is
its UTF-8 bytes, each at BYTE_SCORE. Distinct pre-tokens go into a trie; forward scores are computed once a node, so once
a shared prefix, from the scores along its path; a pre-token's node stores the terminal count.

One pass, no shuffle. The trie of a worker is emptied at NODES nodes, which changes the time only. Cases: null texts are
empty (no pre-tokens, no tokens); null doc_ids stay; repeated rows give repeated results; an empty table gives none;
other columns are ignored; a long pre-token costs time in proportion and, over LONG code points, isn't kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import textvec as V

NODES, LONG = 600_000, 64
BYTE_SCORE = -14_000
SPACE = "▁"


def unigram_scores(model: str) -> dict[str, int]:
    """Piece scores in thousandths, by rank in the vocabulary."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = math.log(sum(1 / (r + 2.7) for r in range(len(pieces))))
    return {p: round(1000 * (-math.log(r + 2.7) - total)) for r, p in enumerate(pieces)}


class Trie:
    """Nodes by (parent, code point); each holds the forward score and the tokens of its path.

    Pieces that end at a new node come from an Aho-Corasick automaton over the vocabulary, started where the shared
    prefix can still matter.
    """

    def __init__(self, scores: dict[str, int]):
        self.longest = max(map(len, scores))
        self.auto = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best, self.count = [0], [0]

    def tokens(self, word: str) -> tuple[int, int]:
        """Tokens and score of a pre-token."""
        if len(self.best) > NODES:
            self.clear()
        child, node, bests, counts, n = self.child, 0, [0], [0], 0
        for c in word:
            to = child.get(node << 21 | ord(c))
            if to is None:
                break
            node = to
            n += 1
            bests.append(self.best[to])
            counts.append(self.count[to])
        shared = n
        if n < len(word):
            for end, (length, score) in self.auto.iter(word, max(0, n - self.longest + 1)):
                end += 1
                if end <= shared:
                    continue
                while n < end:
                    raw = len(word[n].encode())
                    bests.append(bests[n] + BYTE_SCORE * raw)
                    counts.append(counts[n] + raw)
                    n += 1
                at = end - length
                new, tokens = bests[at] + score, counts[at] + 1
                if new > bests[end] or (new == bests[end] and tokens < counts[end]):
                    bests[end], counts[end] = new, tokens
            while n < len(word):
                raw = len(word[n].encode())
                bests.append(bests[n] + BYTE_SCORE * raw)
                counts.append(counts[n] + raw)
                n += 1
            if n <= LONG:
                for k in range(shared, n):
                    to = child[node << 21 | ord(word[k])] = len(self.best)
                    self.best.append(bests[k + 1])
                    self.count.append(counts[k + 1])
                    node = to
        return counts[-1], bests[-1]


_tries: dict[str, Trie] = {}


def counts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens, score (of the segmentations, in thousandths)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _tries:
            _tries[model] = Trie(unigram_scores(model))
        trie, known = _tries[model], {}
        for batch in batches:
            for t in V.texts(batch.column(1)):
                s, e = t.runs(V.SPACE)
                _, first, back = np.unique(t.hashes(s, e), return_index=True, return_inverse=True)
                if len(known) > NODES:
                    known.clear()
                got = np.empty((len(first), 2), np.int64)
                for k, i in enumerate(first.tolist()):
                    word = t.buf[s[i] : e[i]].tobytes()
                    found = known.get(word)
                    if found is None:
                        found = trie.tokens(SPACE + word.decode())
                        if len(word) <= 4 * LONG:
                            known[word] = found
                    got[k] = found
                b = t.bounds(s)
                sums = np.vstack([np.zeros((1, 2), np.int64), np.cumsum(got[back], 0)])
                sums = sums[b[1:]] - sums[b[:-1]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, t.n), pa.array(np.diff(b)), pa.array(sums[:, 0].copy()), pa.array(sums[:, 1].copy())], ["doc_id", "n_pretokens", "n_tokens", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, score long")


def op2_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
