"""Transcript parsing by a hidden Markov model over lines, and canonical turn rendering.

A transcript is a sequence of lines with or without speaker markers. Hidden states are a role with `begin` or `inside`;
a line's observation is its marker, whether a blank line stands before it, its length and its end. Transitions and
emissions are counted, with add-one smoothing, from a bounded sample of labelled conversations (MAX_LABELLED lines);
roles are recovered by Viterbi. Blank lines are separators and belong to no turn.

Lines stream by transcript, sorted, and are decided as soon as all surviving paths agree on them, so what is held of a
transcript doesn't grow with it beyond the lines still open. Turns are rendered `<|role|>`, the text without its marker,
`<|end|>`.

Cases: null texts are empty lines; null keys form one transcript of their own; ties of the order column keep the input's
order by text; repeated rows are repeated lines; an empty table gives no turn; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
STATES = tuple((r, p) for r in ROLES for p in ("begin", "inside"))
MAX_LABELLED = 20_000

MARKERS = {
    "system": ("system", "sys", "context"),
    "user": ("user", "human", "q", "question", "instruction", "prompter"),
    "assistant": ("assistant", "ai", "a", "answer", "bot", "response", "model"),
}
_ROLE = {m: r for r, ms in MARKERS.items() for m in ms}
_MARK = re.compile(r"^\s*(?:#{1,4}\s*|\[|<\|?|\*\*)?(" + "|".join(sorted(_ROLE, key=len, reverse=True)) + r")(?:\]|\|?>|\*\*)?\s*(?::|>|-)\s*", re.I)


def marker(line: str) -> tuple[str, str]:
    """The role a line's marker names, or none; and the line without it."""
    m = _MARK.match(line)
    return (_ROLE[m[1].lower()], line[m.end() :]) if m else ("none", line)


def observe(line: str, blank: bool) -> tuple[int, int, int]:
    """Marker, blank line before and end of line, length: three small numbers."""
    role, rest = marker(line)
    end = rest.rstrip()[-1:]
    return ("none", *ROLES).index(role), 2 * (end == "?") + blank, min(5, int(math.log2(1 + len(rest) / 16)))


SIZES = (4, 4, 6)


class Model:
    def __init__(self, start: np.ndarray, trans: np.ndarray, emit: list[np.ndarray]):
        self.start, self.trans, self.emit = start, trans, emit

    def score(self, o: tuple[int, int, int]) -> np.ndarray:
        return sum(e[:, x] for e, x in zip(self.emit, o, strict=True))


def fit(sequences: list[list[tuple[int, tuple[int, int, int]]]]) -> Model:
    """From labelled sequences of (state, observation)."""
    k = len(STATES)
    start, trans, emit = np.ones(k), np.ones((k, k)), [np.ones((k, n)) for n in SIZES]
    for a, (_, p) in enumerate(STATES):
        start[a] = 0 if p == "inside" else 1
        for b, (r, q) in enumerate(STATES):
            trans[a, b] = 0 if q == "inside" and r != STATES[a][0] else 1
    for seq in sequences:
        for i, (s, o) in enumerate(seq):
            if i:
                trans[seq[i - 1][0], s] += 1
            else:
                start[s] += 1
            for e, x in zip(emit, o, strict=True):
                e[s, x] += 1
    with np.errstate(divide="ignore"):
        return Model(np.log(start / start.sum()), np.log(trans / trans.sum(1, keepdims=True)), [np.log(e / e.sum(1, keepdims=True)) for e in emit])


class Decoder:
    """Viterbi over a stream of observations; `push` and `close` return the states that are decided."""

    def __init__(self, model: Model, every: int = 512):
        self.model, self.every, self.best, self.back = model, every, None, []

    def push(self, o: tuple[int, int, int]) -> list[int]:
        e = self.model.score(o)
        if self.best is None:
            self.best = self.model.start + e
            self.back = [np.zeros(len(e), np.int8)]
            return []
        sums = self.best[:, None] + self.model.trans
        self.back.append(sums.argmax(0).astype(np.int8))
        self.best = sums.max(0) + e
        self.best -= self.best.max()
        return self._agreed() if len(self.back) % self.every == 0 else []

    def _agreed(self) -> list[int]:
        alive = np.flatnonzero(np.isfinite(self.best))
        for t in range(len(self.back) - 1, 0, -1):
            alive = np.unique(self.back[t][alive])
            if len(alive) == 1:
                done = self._path(int(alive[0]), t)
                self.back = self.back[t:]
                return done
        return []

    def _path(self, state: int, n: int) -> list[int]:
        """The n states that end in `state` at place n - 1."""
        out = [state]
        for t in range(n - 1, 0, -1):
            state = int(self.back[t][state])
            out.append(state)
        return out[::-1]

    def close(self) -> list[int]:
        out = self._path(int(self.best.argmax()), len(self.back)) if self.back and self.best is not None else []
        self.best, self.back = None, []
        return out


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>"


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """Turns (conv_id, turn, role, text, rendered) of lines (conv_id, ord1, ord2, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        conv, blank, open_, turn, role, text = object(), False, [], 0, "", []
        rows: list[tuple] = []

        def end_turn() -> None:
            nonlocal turn, text
            if text:
                body = "\n".join(text)
                rows.append((conv, turn, role, body, render(role, body)))
                turn += 1
            text = []

        def take(states: list[int]) -> None:
            nonlocal role, open_
            for s, line in zip(states, open_, strict=False):
                r, place = STATES[s]
                if place == "begin" or r != role:
                    end_turn()
                role = r
                text.append(marker(line)[1] if place == "begin" else line)
            open_ = open_[len(states) :]

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * 5
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], ["conv_id", "turn", "role", "text", "rendered"])

        for batch in batches:
            for c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if c != conv:
                    take(decoder.close())
                    end_turn()
                    conv, blank, turn, role = c, False, 0, ""
                if not (line or "").strip():
                    blank = True
                    continue
                open_.append(line)
                take(decoder.push(observe(line, blank)))
                blank = False
            yield out()
        take(decoder.close())
        end_turn()
        yield out()

    rows = lines.repartition("conv_id").sortWithinPartitions("conv_id", "ord1", "ord2", "line").select("conv_id", "line")
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, rendered string")


def raw_lines(conversations: DataFrame) -> DataFrame:
    """Lines (conv_id, ord1, ord2, line, role, first) of a turn table as a raw transcript: markers in one of four styles a
    conversation (the first for a null key), left out in every fourth turn; a blank line between turns in most."""
    style = F.coalesce(F.pmod(F.col("conv_id"), F.lit(4)), F.lit(0))
    name = {r: F.element_at(F.array(*(F.lit(n) for n in ns)), (style + 1).cast("int")) for r, ns in {"system": ("System: ", "### System: ", "[SYS] - ", "context: "), "user": ("User: ", "### Instruction: ", "[Q] - ", "Human: "), "assistant": ("Assistant: ", "### Response: ", "[A] - ", "AI: ")}.items()}
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0
    mark = F.when(bare, "").when(F.col("role") == "system", name["system"]).when(F.col("role") == "user", name["user"]).when(F.col("role") == "assistant", name["assistant"]).otherwise("")
    gap = F.when(F.pmod(F.xxhash64("turn", "conv_id"), F.lit(8)) == 0, F.lit("")).otherwise(F.lit("\n"))
    text = F.concat(gap, mark, F.coalesce("text", F.lit("")))
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").alias("ord1"), "role", F.posexplode(F.split(text, "\n")).alias("ord2", "line"))


def train(lines: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """From the labelled lines of the transcripts with the least hashes, at most max_labelled lines (the last transcript may be cut)."""
    sample = lines.where("conv_id IS NOT NULL").orderBy(F.xxhash64("conv_id"), "conv_id", "ord1", "ord2", "line").limit(max_labelled).collect()
    sequences, last, blank, before = [], None, False, None
    for r in sample:
        if r.conv_id != last:
            sequences.append([])
            last, blank, before = r.conv_id, False, None
        if not r.line.strip():
            blank = True
            continue
        if r.role in ROLES:
            state = STATES.index((r.role, "inside" if before == (r.role, r.ord1) else "begin"))
            sequences[-1].append((state, observe(r.line, blank)))
            before = (r.role, r.ord1)
        blank = False
    return fit([s for s in sequences if s])


def op6_transcript_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_lines(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return parse(lines.select("conv_id", "ord1", "ord2", "line"), train(lines))
