"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The field is trained by gradient ascent on the log-likelihood of a small labelled table (`labelled`, written by rule
from a seed; held-out accuracy is tested), on the driver, once a query. Its weights are a few thousand numbers. Texts
are decoded by Viterbi in numpy batches, in one pass without a shuffle.

A token is a run without ASCII white space. Structured tokens hold a digit or @; a sequence is a run of structured
tokens with up to CONTEXT words around each. Tokens further away have features that are only seen with O, so they are O.
Spans of the field have kinds `crf_email crf_ip crf_card crf_phone crf_id` and run from the first to the last character
of their tokens without the punctuation around them.

Cases: null texts are empty; null doc_ids stay; repeated rows give repeated results; an empty table gives none; other
columns are ignored; time grows in proportion to the length of a text.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import textvec as V

KINDS = ("email", "ip", "card", "phone")
FIELD = ("email", "ip", "card", "phone", "id")
LABELS = ("O", *(f"{p}-{k}" for k in FIELD for p in "BI"))
CONTEXT = 2

_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Possessive, and only from the first digit of a run: the same matches as without, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    d = [int(c) for c in digits]
    return (sum(d[-1::-2]) + sum(x * 2 - 9 * (x > 4) for x in d[-2::-2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches without overlap: the run before each @, cut at the last match, and the longest domain after it."""
    out, pos, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            pos = m.end()
        else:
            pos = at + 1
        at = text.find("@", pos)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order."""
    out = [(s, 0, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# --- the field ---------------------------------------------------------------------------------------------------


def shape(word: str) -> str:
    return re.sub(r"[^\x00-\x7F]", "a", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "9", word))))


def features(word: str) -> list[str]:
    """Shape features of a token; those of neighbours are added by `sequence`."""
    core = word.strip("\"'.,;:!?<>[]{}|")
    s = shape(core)
    short = re.sub(r"(.)\1+", r"\1+", s)
    digits = sum(c == "9" for c in s)
    if not digits and "@" not in s:
        return ["plain", "cue=" + core.lower()[:8] if core.lower() in CUES else "plain"]
    return ["short=" + short[:12], "long=" + s[:16] if len(s) <= 16 else "long", f"digits={min(digits, 20)}", f"len={min(len(s), 24) // 2}", "first=" + s[:1], "at" if "@" in s else "no-at", f"dots={min(3, s.count('.'))}", f"dashes={min(3, s.count('-'))}"]


CUES = frozenset("call phone tel mobile fax card visa ip host address ssn id passport account mail email contact number version year section price".split())


def sequence(words: list[str]) -> list[list[str]]:
    own = [features(w) for w in words]
    out = []
    for i, f in enumerate(own):
        row = ["bias", *f]
        for d in (-1, 1):
            j = i + d
            row += [f"{d}:{x}" for x in (own[j][:2] if 0 <= j < len(own) else ["edge"])]
        out.append(row)
    return out


def labelled(n: int = 700, seed: int = 11) -> list[list[tuple[str, str]]]:
    """The labelled table: sentences of (token, label)."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    syl = "the of and re in er on an ti ha es ou ed ing ble ly den ver ung que aux cion mente".split()

    def filler() -> str:
        w = "".join(r.choice(syl) for _ in range(r.randint(1, 3)))
        return (w.capitalize() if r.random() < 0.2 else w) + r.choice(["", "", "", "", ",", "."])

    def card() -> str:
        body = d(15)
        return body + next(c for c in "0123456789" if luhn(body + c))

    def entity() -> list[tuple[str, str]]:
        kind = r.choice(FIELD)
        if kind == "email":
            words = [r.choice(["", *syl]) + d(2) * r.randint(0, 1) + r.choice("abc") + r.choice([".", "_", ""]) + r.choice(syl) + "@" + r.choice(syl) + d(1) * r.randint(0, 1) + r.choice([".example.com", ".org", ".co.uk"])]
        elif kind == "ip":
            words = [".".join(str(r.randint(0, 255)) for _ in range(4))]
        elif kind == "card":
            c = card()
            words = r.choice([[c], [c[:4], c[4:8], c[8:12], c[12:]], ["-".join([c[:4], c[4:8], c[8:12], c[12:]])]])
        elif kind == "phone":
            words = r.choice([[f"+{r.randint(1, 99)}", f"({d(3)})", f"{d(3)}-{d(4)}"], [f"({d(3)})", f"{d(3)}-{d(4)}"], [f"{d(3)}-{d(3)}-{d(4)}"], [f"+{r.randint(1, 99)}", d(3), d(7)], [f"{d(3)}.{d(3)}.{d(4)}"], [f"+{d(11)}"]])
        else:
            words = [f"{d(3)}-{d(2)}-{d(4)}"]
        tail = r.choice(["", "", "", ".", ","])
        words[-1] += tail
        return [(w, ("I-" if i else "B-") + kind) for i, w in enumerate(words)]

    def other() -> list[tuple[str, str]]:
        w = r.choice([
            lambda: str(r.randint(1900, 2030)), lambda: f"{r.randint(1, 9)}.{r.randint(0, 9)}", lambda: str(r.randint(0, 999)), lambda: f"{r.randint(0, 23)}:{d(2)}", lambda: f"{r.randint(1, 99)},{d(2)}",
            lambda: f"20{d(2)}-{d(2)}-{d(2)}", lambda: "".join(r.choice("0123456789abcdef") for _ in range(40)), lambda: f"v{d(1)}.{d(1)}.{d(1)}", lambda: f"{d(1)}.{d(1)}.{d(1)}", lambda: d(6), lambda: f"{d(2)}%", lambda: f"#{d(4)}", lambda: r.choice("@abc") + "@", lambda: f"{r.choice(syl)}{d(2)}",
            lambda: f'"{"".join(r.choice("0123456789abcdef") for _ in range(40))}"', lambda: f"{d(2)}/{d(2)}/{d(4)}", lambda: f"${d(3)}.{d(2)}", lambda: f"GPL-{d(1)}.{d(1)}",
        ])()
        return [(w + r.choice(["", "", "", ".", ","]), "O")]

    out = []
    for _ in range(n):
        s: list[tuple[str, str]] = []
        for _ in range(r.randint(1, 3)):
            s += [(filler(), "O") for _ in range(r.randint(1, 3))]
            if r.random() < 0.2:
                s.append((r.choice(sorted(CUES)), "O"))
            s += entity() if r.random() < 0.55 else other()
        out.append(s + [(filler(), "O") for _ in range(r.randint(0, 3))])
    return out


class Field:
    """Weights: a row a feature and a column a label; transitions between labels."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, trans: np.ndarray):
        self.names, self.emit, self.trans = names, emit, trans

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        width = max(map(len, rows))
        ids = np.full((len(rows), width), len(self.names))
        for i, row in enumerate(rows):
            got = [self.names[f] for f in row if f in self.names]
            ids[i, : len(got)] = got
        return self.emit[ids].sum(1)

    def decode(self, sequences: list[list[str]], most: int = 1 << 14) -> list[np.ndarray]:
        """Best labels of each sequence of words, by Viterbi over batches of like length."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        batch: list[int] = []
        for k, i in enumerate(order):
            batch.append(i)
            if k + 1 == len(order) or len(sequences[order[k + 1]]) * (len(batch) + 1) > most:
                for j, labels in zip(batch, self._viterbi([sequences[j] for j in batch]), strict=True):
                    out[j] = labels
                batch = []
        return out

    def _viterbi(self, sequences: list[list[str]]) -> list[np.ndarray]:
        n, lens = len(sequences), np.array([len(s) for s in sequences])
        steps = int(lens.max())
        e = np.zeros((steps, n, len(LABELS)))
        flat = self.scores([row for s in sequences for row in sequence(s)])
        at = np.concatenate([np.arange(x) for x in lens])
        e[at, np.repeat(np.arange(n), lens)] = flat
        best, back = e[0], np.zeros((steps, n, len(LABELS)), np.int8)
        for t in range(1, steps):
            sums = best[:, :, None] + self.trans[None]
            back[t] = sums.argmax(1)
            best = np.where((t < lens)[:, None], sums.max(1) + e[t], best)
        label = best.argmax(1)
        paths = np.zeros((steps, n), np.int8)
        for t in range(steps - 1, -1, -1):
            paths[t] = label
            label = np.where(t < lens, back[t][np.arange(n), label], label) if t else label
        return [paths[: lens[i], i] for i in range(n)]


def train(table: list[list[tuple[str, str]]], epochs: int = 60, rate: float = 0.1, decay: float = 1e-4) -> Field:
    """Adam on the mean log-likelihood, all sentences at once; forward and backward sums in numpy."""
    rows = [sequence([w for w, _ in s]) for s in table]
    names = {f: i for i, f in enumerate(sorted({f for s in rows for row in s for f in row}))}
    n, k, m = len(table), len(LABELS), len(names)
    lens = np.array([len(s) for s in table])
    steps, width = int(lens.max()), max(len(row) for s in rows for row in s)
    ids, gold = np.full((n, steps, width), m), np.zeros((n, steps), int)
    for i, s in enumerate(rows):
        for t, row in enumerate(s):
            ids[i, t, : len(row)] = [names[f] for f in row]
            gold[i, t] = LABELS.index(table[i][t][1])
    real = np.arange(steps)[None] < lens[:, None]
    pairs = real[:, 1:]
    emit, trans = np.zeros((m + 1, k)), np.zeros((k, k))
    forbidden = np.array([[b.startswith("I-") and a[2:] != b[2:] for b in LABELS] for a in LABELS])
    trans[forbidden] = -1e4
    state = [np.zeros_like(x) for x in (emit, emit, trans, trans)]
    lse = lambda x, axis: (top := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - top).sum(axis))
    for epoch in range(1, epochs + 1):
        e = emit[ids].sum(2)
        a, b = np.zeros((n, steps, k)), np.zeros((n, steps, k))
        a[:, 0] = e[:, 0]
        for t in range(1, steps):
            a[:, t] = np.where(real[:, t, None], lse(a[:, t - 1, :, None] + trans[None], 1) + e[:, t], a[:, t - 1])
        for t in range(steps - 2, -1, -1):
            b[:, t] = np.where(real[:, t + 1, None], lse(trans[None] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2), 0)
        z = lse(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None]) * real[:, :, None]
        gap = np.eye(k)[gold] * real[:, :, None] - p
        ge = np.zeros_like(emit)
        np.add.at(ge, ids.reshape(-1), np.repeat(gap.reshape(-1, k), width, 0))
        pp = np.exp(a[:, :-1, :, None] + trans[None, None] + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * pairs[:, :, None, None]
        gt = -pp.sum((0, 1))
        np.add.at(gt, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
        for x, g, j in ((emit, ge / n - decay * emit, 0), (trans, gt / n - decay * np.where(forbidden, 0, trans), 2)):
            state[j] = 0.9 * state[j] + 0.1 * g
            state[j + 1] = 0.99 * state[j + 1] + 0.01 * g * g
            x += rate * (state[j] / (1 - 0.9**epoch)) / (np.sqrt(state[j + 1] / (1 - 0.99**epoch)) + 1e-8)
        emit[m], trans[forbidden] = 0, -1e4
    return Field(names, emit, trans)


# --- over texts --------------------------------------------------------------------------------------------------

_STRUCT = np.zeros(256, bool)
_STRUCT[0x30:0x3A] = _STRUCT[0x40] = True
_EDGE = "\"'.,;:!?<>[]{}|"


def field_spans(t: V.Text, field: Field) -> dict[int, list[tuple[int, int, int]]]:
    """By document of a slice, (start, kind, end) of the field's spans; kinds follow the base ones."""
    starts, ends = t.runs(V.SPACE)
    at = np.flatnonzero(_STRUCT[t.buf])
    if not len(at):
        return {}
    seeds = np.unique(np.searchsorted(starts, at, "right") - 1)
    b = t.bounds(starts)
    doc = np.searchsorted(b, seeds, "right") - 1
    low, high = np.maximum(seeds - CONTEXT, b[doc]), np.minimum(seeds + CONTEXT + 1, b[doc + 1])
    first = np.flatnonzero(np.concatenate(([True], (low[1:] > high[:-1]) | (doc[1:] != doc[:-1]))))
    ranges = list(zip(low[first].tolist(), high[np.append(first[1:], len(seeds)) - 1].tolist(), doc[first].tolist(), strict=True))
    words = [[t.buf[s:e].tobytes().decode() for s, e in zip(starts[i:j].tolist(), ends[i:j].tolist(), strict=True)] for i, j, _ in ranges]
    points = np.concatenate(([0], np.cumsum((t.buf & 0xC0) != 0x80)))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (i, _, d), seq, labels in zip(ranges, words, field.decode(words), strict=True):
        spans: list[list[int]] = []
        for j, y in enumerate(labels.tolist()):
            if y and y % 2:
                spans.append([j, y // 2, j])
            elif y and spans:
                spans[-1][2] = j
        zero = int(points[t.offs[d]])
        for j, kind, last in spans:
            a, z = seq[j], seq[last]
            s = int(points[starts[i + j]]) - zero + len(a) - len(a.lstrip(_EDGE))
            e = int(points[ends[i + last]]) - zero - (len(z) - len(z.rstrip(_EDGE)))
            if e > s:
                out.setdefault(d, []).append((s, len(KINDS) + kind, e))
    return out


NAMES = (*KINDS, *(f"crf_{k}" for k in FIELD))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{NAMES[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts and hash of the base spans, and all spans."""
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    none = hashlib.sha256(b"").hexdigest()
    hot = np.zeros(256, bool)
    hot[0x30:0x3A] = hot[0x40] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in V.texts(batch.column(1)):
                counts, hashes, spans = np.zeros((4, t.n), np.int64), [none] * t.n, [""] * t.n
                more = field_spans(t, field)
                for i in np.unique(t.doc_of(np.flatnonzero(hot[t.buf]))).tolist():
                    base = base_spans(t.bytes(i).decode())
                    for _, k, _ in base:
                        counts[k, i] += 1
                    hashes[i] = hashlib.sha256(_joined(base).encode()).hexdigest()
                    spans[i] = _joined(sorted(base + more.get(i, [])))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, t.n), *map(pa.array, counts), pa.array(hashes), pa.array(spans)], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op3_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), train(labelled()))
