"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger keeps the measurements and one bit for each failed rule
(`fail_bits`); policies are versioned masks over these bits, so a change of policy, or the ablation of a rule, is bitwise
arithmetic on the ledger and never reads a text again.

Cases: a null text is an empty one (no words; fails `few_words`); a null doc_id is kept as null; repeated rows give
repeated rows; an empty table gives an empty ledger; other columns of the input are ignored and can't clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from framelake.llm import spread
from framelake.llm import textvec as V

#: Symbols that the base measurement counts (fixed by the contract).
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bangs", "n_stutter", "n_toxic")

#: name -> SQL condition under which a document fails. The position is the bit. Never reorder: append.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbol_density", "100 * n_symbols > 20 * n_words"),
    ("bang_density", "100 * n_bangs > 40 * n_words"),
    ("upper_case", "n_letters > 0 AND 100 * n_upper > 50 * n_letters"),
    ("repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars > 40 * n_words"),
    ("stutter", "100 * n_stutter > 30 * n_words"),
    ("toxic_words", "n_toxic >= 2 AND 200 * n_toxic >= n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]


@dataclass(frozen=True)
class Policy:
    """A version's name and the rules it enforces."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE_POLICY = Policy("base-1", ("few_words", "repeated_windows"))
PRODUCTION = Policy("full-1", tuple(BIT))
POLICIES = (BASE_POLICY, Policy("full-0", tuple(r for r in BIT if r != "toxic_words")), PRODUCTION)

_SYM = np.zeros(256, bool)
_SYM[list(SYMBOLS)] = True


def _per_doc(counts: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of counts (a value a byte or word) over each document's range."""
    sums = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts.view(np.uint8) if counts.dtype == bool else counts, out=sums[1:])
    return sums[offs[1:]] - sums[offs[:-1]]


def _rare(mask: np.ndarray, t: V.Text) -> np.ndarray:
    """As _per_doc for a mask of few bytes."""
    return np.bincount(t.doc_of(np.flatnonzero(mask)), minlength=t.n)


def _doc_keys(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return V.mix(h ^ V.mix(doc.astype(np.uint64) + np.uint64(0xA5A5)))


def measure(t: V.Text, lexicon: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of a slice of texts. lexicon: sorted hashes of toxic terms."""
    buf, offs = t.buf, t.offs
    starts, ends = t.runs(V.SPACE)
    b = t.bounds(starts)
    chars = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    upper, letter = (buf >= 0x41) & (buf <= 0x5A), ((buf | 0x20) >= 0x61) & ((buf | 0x20) <= 0x7A)
    out = {
        "n_words": np.diff(b),
        "word_chars": _per_doc(chars[ends] - chars[starts], b),
        "n_symbols": _rare(_SYM[buf], t),
        "n_upper": _rare(upper, t),
        "n_letters": _per_doc(letter, offs),
        "n_bangs": _rare(buf == 0x21, t),
    }
    # lines with a word; those equal to an earlier one
    ls, le = t.runs(V.LINE)
    words = np.searchsorted(starts, le) - np.searchsorted(starts, ls)
    ls, le = ls[words > 0], le[words > 0]
    doc = t.doc_of(ls)
    _, first = np.unique(_doc_keys(t.hashes(ls, le), doc), return_index=True)
    out["n_lines"] = np.bincount(doc, minlength=t.n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(doc[first], minlength=t.n)
    # words in windows of 8 that are found twice or more in the text
    h = t.hashes(starts, ends)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[b[:-1][b[:-1] < len(h)]] = False
    out["n_stutter"] = _per_doc(again, b)
    g = V.grams(h, 8)
    at = np.flatnonzero(V.inside(b, len(starts), 8))
    _, back, n = np.unique(_doc_keys(g[at], np.repeat(np.arange(t.n), np.diff(b))[at]), return_inverse=True, return_counts=True)
    at = at[n[back] > 1]
    cover = np.zeros(len(starts) + 9, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + 8, -1)
    out["n_repeat_words"] = _per_doc(np.cumsum(cover)[: len(starts)] > 0, b)
    if len(lexicon):
        ws, we = t.runs(V.ALNUM)
        h = t.hashes(ws, we, V.LOWER)
        hit = lexicon[np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)] == h
        out["n_toxic"] = np.bincount(t.doc_of(ws[hit]), minlength=t.n)
    else:
        out["n_toxic"] = np.zeros(t.n, np.int64)
    return out


def term_hashes(terms: list[str]) -> np.ndarray:
    if not terms:
        return np.zeros(0, np.uint64)
    t = next(V.texts(pa.array(terms, pa.string()), most=1 << 30))
    return np.unique(t.hashes(t.offs[:-1], t.offs[1:], V.LOWER))


def toxic_terms(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_terms: int = 512) -> list[str]:
    """Terms that mark toxic documents, from at most max_labelled labelled rows (those with the least hash of doc_id).

    Near copies count once: texts of a language count as one family if the least hash of their word pairs is the same.
    A term is taken if it is in 3 or more families of toxic texts and in 0.5 % of them, and its share there is at least
    20 times its share of the other texts, smoothed. No labels, or no toxic ones: no terms.
    """
    sample = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang")).join(F.broadcast(sample), "doc_id")
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), 1)
    rows = rows.where("text IS NOT NULL").select("lang", (F.col("toxic") == 1).alias("toxic"), words.alias("words"))
    family = F.expr("array_min(transform(sequence(1, greatest(size(words) - 1, 1)), i -> xxhash64(get(words, i - 1), get(words, i))))")
    rows = rows.select("lang", "toxic", family.alias("family"), F.array_distinct("words").alias("words"))
    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.countDistinct("lang", "family").alias("n")).collect()}
    n_bad, n_good = totals.get(True, 0), totals.get(False, 0)
    found = rows.select("lang", "toxic", "family", F.explode("words").alias("term")).distinct()
    found = found.groupBy("term").agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good"))
    found = found.where(f"bad >= 3 AND bad >= 0.005D * {n_bad} AND bad * {n_good + 1}D >= 20 * (good + 0.5D) * {n_bad}")
    return [r.term for r in found.orderBy(F.desc("bad"), "term").limit(max_terms).collect()]


def ledger(docs: DataFrame, terms: list[str] = (), keep: bool = False) -> DataFrame:
    """doc_id, the MEASURES, and fail_bits (bit i: rule i failed). One pass over the texts, no shuffle.

    With `keep`, docs' own columns and a last column, a struct of all these; its name is one that docs doesn't have.
    """
    spread.small_batches(docs.sparkSession)
    lexicon = term_hashes(list(terms))
    names = docs.columns
    (book,) = spread.unused(names, "ledger")
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in V.texts(batch.column(at)):
                m = measure(t, lexicon)
                yield pa.RecordBatch.from_arrays([*batch.slice(t.first, t.n).columns, pa.StructArray.from_arrays([pa.array(m[k].astype(np.int64)) for k in MEASURES], list(MEASURES))], [*names, book])

    rows = docs.mapInArrow(spread.tidied(run), StructType([*docs.schema.fields, StructField(book, StructType([StructField(k, LongType()) for k in MEASURES]))]))
    bits = " | ".join(f"(CASE WHEN {when} THEN {BIT[name]}L ELSE 0L END)" for name, when in RULES)
    if not keep:
        return rows.select(F.col("doc_id").cast("long").alias("doc_id"), f"{book}.*").withColumn("fail_bits", F.expr(bits))
    measures = F.struct(*(F.col(f"{book}.{k}").alias(k) for k in MEASURES))
    within = re.sub(r"\bn_\w+|\bword_chars", lambda m: f"{book}.{m[0]}", bits)  # the measures' names, in the struct
    return rows.withColumn(book, F.struct(measures.alias("measures"), F.expr(within).alias("fail_bits")))


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with `policy` and `kept`."""
    return book.withColumns({"policy": F.lit(policy.version), "kept": F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0})


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that a policy without it would keep.

    One aggregation of bits; rows: rule, n_fail, n_only, kept_without.
    """
    bits, cols = F.col("fail_bits").bitwiseAND(F.lit(policy.mask)), []
    for r in policy.rules:
        cols += [F.count_if(bits.bitwiseAND(F.lit(BIT[r])) != 0).alias(f"{r}_fail"), F.count_if(bits == BIT[r]).alias(f"{r}_only")]
    one = book.agg(F.count_if(bits == 0).alias("kept"), *cols)
    rows = ", ".join(f"'{r}', {r}_fail, {r}_only, kept + {r}_only" for r in policy.rules)
    return one.selectExpr(f"stack({len(policy.rules)}, {rows}) AS (rule, n_fail, n_only, kept_without)")


def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    terms = toxic_terms(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    book = apply_policy(ledger(docs.select("doc_id", "text"), terms), PRODUCTION)
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.col("fail_bits").bitwiseAND(F.lit(BASE)).cast("boolean").alias("base_failed"), "kept", "fail_bits", "n_toxic", "policy")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose ledger bits the production policy's mask doesn't meet, with all their columns. One pass, no shuffle;
    each row is judged alone. Null texts are empty, and go; null doc_ids and repeated rows are judged as any row."""
    book = ledger(docs, toxic_terms(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), keep=True)
    bits = F.col(f"{book.columns[-1]}.fail_bits")
    return book.where(bits.bitwiseAND(F.lit(PRODUCTION.mask)) == 0).select(*docs.columns)


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production policy's ablations over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ablations(ledger(docs.select("doc_id", "text"), toxic_terms(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))), PRODUCTION)
