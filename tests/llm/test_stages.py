"""Stages of the pipeline on rows with nulls, repeats and long texts, against plain Python; small limits; decoding by enumeration."""

import itertools
import random
import re

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.llm import decontaminate, quality_rules, shingle_join, transcripts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    r = random.Random(3)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(2, 6))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base = [text(60) for _ in range(8)]

    def edit(x, k):
        w = x.split(" ")
        for _ in range(k):
            w[r.randrange(len(w))] = r.choice(vocab)
        return " ".join(w)

    texts = [*base, base[0], base[1].upper(), *(edit(b, k) for b in base[:4] for k in (1, 2, 9)), None, "", " \n", "one", "one two", text(200_000), text(20) + ", " + base[5] + "! " + text(100)]
    out = [(i, x, "en", "s", len(x or "")) for i, x in enumerate(texts)]
    return out + [out[2], out[2], (None, base[3], "en", "s", 1), (500, base[6], None, None, None), (500, base[7], None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOC).repartition(3)


def key(r):
    return repr(tuple(r))


def groups(k, percent):
    """The least id of each connected group, by id; a set a text."""
    own = {}
    for i, x, *_ in rows():
        if i is not None:
            w = WORD.findall(lower(x or ""))
            own.setdefault(i, []).append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()})
    least = {i: i for i in own}
    linked = [(a, b) for a, b in itertools.combinations(sorted(own), 2) if any(p and q and 100 * len(p & q) >= percent * len(p | q) for p in own[a] for q in own[b])]
    for _ in own:
        for a, b in linked:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize(("block", "pairs"), [(4096, 64), (3, 1)])
def test_near_copies_keep_one_of_a_group(spark, docs, monkeypatch, block, pairs):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    monkeypatch.setattr(shingle_join, "PAIRS", pairs)
    least = groups(5, 80)
    want = [r for r in rows() if r[0] is None or least[r[0]] == r[0]]
    assert len(want) < len(rows())
    got = shingle_join.near_copy_stage(spark, docs, "").select(*DOC.replace(" long", "").replace(" string", "").split(", ")).collect()
    assert sorted(map(key, got)) == sorted(map(repr, want))


def without(text, windows, most=0.5):
    """The text without its hits; None if it goes."""
    low = lower(text or "")
    at = [(m.start(), m.end()) for m in ALNUM.finditer(low)]
    w = [low[a:b] for a, b in at]
    hit = set()
    for n in {len(x) for x in windows}:
        for j in range(len(w) - n + 1):
            if tuple(w[j : j + n]) in windows:
                hit.update(range(j, j + n))
    if not hit:
        return text
    if len(hit) > most * len(w):
        return None
    parts, end = [], 0
    for j in sorted(hit):
        if j - 1 not in hit:
            parts.append(text[end : at[j][0]])
        end = at[j][1]
    return " ".join([*parts, text[end:]])


def test_decontamination_stage(spark, docs, tmp_path):
    base = rows()[5][1]
    items = [(1, base.upper()), (2, "one two"), (3, None), (4, ""), (5, rows()[3][1][:120])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    windows = set()
    for _, x in items:
        w = ALNUM.findall(lower(x or ""))
        windows |= {tuple(w[j : j + 10]) for j in range(max(1, len(w) - 9) if w else 0)}
    want = [(i, t, lang, s, None if t is None else len(t)) for i, x, lang, s, _ in rows() if (t := without(x, windows)) is not None or x is None]
    assert 0 < len(want) < len(rows()) and any(t and x and t != x for (_, x, *_), (_, t, *_) in zip(rows(), want))
    got = decontaminate.decontamination_stage(spark, docs, str(tmp_path)).collect()
    assert sorted(key(r) for r in got) == sorted(map(repr, want))


def test_stages_of_empty_tables(spark, docs, tmp_path):
    for name, df in (("documents", docs.limit(0)), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame([], "item_id long, text string"))):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    only = docs.where("doc_id IS NULL OR text IS NULL OR doc_id = 500")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, only, str(tmp_path))
        assert got.columns == only.columns and got.where("doc_id IS NULL").count() == (1 if name != "quality_rules" else got.where("doc_id IS NULL").count())


def test_ablations_are_counts_of_the_ledger(spark, docs):
    book = quality_rules.ledger(docs.select("doc_id", "text"), ["abc"])
    rules, bit = quality_rules.PRODUCTION.rules, quality_rules.BIT
    bits = [r.fail_bits for r in book.collect()]
    of = lambda b, names: [r for r in names if b & bit[r]]
    want = {r: (sum(bool(b & bit[r]) for b in bits), sum(of(b, rules) == [r] for b in bits), sum(not of(b, [x for x in rules if x != r]) for b in bits)) for r in rules}
    assert {r.rule: (r.n_fail, r.n_only, r.kept_without) for r in quality_rules.ablations(book, quality_rules.PRODUCTION).collect()} == want


def test_decoding_finds_a_best_path_of_all():
    r = np.random.default_rng(5)
    n = len(transcripts.STATES)

    class Any:
        start, trans = r.normal(0, 2, n), r.normal(0, 2, (n, n))

        def score(self, o):
            return np.asarray(o, float)

    for every in (1, 2, 50):
        for _ in range(20):
            seen = [tuple(x) for x in r.normal(0, 2, (int(r.integers(1, 6)), n))]
            decoder = transcripts.Decoder(Any())
            decoder.every = every
            got = [s for o in seen for s in decoder.push(o)]
            got += decoder.close()
            cost = lambda p: Any.start[p[0]] + sum(seen[i][s] for i, s in enumerate(p)) + sum(Any.trans[a, b] for a, b in zip(p, p[1:]))
            assert len(got) == len(seen) and abs(cost(got) - max(map(cost, itertools.product(range(n), repeat=len(seen))))) < 1e-9


def test_turns_of_held_out_transcripts(spark, sf_dir):
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet".replace("sf0.001", "sf0.01"))
    lines = transcripts.raw_lines(conv)
    model = transcripts.train(lines.where("conv_id % 2 = 0"))
    held = conv.where("conv_id % 2 = 1").select("conv_id", "role", F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\n\s*\n", "\n")).alias("text")).where("text <> ''")
    turns = transcripts.parse(lines.where("conv_id % 2 = 1").select("conv_id", "ord1", "ord2", "line"), model).select("conv_id", "role", F.trim("text").alias("text"))
    hits = held.intersectAll(turns).count()
    assert hits > 0.8 * held.count() and hits > 0.8 * turns.count()
