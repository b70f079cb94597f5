"""Rounds of the operators on pairs: a later round's work goes by what is new, and no round loses a link."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from framelake.llm import line_dedup, shingle_join, spread
from framelake.llm import textvec as V

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def words(r, n):
    return ["".join(r.choices(LETTERS, k=8)) for _ in range(n)]


def least_of(nodes, edges):
    least = {n: n for n in nodes}
    for _ in least:
        before = dict(least)
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    return least


@pytest.fixture
def sizes(monkeypatch):
    """Edges that `components` is given, call by call."""
    found, own = [], spread.components

    def counted(edges, *more):
        found.append(edges.count())
        return own(edges, *more)

    monkeypatch.setattr(spread, "components", counted)
    return found


def test_merged_groups(spark, sizes):
    r = random.Random(5)
    old = [(r.randrange(300), r.randrange(300)) for _ in range(130)]
    new = [(r.randrange(340), r.randrange(340)) for _ in range(40)] + [(3, 3)]
    put = lambda x: spread.stash(spark.createDataFrame(x, "a long, b long"))
    known = spread.stash(spread.components(put(old)))
    got = spread.merged(known, put(new)).collect()
    want = least_of(range(340), old + new)
    assert len(got) == len({x.node for x in got})
    assert {x.node: x.component for x in got} == {n: want[n] for a, b in old + new if a != b for n in (a, b)}
    assert sizes == [len(old), len(new)]
    known = spread.stash(spread.components(put(old)))
    assert spread.merged(known, put([])) is known


def test_line_rounds_join_only_new_links(spark, monkeypatch, sizes):
    r = random.Random(6)
    base = [words(r, 14) for _ in range(40)]
    far = " ".join(("z" if w[0] != "z" else "y") + w[1:] for w in base[0])  # similar, but without a word in common
    lines = [" ".join(x) for x in base] + [" ".join([*x[:-1], x[-1][:-1]]) for x in base] + [far]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    key = dict(zip(lines, V.signed(line_dedup.Lines(next(V.texts(pa.array(lines), 1 << 60))).key).tolist(), strict=True))
    assert key[far] not in {x.key for x in line_dedup.ledger(docs, wide=True)[1].collect()}
    sizes.clear()
    offer = [(min(key[far], key[lines[0]]), max(key[far], key[lines[0]]), False)]
    monkeypatch.setattr(line_dedup, "across", lambda rows, most: spark.createDataFrame(offer, "a long, b long, left boolean"))
    gone, comp = line_dedup.ledger(docs, wide=True)
    comp = {x.key: x.component for x in comp.collect()}
    assert comp[key[far]] == comp[key[lines[0]]]
    assert {x.doc_id for x in gone.collect()} >= {len(lines) - 1}
    assert sizes[0] >= 30 and sizes[1:] == [1]


def test_first_of_equal_buckets(spark):
    held = {5: (1, 2, 3), 9: (3, 1, 2), 4: (1, 2), 8: (2, 1), 1: (1, 2, 3, 4), 6: (7, 8)}
    rows = spark.createDataFrame([(g, d) for g, ids in held.items() for d in ids], "g long, doc_id long")
    assert sorted(x.g for x in shingle_join._first_of_equal(rows).collect()) == [1, 4, 5, 6]


@pytest.mark.parametrize("m", [6, 40, 160])
def test_a_buckets_offers_grow_with_its_groups(spark, m):
    a = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 100).astype(np.uint64) << np.uint64(1))
    bits, s0, s1 = shingle_join._bitmap(a, 0)
    row = lambda i: (7, 0, 0, i, len(a), i, 0, bits, s0, s1, 7, 99, 99, 99, 2)
    rows = spark.createDataFrame([row(i) for i in range(m)], "g long, tile long, side int, doc_id long, n long, component long, level long, b0 binary, s0 long, s1 long, h0 long, h1 long, h2 long, h3 long, most int")
    got = shingle_join._candidates(rows, 85).collect()
    assert m - 1 <= len(got) <= 2 * m
    assert any(x.left for x in got)
    assert {x.b for x in got} == set(range(1, m))


@pytest.mark.parametrize("pairs", [1, 8])
def test_near_copies_meet_without_all_their_pairs(spark, monkeypatch, pairs):
    r = random.Random(8)
    texts = []
    for _ in range(2):
        base = words(r, 300)
        for _ in range(45):
            x = list(base)
            for i in r.sample(range(300), r.randrange(1, 4)):
                x[i] = words(r, 1)[0]
            texts.append(" ".join(x))
    sets = [set(zip(*(x.split(" ")[i:] for i in range(4)), strict=False)) for x in texts]
    linked = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    tried, own = [], shingle_join._verify

    def counted(docs, found, *more):
        tried.append(found.count())
        return own(docs, found, *more)

    monkeypatch.setattr(shingle_join, "_verify", counted)
    monkeypatch.setattr(shingle_join, "_close", lambda docs, *_: docs.sparkSession.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(shingle_join, "PAIRS", pairs)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in shingle_join.groups(docs).collect()}
    assert got == least_of(range(len(texts)), linked)
    assert sum(tried) < len(linked) / 2
