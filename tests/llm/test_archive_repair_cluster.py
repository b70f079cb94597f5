"""WARC bundles, turn repair and centroids against plain Python, with nulls, repeats, ties, small blocks and empty tables."""

import base64
import hashlib
import heapq
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.llm import centroids, seekable, turn_repair

# -- WARC --------------------------------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a/ b?q=é", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "http://x\r\nWARC-Type: evil", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n\r\n" * 3), (-7, "u", "<p>one</p>"),
    (None, "n", "<p>one</p>"), (None, "n", "only without an id"), (6, "twice", "same"), (6, "twice", "same"), (7, "later", "same"), (8, "long", "w" * 3_000_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, digest string, least long").repartition(3)


def want_pages(rows, least_bytes=0):
    owner, out = {}, []
    for i, _, h in rows:
        if i is not None:
            owner[h or ""] = min(i, owner.get(h or "", i))
    for i, _, h in rows:
        raw = (h or "").encode()
        least = owner.get(h or "") if len(raw) >= least_bytes else None
        again = least is not None and least != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", least if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("frame", "bundle", "least_bytes"), [(1, 1, 0), (200, 500, 0), (1 << 18, 1 << 26, 5)])
def test_archives_are_read_back_whole(spark, pages, tmp_path, frame, bundle, least_bytes):
    index = seekable.write(pages, f"file://{tmp_path}/warc", least_bytes, frame, bundle)
    got = seekable.read(index, payload=True)
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()]
    assert sorted(rows, key=repr) == want_pages(PAGES, least_bytes)
    bodies = {(r.page_id, r.payload.decode()) for r in got.where("record_type = 'response'").collect()}
    assert bodies <= {(i, h or "") for i, _, h in PAGES}
    assert (8, "w" * 3_000_000) in bodies
    if bundle == 1:
        assert index.select("path").distinct().count() == len(PAGES)


def test_records_are_fetched_by_their_offsets(spark, pages, tmp_path):
    index = seekable.write(pages, str(tmp_path / "warc"), frame=300)
    for wanted in (index.where("page_id = 5"), index.where("page_id IS NOT NULL"), index.limit(0)):
        got = seekable.fetch(index, wanted)
        assert sorted((r.record_id, r.path, r.frame, r.offset) for r in got.collect()) == sorted((r.record_id, r.path, r.frame, r.offset) for r in index.join(wanted.select("record_id").distinct(), "record_id").collect())
    (r,) = seekable.fetch(index, index.where("page_id = 5")).collect()
    assert r.payload.decode() == PAGES[4][2]


def test_a_plain_decoder_reads_a_bundle(spark, pages, tmp_path):
    import zstandard

    path = seekable.write(pages.coalesce(1), str(tmp_path / "warc"), frame=300).first().path
    with open(path, "rb") as f:
        raw = f.read()
    text = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    at = n = 0
    while at < len(text):
        _, _, at = seekable.parse(text, at)
        n += 1
    assert n == len(PAGES)


def test_damage_to_a_bundle_is_noticed(spark, pages, tmp_path):
    index = seekable.write(pages.coalesce(1), str(tmp_path / "warc"), frame=300)
    path = index.first().path
    raw = bytearray(open(path, "rb").read())
    raw[40] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises(Exception, match=r"(?s)damaged|rror"):
        seekable.read(index).collect()


def test_record_ids_carry_the_page():
    for page in (0, 1, -1, 2**63 - 1, -(2**63), None):
        for digest in (b"\0" * 20, b"\xff" * 20):
            assert seekable.page_of(seekable.record_id(page, digest)) == page


def test_archives_of_no_pages(spark, pages, tmp_path):
    index = seekable.write(pages.limit(0), str(tmp_path / "warc"))
    assert index.count() == 0 and seekable.read(index).count() == 0


def test_hot_payloads_come_by_broadcast(spark, tmp_path):
    rows = [(i, "u", "hot" if i % 3 else f"p{i % 50}") for i in range(400)]
    got = seekable.read(seekable.write(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "warc")))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=repr) == want_pages(rows)


# -- turn repair -------------------------------------------------------------------------------------------------------

WHITE = " \t\n\x0b\x0c\r"


def brute_repair(rows, damage=True):
    """Dijkstra by (cost, audit) over strings of initials."""
    out, by = {}, {}
    for c, t, r, x in rows:
        by.setdefault(c, [])
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            by[c] += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    for c, v in by.items():
        v.sort(key=lambda z: ((z[0] is not None, z[0] or 0), z[1], z[2]))
        ts = [t for t, _, _ in v if t is not None]
        seen, faults = set(), []
        for _, r, x in v:
            y = x.strip(WHITE)
            faults.append("blank" if not y else "dup" if (r, x) in seen else "cut" if y[-1] not in ".!?" else "")
            seen.add((r, x))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(v, v[1:]))
        goes = lambda state, q: state + q in ("s", "u", "su", "ua", "au") and q != ""
        heap, done = [(0, "", 0, "", ())], set()
        while True:
            cost, audit, i, state, made = heapq.heappop(heap)
            if i == len(v) and state in ("", "a"):
                break
            if (i, state) in done:
                continue
            done.add((i, state))
            for q in ("user", "assistant"):
                if goes(state, q[0]):
                    heapq.heappush(heap, (cost + 3, audit + "I", i, q[0], (*made, q + ":")))
            if i < len(v):
                heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, made))
                if faults[i] not in ("blank", "dup"):
                    (_, r, x), more = v[i], 3 * (faults[i] == "cut")
                    if goes(state, r[:1]):
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, r[0], (*made, f"{r}:{x}")))
                    for q in ("user", "assistant"):
                        if goes(state, q[0]):
                            heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, q[0], (*made, f"{q}:{x}")))
        out[c] = (max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, *(faults.count(f) for f in ("blank", "dup", "cut")), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def repaired(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def odd_turns():
    r = random.Random(11)
    out = [(c, r.choice([None, i // 3, i, r.randint(0, 5)]), r.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), r.choice(["", "ok.", "ok", " ", None, f"x{r.randint(0, 9)}.", " hey! ", " "])) for c in range(40) for i in range(r.randint(1, 30) if c else 250)]
    out += [(None, 1, "user", "a."), (None, None, "assistant", "b?"), (90, 3, "user", "one."), (90, 3, "user", "one."), (91, 2**62, "user", "far."), (91, 0, "assistant", "off.")]
    return out + [(92, 1, "user", "same.")] * 60


@pytest.mark.parametrize("block", [1, 3, 64, 4096])
def test_repair_of_odd_conversations(spark, block):
    rows = odd_turns()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, mark string").repartition(5)
    assert repaired(turn_repair.repair(turn_repair.damaged(df), block)) == brute_repair(rows)
    assert repaired(turn_repair.repair(df, block)) == brute_repair(rows, damage=False)


def test_repair_of_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert repaired(turn_repair.op12_tight_arcs(spark, sf_dir)) == brute_repair(rows)


def test_repair_of_long_texts_and_none(spark):
    rows = [(1, 0, "user", "x" * 3_000_000), (1, 1, "assistant", "y" * 3_000_000 + "."), (2, 0, "system", "only.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert repaired(turn_repair.repair(df)) == brute_repair(rows, damage=False)
    assert turn_repair.repair(df.limit(0)).count() == 0
    gone = turn_repair.repair(df.withColumn("copies", F.lit(0)))
    assert repaired(gone) == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in (1, 2)}


def test_matrices_multiply_to_the_whole():
    r = random.Random(3)
    rows = [(r.choice("sua") if r.random() < 0.8 else "", r.random() < 0.2, r.random() < 0.3) for _ in range(50)]
    for cut in (0, 1, 20, 50):
        a, b = turn_repair.matrix(rows[:cut]), turn_repair.matrix(rows[cut:])
        assert turn_repair.product(a, b) == turn_repair.matrix(rows)


# -- centroids ---------------------------------------------------------------------------------------------------------


def brute_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(float(v) * 1024) if abs(float(v)) < 2**53 else int(float(v)) * 1024 for v in e]) for i, e in rows if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)]
    raw = {n: e for n, (i, e) in enumerate(kept)}
    first = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), raw[n]) for n, (i, _) in enumerate(kept))[:k]
    cs = [v for _, v in first]
    near = lambda v: min((sum((p - q) ** 2 for p, q in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cs)]
    got = [(i, *near(v)[::-1]) for i, v in kept]
    total = [sum(d for _, j, d in got if j == c) for c in range(len(cs))]
    fits = lambda v: v if v < 2**63 else None
    return sorted(((i, j, fits(d), fits(total[j]), fits(sum(total)), hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest()) for i, j, d in got), key=repr)


def clustered(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=repr)


def vectors(n, scale, seed=5):
    r = random.Random(seed)
    return [(i, [r.gauss(0, 1) * scale for _ in range(64)]) for i in range(n)]


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e6, 1e12, 1e300, 1e306])
def test_clusters_are_exact_at_every_magnitude(spark, scale):
    rows = vectors(60, scale) + [(60 + i, [0.25 + i] * 64) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert clustered(centroids.cluster(df)) == brute_clusters(rows)


def test_clusters_of_odd_vectors(spark):
    rows = vectors(30, 1.0) + [(30, None), (31, [1.0] * 63), (32, [1.0] * 63 + [None]), (33, [float("nan")] + [0.0] * 63), (34, [float("inf")] + [0.0] * 63), (None, [0.5] * 64), (7, [0.5] * 64)]
    rows += [(100 + i, [-0.001] * 64) for i in range(50)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, cluster string").repartition(4)
    assert clustered(centroids.cluster(df)) == brute_clusters(rows)
    few = df.where("vec_id < 3")
    assert clustered(centroids.cluster(few)) == brute_clusters(rows[:3])
    assert centroids.cluster(df.limit(0)).count() == 0 and centroids.cluster(df.where("vec_id = 31")).count() == 0


def test_all_three_forms_of_distance_agree():
    x = np.floor(np.random.default_rng(1).normal(0, 500, (40, 8)))
    centres = [[int(v) for v in row] for row in x[:3]]
    want = [[sum((int(p) - q) ** 2 for p, q in zip(row, c)) for c in centres] for row in x]
    assert centroids.distances(x, centres).astype(int).tolist() == want
    y = x + 2.0**27
    wide = [[v + 2**27 for v in c] for c in centres]
    assert centroids.distances(y, wide).dtype == np.int64 and centroids.distances(y, wide).tolist() == want
    y, far = x + 2.0**40, [[v + 2**40 for v in c] for c in centres]
    assert centroids.distances(y, far).dtype == object and centroids.distances(y, far).tolist() == want


def test_small_blocks_change_nothing(spark):
    rows = centroids.usable(spark.createDataFrame(vectors(50, 1.0), "vec_id long, embedding array<double>").repartition(3))
    start = centroids.starts(rows)
    assert centroids.fit(centroids.pack(rows, block=7), start) == centroids.fit(centroids.pack(rows), start)


@pytest.mark.parametrize("name", ["op11_seekable_warc", "op13_centroids"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    from framelake.llm import queries

    con = duckdb.connect()
    for t in ("pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = queries.queries()[name](spark, sf_dir), con.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())
