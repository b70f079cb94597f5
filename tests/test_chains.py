"""Caption chains against plain loops, and work that must not run twice."""

import random
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from framelake.operators import inference
from framelake.plans import dag
from framelake.plans.catalogue import OPERATORS
from framelake.plans.dialect import DUCK

WINDOW = "episode long, window_id long, n_windows long, frame_ids array<long>, transitions array<long>, payloads array<string>, low long, high long"


def simulate(windows, low, high, radius, least, default):
    """windows: (frame_ids, transitions or None, payloads) in order."""
    if not windows:
        return []
    n = len(windows)
    weights = np.hanning(n + 2)[1:-1] if n > 1 else [1.0]
    cuts, line = [], {}
    for (ids, places, said), w in zip(windows, weights, strict=True):
        if places is None or not ids:
            continue
        places = [p for p in places if 0 <= p < len(ids)]
        cuts += [(ids[p], w) for p in places]
        ends = [0, *places, len(ids) - 1]
        for text, a, b in zip(said, ends, ends[1:], strict=False):
            for k in range(a, b + 1):
                line.setdefault(ids[k], []).append(text)
    if not cuts:
        return [(low, high, default)]
    groups = []
    for c in sorted(cuts):
        if groups and c[0] - groups[-1][-1][0] <= radius:
            groups[-1].append(c)
        else:
            groups.append([c])
    centres = sorted({int(round(sum(f * w for f, w in g) / sum(w for _, w in g), 9)) for g in groups})
    kept = [low]
    for c in centres:
        if low < c < high and c - kept[-1] >= least:
            kept.append(c)
    if len(kept) > 1 and high - kept[-1] < least:
        kept.pop()
    out = []
    for s, e in zip(kept, [*kept[1:], high], strict=True):
        a, b = s + int(0.4 * (e - s)), s + int(0.6 * (e - s))
        seen = [x for f in range(a, b + 1) for x in line.get(f, [])] or [x for f in range(s, e) for x in line.get(f, [])]
        text = (Counter(seen).most_common(1)[0][0] if seen else "") or default
        if out and out[-1][2] == text:
            out[-1] = (out[-1][0], e, text)
        else:
            out.append((s, e, text))
    return out


def answers(r, episode):
    high = r.choice([40, 90, 200])
    low = r.choice([0, 0, 15])
    windows = []
    for w in range(r.choice([1, 2, 5])):
        ids = sorted(r.sample(range(low, high), r.choice([1, 4, 8]))) if r.random() < 0.9 else []
        places = None if r.random() < 0.15 else [r.randrange(-1, 10) for _ in range(r.randrange(4))]
        windows.append((ids, places, [r.choice("abc ").strip() for _ in range(r.randrange(5))]))
    return [(episode, i, len(windows), *w, low, high) for i, w in enumerate(windows)], windows, low, high


def test_segments_against_loop(spark):
    r, rows, want = random.Random(5), [], set()
    for episode in range(200):
        got, windows, low, high = answers(r, episode)
        rows += got
        want |= {(episode, *x) for x in simulate(windows, low, high, 20, 25, "perform the current task")}
    got = OPERATORS["generic_segments"].over(windows=spark.createDataFrame(rows, WINDOW))
    assert {(x.episode, x.s, x.e, x.payload) for x in got.collect()} == want
    assert len({x[3] for x in want}) == 4 and len(want) > 100
    assert OPERATORS["generic_segments"].over(windows=spark.createDataFrame([], WINDOW)).count() == 0


def test_two_levels_against_loop(spark):
    r, outer, inner, want = random.Random(6), [], [], {}
    for episode in range(30):
        got, windows, low, high = answers(r, episode)
        outer += got
        tasks = simulate(windows, low, high, 20, 25, "perform the current task")
        short, ids = [], list(range(low, high, 2))
        for i in range(0, len(ids), 6):
            short.append((ids[i : i + 6], None if r.random() < 0.1 else [r.randrange(6) for _ in range(r.randrange(3))], [r.choice(["Pick Up", "put", " "]) for _ in range(3)]))
        inner += [(episode, i, len(short), *w, low, high) for i, w in enumerate(short)]
        for t, (s, e, text) in enumerate(tasks):
            acts = simulate([w for w in short if s <= w[0][0] < e], s, e, 5, 6, "act")
            slug = lambda x: x.strip().lower().replace(" ", "_") or "act"
            want[episode, t] = (text, s, e, ";".join(f"{slug(x)}:{a}-{b}" for a, b, x in acts))
    got = OPERATORS["two_level_captions"].over(windows=spark.createDataFrame(outer, WINDOW), inner=spark.createDataFrame(inner, WINDOW)).collect()
    assert {(x.episode, x.task): (x.caption, x.s, x.e, x.actions) for x in got} == want


def test_refined_tasks(spark):
    parts = [(e, s * 10, s * 10 + 10, t) for e in range(7) for s, t in enumerate(["Wash", "wash ", " ", " ", "dry"])] + [(7, 0, 10, "only")]
    proposals = [
        (0, 0, 0, 40, "wash up"), (0, 1, 40, 50, " "),  # holds
        (1, 0, 0, 30, "gap"), (1, 1, 40, 50, "x"),
        (2, 0, 0, 33, "invented"), (2, 1, 33, 50, "x"),
        (3, 0, 10, 50, "late"),
        (4, 0, 0, 40, "short"),
        (5, 0, 0, 50, "one"),
        (7, 0, 0, 10, "other"),
    ]
    got = OPERATORS["refined_tasks"].over(parts=spark.createDataFrame(parts, "episode long, s long, e long, instruction string"), proposals=spark.createDataFrame(proposals, "episode long, place long, s long, e long, instruction string")).collect()
    found = {}
    for x in sorted(got):
        found.setdefault(x.episode, []).append((x.s, x.e, x.instruction))
    merged = [(0, 20, "Wash"), (20, 30, " "), (30, 40, " "), (40, 50, "dry")]
    assert found == {0: [(0, 40, "wash up"), (40, 50, "perform the current task")], **dict.fromkeys((1, 2, 3, 4, 6), merged), 5: [(0, 50, "one")], 7: [(0, 10, "only")]}


def test_answers_by_field(spark):
    texts = {
        '{"single_person_operation": true}': (None, None, True), '{"single_operator_only": "No"}': (None, False, False), '{"single_person_operation": "true"}': (None, None, None),
        'so "single_operator_only": "yes" it is': (None, True, True), '{"active_manipulation": "true"}': (None, None, None), '{"active_manipulation": false}': (None, False, None),
        '{"hand_count": true}': (1, None, None), '{"count": 2}': (2, None, None), "x2y": (2, None, None), "": (None, None, None),
    }
    rows = [(t, 1, t) for t in texts]
    got = OPERATORS["parse_audit"].over(responses=spark.createDataFrame(rows, "custom_id string, conv_id long, text string")).collect()
    assert {x.custom_id: (x.hands, x.active, x.single) for x in got} == texts


def test_odd_answers_as_the_sql_reads_them(spark):
    texts = ["no\u00f1codota ie", "\u00f1 yes", "\u00e91", '"active_manipulation":\x0b"no"', '{"single_operator_only": true} end', '{"hand_count": false}]', '{"count": true}, 0', "\u0130no", '{"single_operator_only": true}']
    rows = [(str(i), 1, t) for i, t in enumerate(texts)]
    op = OPERATORS["parse_audit"]
    got = op.over(responses=spark.createDataFrame(rows, "custom_id string, conv_id long, text string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE responses (custom_id VARCHAR, conv_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO responses VALUES (?, ?, ?)", rows)
    want = con.sql(op.sql(DUCK).replace("{responses}", "responses").replace("{{", "{").replace("}}", "}"))
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_calls_run_once(spark, tmp_path):
    class Counting(inference.Stub):
        def __init__(self, path, fail=0):
            super().__init__(fail)
            self.path = path

        def answer(self, prompt):
            with open(self.path, "a") as f:
                f.write(prompt + "\n")
            return super().answer(prompt)

    path = str(tmp_path / "calls")
    q = spark.createDataFrame([(f"r{i}", f"prompt {i}") for i in range(20)], "custom_id string, prompt string")
    both = inference.retry_failed(q, inference.call(q, lambda: Counting(path, 3)), lambda: Counting(path))
    assert both.count() == 20
    retried = both.where("retried").count()
    assert retried and len(open(path).readlines()) == 20 + retried


def test_steps_run_once(spark, tmp_path):
    path = str(tmp_path / "runs")

    def step(name, **kw):
        def note(work):
            with open(path, "a") as f:
                f.write(f"{name} {work}\n")
            return work

        return lambda w: w.withColumn("work", F.udf(note)("work")).select(*dag.result(operator=name, **kw))

    reg = dag.Registry()
    reg.add(dag.Step("cut", step("cut", outputs="array(concat(work, '/0'), concat(work, '/1'))"), fan_out=True))
    reg.add(dag.Step("blur", step("blur"), ("cut",)))
    got = dag.run(reg, spark.createDataFrame([("a",), ("b",)], "work string"), fail_fast=True)
    assert got.count() == 6 and dag.report(got).count() == 2
    assert sorted(open(path).read().split("\n")) == ["", "blur a/0", "blur a/1", "blur b/0", "blur b/1", "cut a", "cut b"]
