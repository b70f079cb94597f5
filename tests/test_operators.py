"""Edge rows, invariants and simulations."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.functions import lenient, pixels
from framelake.operators import captions, imu, inference
from framelake.plans import dag
from framelake.plans.catalogue import OPERATORS, Operator
from framelake.sources import discovery, sinks
from framelake.streaming import pending


def windows(n, fps, win, step, k):
    wf, sf = max(1, round(win * fps)), max(1, round(step * fps))
    out, s = [], 0
    while n > 0:
        e = n - 1 if n <= wf else min(s + wf - 1, n - 1)
        m = min(k, e - s + 1)
        out.append((s, e, ",".join(str(int(v)) for v in np.linspace(s, e, m, dtype=int))))
        if e == n - 1:
            return out
        s += sf
    return out


def test_windows_against_simulation(spark):
    rows = [(i, n, 30.0) for i, n in enumerate([0, 1, 2, 14, 15, 16, 22, 23, 100, 101])]
    got = OPERATORS["sample_windows"].over(episodes=spark.createDataFrame(rows, "episode long, n long, fps double")).collect()
    for i, n, fps in rows:
        assert sorted((r.start_frame, r.end_frame, r.frame_ids) for r in got if r.episode == i) == windows(n, fps, 0.5, 0.25, 4)


def frames(spark, cuts, n=200, kinds=None):
    rows = [(1, i, n, (kinds or "a")[i % len(kinds or "a")], i in cuts, i in cuts, 0, 0.5, i, 1.0) for i in range(n)]
    return spark.createDataFrame(rows, "episode long, frame_idx long, n long, kind string, cut boolean, detected boolean, cls int, conf double, k long, value double")


def test_two_clusterings_differ(spark):
    f = frames(spark, {0, 5, 10, 15})
    assert OPERATORS["cut_clusters_anchor"].over(frames=f).count() == 2
    assert OPERATORS["cut_clusters_chain"].over(frames=f).count() == 4
    assert OPERATORS["cut_clusters_chain"].over(frames=frames(spark, {0, 2, 4, 6})).count() == 1


def test_min_length_drops_short_tail(spark):
    got = OPERATORS["cut_min_length"].over(frames=frames(spark, {3, 7, 30, 198})).first()
    assert got.boundaries == "0,7,30"
    assert OPERATORS["cut_min_length"].over(frames=frames(spark, set())).first().boundaries == "0"


def test_votes_ties_go_to_first_seen(spark):
    got = OPERATORS["segment_vote_overlap"].over(frames=frames(spark, set(), 20, "ba")).first()
    assert got.instruction == "a"  # of the middle's spans, frame 5 comes first


def test_positive_ranges_against_loop(spark):
    r = random.Random(4)
    for _ in range(5):
        hit = {i for i in range(60) if r.random() < 0.6}
        want = set()
        for s in range(0, 60, 5):
            if s in hit:
                a = b = s
                while a - 1 in hit:
                    a -= 1
                while b + 1 in hit:
                    b += 1
                want.add((a, b))
        got = {(x.start_frame, x.end_frame) for x in OPERATORS["positive_ranges"].over(frames=frames(spark, hit, 60)).collect()}
        assert got == want


def test_empty_inputs(spark):
    f = frames(spark, set(), 1).limit(0)
    for name in ("cut_clusters_anchor", "cut_min_length", "segment_vote_overlap", "merge_adjacent", "positive_ranges", "task_segments", "asof_nearest"):
        assert OPERATORS[name].over(frames=f).count() == 0, name


def test_flags_take_both_values(spark, sf_dir):
    got = {r["pass"] for r in OPERATORS["quality_summary"].run(spark, sf_dir).collect()}
    assert got == {True, False}


def test_kernels_agree_with_numpy(spark):
    r = np.random.default_rng(1)
    px = r.integers(0, 256, (5, 8, 8))
    df = spark.createDataFrame([(1, i, p.ravel().tolist()) for i, p in enumerate(px)], "episode long, frame_idx long, px array<int>")
    for row in OPERATORS["frame_quality"].over(frames=df).collect():
        assert row.laplacian_var == pytest.approx(pixels.laplacian_variance(px[row.frame_idx]), abs=1e-5)
        assert row.tenengrad == pytest.approx(pixels.tenengrad(px[row.frame_idx]), abs=1e-5)
    binary = spark.createDataFrame([(1, i, 8, 8, bytearray(p.astype(np.uint8).tobytes())) for i, p in enumerate(px)], "episode long, frame_idx long, w int, h int, px binary")
    assert {round(x.tenengrad, 4) for x in pixels.metrics(binary).collect()} == {round(pixels.tenengrad(p), 4) for p in px}


def test_pixels():
    x = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert pixels.rotate(x, 90).shape == (4, 3) and (pixels.rotate(pixels.rotate(x, 90), 270) == x).all()
    assert pixels.shrink(np.full((10, 4000), 7, np.uint8)).shape == (5, 1920)
    image = np.zeros((60, 60), np.uint8)
    image[30, 30] = 255
    soft = pixels.blur_boxes(image, [(20, 20, 45, 45), (0, 0, 0, 0)])
    assert soft[30, 30] < 50 and soft[0, 0] == 0


def test_smoothing_and_peaks(spark):
    t = np.arange(200)
    cubic = 0.001 * t**3 - 0.1 * t**2 + t
    assert np.allclose(imu.smooth(cubic), cubic)
    wave = np.cos(t / 200 * 2 * np.pi * 5)
    assert imu.peaks(wave).tolist() == [40, 80, 120, 160]
    df = spark.createDataFrame([(1, int(i), float(v)) for i, v in enumerate(-wave)] + [(2, 0, None)], "episode long, pos long, value double")
    assert sorted(r.pos for r in imu.valleys(df).collect()) == [40, 80, 120, 160]


@pytest.mark.parametrize(("text", "want"), [('{"a":1}', {"a": 1}), ('```json\n{"a":1}\n```', {"a": 1}), ('x [1, {"b":2}] y', {"b": 2}), ('say {"c":3} end {', {"c": 3}), ("none", None), (None, None)])
def test_lenient_json(text, want):
    assert lenient.first_object(text) == want


def test_lenient_column(spark):
    df = spark.createDataFrame([('x {"b":1,"a":2}',), (None,), ("no",)], "t string")
    assert [r[0] for r in df.select(lenient.canonical_json(df.t)).collect()] == ['{"a":2,"b":1}', None, None]


def test_inference_retries(spark):
    q = spark.createDataFrame([(f"r{i}", f"prompt {i}") for i in range(20)], "custom_id string, prompt string")
    first = inference.call(q, lambda: inference.Stub(fail=3))
    bad = {r.custom_id for r in first.collect() if r.status_code == 500}
    assert bad and all(r.error for r in first.collect() if r.custom_id in bad)
    both = inference.retry_failed(q, first, inference.Stub).collect()
    assert len(both) == 20 and {r.custom_id for r in both if r.retried} == bad and all(r.status_code == 200 for r in both)


def test_batch_lines(spark):
    q = spark.createDataFrame([("r1", "hi")], "custom_id string, prompt string")
    assert '"custom_id":"r1"' in inference.request_lines(q, "m").first().value
    lines = spark.createDataFrame([("",), ('{"custom_id":"r1","response":{"body":{"choices":[{"message":{"content":"yo"}}]}}}',), ("junk",)], "value string")
    assert [tuple(r)[:3] for r in inference.read_answers(lines).collect()] == [("r1", "yo", 200)]


def test_stages_and_run(spark):
    ok = lambda name: lambda w: w.select(*dag.result(operator=name))
    reg = dag.Registry()
    reg.add(dag.Step("cut", lambda w: w.select(*dag.result(operator="cut", outputs="array(concat(work, '/0'), concat(work, '/1'))")), ("caption",), fan_out=True))
    reg.add(dag.Step("caption", lambda w: w.select(*dag.result(operator="caption", status="IF(work = 'b', 'error', 'pending')")), collect=lambda w: w.withColumn("status", w.status.substr(1, 0)).selectExpr("* except(status)", "'ok' AS status")))
    reg.add(dag.Step("blur", ok("blur"), ("cut", "missing")))
    assert [[s.name for s in x] for x in reg.stages()] == [["caption"], ["cut"], ["blur"]]
    assert [[s.name for s in x] for x in reg.stages(["blur", "caption"])] == [["caption", "blur"]]
    work = spark.createDataFrame([("a",), ("b",)], "work string")
    got = {r.operator: r for r in dag.report(dag.run(reg, work)).collect()}
    assert got["blur"]["items"] == 4 and got["caption"].errors == 1 and got["caption"].exit_code == 1
    assert {r.operator: r["items"] for r in dag.report(dag.run(reg, work, fail_fast=True)).collect()}["blur"] == 2


def test_discovery(spark, tmp_path):
    for name in ("e1/rgb.mp4", "e1/other.mp4", "e2/only.mov", "e3/a.mp4", "e3/b.mp4", "e3/.hidden.mp4"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    found = discovery.files(spark, str(tmp_path))
    assert {r.path.rsplit("/", 2)[-2:][0] + "/" + r.path.rsplit("/", 1)[-1] for r in discovery.input_video(found).collect()} == {"e1/rgb.mp4", "e2/only.mov"}
    assert discovery.mirrored(found, str(tmp_path), "/out", "mkv").where("output = '/out/e2/only.mkv'").count() == 1
    assert discovery.primary(discovery.artifacts('{"items": [1, {"type": "x"}, {"type": "video"}]}'))["type"] == "video"
    with pytest.raises(ValueError):
        discovery.artifacts('{"a": 1}')


def test_probes(spark):
    raw = spark.createDataFrame([("a/v.mp4", '{"streams":[{"codec_type":"video","codec_name":"h264","r_frame_rate":"30000/1001","width":4}],"format":{"bit_rate":"2500000"}}'), ("b.mkv", "junk")], "path string, json string")
    a, b = discovery.probes(raw).orderBy("path").collect()
    assert (a.codec, a.fps, a.bitrate_kbps, a.container) == ("h264", 29.97, 2500, "mp4") and b.codec is None


def test_sinks(spark, tmp_path):
    made = []
    wanted = spark.createDataFrame([(1, 0), (1, 1), (1, 1)], "episode long, frame_idx long")

    def make(missing):
        made.append(missing.count())
        return missing.selectExpr("*", "frame_idx * 10 AS value")

    assert sinks.fill(wanted, str(tmp_path / "t"), make).count() == 2
    assert sinks.fill(wanted.union(spark.createDataFrame([(2, 5)], wanted.schema)), str(tmp_path / "t"), make).count() == 3
    assert made == [2, 1]
    old, new = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("b", 2)], [("b", 3), ("c", 4)]))
    assert {tuple(r) for r in sinks.upsert(old, new, "k").collect()} == {("a", 1), ("b", 3), ("c", 4)}
    seg = spark.createDataFrame([("e", 1, "y", True), ("e", 0, "x", True), ("f", 0, "z", False)], "episode string, segment int, output string, ready boolean")
    assert [tuple(r) for r in sinks.concat_ready(seg).collect()] == [("e", ["x", "y"], "concat")]


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    (tmp_path / "in").mkdir()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = pending.hopping_counts(stream).writeStream.format("memory").queryName("hops").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    norm = lambda df: sorted((r.start, r.event_type, r.n, round(r.value, 4)) for r in df.collect())
    assert norm(spark.table("hops")) == norm(pending.hopping_counts(events))


def test_pending(spark):
    ask = spark.sql("SELECT 'a' AS custom_id, timestamp'2024-01-01' AS asked UNION ALL SELECT 'b', timestamp'2024-01-01'")
    got = spark.sql("SELECT 'a' AS answer_id, 'x' AS text, timestamp'2024-01-01 01:00:00' AS answered")
    assert {(r.custom_id, r.status) for r in pending.collect_answers(ask, got).collect()} == {("a", "ok"), ("b", "pending")}


def test_numbers_of_windows_need_no_sort(spark):
    tasks = spark.createDataFrame([(1, 7, 0, 95), (1, 8, 3, 5), (2, 9, 5, 5), (2, 10, 40, 55)], "episode long, task long, s long, e long")
    got = OPERATORS["action_jobs"].over(tasks=tasks)
    rows = {}
    for r in sorted(got.collect(), key=lambda r: (r.task, r.start_frame)):
        rows.setdefault(r.task, []).append((r.window_id, r.start_frame, r.end_frame))
    assert set(rows) == {7, 8, 10} and all([w for w, _, _ in x] == list(range(len(x))) for x in rows.values())
    assert rows[8] == [(0, 3, 4)] and rows[7][:2] == [(0, 0, 14), (1, 8, 22)] and rows[7][-1][2] == 94
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan


def test_model_calls_are_dealt_to_all_tasks(spark):
    """Requests that lie in one partition, as few bytes do, are asked in several tasks."""
    q = spark.range(40).selectExpr("CAST(id AS STRING) AS custom_id", "'p' AS prompt").coalesce(1)
    got = inference.call(q, inference.Stub).select(F.spark_partition_id().alias("p"), "custom_id").collect()
    assert len({r.p for r in got}) > 1 and len({r.custom_id for r in got}) == len(got) == 40


def test_tasks_are_validated_without_windows(spark):
    """One pass over the actions says what the SQL says: gaps, steps back, unknown ends, nulls, tasks that repeat or have none."""
    tasks = spark.createDataFrame([(1, 0, 6), (1, 0, 6), (1, 0, 5), (2, 0, 9), (3, None, 4), (4, 0, 1), (5, 2, 8), (None, 0, 6)], "task long, s long, e long")
    rows = [(1, 1, 0, 3, "a"), (1, 2, 3, 5, "b"), (1, 3, 5, 6, "b"), (2, 2, 4, 9, "a"), (2, 1, 0, 3, "b"), (3, 1, 0, 4, None), (3, 2, 4, None, "x"), (3, 3, None, 4, "w"), (5, 3, 2, 8, "a"), (5, 1, 2, 8, "a"), (6, 1, 0, 1, "z"), (None, 1, 0, 6, "n")]
    actions = spark.createDataFrame(rows, "task long, step long, s long, e long, caption string")
    got = OPERATORS["refine_validate"].over(tasks=tasks, actions=actions)
    want = Operator(captions.refine_validate).over(tasks=tasks, actions=actions)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
