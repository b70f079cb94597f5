"""Cache demand, the frame table, run documents, and stages whose steps run side by side."""

import base64
import json
import time

from pyspark.sql import functions as F

from framelake.operators import demand, imu, results
from framelake.plans import dag
from framelake.sources.frames import FrameTable

SETTING = "pipeline long, operator string, option string, value string"


def test_options_without_settings_are_the_defaults(spark):
    got = demand.cache_options(spark.range(2).select(F.col("id").alias("pipeline")), spark.createDataFrame([], SETTING)).collect()
    r = got[0].asDict()
    assert len(got) == 2 and (r["caption_method"], r["caption_window_sec"], r["caption_frames_per_window"], r["hand_frame_step"], r["caption_scene_frames"]) == ("segment_v2t", 10.0, 12, 120, 16)
    assert (r["include_caption"], r["include_hand_vlm"], r["include_video_quality"], r["quality_sample_fps"]) == (True, False, False, None)


def test_options_follow_their_readers_unless_set(spark):
    rows = [(1, "frame_cache", "caption_step_sec", "2"), (1, "video_segmentation", "step_sec", "4"), (1, "video_segmentation", "window_sec", "x"), (1, None, "hand_vlm_sample_frame_step", "9"), (1, "hand_analysis", "frame_step", "7"), (1, "hand_analysis", "method", "vlm"), (1, "frame_cache", "include_hand_vlm", "false"), (2, "hand_analysis", "method", None)]
    settings = spark.createDataFrame(rows, SETTING)
    pipelines = spark.createDataFrame([(1,), (2,), (1,)], "pipeline long")
    got = {r.pipeline: r for r in demand.cache_options(pipelines, settings).collect()}
    assert (got[1].caption_step_sec, got[1].caption_window_sec, got[1].hand_frame_step, got[1].include_hand_vlm) == (2.0, None, 9, False) and got[2].include_hand_vlm is False
    hands = {r.pipeline: (r.method, r.vlm_sample_frame_step, r.yolo_frame_step) for r in demand.hand_options(pipelines, settings).collect()}
    assert hands == {1: ("vlm", 9, None), 2: ("yolo", None, 1)}


def test_no_frames_of_an_empty_episode(spark):
    options = demand.cache_options(spark.createDataFrame([(1,)], "pipeline long"), spark.createDataFrame([(1, "hand_analysis", "method", "vlm"), (1, "video_quality", "sample_fps", "0")], SETTING))
    episodes = spark.createDataFrame([(1, 1, 0, 30.0), (1, 2, 1, 0.0), (1, 3, 250, 25.0)], "pipeline long, episode long, n long, fps double")
    got = {}
    for r in demand.wanted_frames(episodes, options).collect():
        got.setdefault((r.episode, r.profile), set()).add(r.frame_idx)
    assert set(got) == {(2, "vlm"), (2, "quality"), (3, "vlm"), (3, "quality")}
    assert got[2, "vlm"] == {0} and got[3, "quality"] == set(range(250)) and {0, 120, 240, 249} <= got[3, "vlm"]


def test_wanted_frames_stay_in_their_episodes_row(spark):
    options = demand.cache_options(spark.createDataFrame([(1,)], "pipeline long"), spark.createDataFrame([(1, "hand_analysis", "method", "vlm"), (1, "hand_analysis", "frame_step", "5")], SETTING))
    episodes = spark.createDataFrame([(1, e % 3, 90, 30.0) for e in range(6)], "pipeline long, episode long, n long, fps double")
    got = demand.wanted_frames(episodes, options)
    rows = [(r.episode, r.profile, r.frame_idx) for r in got.collect()]
    assert len(rows) == len(set(rows)) and {e for e, _, _ in rows} == {0, 1, 2}
    # what is told apart by an aggregation is episodes, below the generators, not frames
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "Aggregate" not in plan[: plan.rindex("Generate")]


def test_frames_are_decoded_once_and_given_whole(spark, tmp_path):
    log = str(tmp_path / "log")

    def decode(wanted):
        def note(episode, frame_idx):
            with open(log, "a") as f:
                f.write(f"{episode}/{frame_idx}\n")
            return f"{episode}/{frame_idx}".encode()

        return wanted.where("frame_idx < 20").withColumn("image", F.udf(note, "binary")("episode", "frame_idx"))

    table = FrameTable(str(tmp_path / "frames"), decode, buckets=4)
    wanted = spark.createDataFrame([(e, "vlm", r, f) for e in range(6) for r in range(3) for f in range(r * 5, r * 5 + 8)], "episode long, profile string, request long, frame_idx long")
    table.ensure(wanted.where("request = 0"))
    got = table.provide(wanted, ["episode", "request"]).collect()
    assert {(r.episode, r.request) for r in got} == {(e, r) for e in range(6) for r in range(3)} and all(bytes(r.image) == f"{r.episode}/{r.frame_idx}".encode() for r in got)
    calls = open(log).read().split()
    assert len(calls) == len(set(calls)) == 6 * 18
    half = wanted.select("episode", "profile", (F.col("request") + 1).alias("request"), (F.col("frame_idx") + 5).alias("frame_idx"))  # up to 22: the last lacks two
    assert {r.request for r in table.provide(half, ["episode", "request"]).collect()} == {1, 2}
    images = table.get_base64(wanted.where("episode = 1 AND request = 1"), ["episode", "request"]).first().images
    assert [base64.b64decode(x).decode() for x in images] == [f"1/{f}" for f in range(5, 13)]
    assert table.get(wanted.limit(0), ["episode", "request"]).count() == 0


def test_documents_of_runs(spark):
    steps = [("a", "caption", ["/o/a.json"]), ("a", "segment_video", ["/o/1.mp4", "/o/2.mp4"]), ("b", "caption", ["/o/b.json"]), ("c", "caption", ["/o/c.json"]), ("c", "quality", ["/o/q.json"])]
    rows = spark.createDataFrame([(w, o, "ok", x, {}, [], []) for w, o, x in steps], dag.RESULT)
    runs = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "run long, work string, input long")
    logs = spark.createDataFrame([(r, f"2024-01-0{i}", "INFO", f'say "{i}"', "caption") for r in (1, 3) for i in (2, 1)], "run long, at string, level string, message string, operator string")
    got = {r.run: json.loads(r.value) for r in results.documents(results.from_steps(rows, runs), logs).collect()}
    assert [x["name"] for x in got[1]["artifacts"]] == ["a.json", "1.mp4", "2.mp4", "b.json", "caption_manifest.json"]
    assert got[1]["artifacts"][-1]["data"] == {"inputCount": 2, "captions": ["/o/a.json", "/o/b.json"]}
    assert [x["message"] for x in got[1]["logs"]] == ['say "1"', 'say "2"'] and got[1]["resourceSeries"] == []
    assert [x["name"] for x in got[2]["artifacts"]] == ["c.json"] and got[2]["logs"] == []
    assert got[3]["artifacts"] == [] and len(got[3]["logs"]) == 2
    assert got[1]["artifacts"][1]["metadata"] == {"inputPath": "a", "inputIndex": 1, "inputCount": 2, "outputIndex": 1, "outputCount": 2}


def test_documents_of_steps_gather_no_json(spark):
    steps = [("a", "caption", ["/o/a.json"]), ("a", "segment_video", ["/o/1.mp4", "/o/2.mp4"]), ("a", "caption", ["/o/z.json", "/o/b.json"]), ("b", "caption", ["/o/b.json"]), ("c", "quality", ["/o/q.json"]), ("d", "caption", []), ("e", "segments", ["/o/s.json"])]
    rows = spark.createDataFrame([(w, o, "ok" if w != "b" else None, x, {}, [], []) for w, o, x in steps], dag.RESULT)
    runs = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (4, "d", 1), (5, "d", 1), (5, "a", 2), (6, "e", 1)], "run long, work string, input long")
    logs = spark.createDataFrame([(r, "2024", "INFO", "m", "caption") for r in (1, 3, 4)], "run long, at string, level string, message string, operator string")
    got = results.step_documents(rows, runs, logs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, results.documents(results.from_steps(rows, runs), logs).collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "payloadPath" in plan and all("payloadPath" not in x[:200] for x in plan.split("collect_list(")[1:])


def test_steps_of_a_stage_run_side_by_side_and_all_fan_out(spark):
    def slow(name, **kw):
        def wait(x):
            time.sleep(1.5)
            return x

        return lambda w: w.coalesce(1).withColumn("work", F.udf(wait)("work")).select(*dag.result(operator=name, **kw))

    reg = dag.Registry()
    reg.add(dag.Step("cut", slow("cut", outputs="array(concat(work, '/0'))"), fan_out=True))
    reg.add(dag.Step("split", slow("split", outputs="array(concat(work, '/1'), concat(work, '/2'))"), fan_out=True))
    reg.add(dag.Step("blur", lambda w: w.select(*dag.result(operator="blur")), ("cut", "split")))
    work = spark.createDataFrame([("a",)], "work string")
    spark.range(1).count()
    began = time.monotonic()
    got = dag.run(reg, work).collect()
    took = time.monotonic() - began
    assert sorted(r.work for r in got if r.operator == "blur") == ["a/0", "a/1", "a/2"]
    steps = [float(r.metrics["step_sec"]) for r in got if r.operator in ("cut", "split")]
    assert min(steps) >= 1.5 and took < sum(steps) + 2


def test_motion_files(spark, tmp_path):
    import numpy as np
    import pandas as pd

    r = np.random.default_rng(3)
    for name, n in (("ep1", 200), ("ep2", 120), ("ep3", 60)):
        (tmp_path / name).mkdir()
        lh, rh = r.normal(0, 3, (n, 3)), r.normal(0, 3, (n, 3))
        rows = {"lh_imu_accel": list(lh), "rh_imu_accel": [None, *rh[1:]] if name == "ep3" else list(rh), "other": range(n)}
        pd.DataFrame(rows).to_parquet(tmp_path / name / "frames.parquet")
        if name == "ep1":
            value = np.linalg.norm(lh - lh.mean(0), axis=1) + np.linalg.norm(rh - rh.mean(0), axis=1)
            want = imu.peaks(-imu.smooth(value)).tolist()
    (tmp_path / "ep4").mkdir()
    (tmp_path / "ep4" / "frames.parquet").write_bytes(b"no parquet at all")
    signals = imu.read_signals(spark, [str(tmp_path / f"ep{i}") for i in (1, 2, 3, 4)])
    got = {}
    for x in imu.hand_valleys(signals).collect():
        got.setdefault(x.episode, []).append(x.mark)
    assert set(got) <= {"ep1", "ep2"} and sorted(got["ep1"]) == want and want
