"""All seven operators as steps of one run, with stand-ins behind them."""

import pytest
from pyspark.sql import functions as F

from framelake.operators import blur, demand, inference
from framelake.plans import adapters, dag
from framelake.plans.media import ByDigits, Pattern


def tools(spark, **kw):
    known = spark.createDataFrame([("a", 1, 1500, 10.0, "/d/a"), ("b", 2, 40, 10.0, "/d/b"), ("c", 3, 0, 10.0, "/d/c")], "work string, episode long, n long, fps double, path string")

    def of(work):
        parts = work.select("work", F.split("work", "/")[0].alias("top")).distinct()
        return parts.join(known.withColumnRenamed("work", "top"), "top").drop("top")

    options = demand.cache_options(spark.createDataFrame([(0,)], "pipeline long"), spark.createDataFrame([], "pipeline long, operator string, option string, value string"))
    checks = spark.createDataFrame([("a", True), ("b", False)], "work string, pass boolean")
    audits = spark.createDataFrame([(e, f, f"hands? {e} {f}") for e in (1, 2) for f in (0, 10, 20)], "episode long, frame_idx long, prompt string")
    hands = spark.createDataFrame([(1, 0), (1, 2), (2, 1)], "episode long, hands int")
    base = {"episodes": of, "ask": inference.Direct(inference.Scripted), "look": blur.Look(Pattern, step=5), "runner": ByDigits, "options": options, "checks": checks, "audits": audits, "hands": hands}
    return adapters.Tools(**base | kw)


def plan(of):
    rows = of.select("work", "episode", F.explode(F.array(*map(F.lit, range(3)))).alias("segment"))
    k = F.col("episode") * 10 + F.col("segment")
    return rows.select("episode", F.col("segment").cast("long"), F.format_string("seg_%03d", "segment").alias("segment_id"), F.concat("work", F.lit("/seg"), "segment", F.lit("/rgb.mp4")).alias("output"), F.format_string("copy %d", k).alias("copy"), F.format_string("encode %d", k).alias("encode"), F.lit(None).cast("string").alias("reason"))


def by_step(rows):
    out = {}
    for r in rows:
        out.setdefault(r.operator, {})[r.work] = r
    return out


def test_a_run_of_all_operators(spark):
    t = tools(spark, spec=lambda of: of.select(F.col("episode").alias("media"), F.lit(0).alias("spec"), F.concat("path", F.lit("/out.mp4")).alias("output"), F.format_string("encode %d", F.col("episode") - 1).alias("command"), F.lit(None).cast("string").alias("error")))
    none = spark.createDataFrame([], "output string, bytes long")
    steps = {"frame_cache": adapters.frame_cache(t), "video_segmentation": adapters.video_segmentation(t), "segment_cut": adapters.segment_cut(t, plan, none), "video_quality": adapters.video_quality(t), "hand_analysis": adapters.hand_analysis(t), "privacy_blur": adapters.privacy_blur(t), "transcode": adapters.transcode(t, lambda df: df.select("media", "spec", F.lit("h264").alias("codec")))}
    reg = adapters.registry(steps)
    assert [[s.name for s in stage] for stage in reg.stages()] == [["frame_cache", "privacy_blur"], ["video_segmentation", "video_quality", "hand_analysis", "transcode"], ["segment_cut"]]
    work = spark.createDataFrame([("a",), ("b",), ("c",), ("unknown",)], "work string")
    got = by_step(dag.run(reg, work).collect())
    status = {o: {w: r.status for w, r in rows.items()} for o, rows in got.items()}
    assert status["frame_cache"] == {"a": "ok", "b": "ok", "c": "skipped", "unknown": "error"} and int(got["frame_cache"]["a"].metrics["cached_vlm_frame_count"]) > 100
    assert status["privacy_blur"]["a"] == "ok" and got["privacy_blur"]["a"].metrics["total_frames"] == "1500" and status["privacy_blur"]["unknown"] == "error"
    assert status["video_segmentation"]["a"] == "ok" and status["video_segmentation"]["c"] == "error" and got["video_segmentation"]["a"].outputs == ["/d/a/caption.json"]
    assert status["video_quality"] == {"a": "ok", "b": "fail", "c": "error", "unknown": "error"}
    assert got["hand_analysis"]["a"].metrics["frames"] == "2" and got["hand_analysis"]["a"].metrics["with_hands"] == "1"
    assert status["transcode"]["a"] == "ok" and status["transcode"]["b"] == "error" and got["transcode"]["b"].errors == ["cannot encode 1"]
    assert got["segment_cut"]["a"].metrics["requested"] == "3" and all(x.startswith("a/seg") for x in got["segment_cut"]["a"].outputs)
    assert all("step_sec" in r.metrics for rows in got.values() for r in rows.values())


def test_methods_are_dispatched(spark):
    work = spark.createDataFrame([("a",), ("b",)], "work string")
    for method in ("segment_v2t", " ATOMIC ", "sop"):
        sops = spark.createDataFrame([(1, "pouring", [(1, "open it"), (2, "pour")])], "episode long, task_name string, steps array<struct<step:int,description:string>>")
        t = tools(spark, method=method, sops=sops, valleys=spark.createDataFrame([(1, 100)], "episode long, mark long"))
        got = {r.work: r for r in adapters.video_segmentation(t)(work).collect()}
        assert got["a"].status == "ok" and int(got["a"].metrics["total_tasks"]) >= 1
        assert got["b"].status == ("error" if method == "sop" else "ok")
    with pytest.raises(ValueError, match="unknown method"):
        adapters.video_segmentation(tools(spark, method="other"))(work)
    audit = tools(spark, hand_method="VLM", ask=inference.Direct(inference.Stub))
    got = {r.work: r for r in adapters.hand_analysis(audit)(work).collect()}
    assert got["a"].metrics["frames"] == "3" and got["b"].status == "ok"
    with pytest.raises(ValueError, match="hand method"):
        adapters.hand_analysis(tools(spark, hand_method="other"))


def test_without_captions_nothing_is_cut(spark):
    steps = {n: (lambda w: w) for n in adapters.AFTER}
    assert {s.name for stage in adapters.registry(steps, frozenset({"video_segmentation"})).stages() for s in stage} == set(adapters.AFTER) - {"video_segmentation", "segment_cut"}
