"""The operators as steps of a run: each takes work rows and gives rows of `dag.RESULT`, dispatched by its settings.

`Tools` says what stands behind the steps: episodes, the model, the detector, the runner of commands. A step computes for
all its work at once; an episode's failure is its row's status.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.columns import METHODS
from framelake.operators import blur, clips, demand, flows
from framelake.plans.dag import Registry, Step
from framelake.sources.frames import FrameTable


@dataclass(frozen=True)
class Tools:
    """episodes: of work rows (work), those that are known, with episode, n, fps, path. options: as of `demand.cache_options`, one row. sops, valleys, audits: see the flows.

    checks: work, pass, a quality verdict; audits: episode, frame_idx, prompt, the frames for hand audits, and hands: episode,
    hands, what a detector saw.
    """

    episodes: Callable[[DataFrame], DataFrame]
    ask: flows.Ask
    look: blur.Look
    runner: Callable[[], clips.Runner]
    method: str = "task"
    hand_method: str = "yolo"
    sops: DataFrame | None = None
    valleys: DataFrame | None = None
    checks: DataFrame | None = None
    audits: DataFrame | None = None
    hands: DataFrame | None = None
    frames: FrameTable | None = None
    options: DataFrame | None = None
    spec: Callable[[DataFrame], DataFrame] | None = None


def _rows(work: DataFrame, got: DataFrame, operator: str, missing: str) -> DataFrame:
    """RESULT rows of `got` (work, status, outputs, metrics, errors); work that isn't among it is an error, `missing`."""
    texts = F.array().cast("array<string>")
    rows = work.select("work").join(got, "work", "left")
    there = F.col("status").isNotNull()
    return rows.select(
        "work", F.lit(operator).alias("operator"), F.coalesce("status", F.lit("error")).alias("status"), F.coalesce("outputs", texts).alias("outputs"),
        F.coalesce("metrics", F.expr("CAST(map() AS map<string,string>)")).alias("metrics"), F.when(there, F.coalesce("errors", texts)).otherwise(F.array(F.lit(missing))).alias("errors"), texts.alias("notes"),
    )


def _metrics(*names: str) -> Column:
    return F.map_filter(F.create_map(*(x for n in names for x in (F.lit(n), F.col(n).cast("string")))), lambda _, v: v.isNotNull()).alias("metrics")


def _none() -> Column:
    return F.array().cast("array<string>")


def frame_cache(tools: Tools) -> Callable[[DataFrame], DataFrame]:
    """Decodes what the consumers want, once; an episode of which nothing is wanted is skipped."""

    def run(work: DataFrame) -> DataFrame:
        of = tools.episodes(work)
        wanted = demand.wanted_frames(of.select(F.lit(0).alias("pipeline"), "episode", "n", "fps"), tools.options.withColumn("pipeline", F.lit(0)))
        if tools.frames is not None:
            tools.frames.ensure(wanted)
        n = lambda profile: F.count_if(F.col("profile") == profile)
        counts = wanted.groupBy("episode").agg(n("vlm").alias("cached_vlm_frame_count"), n("quality").alias("cached_quality_frame_count"))
        rows = of.join(counts, "episode", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("cached_vlm_frame_count", "cached_quality_frame_count")})
        some = F.col("cached_vlm_frame_count") + F.col("cached_quality_frame_count") > 0
        got = rows.select("work", F.when(some, "ok").otherwise("skipped").alias("status"), F.when(some, F.array(F.concat(F.col("path"), F.lit("/.frame_cache")))).otherwise(_none()).alias("outputs"), _metrics("cached_vlm_frame_count", "cached_quality_frame_count"), F.when(some, _none()).otherwise(F.array(F.lit("No precomputable frame requests for this episode"))).alias("errors"))
        return _rows(work, got, "frame_cache", "video not found")

    return run


def video_segmentation(tools: Tools) -> Callable[[DataFrame], DataFrame]:
    """Captions by the method; unknown names of methods are an error of the settings."""
    method = METHODS.get(tools.method.strip().lower(), tools.method.strip().lower())

    def run(work: DataFrame) -> DataFrame:
        of = tools.episodes(work)
        one = of.select("episode", "n", "fps")
        if method == "task":
            rows = flows.task_captions(one, tools.ask).select("episode", "scene", "status", F.lit(0).alias("actions"), F.when(F.col("status") == "error", F.col("caption")).alias("why"))
        elif method == "atomic_action":
            rows = flows.two_level_captions(one, tools.ask).select("episode", "scene", F.lit("ok").alias("status"), F.size("actions").alias("actions"), F.lit(None).cast("string").alias("why"))
        elif method == "sop":
            rows = flows.sop_captions(one, tools.sops, tools.valleys, tools.ask).select("episode", "scene", F.lit("ok").alias("status"), F.lit(1).alias("actions"), F.lit(None).cast("string").alias("why"))
        else:
            raise ValueError(f"unknown method {tools.method!r}")
        count = rows.groupBy("episode").agg(F.max("status").alias("worst"), F.count_if(F.col("status") == "ok").alias("total_tasks"), F.sum("actions").alias("total_actions"), F.first("scene").alias("scene"), F.max("why").alias("why"))
        bad = F.col("worst").isNotNull() & (F.col("total_tasks") == 0)
        got = of.join(count, "episode").select("work", F.when(bad, "error").otherwise("ok").alias("status"), F.when(bad, _none()).otherwise(F.array(F.concat(F.col("path"), F.lit("/caption.json")))).alias("outputs"), _metrics("total_tasks", "total_actions", "scene"), F.when(bad, F.array("why")).otherwise(_none()).alias("errors"))
        return _rows(work, got, "video_segmentation", "no caption: the episode is unknown, empty, or has no procedure")

    return run


def privacy_blur(tools: Tools) -> Callable[[DataFrame], DataFrame]:
    def run(work: DataFrame) -> DataFrame:
        of = tools.episodes(work)
        got = blur.summary(of.select("episode", "n"), blur.detections(of.select("episode", "n"), tools.look), tools.look)
        rows = of.select("work", "episode", "path").join(got, "episode").select("work", F.lit("ok").alias("status"), F.array(F.concat(F.col("path"), F.lit("/rgb_blurred.mp4"))).alias("outputs"), _metrics("total_frames", "detections_total", "frames_with_detections", "unique_detection_frames"), _none().alias("errors"))
        return _rows(work, rows, "privacy_blur", "video not found")

    return run


def video_quality(tools: Tools) -> Callable[[DataFrame], DataFrame]:
    def run(work: DataFrame) -> DataFrame:
        rows = tools.checks.select("work", F.when(F.col("pass"), "ok").otherwise("fail").alias("status"), _none().alias("outputs"), _metrics("pass"), F.when(F.col("pass"), _none()).otherwise(F.array(F.lit("quality check failed"))).alias("errors"))
        return _rows(work, rows, "video_quality", "no frame could be judged")

    return run


def hand_analysis(tools: Tools) -> Callable[[DataFrame], DataFrame]:
    """By detector, a count of what it saw; by model, an audit of sampled frames, of which answers that can't be read don't count."""
    method = tools.hand_method.strip().lower()
    if method not in ("yolo", "vlm"):
        raise ValueError(f"hand method must be yolo or vlm, not {tools.hand_method!r}")

    def run(work: DataFrame) -> DataFrame:
        of = tools.episodes(work)
        if method == "yolo":
            counts = tools.hands.groupBy("episode").agg(F.count(F.lit(1)).alias("frames"), F.count_if(F.col("hands") > 0).alias("with_hands"))
        else:
            asked = tools.audits.join(of.select("episode"), "episode", "left_semi").withColumn("custom_id", F.format_string("%s/hand_%d", F.col("episode").cast("string"), F.col("frame_idx")))
            hands = F.expr("try_variant_get(try_parse_json(text), '$.ego_hand_count', 'int')")
            counts = tools.ask(asked.select("custom_id", "prompt")).withColumn("hands", hands).where("hands IS NOT NULL").groupBy(F.split("custom_id", "/")[0].cast("long").alias("episode")).agg(F.count(F.lit(1)).alias("frames"), F.count_if(F.col("hands") > 0).alias("with_hands"))
        rows = of.join(counts, "episode").select("work", F.lit("ok").alias("status"), F.array(F.concat(F.col("path"), F.lit("/hand_analysis.json"))).alias("outputs"), _metrics("frames", "with_hands"), _none().alias("errors"))
        return _rows(work, rows, "hand_analysis", "no frame could be judged")

    return run


def segment_cut(tools: Tools, plan: Callable[[DataFrame], DataFrame], existing: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Clips of a plan (as of `clips.cut_clips`, with work); the clips' folders are the work of what follows."""

    def run(work: DataFrame) -> DataFrame:
        of = tools.episodes(work)
        cut = clips.cut_clips(plan(of), existing, tools.runner)
        made = F.array_sort(F.collect_list(F.when(F.col("how") != "failed", F.regexp_replace("output", "/[^/]*$", ""))))
        rows = clips.manifest(cut).join(cut.groupBy("episode").agg(made.alias("dirs")), "episode").join(of.select("work", "episode"), "episode")
        bad = F.col("status") == "failed"
        got = rows.select("work", F.when(bad, "error").otherwise("ok").alias("status"), F.col("dirs").alias("outputs"), _metrics("requested", "successful", "failed", "cached", "copied", "reencoded"), F.when(bad, F.array(F.lit("no clip could be cut"))).otherwise(_none()).alias("errors"))
        return _rows(work, got, "segment_cut", "no caption to cut by")

    return run


def transcode(tools: Tools, probe: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    def run(work: DataFrame) -> DataFrame:
        of = tools.episodes(work)
        done = clips.transcoded(tools.spec(of), tools.runner, probe).join(of.select("work", F.col("episode").alias("media")), "media")
        rows = done.select("work", "status", F.when(F.col("status") == "ok", F.array("output")).otherwise(_none()).alias("outputs"), F.expr("CAST(map() AS map<string,string>)").alias("metrics"), F.when(F.col("error").isNotNull(), F.array("error")).otherwise(_none()).alias("errors"))
        return _rows(work, rows, "transcode", "video not found")

    return run


#: Fixed: which operators come after which, as far as both are enabled.
AFTER = {"frame_cache": (), "video_segmentation": ("frame_cache",), "segment_cut": ("video_segmentation",), "video_quality": ("frame_cache",), "hand_analysis": ("frame_cache",), "privacy_blur": (), "transcode": ("privacy_blur",)}


def registry(steps: dict[str, Callable[[DataFrame], DataFrame]], off: frozenset[str] = frozenset()) -> Registry:
    """The steps that aren't off, in their order; without captions nothing is cut."""
    out = Registry()
    for name, after in AFTER.items():
        if name in steps and name not in off and not (name == "segment_cut" and "video_segmentation" in off):
            out.add(Step(name, steps[name], after, fan_out=name == "segment_cut"))
    return out
