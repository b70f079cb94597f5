"""What the frame cache must hold: its options, derived from those of the operators that read it, and the frames these want.

Settings: pipeline, operator (empty for the pipeline's own), option, value (text). One row a pipeline is made of them by
one aggregation; then all is columns. Frames of captions and hands share a profile, those of quality checks have their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.operators import cuts

#: Fixed names: an option of the cache, where it is looked for after the cache's own settings, its default, and its type.
COPIED = (
    ("caption_method", ("video_segmentation.method",), "segment_v2t", "string"),
    ("caption_window_sec", ("video_segmentation.window_sec",), "10.0", "double"),
    ("caption_step_sec", ("video_segmentation.step_sec",), "5.0", "double"),
    ("caption_frames_per_window", ("video_segmentation.frames_per_window",), "12", "int"),
    ("caption_task_window_sec", ("video_segmentation.task_window_sec",), "12.0", "double"),
    ("caption_task_step_sec", ("video_segmentation.task_step_sec",), "6.0", "double"),
    ("caption_task_frames_per_window", ("video_segmentation.task_frames_per_window",), "12", "int"),
    ("caption_action_window_sec", ("video_segmentation.action_window_sec",), "6.0", "double"),
    ("caption_action_step_sec", ("video_segmentation.action_step_sec",), "3.0", "double"),
    ("caption_action_frames_per_window", ("video_segmentation.action_frames_per_window",), "8", "int"),
    ("hand_frame_step", (".hand_vlm_sample_frame_step", "hand_analysis.frame_step"), "120", "int"),
    ("quality_sample_fps", ("video_quality.sample_fps",), None, "double"),
)
SCENE_FRAMES = 16
TWO_LEVEL = "task_action_v2t"


def _by_pipeline(settings: DataFrame) -> DataFrame:
    """pipeline and a map `operator.option` to value; of repeated settings the greatest value counts."""
    one = settings.where("value IS NOT NULL").groupBy("pipeline", F.concat_ws(".", F.coalesce("operator", F.lit("")), "option").alias("k")).agg(F.max("value").alias("v"))
    return one.groupBy("pipeline").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m"))


def _get(*keys: str, default: str | None = None) -> Column:
    return F.coalesce(*(F.try_element_at("m", F.lit(k)) for k in keys), F.lit(default).cast("string"))


def cache_options(pipelines: DataFrame, settings: DataFrame) -> DataFrame:
    """The frame cache's options of each pipeline (column pipeline): its own where they are set, else what its readers' say."""
    rows = pipelines.select("pipeline").distinct().join(_by_pipeline(settings), "pipeline", "left").withColumn("m", F.coalesce("m", F.expr("CAST(map() AS map<string,string>)")))
    flag = lambda key: F.coalesce(F.lower(F.trim(_get(key))).isin("1", "true", "yes", "y", "on"), F.lit(True))
    own = lambda name, else_: F.coalesce(F.lower(F.trim(_get(f"frame_cache.{name}"))).isin("1", "true", "yes", "y", "on"), else_).alias(name)
    cols = [F.coalesce(_get(f"frame_cache.{name}", *keys, default=default)).try_cast(kind).alias(name) for name, keys, default, kind in COPIED]
    return rows.select(
        "pipeline", *cols, own("include_caption", flag("video_segmentation.enabled")), own("include_hand_vlm", flag("hand_analysis.enabled") & (F.lower(_get("hand_analysis.method", default="yolo")) == "vlm")),
        own("include_video_quality", flag("video_quality.enabled") & _get("video_quality.sample_fps").isNotNull()), F.coalesce(_get("frame_cache.caption_scene_frames").try_cast("int"), F.lit(SCENE_FRAMES)).alias("caption_scene_frames"),
    )


def hand_options(pipelines: DataFrame, settings: DataFrame) -> DataFrame:
    """pipeline, method, vlm_sample_frame_step, yolo_frame_step of the hand operator: an old `frame_step` goes to the method in
    use, a pipeline's own step for model samples before it."""
    rows = pipelines.select("pipeline").distinct().join(_by_pipeline(settings), "pipeline", "left").withColumn("m", F.coalesce("m", F.expr("CAST(map() AS map<string,string>)")))
    method, vlm = F.lower(_get("hand_analysis.method", default="yolo")), F.lower(_get("hand_analysis.method", default="yolo")) == "vlm"
    return rows.select("pipeline", method.alias("method"), F.when(vlm, _get(".hand_vlm_sample_frame_step", "hand_analysis.frame_step", default="120")).otherwise(_get("hand_analysis.vlm_sample_frame_step")).try_cast("int").alias("vlm_sample_frame_step"), F.when(~vlm, _get("hand_analysis.yolo_frame_step", "hand_analysis.frame_step", default="1")).otherwise(_get("hand_analysis.yolo_frame_step")).try_cast("int").alias("yolo_frame_step"))


def wanted_frames(episodes: DataFrame, options: DataFrame) -> DataFrame:
    """pipeline, episode, profile (vlm or quality), frame_idx: each frame once. Episodes: pipeline, episode, n, fps; an episode
    has one length in a pipeline. Its frames are made and told apart in its own row, so none is shuffled."""
    base = episodes.select("pipeline", "episode", "n", "fps").where("n > 0").distinct().join(options, "pipeline").withColumns({"low": F.lit(0).cast("long"), "high": F.col("n").cast("long"), "fps": F.when(F.col("fps") > 0, F.col("fps").cast("double")).otherwise(30.0)})
    two = F.coalesce(F.lower("caption_method") == TWO_LEVEL, F.lit(False))
    none = F.array().cast("array<long>")
    at = lambda name: F.col(f"caption_{name}")
    # a scene's sample is one window over the whole
    scene = F.when(at("scene_frames") > 0, cuts.sampled(F.col("high") / F.col("fps"), F.col("high") / F.col("fps"), at("scene_frames")))
    tasks = cuts.sampled(at("task_window_sec"), at("task_step_sec"), at("task_frames_per_window"))
    plain = F.when(at("method").isNotNull(), cuts.sampled(at("window_sec"), at("step_sec"), at("frames_per_window")))
    caption = F.when(F.col("include_caption"), F.when(two, F.concat(F.coalesce(tasks, none), F.coalesce(scene, none))).otherwise(plain))
    step = F.greatest(F.lit(1), F.col("hand_frame_step")).cast("long")
    hand = F.when(F.col("include_hand_vlm"), F.array_append(F.sequence("low", F.col("high") - 1, step), F.col("high") - 1))
    every = F.when((F.col("quality_sample_fps") > 0) & (F.col("quality_sample_fps") < F.col("fps")), F.greatest(F.lit(1), F.rint(F.col("fps") / F.col("quality_sample_fps")).cast("long"))).otherwise(F.lit(1)).cast("long")
    quality = F.when(F.col("include_video_quality") & F.col("quality_sample_fps").isNotNull(), F.sequence("low", F.col("high") - 1, every))
    vlm = F.array_distinct(F.concat(F.coalesce(caption, none), F.coalesce(hand, none)))
    rows = base.select("pipeline", "episode", F.explode(F.array(F.struct(F.lit("vlm").alias("profile"), vlm.alias("f")), F.struct(F.lit("quality").alias("profile"), quality.alias("f")))).alias("x"))
    return rows.select("pipeline", "episode", "x.profile", F.explode("x.f").alias("frame_idx"))
