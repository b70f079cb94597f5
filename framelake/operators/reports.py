"""Joins of frames with what was found in them, choice of inputs, benchmark figures and texts of reports.

Each is a function of DataFrames. Frames are matched by episode and frame number, never by place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions import columns as C

FRAME = ["episode", "frame_idx"]


def frame_detections(frames: DataFrame, *sources: DataFrame) -> DataFrame:
    """frames (episode, frame_idx) with `boxes`, those of all sources (episode, frame_idx, det_idx, x1, y1, x2, y2, conf) by
    source, then det_idx; empty for a frame without. A frame's boxes are few; boxes of other frames are left out."""
    box = F.struct(F.lit(0).alias("source"), "det_idx", "x1", "y1", "x2", "y2", "conf")
    every = reduce(DataFrame.union, (s.select(*FRAME, box.withField("source", F.lit(i)).alias("box")) for i, s in enumerate(sources)))
    found = every.groupBy(*FRAME).agg(F.array_sort(F.collect_list("box")).alias("boxes"))
    return frames.select(*FRAME).join(found, FRAME, "left").withColumn("boxes", F.coalesce("boxes", F.array().cast(found.schema["boxes"].dataType)))


def requested_frames(frames: DataFrame, ids: DataFrame) -> DataFrame:
    """The frames among the requested ids, each once however often it is asked for."""
    return frames.join(ids.select(*FRAME), FRAME, "left_semi")


def blurred_pairs(original: DataFrame, blurred: DataFrame, value: str) -> DataFrame:
    """Frames that both have, with the value of each."""
    take = lambda df, name: df.select(*FRAME, F.col(value).alias(name))
    return take(original, "original").join(take(blurred, "blurred"), FRAME)


def preferred_input(raw: DataFrame, blurred: DataFrame) -> DataFrame:
    """(episode, path): the blurred video where there is a valid one, else the raw one.

    A video is valid unless a column `bytes` or `codec` says that it is empty or can't be read. Of several of an episode the
    first by path counts; episodes without a valid video are left out.
    """

    def one(df: DataFrame, name: str) -> DataFrame:
        if "bytes" in df.columns:
            df = df.where("bytes > 0")
        if "codec" in df.columns:
            df = df.where("codec IS NOT NULL")
        return df.groupBy("episode").agg(F.min("path").alias(name))

    return one(raw, "raw").join(one(blurred, "blurred"), "episode", "full").select("episode", F.coalesce("blurred", "raw").alias("input"))


def by_episode(report: DataFrame) -> DataFrame:
    """A report in the order of its episodes."""
    return report.orderBy("episode")


def audio_remux(videos: DataFrame) -> DataFrame:
    """videos (path, audio_codec, original, original_audio) with `command`, which copies the original's sound into a video
    that has none; null where the video has sound or the original has not."""
    name = F.concat(C.folder(F.col("path")), F.lit("/"), C.stem(F.col("path")), F.lit("_audio_mux"), F.regexp_extract("path", r"(\.[^./]*)$", 1))
    args = [F.lit(x) for x in ("ffmpeg", "-y", "-i")] + [F.col("path"), F.lit("-i"), F.col("original")]
    args += [F.lit(x) for x in ("-map", "0:v:0", "-map", "1:a:0", "-c:v", "copy", "-c:a", "copy", "-shortest")] + [name]
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return videos.withColumn("command", F.when(blank("audio_codec") & ~blank("original_audio"), F.array(*args)))


def first_of(df: DataFrame, key: str, place: str) -> DataFrame:
    """Distinct keys in the order in which they come first."""
    return df.groupBy(key).agg(F.min(place).alias(place))


def phase_totals(metrics: DataFrame) -> DataFrame:
    """metrics (episode, video_sec, total_sec, win_in, win_out, ref_in, ref_out) with tokens in and out of both phases."""
    return metrics.withColumn("total_in", F.col("win_in") + F.col("ref_in")).withColumn("total_out", F.col("win_out") + F.col("ref_out"))


def benchmark(metrics: DataFrame) -> DataFrame:
    """One row: sums of tokens, mean lengths, the mean of the episodes' ratios, whole mean tokens. An episode of no length has no ratio."""
    m = phase_totals(metrics)
    sums = [F.sum(c).alias(f"sum_{c}") for c in ("win_in", "win_out", "ref_in", "ref_out", "total_in", "total_out")]
    ratio = F.try_divide(F.col("total_sec").cast("double"), F.col("video_sec").cast("double"))
    got = m.agg(F.count(F.lit(1)).alias("n"), *sums, F.avg("video_sec").alias("mean_video_sec"), F.avg("total_sec").alias("mean_total_sec"), F.avg(ratio).alias("mean_ratio"))
    return got.select("*", *(F.expr(f"IF(n > 0, sum_total_{d} DIV n, NULL)").alias(f"mean_{d}") for d in ("in", "out")))


# How a fault is told.
BLURRY, SHARPNESS = "模糊帧 %s帧 (%s)", "，平均清晰度 lap=%s"
JITTER = "剧烈抖动 %s处，最大位移 %spx，最大旋转 %.4frad"
OVEREXPOSED, UNDEREXPOSED = "过曝帧 %s帧 (%s)", "欠曝帧 %s帧 (%s)"


def quality_errors(summary: DataFrame) -> DataFrame:
    """summary (episode, n_blurry, blur_ratio, laplacian, jitter: array of (translation, rotation), n_over, over_ratio,
    n_under, under_ratio) with `errors`, a line for each fault in this order; empty if there is none."""
    c = F.col
    most = lambda f: F.coalesce(F.array_max(F.transform("jitter", lambda j: F.coalesce(j[f], F.lit(0.0)))), F.lit(0.0))
    sharp = F.when(c("laplacian").isNotNull(), F.format_string(SHARPNESS, C.tenths(c("laplacian")))).otherwise("")
    counted = lambda n, line, ratio: F.when(c(n) > 0, F.format_string(line, n, C.percent(c(ratio))))
    shaken = F.when(F.size("jitter") > 0, F.format_string(JITTER, F.size("jitter"), C.tenths(most("translation")), most("rotation")))
    lines = [F.concat(counted("n_blurry", BLURRY, "blur_ratio"), sharp), shaken, counted("n_over", OVEREXPOSED, "over_ratio"), counted("n_under", UNDEREXPOSED, "under_ratio")]
    return summary.withColumn("errors", F.array_compact(F.array(*lines)))


def hand_lines(any_hand: Column, left: Column, right: Column, both: Column, none: Column, one: Column, two: Column, active: Column, single: Column) -> Column:
    """Lines on hands: of detections if there is their ratio of frames with a hand, else of audited answers. Null ratios count as 0."""
    p, zero = C.percent0, lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    seen = F.array(F.concat(F.lit("Hands visible in "), p(any_hand), F.lit(" of sampled frames (left "), p(left), F.lit(", right "), p(right), F.lit(", both "), p(both), F.lit(")")))
    own = F.concat(F.lit("Ego hands visible in "), p(F.greatest(F.lit(0.0), 1 - zero(none))), F.lit(" of sampled frames (1 hand "), p(one), F.lit(", 2 hands "), p(two), F.lit(")"))
    acts = F.when(zero(active) > 0, F.concat(F.lit("Active manipulation detected in "), p(active), F.lit(" of sampled frames")))
    alone = F.concat(F.lit("Single-person operation in "), p(single), F.lit(" of sampled frames"))
    return F.when(any_hand.isNotNull(), seen).otherwise(F.array_compact(F.array(own, acts, alone)))


# The fields of a compact audit.
AUDIT = ("total_frames_sampled", "avg_ego_hand_count", "ego_0_hands_ratio", "ego_1_hand_ratio", "ego_2_hands_ratio", "active_manipulation_ratio", "single_person_operation_ratio")
SAMPLED = ("global_frame", "time_sec", "ego_hand_count", "active_manipulation", "single_person_operation")


def compact_audit(audits: DataFrame) -> DataFrame:
    """audits (episode, summary, frame_results) with the fields of a report alone; missing figures are 0, missing flags null."""
    short = F.struct(*(F.coalesce(F.col("summary")[k], F.lit(0)).alias(k) for k in AUDIT))
    row = lambda x: F.struct(*((F.coalesce(x[k], F.lit(0)) if i < 3 else x[k]).alias(k) for i, k in enumerate(SAMPLED)))
    return audits.select("episode", short.alias("summary"), F.coalesce(F.transform("frame_results", row), F.array()).alias("sampled_hand_counts"))
