"""Clusters of cuts and votes of segments over frames (episode, frame_idx, n, kind, cut), without a join by range: what meets a
segment meets it in a bucket, and clusters are a fold over a recording's sorted cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.ranges import overlaps
from framelake.operators import segmentation as G
from framelake.operators.cuts import BUCKET
from framelake.plans.dialect import SPARK
from framelake.sources.sinks import kept


def anchor_clusters(frames: DataFrame, radius: int = 6) -> DataFrame:
    """episode, anchor (the cluster's first cut), size, centre."""
    n, i = F.col("n"), F.col("frame_idx")
    w = F.when(n == 1, F.lit(1.0)).otherwise(F.lit(0.5) + F.lit(0.5) * F.cos(F.pi() * (1 - (n + 2) + 2 * (i + 1)) / (n + 1)))
    one = frames.where("cut").groupBy("episode").agg(F.array_sort(F.collect_list(F.struct(i.alias("f"), w.alias("w")))).alias("cuts"))
    done = "named_struct('anchor', s.anchor, 'size', s.size, 'sf', s.sf, 'sw', s.sw)"
    kind = "ARRAY<STRUCT<anchor: BIGINT, size: BIGINT, sf: DOUBLE, sw: DOUBLE>>"
    fold = f"""aggregate(cuts, named_struct('done', CAST(array() AS {kind}), 'anchor', CAST(0 AS BIGINT), 'size', 0L, 'sf', 0D, 'sw', 0D),
        (s, c) -> IF(s.size > 0 AND c.f - s.anchor <= {radius}, named_struct('done', s.done, 'anchor', s.anchor, 'size', s.size + 1, 'sf', s.sf + c.f * c.w, 'sw', s.sw + c.w),
            named_struct('done', IF(s.size > 0, array_append(s.done, {done}), s.done), 'anchor', c.f, 'size', 1L, 'sf', c.f * c.w, 'sw', c.w)),
        s -> array_append(s.done, {done}))"""
    return one.select("episode", F.explode(F.expr(fold)).alias("x")).select("episode", "x.anchor", "x.size", F.expr("CAST(round(x.sf / x.sw, 9) AS BIGINT)").alias("centre"))


def _segments(frames: DataFrame, least: int) -> DataFrame:
    return kept(frames.sparkSession.sql(G._segments(SPARK, least), frames=frames))


def _middle() -> tuple[Column, Column]:
    long = F.col("e") - F.col("s")
    return F.col("s") + (F.lit(0.4) * long).cast("long"), F.col("s") + (F.lit(0.6) * long).cast("long")


def vote_overlap(frames: DataFrame, least: int = 5, span: int = 3) -> DataFrame:
    """Segments with the majority of the spans (`span` frames from each) that touch their middle fifth; of ties the first."""
    a, b = _middle()
    segments = _segments(frames, least)
    spans = frames.select("episode", "kind", F.col("frame_idx").alias("from_"), (F.col("frame_idx") + span).alias("to_"))
    votes = overlaps(segments.withColumns({"mid_s": a, "mid_e": b}), spans, ["episode"], ("mid_s", "mid_e"), ("from_", "to_"), BUCKET).groupBy("episode", "s", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("from_").alias("first"))
    won = votes.groupBy("episode", "s").agg(F.min_by("kind", F.struct(-F.col("n"), "first")).alias("kind"), F.max("n").alias("n"))
    return segments.join(won, ["episode", "s"], "left").select("episode", "s", "e", F.coalesce("kind", F.lit("none")).alias("instruction"), F.coalesce("n", F.lit(0)).alias("votes"))


def vote_timeline(frames: DataFrame, least: int = 5, every: int = 4) -> DataFrame:
    """Majority at every `every`-th frame of the middle fifth; where there is none, of the whole segment. One pass for both."""
    a, b = _middle()
    segments = _segments(frames, least)
    line = frames.where(F.col("frame_idx") % every == 0).select("episode", "kind", F.col("frame_idx").alias("at_"), F.col("frame_idx").alias("at2_"))
    met = overlaps(segments.where("e > s").withColumn("last", F.col("e") - 1), line, ["episode"], ("s", "last"), ("at_", "at2_"), BUCKET)
    mid = F.col("at_").between(a, b)
    votes = met.groupBy("episode", "s", "e", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("at_").alias("first"), F.count_if(mid).alias("m"), F.min(F.when(mid, F.col("at_"))).alias("m_first"))
    inside = F.col("m") > 0
    won = votes.groupBy("episode", "s").agg(F.min_by("kind", F.struct(-F.col("n"), "first")).alias("all_"), F.max("n").alias("n_all"), F.min_by(F.when(inside, F.col("kind")), F.when(inside, F.struct(-F.col("m"), "m_first"))).alias("mid"), F.max(F.when(inside, F.col("m"))).alias("n_mid"))
    return segments.join(won, ["episode", "s"], "left").select("episode", "s", "e", F.coalesce("mid", "all_", F.lit("default")).alias("instruction"), F.coalesce("n_mid", "n_all", F.lit(0)).alias("votes"))


def task_segments(frames: DataFrame, radius: int = 6, least: int = 5) -> DataFrame:
    """Clusters' centres as cuts, minimum length, overlap votes; an episode without cuts is one segment."""
    centres = anchor_clusters(frames, radius).select("episode", F.col("centre").alias("frame_idx"), F.lit(True).alias("at_")).distinct()
    marked = frames.join(centres, ["episode", "frame_idx"], "left").select("episode", "frame_idx", "n", "kind", F.coalesce("at_", F.lit(False)).alias("cut"))
    return vote_overlap(kept(marked), least)


def subtitles(tasks: DataFrame, actions: DataFrame, every: int = 10) -> DataFrame:
    """task, frame, caption: the action that each `every`-th frame of a task is in, the first if several."""
    points = tasks.where("e > s").select("task", F.explode(F.sequence("s", F.col("e") - 1, F.lit(every).cast("long"))).alias("frame")).withColumn("frame2", F.col("frame"))
    spans = actions.where("e > s").select("task", "step", "caption", F.col("s").alias("from_"), (F.col("e") - 1).alias("to_"))
    return overlaps(points, spans, ["task"], ("frame", "frame2"), ("from_", "to_"), BUCKET).groupBy("task", "frame").agg(F.min_by("caption", "step").alias("caption"))
