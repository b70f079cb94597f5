"""Queries of the blur driver and of cutting clips over the driver's tables, with stand-ins, and SQL of their own.

The stand-in detector finds a face or a plate by arithmetic on episode and frame; the stand-in runner succeeds, fails, or
leaves no file by the command's digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.operators import blur, clips


class Pattern:
    """Faces for a while, plates for a shorter while; every fourth time both are one box."""

    def faces(self, episode: int, frame_idx: int) -> list[blur.Box]:
        return [[frame_idx % 50, 10.0, frame_idx % 50 + 20, 40.0]] if (frame_idx // 9 + episode) % 3 == 0 else []

    def plates(self, episode: int, frame_idx: int) -> list[blur.Box]:
        return [[frame_idx % 50, 10.0, frame_idx % 50 + (20 if frame_idx % 4 == 0 else 5), 40.0]] if (frame_idx // 5 + episode) % 4 == 1 else []


STEP = 6


def blur_flow(events: DataFrame) -> DataFrame:
    episodes = events.groupBy(F.col("user_id").alias("episode")).agg(F.count(F.lit(1)).alias("n"))
    look = blur.Look(Pattern, blur.DEDUPING, step=STEP)
    got = blur.summary(episodes, blur.detections(episodes, look), look)
    return got.withColumn("positive_ranges", F.array_join(F.transform("positive_ranges", lambda r: F.format_string("%d-%d", r["start_frame"], r["end_frame"])), ","))


_BLUR = f"""WITH ep AS (SELECT user_id AS episode, count(*) AS n FROM events GROUP BY user_id),
    fr AS MATERIALIZED (SELECT episode, n, f, CASE WHEN (f // 9 + episode) % 3 = 0 THEN 1 ELSE 0 END AS a, CASE WHEN (f // 5 + episode) % 4 = 1 THEN 1 ELSE 0 END AS b FROM (SELECT *, unnest(range(0, n)) AS f FROM ep) x),
    hit AS (SELECT episode, n, f, a + b - CASE WHEN a + b = 2 AND f % 4 = 0 THEN 1 ELSE 0 END AS k FROM fr WHERE a + b > 0),
    run AS (SELECT episode, n, min(f) AS s, max(f) AS e, sum(k) AS k FROM (SELECT *, f - row_number() OVER (PARTITION BY episode ORDER BY f) AS g FROM hit) y GROUP BY episode, n, g HAVING count(*) FILTER (WHERE f % {STEP} = 0) > 0),
    seen AS (SELECT episode, f FROM fr WHERE f % {STEP} = 0 UNION SELECT episode, unnest(range(greatest(s - 1, 0), least(e + 1, n - 1) + 1)) FROM run)
    SELECT ep.episode, ep.n AS total_frames, CAST(coalesce(r.k, 0) AS BIGINT) AS detections_total, CAST(coalesce(r.frames, 0) AS BIGINT) AS frames_with_detections, 'yolo' AS detector_backend, 'sampling_expand' AS detection_mode, (ep.n + {STEP - 1}) // {STEP} AS sampled_frames,
        (SELECT count(*) FROM hit h WHERE h.episode = ep.episode AND h.f % {STEP} = 0) AS sample_hit_frames, s.c AS unique_detection_frames, CAST(coalesce(r.grown, 0) AS BIGINT) AS unique_expanded_frames, coalesce(r.listed, '') AS positive_ranges
    FROM ep LEFT JOIN (SELECT episode, sum(k) AS k, sum(e - s + 1) AS frames, sum(e - s) AS grown, string_agg(s || '-' || e, ',' ORDER BY s) AS listed FROM run GROUP BY episode) r ON r.episode = ep.episode JOIN (SELECT episode, count(*) AS c FROM seen GROUP BY episode) s ON s.episode = ep.episode"""


class ByDigits:
    """`copy K`, `encode K`: what happens follows from K."""

    def run(self, command: str, output: str) -> tuple[bool, int | None, str]:
        what, k = command.split()
        k = int(k) % (4 if what == "copy" else 5)
        return [(True, 100, ""), (False, None, f"cannot {command}"), (True, 0, ""), (False, 7, "late")][k % 4] if what == "copy" else [(True, 50, ""), (False, 9, f"cannot {command}"), (True, None, ""), (True, 1, ""), (True, 2, "")][k]


def clip_cuts(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Clips of line items: some can't be cut, some are there."""
    # smaller parts than the session's: a task sorts both sides and gathers
    parts = 4 * int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = lineitem.select("l_orderkey", "l_linenumber").repartition(parts, "l_orderkey").join(orders.select("o_orderkey").repartition(parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    plan = rows.groupBy(F.col("l_orderkey").alias("episode"), F.col("l_linenumber").cast("long").alias("segment")).agg(F.max(k).alias("k"))
    plan = plan.select("episode", "segment", F.format_string("seg_%03d", F.col("segment")).alias("segment_id"), F.format_string("/c/%d/%d.mp4", F.col("episode"), F.col("segment")).alias("output"), F.format_string("copy %d", F.col("k")).alias("copy"), F.format_string("encode %d", F.col("k")).alias("encode"), F.when(F.col("k") % 13 == 0, "invalid_frame_interval").alias("reason"), "k")
    existing = plan.where("k % 11 < 2").select("output", F.when(F.col("k") % 11 == 0, 5).otherwise(0).cast("long").alias("bytes"))
    got = clips.manifest(clips.cut_clips(plan, existing, ByDigits))
    shown = F.array_join(F.transform("failures", lambda f: F.concat_ws("|", f["segment_id"], f["reason"], F.coalesce(f["message"], F.lit("")))), ";")
    return got.withColumn("failures", shown)


_CLIPS = """WITH c AS (SELECT DISTINCT l_orderkey AS episode, CAST(l_linenumber AS BIGINT) AS segment, l_orderkey * 7 + l_linenumber AS k FROM lineitem SEMI JOIN orders ON l_orderkey = o_orderkey),
    d AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'failed' WHEN k % 11 = 0 THEN 'cached' WHEN k % 4 IN (0, 3) THEN 'copy' WHEN k % 5 IN (0, 3, 4) THEN 'reencode' ELSE 'failed' END AS how FROM c),
    e AS (SELECT *, CASE WHEN how <> 'failed' THEN NULL WHEN k % 13 = 0 THEN 'invalid_frame_interval' WHEN k % 5 = 1 THEN 'ffmpeg_failed' ELSE 'output_too_small' END AS reason FROM d),
    f AS (SELECT *, CASE reason WHEN 'ffmpeg_failed' THEN CASE WHEN k % 4 = 1 THEN 'stream-copy failed first:' || chr(10) || 'cannot copy ' || k || chr(10) || chr(10) || 're-encode failed:' || chr(10) ELSE '' END || 'cannot encode ' || k WHEN 'output_too_small' THEN 'output file missing or too small: 0 bytes' ELSE '' END AS message, row_number() OVER (PARTITION BY episode, how ORDER BY segment) AS place FROM e)
    SELECT episode, count(*) AS requested, count(*) FILTER (WHERE how <> 'failed') AS successful, count(*) FILTER (WHERE how = 'failed') AS failed, count(*) FILTER (WHERE how IN ('copy', 'reencode')) AS cut, count(*) FILTER (WHERE how = 'cached') AS cached, count(*) FILTER (WHERE how = 'copy') AS copied, count(*) FILTER (WHERE how = 'reencode') AS reencoded,
        coalesce(string_agg(printf('seg_%03d', segment) || '|' || reason || '|' || message, ';' ORDER BY segment) FILTER (WHERE how = 'failed' AND place <= 3), '') AS failures, CASE WHEN count(*) FILTER (WHERE how <> 'failed') = 0 THEN 'failed' WHEN count(*) FILTER (WHERE how = 'failed') > 0 THEN 'partial' ELSE 'ok' END AS status FROM f GROUP BY episode"""


def blur_args(part: DataFrame) -> DataFrame:
    """Encoder arguments of sources of several codecs and rates, with a card and without."""
    k = F.col("p_partkey")
    codec = F.element_at(F.array(*map(F.lit, ["h264", "hevc", "h265", "vp9", "av1", "mpeg4"])), (k % 6 + 1).cast("int"))
    rate, pix = F.when(k % 4 > 0, (F.col("p_size") * 1001).cast("long")), F.when(k % 5 > 0, F.when(k % 5 == 1, "").otherwise("yuv420p10le"))
    return part.select("p_partkey", blur.encode_args(codec, pix, rate).alias("plain"), blur.encode_args(codec, pix, rate, card=True).alias("card"))


_ARGS = """SELECT p_partkey, '-c:v ' || plain || ' -pix_fmt ' || pix || CASE WHEN rate > 0 THEN ' -b:v ' || rate ELSE '' END || CASE WHEN plain NOT IN ('libx264', 'libx265') THEN '' WHEN rate > 0 THEN ' -preset veryfast -profile:v ' || CASE plain WHEN 'libx264' THEN 'high' ELSE 'main' END ELSE ' -crf ' || CASE plain WHEN 'libx264' THEN 17 ELSE 18 END || ' -preset veryfast' END AS plain,
    '-c:v ' || coalesce(nv, plain) || ' -pix_fmt ' || pix || CASE WHEN rate > 0 THEN ' -b:v ' || rate ELSE '' END || CASE WHEN nv IS NOT NULL THEN CASE WHEN rate > 0 THEN ' -maxrate:v ' || CAST(trunc(rate * 1.5e0) AS BIGINT) || ' -bufsize:v ' || rate * 2 ELSE ' -cq 18 -preset p4' END WHEN plain NOT IN ('libx264', 'libx265') THEN '' WHEN rate > 0 THEN ' -preset veryfast -profile:v ' || CASE plain WHEN 'libx264' THEN 'high' ELSE 'main' END ELSE ' -crf ' || CASE plain WHEN 'libx264' THEN 17 ELSE 18 END || ' -preset veryfast' END AS card
    FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 1 THEN 'libx265' WHEN 2 THEN 'libx265' WHEN 3 THEN 'libvpx-vp9' WHEN 4 THEN 'libsvtav1' ELSE 'libx264' END AS plain, CASE p_partkey % 6 WHEN 0 THEN 'h264_nvenc' WHEN 1 THEN 'hevc_nvenc' WHEN 2 THEN 'hevc_nvenc' END AS nv,
        CASE WHEN p_partkey % 4 > 0 THEN CAST(p_size AS BIGINT) * 1001 ELSE 0 END AS rate, CASE WHEN p_partkey % 5 > 1 THEN 'yuv420p10le' ELSE 'yuv420p' END AS pix FROM part) x"""

QUERIES = {
    "blur_flow": (blur_flow, _BLUR, ("events",)),
    "clip_cuts": (clip_cuts, _CLIPS, ("orders", "lineitem")),
    "blur_args": (blur_args, _ARGS, ("part",)),
}
