"""Queries of names, inputs and reports over the driver's tables, each with SQL of its own for the other engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import columns as C
from framelake.operators import reports as R


def _events(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("episode"), F.col("event_id").alias("frame_idx"), "event_type", "value")


def detections(events: DataFrame) -> DataFrame:
    """Faces of clicks, plates of errors and purchases, two a frame for some; every seventh frame is missing, and some boxes are
    of frames that were never read."""
    e = _events(events)
    frames = e.where("frame_idx % 7 <> 3")
    number = F.when(F.col("frame_idx") % 5 == 0, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0)))

    def boxes(*kinds: str) -> DataFrame:
        return e.where(F.col("event_type").isin(*kinds)).select("episode", F.when(F.col("frame_idx") % 11 == 0, -F.col("frame_idx") - 1).otherwise(F.col("frame_idx")).alias("frame_idx"), F.explode(number).alias("det_idx"), *(F.col("value").alias(c) for c in ("x1", "y1", "x2", "y2", "conf")))

    got = R.frame_detections(frames, boxes("click"), boxes("error", "purchase"), boxes("click", "error"))
    return got.select(*R.FRAME, F.size("boxes").alias("n_boxes"), F.array_join(F.transform("boxes", lambda b: F.concat(b["source"].cast("string"), F.lit("."), b["det_idx"].cast("string"))), ",").alias("sources"))


def blurred(events: DataFrame) -> DataFrame:
    """Requested frames, asked for twice, against a blurred video that lacks some, has others, and changes values."""
    e = _events(events)
    asked = e.where("event_type <> 'view'").select(*R.FRAME)
    after = e.where("frame_idx % 4 <> 1").withColumn("value", F.col("value") + 1).union(e.where("frame_idx % 9 = 0").withColumn("frame_idx", -F.col("frame_idx") - 1))
    return R.blurred_pairs(R.requested_frames(e, asked.union(asked)), after, "value")


def inputs(orders: DataFrame) -> DataFrame:
    """Raw and blurred videos of orders: some are missing, empty, unreadable, or there twice."""
    path = lambda name: F.concat(F.lit("e/"), F.col("o_orderkey").cast("string"), F.lit(f"/{name}.mp4")).alias("path")
    k = F.col("o_orderkey")
    video = lambda df, name: df.select(k.alias("episode"), path(name), F.when(k % 10 == 4, 0).otherwise(5).cast("long").alias("bytes"), F.when(k % 10 != 6, "h264").alias("codec"))
    raw = orders.where(k % 5 != 2).select(k.alias("episode"), path("rgb"))
    done = orders.where("o_orderstatus = 'F'")
    return R.preferred_input(raw, video(done, "rgb_blurred").union(video(done.where(k % 3 == 0), "a_blurred")))


def rounded(lineitem: DataFrame) -> DataFrame:
    """Figures with many halves and almost halves, rounded as reports do."""
    k = (F.col("l_orderkey") + F.col("l_linenumber")).cast("double")
    x = F.col("l_extendedprice") * F.col("l_discount") / 1.6 + (F.col("l_orderkey") % 1000) / 8.0 + 0.005
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", C.rounded(x, 2).alias("two"), C.rounded(x / 3, 1).alias("one"), C.rounded(x / 7, 4).alias("four"), C.rounded(k / 2, 0).alias("whole"))


def figures(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    m = orders.select(key.alias("episode"), (key % 90).alias("video_sec"), (key % 41 + 1).alias("total_sec"), (key % 997).alias("win_in"), (key % 101).alias("win_out"), (key % 59).alias("ref_in"), (key % 31).alias("ref_out"))
    return R.benchmark(m).select("*", *(F.round(c, 6).alias(f"r_{c}") for c in ("mean_video_sec", "mean_total_sec", "mean_ratio"))).drop("mean_video_sec", "mean_total_sec", "mean_ratio")


def names(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    path = F.concat(F.lit("a/ep"), k.cast("string"), F.when(k % 3 == 0, F.concat(F.lit("/segments/seg_"), F.lpad(k.cast("string"), 9, "0"))).otherwise(F.lit("")))
    video = F.concat(path, F.lit("/clip.v1.mp4"))
    said = F.when(k % 7 < 5, F.element_at(F.array(*map(F.lit, [" Task_V2T", "atomic", "atomic-action", "sop", ""])), (k % 5 + 1).cast("int")))
    codec = F.element_at(F.array(*map(F.lit, ["H264", "hevc", "ProRes_ks", "mpeg4", "AV1", "h265"])), (k % 6 + 1).cast("int"))
    by_episode = k % 2 == 0
    return part.select(
        "p_partkey", C.episode_root(path).alias("root"), C.segment_prefix(path).alias("prefix"), C.cache_root(path).alias("cache"), C.cache_root(video).alias("video_cache"),
        C.default_blurred(video, path, by_episode).alias("blurred"), C.default_output(video, F.lit("base"), by_episode, "caption.json").alias("output"),
        C.method_key(said).alias("method"), C.codec_key(codec).alias("codec"), C.short_digest(path).alias("digest"), C.even(F.col("p_size")).alias("even_size"),
        C.percent(F.when(k % 5 > 0, F.col("p_size") / 64.0)).alias("share"),
    )


_PATH = "'a/ep' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '/segments/seg_' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') ELSE '' END"

QUERIES = {
    "frame_detections": (detections, """SELECT f.episode, f.frame_idx, CAST(count(d.s) AS INTEGER) AS n_boxes, coalesce(string_agg(d.s || '.' || d.i, ',' ORDER BY d.s, d.i), '') AS sources FROM (SELECT user_id AS episode, event_id AS frame_idx FROM events WHERE event_id % 7 <> 3) f
        LEFT JOIN (SELECT e.user_id, e.event_id, s.s, i.i FROM events e JOIN (VALUES ('click', 0), ('error', 1), ('purchase', 1), ('click', 2), ('error', 2)) s(t, s) ON s.t = e.event_type JOIN (VALUES (0), (1)) i(i) ON i.i = 0 OR e.event_id % 5 = 0 WHERE e.event_id % 11 <> 0) d ON d.user_id = f.episode AND d.event_id = f.frame_idx GROUP BY f.episode, f.frame_idx""", ("events",)),
    "blurred_pairs": (blurred, "SELECT user_id AS episode, event_id AS frame_idx, value AS original, value + 1 AS blurred FROM events WHERE event_type <> 'view' AND event_id % 4 <> 1", ("events",)),
    "preferred_input": (inputs, """SELECT k AS episode, 'e/' || k || CASE WHEN o_orderstatus = 'F' AND k % 10 NOT IN (4, 6) THEN CASE WHEN k % 3 = 0 THEN '/a_blurred.mp4' ELSE '/rgb_blurred.mp4' END ELSE '/rgb.mp4' END AS input
        FROM (SELECT *, o_orderkey AS k FROM orders) o WHERE k % 5 <> 2 OR (o_orderstatus = 'F' AND k % 10 NOT IN (4, 6))""", ("orders",)),
    "rounded_figures": (rounded, "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(printf('%.2f', x) AS DOUBLE) AS two, CAST(printf('%.1f', x / 3) AS DOUBLE) AS one, CAST(printf('%.4f', x / 7) AS DOUBLE) AS four, CAST(printf('%.0f', k / 2e0) AS DOUBLE) AS whole FROM (SELECT *, l_orderkey + l_linenumber AS k, l_extendedprice * l_discount / 1.6e0 + (l_orderkey % 1000) / 8e0 + 0.005e0 AS x FROM lineitem) y", ("lineitem",)),
    "benchmark_report": (figures, """SELECT *, sum_total_in // n AS mean_in, sum_total_out // n AS mean_out FROM (SELECT count(*) AS n, CAST(sum(i) AS BIGINT) AS sum_win_in, CAST(sum(o) AS BIGINT) AS sum_win_out,
        CAST(sum(ri) AS BIGINT) AS sum_ref_in, CAST(sum(ro) AS BIGINT) AS sum_ref_out, CAST(sum(i + ri) AS BIGINT) AS sum_total_in, CAST(sum(o + ro) AS BIGINT) AS sum_total_out,
        round(avg(v), 6) AS r_mean_video_sec, round(avg(t), 6) AS r_mean_total_sec, round(avg(t / nullif(v, 0)), 6) AS r_mean_ratio
        FROM (SELECT o_orderkey % 90 AS v, o_orderkey % 41 + 1 AS t, o_orderkey % 997 AS i, o_orderkey % 101 AS o, o_orderkey % 59 AS ri, o_orderkey % 31 AS ro FROM orders) x) y""", ("orders",)),
    "name_helpers": (names, f"""SELECT p_partkey, 'a/ep' || p_partkey AS root, CASE WHEN p_partkey % 3 = 0 THEN 'seg_' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '_' ELSE '' END AS prefix,
        path || '/.frame_cache' AS cache, path || '/.frame_cache/clip.v1' AS video_cache, path || CASE WHEN p_partkey % 2 = 0 THEN '/rgb_blurred.mp4' ELSE '/clip.v1_blurred.mp4' END AS blurred,
        CASE WHEN p_partkey % 2 = 0 THEN 'base' ELSE path END || '/caption.json' AS output, CASE WHEN p_partkey % 7 >= 5 THEN 'task' ELSE CASE p_partkey % 5 WHEN 1 THEN 'atomic_action' WHEN 2 THEN 'atomic_action' WHEN 3 THEN 'sop' ELSE 'task' END END AS method,
        CASE p_partkey % 6 WHEN 0 THEN 'h264' WHEN 1 THEN 'h265' WHEN 2 THEN 'prores' WHEN 4 THEN 'av1' WHEN 5 THEN 'h265' END AS codec, left(sha1(path), 12) AS digest, CASE WHEN p_size % 2 = 1 THEN p_size + 1 ELSE p_size END AS even_size,
        CASE WHEN p_partkey % 5 = 0 THEN '0%' ELSE printf('%.1f', p_size / 64 * 100) || '%' END AS share FROM (SELECT *, {_PATH} AS path FROM part) p""", ("part",)),
}
