"""Sources: episodes and videos in a folder tree, media probes, batch answers, artifact lists. All through Spark's readers,
so a path may be in any store that Spark reads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed suffixes of media files.
SUFFIXES = (".mp4", ".mkv", ".mov", ".avi", ".webm", ".mxf", ".ts", ".flv", ".wmv")


def files(spark: SparkSession, root: str) -> DataFrame:
    """path, dir, name, bytes of all files under a folder; contents aren't read. Names with a leading dot are left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("bytes"))
    return found.withColumns({"dir": F.regexp_extract("path", "^(.*)/[^/]*$", 1), "name": F.regexp_extract("path", "([^/]*)$", 1)}).where("name NOT LIKE '.%'").select("path", "dir", "name", "bytes")


def videos(found: DataFrame) -> DataFrame:
    return found.where(" OR ".join(f"lower(name) LIKE '%{s}'" for s in SUFFIXES))


def input_video(found: DataFrame, preferred: str | None = None) -> DataFrame:
    """episode, path: rgb.mp4, cam_head.mp4 or video.mp4 in a folder, in this order, after `preferred`; else its only video."""
    rank = F.when(F.col("name") == preferred, 0) if preferred else F.when(F.lit(False), 0)
    for i, name in enumerate(("rgb.mp4", "cam_head.mp4", "video.mp4"), 1):
        rank = rank.when(F.lower("name") == name, i)
    ranked = videos(found).withColumn("rank", rank.otherwise(9))
    best = ranked.groupBy(F.col("dir").alias("episode")).agg(F.min_by("path", F.struct("rank", "name")).alias("path"), F.min("rank").alias("rank"), F.count("*").alias("n"))
    return best.where("rank < 9 OR n = 1").select("episode", "path")


def mirrored(found: DataFrame, root: str, out: str, container: str | None = None) -> DataFrame:
    """Videos with the output path that mirrors theirs, its suffix swapped for the container's."""
    relative = F.regexp_replace(F.substring_index("path", root.rstrip("/") + "/", -1), r"\.[^./]*$", f".{container}") if container else F.substring_index("path", root.rstrip("/") + "/", -1)
    return videos(found).select("path", F.concat(F.lit(out.rstrip("/") + "/"), relative).alias("output"))


PROBE = "struct<streams:array<struct<codec_type:string,codec_name:string,width:int,height:int,avg_frame_rate:string,r_frame_rate:string,bit_rate:string,pix_fmt:string,tags:map<string,string>>>,format:struct<format_name:string,duration:string,bit_rate:string>>"


def probes(raw: DataFrame) -> DataFrame:
    """S_PROBE columns of raw probe output (path, json). What can't be read is null; a rate with no denominator is 30."""
    rate = "CASE WHEN {0} LIKE '%/%' THEN coalesce(try_divide(try_cast(split({0}, '/')[0] AS DOUBLE), try_cast(split({0}, '/')[1] AS DOUBLE)), 30D) ELSE coalesce(try_cast({0} AS DOUBLE), 30D) END"
    x = raw.select("path", F.from_json("json", PROBE).alias("p")).selectExpr("path", "p", "get(filter(p.streams, s -> s.codec_type = 'video'), 0) AS v", "get(filter(p.streams, s -> s.codec_type = 'audio'), 0) AS a")
    return x.selectExpr(
        "path", "v.codec_name AS codec", "v.width", "v.height", f"round({rate.format('v.r_frame_rate')}, 3) AS fps", "CAST(coalesce(try_cast(v.bit_rate AS BIGINT), try_cast(p.format.bit_rate AS BIGINT)) DIV 1000 AS INT) AS bitrate_kbps",
        "try_cast(p.format.duration AS DOUBLE) AS duration_sec", "v.pix_fmt", "lower(regexp_extract(path, '\\\\.([^.]*)$', 1)) AS container", "a.codec_name AS audio_codec", "pmod(coalesce(try_cast(v.tags['rotate'] AS INT), 0), 360) AS rotation",
    )


def artifacts(payload: str) -> list[dict]:
    """The list of artifacts in a JSON payload: a list, or an object with `artifacts`, `items` or `inputs`; what isn't an object is dropped."""
    value = json.loads(payload)
    if isinstance(value, dict):
        value = next((value[k] for k in ("artifacts", "items", "inputs") if k in value), None)
    if not isinstance(value, list):
        raise ValueError("the payload has no list of artifacts")
    return [x for x in value if isinstance(x, dict)]


def primary(found: list[dict]) -> dict | None:
    """The first artifact of type video or json, or of an input port; else the first."""
    hit = lambda x: x.get("type") in ("video", "json") or x.get("portName") in ("input", "video") or x.get("portId") == "in-1"
    return next((x for x in found if hit(x)), found[0] if found else None)


def sop_episodes(episodes: DataFrame, kinds: DataFrame, sops: DataFrame, kind: str | None = None, name: str | None = None) -> DataFrame:
    """Episodes (name, has_video, ...) that have a video, with the first kind (place, kind, sop) that their name starts with, and
    its procedure (sop, task_name, steps). Without a kind, or a procedure of it, an episode is left out; `kind` and `name`
    keep equal ones only.

    A name meets kinds by equality with each of its starts, so no pair of a name and another kind is made.
    """
    work = episodes.where("has_video")
    if name is not None:
        work = work.where(F.col("name") == name)
    starts = work.select("name").distinct().select("name", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("name"), F.lit(1))), lambda i: F.left("name", i))).alias("kind"))
    first = starts.join(kinds, "kind").groupBy("name").agg(F.min_by(F.struct("kind", "sop"), "place").alias("k")).select("name", "k.*")
    if kind is not None:
        first = first.where(F.col("kind") == kind)
    return work.join(first, "name").join(sops, "sop").drop("sop")


def episode_list(tree: DataFrame, explicit: list[str] | str, root: str | None = None, base: str = "/") -> DataFrame:
    """place, episode, note: the explicit folders in order (relative ones from `base`), then, in order of their names, the
    folders in `root` that hold an input video. An episode may be in both. What isn't a folder has a note and no place.

    tree: path, is_dir of all files and folders.
    """
    spark = tree.sparkSession
    listed = [explicit] if isinstance(explicit, str) else list(explicit)
    whole = [p if p.startswith("/") else f"{base.rstrip('/')}/{p}" for p in listed]
    dirs = tree.where("is_dir").select(F.col("path").alias("episode"), F.lit(True).alias("there"))
    first = spark.createDataFrame([(i, p.rstrip("/") or "/") for i, p in enumerate(whole)], "i long, episode string").join(dirs, "episode", "left")
    rows = first.select(F.lit(0).alias("part"), "i", "episode", F.when(F.col("there").isNull(), "episode folder not found").alias("note"))
    if root is not None:
        top = (root if root.startswith("/") else f"{base.rstrip('/')}/{root}").rstrip("/")
        files = tree.where("NOT is_dir").select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
        held = input_video(files.where(F.regexp_extract("dir", "^(.*)/[^/]*$", 1) == top)).select("episode")
        found = held.join(dirs, "episode", "left_semi").select(F.lit(1).alias("part"), F.lit(0).cast("long").alias("i"), "episode", F.lit(None).cast("string").alias("note"))
        gone = spark.createDataFrame([(top,)], "episode string").join(dirs, "episode", "left_anti").select(F.lit(1).alias("part"), F.lit(0).cast("long").alias("i"), "episode", F.lit("episode root not found").alias("note"))
        rows = rows.unionByName(found).unionByName(gone)
    # a run's episodes are few, and their order is the result
    return rows.withColumn("place", F.when(F.col("note").isNull(), F.row_number().over(Window.orderBy(F.col("note").isNotNull(), "part", "i", "episode")) - 1)).select("place", "episode", "note")
