"""Views that give driver tables the shapes of frames, detections, responses, captions, media probes and paths.

Each is SQL over a dialect; `load` makes it a DataFrame. Orders are total.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from framelake.plans.dialect import SPARK, Spark


def gray(d: Spark) -> str:
    """8 x 8 gray frames from vectors: episode, frame_idx, px."""
    value = "floor(40 + 25 * (vec_id % 8) + (80 + 60 * (" + d.idiv("vec_id", "8") + " % 5)) * CAST(v AS DOUBLE))"
    px = d.map("embedding", "v", f"CAST(greatest(0, least(255, {value})) AS INT)")
    return f"SELECT CAST(label AS BIGINT) AS episode, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS frame_idx, {px} AS px FROM embeddings"


def frames(d: Spark) -> str:
    """Frame events: episode, frame_idx, n, kind, cut, detected, cls, conf, k, value."""
    k = d.json("props", "k")
    return f"""SELECT user_id AS episode, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT) AS frame_idx,
        count(*) OVER (PARTITION BY user_id) AS n, event_type AS kind, event_type = 'click' AS cut, event_type IN ('click', 'view', 'error') AS detected,
        CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS cls, least(value / 500, 1D) AS conf, CAST({k} AS BIGINT) AS k, value FROM events""".replace("1D", "CAST(1 AS DOUBLE)")


def episodes(d: Spark) -> str:
    return "SELECT user_id AS episode, count(*) AS n, CAST(30 AS DOUBLE) AS fps FROM events GROUP BY user_id"


def boxes(d: Spark) -> str:
    """Several boxes a frame: episode, frame_idx, det_idx, conf, x1, y1, x2, y2."""
    return f"""SELECT episode, {d.idiv('frame_idx', '4')} AS frame_idx, frame_idx % 4 AS det_idx, conf,
        CAST(k AS DOUBLE) AS x1, value % 100 AS y1, CAST(k + 20 + k % 7 AS DOUBLE) AS x2, value % 100 + 20 + k % 5 AS y2 FROM ({frames(d)}) f"""


def requests(d: Spark) -> str:
    return "SELECT concat(CAST(conv_id AS STRING), '_', CAST(turn AS STRING)) AS custom_id, conv_id, turn, text AS prompt FROM conversations WHERE role = 'user'"


def responses(d: Spark) -> str:
    """Answers with a body of one of four forms by conversation: JSON, fenced JSON, JSON in prose, garbage."""
    body = """concat('{{"thought": "t', CAST(turn AS STRING), '", "scene": "', CASE turn % 3 WHEN 0 THEN ' Household' WHEN 1 THEN 'kitchen' ELSE 'outdoor' END, '", "ego_hand_count": ', CAST(turn % 3 AS STRING), ', "active_manipulation": "', CASE WHEN turn % 4 < 2 THEN 'yes' ELSE 'no' END, '", "', CASE WHEN turn % 8 < 4 THEN 'single_person_operation' ELSE 'single_operator_only' END, CASE turn % 5 WHEN 0 THEN '": true}}' WHEN 1 THEN '": false}}' WHEN 2 THEN '": "yes"}}' WHEN 3 THEN '": "no"}}' ELSE '": "true"}}' END)"""
    text = f"CASE conv_id % 4 WHEN 0 THEN {body} WHEN 1 THEN concat('```json\n', {body}, '\n```') WHEN 2 THEN concat(text, ' ', {body}, ' end') ELSE text END"
    words = d.size(f"{'split(text, chr(32))' if d.name == 'spark' else 'string_split(text, chr(32))'}")
    return f"""SELECT concat(CAST(conv_id AS STRING), '_', CAST(before AS STRING)) AS custom_id, conv_id, turn, {text} AS text, CAST({words} AS BIGINT) AS completion_tokens
        FROM (SELECT conv_id, turn, role, text, lag(turn) OVER w AS before, lag(role) OVER w AS before_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) t
        WHERE role = 'assistant' AND before_role = 'user'"""


def actions(d: Spark) -> str:
    """Atomic actions of tasks: episode, task, step, s, e (exclusive), caption."""
    return """SELECT o_custkey AS episode, o_orderkey AS task, CAST(row_number() OVER w AS BIGINT) AS step,
        CAST((sum(l_quantity) OVER w) - l_quantity AS BIGINT) AS s, CAST(sum(l_quantity) OVER w AS BIGINT) AS e, concat(l_returnflag, l_linestatus) AS caption
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def tasks(d: Spark) -> str:
    return f"SELECT o.o_custkey AS episode, o.o_orderkey AS task, o.o_orderpriority AS caption, coalesce(a.s, 0) AS s, coalesce(a.e, 0) AS e, coalesce(a.n, 0) AS n_actions FROM orders o LEFT JOIN (SELECT task, min(s) AS s, max(e) AS e, count(*) AS n FROM ({actions(d)}) x GROUP BY task) a ON o.o_orderkey = a.task"


def probes(d: Spark) -> str:
    """Media probes from parts."""
    return f"""SELECT p_partkey AS media, CASE p_partkey % 6 WHEN 0 THEN 'h264' WHEN 1 THEN 'hevc' WHEN 2 THEN 'vp9' WHEN 3 THEN 'prores' WHEN 4 THEN 'av1' ELSE 'mpeg4' END AS codec,
        CASE WHEN p_size % 3 = 0 THEN 1920 WHEN p_size % 3 = 1 THEN 1280 ELSE 640 END AS width, CASE WHEN p_size % 3 = 0 THEN 1080 WHEN p_size % 3 = 1 THEN 720 ELSE 480 END AS height,
        CASE WHEN p_size % 2 = 0 THEN CAST(30 AS DOUBLE) ELSE CAST(25 AS DOUBLE) END AS fps, CAST({d.whole('p_retailprice')} AS BIGINT) AS bitrate_kbps,
        CASE WHEN p_size % 5 = 0 THEN 'yuv420p10le' ELSE 'yuv420p' END AS pix_fmt, CASE p_partkey % 4 WHEN 0 THEN 'mp4' WHEN 1 THEN 'mkv' WHEN 2 THEN 'mov' ELSE 'webm' END AS container,
        CASE p_partkey % 3 WHEN 0 THEN 'aac' WHEN 1 THEN 'opus' END AS audio_codec,
        CAST(8000 + p_size * 137 AS BIGINT) AS duration_ms, CAST((8000 + p_size * 137) * 9973 AS BIGINT) AS size_bytes FROM part"""


def specs(d: Spark) -> str:
    """Target specifications."""
    rows = [
        (0, None, None, None, None, None, None), (1, "h264", "mp4", None, None, None, None), (2, "h265", "mkv", "1280x720", None, None, None), (3, "vp9", "webm", None, "8000k", None, None),
        (4, "av1", "webm", None, None, 25.0, None), (5, "prores", "mov", None, None, None, "yuv422p10le"), (6, "copy", "mkv", None, None, None, None), (7, "copy", "mp4", "640x480", None, None, None), (8, None, "avi", None, "50M", None, None), (9, "theora", "mkv", None, None, None, None),
    ]
    q = lambda x: "NULL" if x is None else f"'{x}'"
    return " UNION ALL ".join(f"SELECT {i} AS spec, CAST({q(c)} AS STRING) AS codec, CAST({q(k)} AS STRING) AS container, CAST({q(r)} AS STRING) AS resolution, CAST({q(b)} AS STRING) AS bitrate, CAST({'NULL' if f is None else f} AS DOUBLE) AS fps, CAST({q(p)} AS STRING) AS pix_fmt" for i, c, k, r, b, f, p in rows)


def outputs(d: Spark) -> str:
    """What encoding made of the probes: codec, size and length differ."""
    return f"SELECT media, CASE WHEN media % 2 = 0 THEN 'hevc' ELSE codec END AS codec, width, CASE WHEN media % 7 = 0 THEN height - 2 ELSE height END AS height, {d.idiv('size_bytes * 2', '3')} AS size_bytes, CAST(duration_ms + media % 9 * 83 AS DOUBLE) / 1000 AS duration_sec FROM ({probes(d)}) p"


def windows(d: Spark, wide: int = 6, step: int = 3, scale: int = 10) -> str:
    """Answers by window of `wide` frames, a new one every `step`: some fail, some transitions are out of range, some payloads are blank or missing."""
    first = d.idiv("frame_idx", str(step))
    pos = f"frame_idx - {step} * window_id"
    lists = f"{d.listed(f'frame_idx * {scale}', 'frame_idx')} AS frame_ids, {d.listed(f"CASE WHEN kind = 'click' THEN {pos} WHEN k % 11 = 0 THEN CAST(99 AS BIGINT) END", 'frame_idx')} AS places, {d.listed("CASE WHEN frame_idx % 4 = 1 THEN NULL WHEN k % 13 = 0 THEN '' ELSE kind END", 'frame_idx')} AS said"
    return f"""SELECT episode, window_id, max(window_id) OVER (PARTITION BY episode) + 1 AS n_windows, frame_ids, CASE WHEN window_id % 7 <> 5 THEN {d.keep('places', 'z_', 'z_ IS NOT NULL')} END AS transitions, {d.keep('said', 'z_', 'z_ IS NOT NULL')} AS payloads, CAST(0 AS BIGINT) AS low, n * {scale} AS high
        FROM (SELECT episode, n, window_id, {lists} FROM (SELECT episode, frame_idx, n, kind, k, {d.explode(d.seq(f'greatest({first} - {wide // step - 1}, 0)', first))} AS window_id FROM ({frames(d)}) f) g GROUP BY episode, n, window_id) h"""


def inner(d: Spark) -> str:
    """Shorter windows, for actions."""
    return windows(d, 4, 2)


def parts(d: Spark) -> str:
    """Neighbouring segments of an episode, of which many say the same in other letters; some say nothing."""
    return f"SELECT episode, frame_idx * 10 AS s, frame_idx * 10 + 10 AS e, CASE WHEN k % 13 = 0 THEN ' ' WHEN k % 2 = 0 THEN upper(kind) ELSE concat(kind, ' ') END AS instruction FROM ({frames(d)}) f WHERE episode % 10 <> 7 OR frame_idx = 0"


def proposals(d: Spark) -> str:
    """Merged segments as a model gives them, by four frames: right, with a gap, with invented ends, or none, by episode."""
    return f"""SELECT episode, place, CASE WHEN episode % 4 = 1 AND place = 2 THEN s + 10 WHEN episode % 4 = 2 AND place = 1 THEN s + 3 ELSE s END AS s, CASE WHEN episode % 4 = 2 AND place = 0 THEN e + 3 ELSE e END AS e, CASE WHEN place % 5 = 0 THEN ' ' ELSE concat('task ', CAST(place AS STRING)) END AS instruction
        FROM (SELECT episode, {d.idiv('s', '40')} AS place, min(s) AS s, max(e) AS e FROM ({parts(d)}) p WHERE episode % 4 <> 3 GROUP BY episode, {d.idiv('s', '40')}) q"""


def paths(d: Spark) -> str:
    """Files of episodes: page_id, dir, name."""
    host = d.search("url", "^https?://([^/]+)/", 1)
    return f"SELECT page_id, coalesce({host}, 'none') AS dir, CASE page_id % 5 WHEN 0 THEN 'rgb.mp4' WHEN 1 THEN 'cam_head.mp4' WHEN 2 THEN 'video.mp4' WHEN 3 THEN concat('other', CAST(page_id AS STRING), '.mov') ELSE 'x.txt' END AS name FROM pages"


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, view) -> DataFrame:
    """A view over the tables of sf_dir. Only the tables it names are read."""
    text, kw = view(SPARK), {}
    for t in TABLES:
        new = re.sub(rf"(?<=FROM ){t}\b|(?<=JOIN ){t}\b", f"{{{t}}}", text)
        if new != text:
            text, kw[t] = new, spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(text, **kw)
