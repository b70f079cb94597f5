"""Input discovery over path tables: ranked video resolution, parents that hold other inputs, text helpers over tables.

Inputs: paths (page_id, dir, name).
"""

from __future__ import annotations

from framelake.functions import text as T
from framelake.operators.quality import num
from framelake.plans.dialect import Spark

_RANK = "CASE WHEN lower(name) = 'rgb.mp4' THEN 0 WHEN lower(name) = 'cam_head.mp4' THEN 1 WHEN lower(name) = 'video.mp4' THEN 2 ELSE 3 END"
_VIDEO = "(lower(name) LIKE '%.mp4' OR lower(name) LIKE '%.mov' OR lower(name) LIKE '%.mkv' OR lower(name) LIKE '%.avi' OR lower(name) LIKE '%.webm' OR lower(name) LIKE '%.m4v')"


def candidate_rank(d: Spark) -> str:
    return f"SELECT page_id, dir, name, {_RANK} AS rank, CAST(row_number() OVER (PARTITION BY dir ORDER BY {_RANK}, name, page_id) AS BIGINT) AS place FROM {{paths}} WHERE {_VIDEO}"


def path_resolve(d: Spark) -> str:
    """Each directory's input video: the best ranked; one without a known name only if it is the only video."""
    return f"SELECT dir, count(*) AS videos, CASE WHEN min({_RANK}) < 3 OR count(*) = 1 THEN {d.argmin('name', (_RANK, 'name', 'page_id'))} END AS video FROM {{paths}} WHERE {_VIDEO} GROUP BY dir"


def drop_parent(d: Spark) -> str:
    """Directories under which no other input directory lies; a parent gives way to what it holds. Parents are found by equality of their path with each prefix."""
    parts = "split(path, '/')" if d.name == "spark" else "string_split(path, '/')"
    prefix = d.explode(d.map(d.seq("1", f"{d.size(parts)} - 1"), "i", "slice(" + parts + ", 1, i)" if d.name == "spark" else parts + "[1:i]"))
    return f"""SELECT a.path FROM (SELECT DISTINCT path FROM ({_dirs(d)}) x) a LEFT JOIN (SELECT DISTINCT {d.join('parts', '/')} AS parent FROM (SELECT {prefix} AS parts FROM ({_dirs(d)}) y) z) b ON a.path = b.parent WHERE b.parent IS NULL"""


def _dirs(d: Spark) -> str:
    return "SELECT DISTINCT CASE WHEN page_id % 3 = 0 THEN dir WHEN page_id % 3 = 1 THEN concat(dir, '/segments') ELSE concat(dir, '/segments/', CAST(page_id AS STRING)) END AS path FROM {paths}"


def text_helpers(d: Spark) -> str:
    """Slug, truncations and mask of documents' texts and sources."""
    return f"SELECT doc_id, {T.slug(d, 'left(text, 40)')} AS slug, {T.tail('text', 40)} AS tail, {T.head('text', 30)} AS head, {T.mask('source')} AS masked, {T.mask('text')} AS masked_text FROM {{documents}}"


def parse_rates(d: Spark) -> str:
    """Frame rates and sizes written in several ways by part."""
    text = "CASE p_partkey % 7 WHEN 0 THEN '30000/1001' WHEN 1 THEN '0/0' WHEN 2 THEN concat(CAST(p_size AS STRING), '/1') WHEN 3 THEN '25' WHEN 4 THEN '' WHEN 5 THEN '24/0' ELSE 'x' END"
    size = "CASE p_partkey % 4 WHEN 0 THEN concat(CAST(p_size * 10 AS STRING), 'X', CAST(p_size AS STRING)) WHEN 1 THEN '640x480' WHEN 2 THEN '640' ELSE '1x2x3' END"
    return f"SELECT p_partkey, round({T.rate(d, 'r')}, 6) AS rate, {T.side(d, 's', 1)} AS width, {T.side(d, 's', 2)} AS height, {T.truthy('t')} AS flag FROM (SELECT p_partkey, {text} AS r, {size} AS s, CASE p_partkey % 3 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'off' ELSE '1' END AS t FROM {{part}}) p"


def asof_nearest(d: Spark, most: int = 6) -> str:
    """Each cut with the nearest valley (k >= 90) of its episode within `most` frames, the first of ties; else itself.

    Valleys are dealt to buckets of most + 1 frames, so a cut meets those of three buckets only.
    """
    width = most + 1
    return f"""SELECT c.episode, c.frame_idx, coalesce({d.argmin('v.f', ('abs(v.f - c.frame_idx)', 'v.f'))}, c.frame_idx) AS snapped FROM {{frames}} c
        LEFT JOIN (SELECT episode, f, {d.idiv('f', str(width))} + o AS bucket FROM (SELECT episode, frame_idx AS f FROM {{frames}} WHERE k >= 90) x CROSS JOIN (SELECT -1 AS o UNION ALL SELECT 0 UNION ALL SELECT 1) y) v
        ON v.episode = c.episode AND v.bucket = {d.idiv('c.frame_idx', str(width))} AND abs(v.f - c.frame_idx) <= {most} WHERE c.cut GROUP BY c.episode, c.frame_idx"""


def imu_magnitude(d: Spark) -> str:
    """Two three-axis signals centred by their means over the episode: the sum of their lengths."""
    axes = [d.at("embedding", str(i)) for i in range(6)]
    cols = ", ".join(f"CAST({a} AS DOUBLE) AS a{i}" for i, a in enumerate(axes))
    centred = ", ".join(f"a{i} - avg(a{i}) OVER (PARTITION BY label) AS c{i}" for i in range(6))
    return f"SELECT label, vec_id, round(sqrt(c0 * c0 + c1 * c1 + c2 * c2) + sqrt(c3 * c3 + c4 * c4 + c5 * c5), 6) AS magnitude FROM (SELECT label, vec_id, {centred} FROM (SELECT label, vec_id, {cols} FROM {{embeddings}}) a) b".replace("{num}", num(0))
