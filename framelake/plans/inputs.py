"""Queries of input resolution and provider payloads over the driver's tables, each with SQL of its own for the other engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import payloads
from framelake.sources import resolve
from framelake.streaming import submissions

#: By page: what its folder holds (file, text) and its artifact; `@` is the folder. A manifest, two files that name each
#: other, a deep folder, a parent with a child, unknown keys, and one that leads nowhere.
CASES = [
    ([("rgb.mp4", None), ("x.mp4", None)], '{"path": "@"}'),
    ([("m.json", '{"clips": ["a.mp4", {"clip_path": "sub"}], "video": "b.mp4"}'), ("a.mp4", None), ("b.mp4", None), ("sub/video.mp4", None)], '{"dataRef": {"manifestPath": "@/m.json"}}'),
    ([("x.json", '{"n": "y.json"}'), ("y.json", '["x.json", {"deep": {"er": "./sub/../c.mov"}}]'), ("c.mov", None)], '{"path": "@/x.json"}'),
    ([("readme.txt", None)], '{"path": "@", "data": {"clips": []}}'),
    ([("a/b/cam_head.mp4", None)], '{"path": "@"}'),
    ([("b.MKV", None), ("a.webm", None)], '{"data": {"videos": [], "entries": [{"episode_dir": "nothing"}], "dir": "@"}}'),
    ([("rgb.mp4", None), ("segments/s1.mp4", None)], '{"data": {"segment_dirs": ["@", "@/segments"]}}'),
    ([("one.avi", None)], '{"data": [null, 3, "store://bucket/one.avi", {"z": {"y": ["@/one.avi", "@/one.avi"]}}]}'),
]
#: What follows: kind and path, in order; nothing: an error.
FOUND = [[("video", "rgb.mp4")], [("video", "a.mp4"), ("video", "sub/video.mp4")], [("video", "c.mov")], [], [("episode", "a/b")], [("video", "a.webm"), ("video", "b.MKV")], [("video", "segments/s1.mp4")], [("video", "one.avi")]]


def _cases(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Artifacts and the tree of all pages' folders."""
    root = F.concat(F.lit("/data/ep"), F.col("page_id").cast("string"))
    rows = pages.select(F.col("page_id").alias("artifact"), root.alias("root"), (F.col("page_id") % len(CASES)).cast("int").alias("case"))
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("case") + 1)
    artifacts = rows.select("artifact", F.replace(pick([a for _, a in CASES]), F.lit("@"), F.col("root")).alias("payload"))
    entry = lambda f, t: F.struct(F.lit(f).alias("f"), F.lit(t).cast("string").alias("t"))
    held = F.element_at(F.array(*(F.array(*(entry(f, t) for f, t in files)) for files, _ in CASES)), F.col("case") + 1)
    files = rows.select("root", F.explode(held).alias("x")).select(F.concat("root", F.lit("/"), "x.f").alias("path"), F.lit(False).alias("is_dir"), F.col("x.t").alias("text"))
    parts = F.split("path", "/")
    dirs = files.select(F.explode(F.transform(F.sequence(F.lit(2), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).alias("path")).distinct()
    return artifacts, files.union(dirs.select("path", F.lit(True), F.lit(None).cast("string")))


def resolved_inputs(pages: DataFrame) -> DataFrame:
    return resolve.platform_inputs(*_cases(pages)).select("artifact", "place", "kind", "path", F.col("error").isNotNull().alias("failed"))


def _resolved_sql() -> str:
    rows = [(c, i, k, p, "false") for c, found in enumerate(FOUND) for i, (k, p) in enumerate(found)]
    values = ", ".join(f"({c}, {i}, '{k}', '{p}', {f})" for c, i, k, p, f in rows) + ", " + ", ".join(f"({c}, 0, NULL, NULL, true)" for c, found in enumerate(FOUND) if not found)
    return f"SELECT page_id AS artifact, CAST(place AS BIGINT) AS place, kind, '/data/ep' || page_id || '/' || p AS path, failed FROM pages JOIN (VALUES {values}) v(c, place, kind, p, failed) ON page_id % {len(CASES)} = c"


def provider_answers(conversations: DataFrame) -> DataFrame:
    """Answers in eight shapes by turn: texts, parts, `output_text`, `output`, none, an error, an object, and a line without an id."""
    c = conversations.select(F.concat_ws("_", "conv_id", "turn").alias("id"), F.col("turn").alias("k"), F.coalesce("text", F.lit("")).alias("t"))
    shapes = [
        "named_struct('custom_id', id, 'response', named_struct('status_code', 200, 'body', named_struct('choices', array(named_struct('message', named_struct('content', t))), 'usage', named_struct('prompt_tokens', 3, 'completion_tokens', k))))",
        "named_struct('custom_id', id, 'response', named_struct('body', named_struct('choices', array(named_struct('message', named_struct('content', array(named_struct('type', 'text', 'text', t), named_struct('type', 'image_url', 'text', 'no'), named_struct('type', 'text', 'text', 'end'))))), 'usage', named_struct('input_tokens', 7))))",
        "named_struct('custom_id', id, 'response', named_struct('status_code', 201, 'body', named_struct('output_text', t, 'output', array(named_struct('content', array(named_struct('type', 'text', 'text', 'other')))), 'usage', named_struct('input_tokens', 0, 'prompt_tokens', 9, 'output_tokens', k))))",
        "named_struct('custom_id', id, 'response', named_struct('body', named_struct('output', array(named_struct('content', array(named_struct('type', 'output_text', 'text', t))), named_struct('content', array(named_struct('type', 'reasoning', 'text', 'no'), named_struct('type', 'text', 'text', 'more')))))))",
        "named_struct('custom_id', id, 'response', named_struct('body', named_struct('choices', array(), 'usage', named_struct('prompt_tokens', 0, 'input_tokens', 5))))",
        "named_struct('custom_id', id, 'error', named_struct('message', 'bad'), 'response', named_struct('status_code', 500))",
        "named_struct('custom_id', id, 'response', named_struct('body', named_struct('choices', array(named_struct('message', named_struct('content', named_struct('a', k)))))))",
        "named_struct('id', id)",
    ]
    line = F.expr("CASE k % 8 " + " ".join(f"WHEN {i} THEN to_json({s})" for i, s in enumerate(shapes)) + " END")
    return payloads.answers(c.select(line.alias("value")))


_ANSWERS = """SELECT id AS custom_id, CASE k % 8 WHEN 0 THEN t WHEN 1 THEN CASE WHEN t = '' THEN 'end' ELSE t || chr(10) || 'end' END WHEN 2 THEN CASE WHEN trim(t, ' ') = '' THEN 'other' ELSE t END WHEN 3 THEN CASE WHEN t = '' THEN 'more' ELSE t || chr(10) || 'more' END WHEN 6 THEN '{"a":' || k || '}' END AS text,
    CAST(CASE k % 8 WHEN 0 THEN 3 WHEN 1 THEN 7 WHEN 2 THEN 9 WHEN 4 THEN 5 ELSE 0 END AS BIGINT) AS prompt_tokens, CASE WHEN k % 8 IN (0, 2) THEN k ELSE 0 END AS completion_tokens, CASE k % 8 WHEN 2 THEN 201 WHEN 5 THEN 500 ELSE 200 END AS status_code, CASE WHEN k % 8 = 5 THEN 'bad' END AS error
    FROM (SELECT conv_id || '_' || turn AS id, turn AS k, coalesce(text, '') AS t FROM conversations) c WHERE k % 8 <> 7"""

#: Seconds after which a submission expires.
PATIENCE = 2 * 86400


def submissions_of(events: DataFrame) -> DataFrame:
    """Submissions, polls and clearings of users' work."""
    k, t = F.get_json_object("props", "$.k").cast("int"), F.col("event_type")
    return events.select(
        F.col("user_id").alias("work"), F.col("ts").cast("timestamp").alias("at"), F.when(t == "signup", "submit").when((t == "error") & (k % 3 == 0), "clear").otherwise("poll").alias("kind"),
        F.when(t == "signup", F.concat(F.lit("b"), F.col("event_id").cast("string"))).alias("batch"), F.when(t == "purchase", "completed").when(t == "error", "failed").when(t != "signup", "in_progress").alias("status"),
    )


def submission_states(events: DataFrame) -> DataFrame:
    got = submissions.table(submissions_of(events), PATIENCE)
    return got.select("work", "batch", "status", F.unix_millis("at").alias("ms"), "polls")


_STATES = f"""WITH RECURSIVE e AS MATERIALIZED (SELECT user_id AS work, epoch_us(ts) // 1000 AS ms, event_type AS t, 'b' || event_id AS b, t = 'error' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 0 AS clear, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM events),
    s AS (SELECT work, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS batch, CAST(NULL AS BIGINT) AS till, CAST(0 AS BIGINT) AS polls, CAST([] AS STRUCT(b VARCHAR, s VARCHAR, m BIGINT, p BIGINT)[]) AS said FROM e WHERE rn = 1
        UNION ALL SELECT work, rn, CASE WHEN t = 'signup' THEN b WHEN alive AND NOT clear AND t IN ('view', 'click') THEN batch END, CASE WHEN t = 'signup' THEN ms + {PATIENCE * 1000} WHEN alive AND NOT clear AND t IN ('view', 'click') THEN till END, CASE WHEN t <> 'signup' AND alive THEN polls + 1 ELSE 0 END,
            list_concat(CASE WHEN till <= ms THEN [struct_pack(b := batch, s := 'expired', m := till, p := polls)] ELSE [] END, CASE WHEN t = 'signup' OR clear THEN [] WHEN NOT alive THEN [struct_pack(b := NULL, s := 'error', m := ms, p := 0)] WHEN t IN ('purchase', 'error') THEN [struct_pack(b := batch, s := CASE t WHEN 'error' THEN 'failed' ELSE 'completed' END, m := ms, p := polls + 1)] ELSE [] END)
        FROM (SELECT e.*, s.batch, s.till, s.polls, coalesce(e.ms < s.till, false) AS alive FROM s JOIN e ON e.work = s.work AND e.rn = s.rn + 1) x)
    SELECT work, x.b AS batch, x.s AS status, x.m AS ms, x.p AS polls FROM (SELECT work, unnest(said) AS x FROM s) y UNION ALL
    SELECT work, batch, 'expired', till, polls FROM (SELECT *, row_number() OVER (PARTITION BY work ORDER BY rn DESC) AS last FROM s) z WHERE last = 1 AND till <= (SELECT max(ms) FROM e)"""

QUERIES = {
    "resolved_inputs": (resolved_inputs, _resolved_sql(), ("pages",)),
    "submission_states": (submission_states, _STATES, ("events",)),
    "provider_answers": (provider_answers, _ANSWERS, ("conversations",)),
}
