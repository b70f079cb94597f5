"""Queries of the caption flows over the driver's tables, with scripted answers, and SQL for the other engine.

An episode is a user's events, ten frames each at ten frames a second; its name starts with a kind of work. The oracles
read a scripted answer off the digits of its hash, and don't share code with the flows: levels by `chains.segments`, others
by recursion over the cuts.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.functions import prompts as P
from framelake.functions import text as T
from framelake.functions.ranges import overlaps
from framelake.functions.text import SCENES
from framelake.operators import chains as N
from framelake.operators import cuts, flows, imu, inference
from framelake.operators import sampling as S
from framelake.plans.dialect import DUCK, SPARK
from framelake.sources import batches, discovery
from framelake.sources.sinks import kept, shared

ASK = inference.Direct(inference.Scripted)
FPS, RADIUS, LEAST = 10, 20, 8

#: Kinds of work by the start of a name, in the order in which they are tried; some are starts of others.
KINDS = [(0, "pour", "pouring"), (1, "screw", "screwing"), (2, "screwun", "unscrewing"), (3, "box_cut", "cutting"), (4, "box", "boxing"), (5, "drill", None)]
NAMES = ["pourwater", "screwunscrew", "box_cut", "boxing", "walk", "drill"]
SOPS = {"pouring": ["take the jug", "pour", "put the jug down"], "screwing": ["set the screw", "turn it"], "cutting": ["mark", "cut", "fold", "stack"], "boxing": ["close the box"]}


def episodes(events: DataFrame) -> DataFrame:
    return events.groupBy(F.col("user_id").alias("episode")).agg((F.count(F.lit(1)) * FPS).alias("n"), F.lit(float(FPS)).alias("fps"))


def named(events: DataFrame) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, NAMES)), (F.col("episode") % len(NAMES) + 1).cast("int"))
    return episodes(events).withColumns({"name": F.concat(name, F.col("episode").cast("string")), "has_video": F.col("episode") % 7 != 5})


def procedures(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Kinds (place, kind, sop) and procedures (sop, task_name, steps)."""
    kinds = spark.createDataFrame(KINDS, "place int, kind string, sop string")
    rows = [(k, f"{k} work", [(i, x) for i, x in enumerate(v, 1)]) for k, v in SOPS.items()]
    return kinds, spark.createDataFrame(rows, "sop string, task_name string, steps array<struct<step:int,description:string>>")


def sop_episodes(events: DataFrame) -> DataFrame:
    got = discovery.sop_episodes(named(events), *procedures(events.sparkSession))
    return got.select("episode", "name", "kind", "task_name", F.size("steps").alias("n_steps"))


def task_captions(events: DataFrame) -> DataFrame:
    return flows.task_captions(episodes(events), ASK).where("status = 'ok'").select("episode", "scene", "instruction", "s", "e", "caption")


def two_level_flow(events: DataFrame) -> DataFrame:
    got = flows.two_level_captions(episodes(events), ASK)
    return got.withColumn("actions", F.array_join(F.transform("actions", lambda a: F.format_string("%s:%d-%d", a["caption"], a["s"], a["e"])), ";"))


def signals(events: DataFrame) -> DataFrame:
    """A sample of both hands' motion for each event."""
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    k = F.get_json_object("props", "$.k").cast("double")
    v = F.col("value")
    return events.select(F.col("user_id").alias("episode"), pos.cast("long").alias("pos"), F.array(v, k, v * 0.5).alias("lh"), F.when(F.col("user_id") % 10 != 9, F.array(k, v)).alias("rh"))


def hand_valleys(events: DataFrame) -> DataFrame:
    return imu.hand_valleys(signals(events))


def sop_flow(events: DataFrame) -> DataFrame:
    """Cuts snap to where the hands rest; a sample of their motion is ten frames."""
    work = discovery.sop_episodes(named(events), *procedures(events.sparkSession))
    valleys = kept(hand_valleys(events).withColumn("mark", F.col("mark") * FPS))
    return flows.sop_captions(episodes(events), work.select("episode", "task_name", "steps"), valleys, ASK)


def window_captions(events: DataFrame) -> DataFrame:
    """Windows, requests, a batch submitted and collected through the data source, segments."""
    spark = events.sparkSession
    asked = kept(flows.jobs(flows.ranges(episodes(events)), flows.STEPS, P.STEPS, F.format_string("%s/win_%d", F.col("episode").cast("string"), F.col("window_id")), task=F.lit("")))
    folder = f"{shared(spark)}/spool-{uuid.uuid4().hex}"
    answers = batches.Batches(batches.Spool(folder if "://" in folder else f"file://{folder}", inference.Scripted), interval=0.05)(asked.select("custom_id", "prompt"))
    return cuts.chained(kept(flows.read_windows(asked, answers, "instructions")), ["episode"], N.DEFAULT_TASK)


def generic_segments(windows: DataFrame) -> DataFrame:
    return cuts.chained(windows.withColumn("fps", F.lit(float(FPS))), ["episode"], N.DEFAULT_TASK, cluster=2.0, least=2.5)


def two_level_captions(windows: DataFrame, inner: DataFrame) -> DataFrame:
    """Tasks of `windows`; windows of `inner` belong to the task that holds their first frame. Tasks and dealt windows are written."""
    at = Window.partitionBy("episode").orderBy("s")
    tasks = kept(generic_segments(windows).select("episode", (F.row_number().over(at) - 1).cast("long").alias("task"), "s", "e", F.col("payload").alias("caption")))
    first = inner.select("episode", "window_id", "frame_ids", "transitions", "payloads", F.col("frame_ids")[0].alias("frame"), F.col("frame_ids")[0].alias("until"))
    met = overlaps(first, tasks.select("episode", "task", F.col("s").alias("low"), F.col("e").alias("high"), (F.col("e") - 1).alias("last")), ["episode"], ("frame", "until"), ("low", "last"), cuts.BUCKET)
    own = Window.partitionBy("episode", "task")
    dealt = kept(met.select("episode", "task", "frame_ids", "transitions", "payloads", "low", "high", (F.row_number().over(own.orderBy("window_id")) - 1).cast("long").alias("window_id"), F.count(F.lit(1)).over(own).alias("n_windows"), F.lit(float(FPS)).alias("fps")))
    acts = cuts.chained(dealt, ["episode", "task"], N.DEFAULT_ACTION, cluster=0.5, least=0.6)
    said = F.format_string("%s:%d-%d", T.column(T.slug(SPARK, "payload", N.DEFAULT_ACTION)), F.col("s"), F.col("e"))
    listed = acts.groupBy("episode", "task").agg(F.array_sort(F.collect_list(F.struct("s", said.alias("x")))).alias("a")).select("episode", "task", F.array_join(F.transform("a", lambda x: x["x"]), ";").alias("actions"))
    return tasks.join(listed, ["episode", "task"], "left").select("episode", "task", "caption", "s", "e", F.coalesce("actions", F.lit("")).alias("actions"))


# -- the other engine --------------------------------------------------------------------------------------------------

_EPISODES = f"SELECT user_id AS episode, count(*) * {FPS} AS n, CAST({FPS} AS DOUBLE) AS fps FROM events GROUP BY user_id"
_NAMED = f"SELECT episode, n, fps, ({NAMES!r})[episode % {len(NAMES)} + 1] || episode AS name, episode % 7 <> 5 AS has_video FROM ({_EPISODES}) e"
_KINDS = "SELECT * FROM (VALUES " + ", ".join(f"({a}, '{b}', {'NULL' if c is None else repr(c)})" for a, b, c in KINDS) + ") k(place, kind, sop)"
_SOPS = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{k} work', {v!r})" for k, v in SOPS.items()) + ") s(sop, task_name, steps)"
_WORK = f"SELECT n.episode, n.name, n.n, n.fps, k.kind, s.task_name, s.steps FROM ({_NAMED}) n, LATERAL (SELECT kind, sop FROM ({_KINDS}) k WHERE starts_with(n.name, kind) ORDER BY place LIMIT 1) k JOIN ({_SOPS}) s ON s.sop = k.sop WHERE n.has_video"


def _digit(i: int, h: str = "h") -> str:
    return f"CAST('0x' || substr({h}, {i + 1}, 1) AS INTEGER)"


def _hash(custom_id: str, prompt: str) -> str:
    return f"sha256({custom_id} || chr(10) || {prompt})"


def _asked(rows: str, sampling: flows.Sampling, template: P.Template, custom_id: str, word: str, key: str = "episode", match: str = "r.episode", low: str = "0", high: str = "n", legacy: bool = False, **places: str) -> str:
    """Windows of rows (key, fps, ...) with the transitions and payloads of their scripted answers; k_ is the row of the range."""
    win = S.sample_windows(DUCK, sampling.window, sampling.step, sampling.frames, low, high, legacy).replace("{episodes}", f"(SELECT {key} AS episode, * EXCLUDE (episode) FROM ({rows}) r_)")
    span = {"n": "len(list_distinct(f))", "start": "printf('%.1f', start_frame / fps)", "end": "printf('%.1f', end_frame / fps)"}
    prompt = template.sql(**span, **places)
    k, m = f"{_digit(1)} % 3", f"({_digit(1)} % 3 + CASE WHEN {_digit(9)} > 0 THEN 1 ELSE 0 END)"
    said = ", ".join(f"CASE WHEN {_digit(5 + i)} % 4 = 3 THEN '' ELSE {word.format(w=f'({_digit(5 + i)} % 4)')} END" for i in range(3))
    return f"""SELECT * EXCLUDE (h, f), f AS frame_ids, CASE WHEN {_digit(0)} > 1 THEN list_transform([{_digit(2)}, {_digit(3)}][1:{k}], lambda x: CAST(x AS BIGINT)) END AS transitions, [{said}][1:{m}] AS payloads FROM (
        SELECT k_, window_id, n_windows, lo_ AS low, hi_ AS high, f, {_hash(custom_id, prompt)} AS h FROM (
            SELECT w.window_id, w.start_frame, w.end_frame, count(*) OVER (PARTITION BY w.episode) AS n_windows, list_transform(string_split(w.frame_ids, ','), lambda x: CAST(x AS BIGINT)) AS f, r.fps, r AS k_, CAST(r.{low if low != '0' else 'zero'} AS BIGINT) AS lo_, CAST(r.{high} AS BIGINT) AS hi_
            FROM ({win}) w JOIN (SELECT 0 AS zero, * FROM ({rows}) r0_) r ON w.episode = {match}) a_) b_"""


def _scene() -> str:
    prompt = P.SCENE.sql(n="least(16, n)", seconds="printf('%.1f', n / fps)")
    labels = list(SCENES)
    return f"SELECT episode, CASE WHEN d < 10 THEN ({labels!r})[d + 1] ELSE 'unknown' END AS scene FROM (SELECT episode, {_digit(0)} AS d FROM (SELECT episode, {_hash(chr(39).join(['episode || ', '/scene', '']), prompt)} AS h FROM ({_EPISODES}) e) s1_) s2_"


def _listing(rows: str, extra: str = "") -> str:
    return f"SELECT episode, count(*) AS n_parts, to_json(list({{'seg_id': seg, 'frame_interval': [s, e], 'instruction': caption}} ORDER BY s)) AS segments{extra} FROM (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY s) - 1 AS seg FROM ({rows}) l1_) l2_ GROUP BY episode"


def _two_level() -> str:
    default = '{"instruction":"' + N.DEFAULT_TASK + '"}'
    asked = _asked(_EPISODES, flows.TASKS, P.TASKS, "k_.episode || '/task_' || window_id", """'{{"instruction":"task ' || {w} || '"}}'""")
    raw = N.segments(DUCK, "asked", RADIUS, LEAST, default)
    pairs = "SELECT episode, seg // 2 AS pair, min(s) AS s, max(e) AS e FROM parts GROUP BY episode, seg // 2"
    inner = _asked("SELECT *, CAST(10 AS DOUBLE) AS fps FROM level", flows.ACTIONS, P.ACTIONS, "k_.episode || '/action_' || k_.task || '_' || window_id", "'Do ' || {w} || '!'", "row(episode, task)", "row(r.episode, r.task)", "s", "e", task="k_.caption")
    return f"""WITH asked AS MATERIALIZED (SELECT k_.episode AS episode, * EXCLUDE (k_) FROM ({asked}) q),
        first AS MATERIALIZED (SELECT episode, s, e, json_extract_string(payload, '$.instruction') AS caption FROM ({raw}) r),
        parts AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY s) - 1 AS seg FROM first),
        mode AS (SELECT episode, n_parts, {_digit(0)} % 6 AS m FROM (SELECT episode, n_parts, {_hash("episode || '/refine_tasks'", P.MERGE_TASKS.sql(segments='segments'))} AS h FROM ({_listing('SELECT * FROM first')}) x) y),
        good AS (SELECT episode FROM mode WHERE n_parts > 1 AND (m IN (2, 5) OR (m = 4 AND n_parts <= 2))),
        refined AS (SELECT p.episode, p.s, p.e, CASE WHEN p.pair % 3 < 2 THEN 'merged ' || p.pair ELSE '{N.DEFAULT_TASK}' END AS caption, 'refined' AS how FROM ({pairs}) p SEMI JOIN good g ON g.episode = p.episode),
        runs AS (SELECT *, sum(new) OVER (PARTITION BY episode ORDER BY s) AS run FROM (SELECT *, CASE WHEN lower(trim(caption)) = lag(lower(trim(caption))) OVER (PARTITION BY episode ORDER BY s) THEN 0 ELSE 1 END AS new FROM first ANTI JOIN good USING (episode)) z),
        merged AS (SELECT r.episode, min(s) AS s, max(e) AS e, arg_min(caption, s) AS caption, CASE WHEN max(n_parts) > 1 THEN 'merged' ELSE 'kept' END AS how FROM runs r JOIN mode m ON m.episode = r.episode GROUP BY r.episode, run),
        level AS MATERIALIZED (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY s) - 1 AS task, s, e, caption, how FROM (SELECT * FROM refined UNION ALL SELECT * FROM merged) u),
        inside AS MATERIALIZED (SELECT k_.episode AS episode, k_.task AS task, * EXCLUDE (k_) FROM ({inner}) q),
        acts AS (SELECT episode, task, string_agg(coalesce(nullif(trim(regexp_replace(lower(payload), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'act') || ':' || s || '-' || e, ';' ORDER BY s) AS actions FROM ({N.segments(DUCK, 'inside', RADIUS, LEAST, N.DEFAULT_ACTION, 'episode, task')}) a GROUP BY episode, task)
        SELECT l.episode, c.scene, i.instruction, l.task, l.s, l.e, l.caption, l.how, coalesce(a.actions, '') AS actions FROM level l JOIN ({_scene()}) c ON c.episode = l.episode JOIN (SELECT episode, string_agg(caption, '; ' ORDER BY s) AS instruction FROM level GROUP BY episode) i ON i.episode = l.episode LEFT JOIN acts a ON a.episode = l.episode AND a.task = l.task"""


def _anchored(snap: str) -> str:
    """CTEs from `asked` (episode, window_id, n_windows, frame_ids, transitions, payloads, high) to `segs` (episode, step, s, e, caption or null)."""
    w = "CASE WHEN n_windows = 1 THEN 1 ELSE 0.5e0 - 0.5e0 * cos(2 * pi() * (window_id + 1) / (n_windows + 1)) END"
    return f"""read AS (SELECT *, list_filter(transitions, lambda t: t < len(frame_ids)) AS ok FROM asked WHERE transitions IS NOT NULL),
        cut AS (SELECT episode, frame, w, row_number() OVER (PARTITION BY episode ORDER BY frame, window_id, i) AS rn FROM (SELECT episode, window_id, {w} AS w, unnest(range(1, len(ok) + 1)) AS i, frame_ids[ok[i] + 1] AS frame FROM read)),
        grouped AS (SELECT episode, rn, frame, w, frame AS anchor FROM cut WHERE rn = 1 UNION ALL SELECT c.episode, c.rn, c.frame, c.w, CASE WHEN c.frame - g.anchor <= {RADIUS} THEN g.anchor ELSE c.frame END FROM grouped g JOIN cut c ON c.episode = g.episode AND c.rn = g.rn + 1),
        centre AS (SELECT episode, CAST(trunc(round(sum(frame * w) / sum(w), 9)) AS BIGINT) AS c FROM grouped GROUP BY episode, anchor),
        point AS (SELECT episode, c, row_number() OVER (PARTITION BY episode ORDER BY c) AS rn FROM (SELECT DISTINCT episode, {snap} AS c FROM centre)),
        walk AS (SELECT episode, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS edge, true AS kept FROM (SELECT DISTINCT episode FROM asked) UNION ALL SELECT p.episode, p.rn, CASE WHEN p.c - k.edge >= {LEAST} THEN p.c ELSE k.edge END, p.c - k.edge >= {LEAST} FROM walk k JOIN point p ON p.episode = k.episode AND p.rn = k.rn + 1),
        bound AS (SELECT w.episode, w.edge AS s, e.n, max(edge) OVER (PARTITION BY w.episode) AS last FROM walk w JOIN ({_EPISODES}) e ON e.episode = w.episode WHERE kept),
        part AS (SELECT episode, s, coalesce(lead(s) OVER (PARTITION BY episode ORDER BY s), n) AS e, row_number() OVER (PARTITION BY episode ORDER BY s) - 1 AS step FROM bound WHERE NOT (s = last AND s > 0 AND n - s < {LEAST})),
        span AS (SELECT episode, window_id, j, frame_ids[(CASE WHEN j = 1 THEN 0 ELSE ok[j - 1] END) + 1] AS a, frame_ids[(CASE WHEN j = len(ok) + 1 THEN len(frame_ids) - 1 ELSE ok[j] END) + 1] AS b, payloads[j] AS said FROM (SELECT *, unnest(range(1, len(ok) + 2)) AS j FROM read) WHERE j <= len(payloads)),
        vote AS (SELECT p.episode, p.s, v.said, count(*) AS votes, min(v.window_id * 1000 + v.j) AS first FROM part p JOIN span v ON v.episode = p.episode AND v.a <= p.s + CAST(trunc(0.6e0 * (p.e - p.s)) AS BIGINT) AND v.b >= p.s + CAST(trunc(0.4e0 * (p.e - p.s)) AS BIGINT) GROUP BY p.episode, p.s, v.said),
        segs AS MATERIALIZED (SELECT p.*, (SELECT count(*) FROM cut c WHERE c.episode = p.episode) > 0 AS has_cuts, v.said AS caption, f.said AS first_said FROM part p LEFT JOIN (SELECT episode, s, arg_max(said, votes * 1000000 - first) AS said FROM vote GROUP BY episode, s) v ON v.episode = p.episode AND v.s = p.s LEFT JOIN (SELECT episode, arg_min(said, window_id * 1000 + j) AS said FROM span GROUP BY episode) f ON f.episode = p.episode)"""


def _window_sql() -> str:
    asked = _asked(_EPISODES, flows.STEPS, P.STEPS, "k_.episode || '/win_' || window_id", "'step ' || {w}", task="''")
    return f"WITH asked AS MATERIALIZED (SELECT k_.episode AS episode, * EXCLUDE (k_) FROM ({asked}) q) SELECT * FROM ({N.segments(DUCK, 'asked', RADIUS, LEAST, N.DEFAULT_TASK)}) s"


def _task_sql() -> str:
    asked = _asked(_EPISODES, flows.STEPS, P.STEPS, "k_.episode || '/win_' || window_id", "'step ' || {w}", task="''")
    return f"""WITH RECURSIVE asked AS MATERIALIZED (SELECT k_.episode AS episode, * EXCLUDE (k_) FROM ({asked}) q), {_anchored('c')},
        told AS (SELECT episode, s, e, CASE WHEN has_cuts THEN coalesce(caption, 'Step ' || (step + 1)) ELSE coalesce(first_said, 'Full video') END AS caption FROM segs SEMI JOIN read USING (episode))
        SELECT t.episode, c.scene, i.instruction, t.s, t.e, t.caption FROM told t JOIN ({_scene()}) c ON c.episode = t.episode JOIN (SELECT episode, arg_min(caption, s) AS instruction FROM told GROUP BY episode) i ON i.episode = t.episode"""


def _valley_sql() -> str:
    """Signals as lists: smoothing by a fitted polynomial's matrix, strict tops of the negative, thinned from the highest on, prominence."""
    w, half = imu.WINDOW, imu.WINDOW // 2
    basis = np.vander(np.arange(-half, half + 1), imu.ORDER + 1, increasing=True).astype(float)
    hat = (basis @ np.linalg.pinv(basis)).tolist()
    row = f"CASE WHEN i <= {half} THEN i WHEN i > n - {half} THEN {w} - (n - i) ELSE {half + 1} END"
    start = f"CASE WHEN i <= {half} THEN 0 WHEN i > n - {half} THEN n - {w} ELSE i - {half + 1} END"
    far = lambda side: f"list_sum(list_transform(range(1, len({side}) + 1), lambda j: ({side}[j] - m_{side}[j]) * ({side}[j] - m_{side}[j])))"
    return f"""WITH RECURSIVE raw AS (SELECT user_id AS episode, event_id, [value, CAST(json_extract_string(props, '$.k') AS DOUBLE), value * 0.5e0] AS lh, [CAST(json_extract_string(props, '$.k') AS DOUBLE), value] AS rh FROM events WHERE user_id % 10 <> 9),
        mean AS (SELECT episode, [avg(lh[1]), avg(lh[2]), avg(lh[3])] AS m_lh, [avg(rh[1]), avg(rh[2])] AS m_rh FROM raw GROUP BY episode),
        line AS (SELECT episode, list(sqrt({far('lh')}) + sqrt({far('rh')}) ORDER BY event_id) AS x, count(*) AS n FROM raw JOIN mean USING (episode) GROUP BY episode),
        low AS MATERIALIZED (SELECT episode, n, list_transform(range(1, n + 1), lambda i: -list_sum(list_transform(range(1, {w + 1}), lambda k: CAST(hat[{row}][k] AS DOUBLE) * x[k + {start}]))) AS y FROM line, (SELECT {hat} AS hat) h),
        top AS (SELECT episode, list(struct_pack(i := i, y := y[i]) ORDER BY y[i] DESC, i DESC) AS left_ FROM (SELECT episode, y, unnest(range(2, n)) AS i FROM low) t WHERE y[i - 1] < y[i] AND y[i] > y[i + 1] GROUP BY episode),
        thin AS (SELECT episode, left_, CAST(NULL AS BIGINT) AS i FROM top UNION ALL SELECT episode, list_filter(left_[2:], lambda z: abs(z.i - left_[1].i) >= {imu.DISTANCE}), left_[1].i FROM thin WHERE len(left_) > 0)
        SELECT t.episode, t.i - 1 AS mark FROM thin t JOIN low l ON l.episode = t.episode WHERE t.i IS NOT NULL AND
            y[t.i] - greatest(list_min(y[coalesce(list_max(list_filter(range(1, t.i), lambda j: y[j] > y[t.i])), 0) + 1:t.i]), list_min(y[t.i:coalesce(list_min(list_filter(range(t.i + 1, n + 1), lambda j: y[j] > y[t.i])), n + 1) - 1])) >= {imu.PROMINENCE}"""


def _sop_sql() -> str:
    lines = "array_to_string(list_transform(range(1, len(k_.steps) + 1), lambda i: '  Step ' || i || ': ' || k_.steps[i]), chr(10))"
    asked = _asked(_WORK, flows.STEPS, P.SOP_STEPS, "k_.episode || '/desc_win_' || window_id", "'step ' || {w}", legacy=True, task="k_.task_name", steps=lines)
    near = f"coalesce((SELECT arg_min(m, abs(m - c) * 1000000000 + m) FROM valley v WHERE v.episode = centre.episode AND abs(m - c) <= {flows.SNAP}), c)"
    prompt = P.MERGE_STEPS.sql(task="k.task_name", steps=lines.replace("k_.", "k."), segments="l.segments")
    tries = " UNION ALL ".join(f"SELECT l.episode, {i} AS k, l.n_parts, {_hash(f'l.episode || ' + repr(f'/refine_{i}'), prompt)} AS h FROM ({_listing('SELECT episode, s, e, caption FROM told')}) l JOIN ({_WORK}) k ON k.episode = l.episode" for i in range(1, flows.ROUNDS + 1))
    return f"""WITH RECURSIVE asked AS MATERIALIZED (SELECT k_.episode AS episode, * EXCLUDE (k_) FROM ({asked}) q),
        valley AS MATERIALIZED (SELECT episode, mark * {FPS} AS m FROM ({_valley_sql()}) v0_), {_anchored(near)},
        told AS MATERIALIZED (SELECT g.episode, g.s, g.e, CASE WHEN has_cuts THEN coalesce(caption, k.steps[least(step + 1, len(k.steps))]) ELSE coalesce(first_said, k.task_name) END AS caption FROM segs g JOIN ({_WORK}) k ON k.episode = g.episode),
        round AS (SELECT episode, min(k) AS k FROM (SELECT episode, k, n_parts, {_digit(0)} % 6 AS m FROM ({tries}) t) u WHERE m = 2 OR (m IN (4, 5) AND n_parts <= 2) GROUP BY episode),
        mode AS (SELECT r.episode, r.k, {_digit(0)} % 6 AS m FROM round r JOIN ({tries}) t ON t.episode = r.episode AND t.k = r.k),
        good AS (SELECT p.episode, seg // 2 AS step, min(s) AS s, max(e) AS e, CASE WHEN seg // 2 % 3 < 2 THEN 'merged ' || (seg // 2) ELSE ' ' END AS instruction, CASE WHEN max(m) = 5 THEN -(seg // 2) ELSE seg // 2 + 1 END AS sop_step_index, max(k) AS attempts, 'refined' AS how
            FROM (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY s) - 1 AS seg FROM told) p JOIN mode m ON m.episode = p.episode GROUP BY p.episode, seg // 2),
        runs AS (SELECT episode, min(s) AS s, max(e) AS e, arg_min(caption, s) AS instruction FROM (SELECT *, sum(new) OVER (PARTITION BY episode ORDER BY s) AS run FROM (SELECT *, CASE WHEN caption = lag(caption) OVER (PARTITION BY episode ORDER BY s) THEN 0 ELSE 1 END AS new FROM told ANTI JOIN round USING (episode)) a) b GROUP BY episode, run),
        bad AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY s) - 1 AS step, s, e, instruction, row_number() OVER (PARTITION BY episode ORDER BY s) AS sop_step_index, {flows.ROUNDS} AS attempts, 'merged' AS how FROM runs)
        SELECT x.episode, c.scene, k.task_name, x.step, x.s, x.e, x.instruction, CAST(x.sop_step_index AS BIGINT) AS sop_step_index, CAST(x.attempts AS BIGINT) AS attempts, x.how FROM (SELECT * FROM good UNION ALL SELECT * FROM bad) x JOIN ({_scene()}) c ON c.episode = x.episode JOIN ({_WORK}) k ON k.episode = x.episode"""


QUERIES = {
    "sop_episodes": (sop_episodes, f"SELECT episode, name, kind, task_name, CAST(len(steps) AS INTEGER) AS n_steps FROM ({_WORK}) w", ("events",)),
    "window_captions": (window_captions, _window_sql(), ("events",)),
    "task_captions": (task_captions, _task_sql(), ("events",)),
    "two_level_flow": (two_level_flow, _two_level(), ("events",)),
    "hand_valleys": (hand_valleys, _valley_sql(), ("events",)),
    "sop_flow": (sop_flow, _sop_sql(), ("events",)),
}
