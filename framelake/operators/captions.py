"""Caption trees, clip plans and cut manifests.

Inputs: tasks (episode, task, caption, s, e, n_actions), actions (episode, task, step, s, e, caption). Ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions import text as T
from framelake.operators.quality import num
from framelake.plans.dialect import Spark


def caption_tree(d: Spark) -> str:
    """Each task with its actions in order."""
    inner = d.join(d.listed("concat(caption, ':', CAST(s AS STRING), '-', CAST(e AS STRING))", "step"), ";")
    return f"SELECT t.episode, t.task, t.caption, t.s, t.e, coalesce(a.n, 0) AS n_actions, coalesce(a.actions, '') AS actions FROM {{tasks}} t LEFT JOIN (SELECT task, count(*) AS n, {inner} AS actions FROM {{actions}} GROUP BY task) a ON t.task = a.task"


def overall_instruction(d: Spark) -> str:
    """Captions that aren't blank, joined; none: the default."""
    return f"SELECT episode, coalesce(max(joined), 'Untitled') AS instruction, CAST(coalesce(max(actions), 0) AS BIGINT) AS actions, CAST(coalesce(nullif(max(actions), 0), max(tasks)) AS BIGINT) AS segments FROM (SELECT episode, {d.join(d.listed('caption', 'task'), '; ')} AS joined, sum(n_actions) AS actions, count(*) AS tasks FROM {{tasks}} WHERE trim(caption) <> '' GROUP BY episode UNION ALL SELECT DISTINCT episode, CAST(NULL AS STRING) AS joined, 0 AS actions, 0 AS tasks FROM {{tasks}}) a GROUP BY episode"


def _plan(d: Spark, rows: str, order: str, prefix: str, fps: float) -> str:
    reason = "CASE WHEN e <= s THEN 'invalid_frame_interval' WHEN (e - s) / " + num(fps) + " <= 0.04e0 THEN 'non_positive_duration' END"
    return f"SELECT episode, segment, concat('{prefix}_', lpad(CAST(segment AS STRING), 3, '0')) AS segment_id, {T.slug(d, 'caption')} AS slug, s, e, round(s / {num(fps)}, 6) AS start_sec, round((e - s) / {num(fps)}, 6) AS duration_sec, {reason} AS reason FROM (SELECT episode, caption, s, e, CAST(row_number() OVER (PARTITION BY episode ORDER BY {order}) - 1 AS BIGINT) AS segment FROM {rows}) p"


def cut_plan_task(d: Spark, fps: float = 30) -> str:
    """Task clips; intervals under two frames are left out, invalid ones keep a reason."""
    return _plan(d, "(SELECT * FROM {tasks} WHERE e - s >= 2 OR e <= s) t", "task", "seg", fps)


def cut_plan_action(d: Spark, fps: float = 30) -> str:
    return _plan(d, "(SELECT * FROM {actions} WHERE e - s >= 2) t", "task, step", "act", fps)


def cut_manifest(d: Spark) -> str:
    """Counters and the status ladder; up to three failures as a sample (a feature of the report)."""
    first = d.join(d.listed("segment_id", "segment"))
    return f"""SELECT a.episode, a.requested, a.successful, a.failed, CASE WHEN a.requested > 0 AND a.successful = 0 THEN 'failed' WHEN a.failed > 0 THEN 'partial' ELSE 'ok' END AS status, coalesce(f.failures, '') AS failures FROM
        (SELECT episode, count(*) AS requested, count_if(reason IS NULL) AS successful, count_if(reason IS NOT NULL) AS failed FROM ({cut_plan_task(d)}) p GROUP BY episode) a
        LEFT JOIN (SELECT episode, {first} AS failures FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY segment) AS place FROM ({cut_plan_task(d)}) q WHERE reason IS NOT NULL) r WHERE place <= 3) s GROUP BY episode) f ON a.episode = f.episode"""


def refine_validate(d: Spark) -> str:
    """Whether a task's actions cover it without gaps, in order, with captions that never go back; refined ends must be old ends."""
    return """SELECT t.task, t.s = min(a.s) AS starts, t.e = max(a.e) AS ends, bool_and(coalesce(a.s = a.before_e, true)) AS continuous, bool_and(coalesce(a.caption >= a.before_caption, true)) AS monotone, count_if(a.e % 2 = 0 AND o.e IS NULL) = 0 AS known_ends
        FROM {tasks} t JOIN (SELECT task, step, s, e, caption, lag(e) OVER (PARTITION BY task ORDER BY step) AS before_e, lag(caption) OVER (PARTITION BY task ORDER BY step) AS before_caption FROM {actions}) a ON t.task = a.task
        LEFT JOIN (SELECT DISTINCT task, e FROM {actions} WHERE step % 3 <> 0) o ON a.task = o.task AND a.e = o.e GROUP BY t.task, t.s, t.e"""


def validated(tasks: DataFrame, actions: DataFrame) -> DataFrame:
    """What `refine_validate` says, from one pass over the actions: a task and its own are gathered in a row, whose size is the
    task's. No join or window sorts them again."""
    item = F.struct("step", "s", "e", "caption")
    none = F.lit(None)
    kind = actions.select(item.alias("a")).schema["a"].dataType
    t = tasks.select("task", F.struct("s", "e").alias("t"), none.cast(kind).alias("a"))
    own = actions.select("task", none.cast(t.schema["t"].dataType).alias("t"), item.alias("a"))
    # each side is dealt on its own, to smaller parts: in the tasks that make them, its sorts would add up with the gathering's
    parts = 4 * int(tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t, own = (x.where("task IS NOT NULL").repartition(parts, "task") for x in (t, own))
    one = t.union(own).groupBy("task").agg(F.collect_set("t").alias("t"), F.array_sort(F.collect_list("a")).alias("a"))
    told = lambda rule: F.expr(f"forall(sequence(0, size(a) - 1), i -> coalesce({rule}, true))")
    ends = "array_except(transform(filter(a, x -> x.e % 2 = 0), x -> x.e), transform(filter(a, x -> x.step % 3 <> 0), x -> x.e))"
    got = one.where("size(a) > 0").select("task", "t", F.expr("array_min(transform(a, x -> x.s))").alias("low"), F.expr("array_max(transform(a, x -> x.e))").alias("high"), told("a[i].s = get(a, i - 1).e").alias("continuous"), told("a[i].caption >= get(a, i - 1).caption").alias("monotone"), F.expr(f"size({ends}) = 0").alias("known_ends"))
    return got.withColumn("t", F.explode("t")).select("task", (F.col("t.s") == F.col("low")).alias("starts"), (F.col("t.e") == F.col("high")).alias("ends"), "continuous", "monotone", "known_ends")


def subtitle_lookup(d: Spark, every: int = 10) -> str:
    """The action that each `every`-th frame of an order's timeline is in, the first if several. Intervals are found by task and range."""
    return f"SELECT f.task, f.frame, {d.argmin('a.caption', ('a.step',))} AS caption FROM (SELECT task, {d.explode(d.seq('s', 'e - 1', str(every)))} AS frame FROM {{tasks}} WHERE e > s) f JOIN {{actions}} a ON a.task = f.task AND a.s <= f.frame AND f.frame < a.e GROUP BY f.task, f.frame"


def sop_join(d: Spark) -> str:
    """Items with the first task type that is a prefix of their type; the list of prefixes is small."""
    return f"SELECT p.p_partkey, {d.argmin('m.kind', ('m.place',))} AS kind FROM {{part}} p JOIN (SELECT 0 AS place, 'STANDARD' AS kind UNION ALL SELECT 1, 'SMALL' UNION ALL SELECT 2, 'S' UNION ALL SELECT 3, 'PROMO' UNION ALL SELECT 4, 'ECON' UNION ALL SELECT 5, 'A' UNION ALL SELECT 6, 'B' UNION ALL SELECT 7, 'C' UNION ALL SELECT 8, 'D' UNION ALL SELECT 9, 'E') m ON left(upper(p.p_type), length(m.kind)) = m.kind GROUP BY p.p_partkey"
