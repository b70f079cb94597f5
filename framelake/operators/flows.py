"""Caption flows: windows, model calls, segments, refinement, and trees, each call once.

Episodes: episode, n (frames), fps. `ask` takes requests (custom_id, prompt) and gives answers (custom_id, text,
status_code), written before they are used: `inference.Direct` or `batches.Batches`. A flow asks for all episodes at once,
window and scene requests together; a later level asks when the one before is written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions import lenient
from framelake.functions import prompts as P
from framelake.functions import text as T
from framelake.functions.columns import tenths
from framelake.operators import cuts
from framelake.operators.chains import DEFAULT_ACTION, DEFAULT_TASK
from framelake.plans.dialect import SPARK
from framelake.sources.sinks import kept

Ask = Callable[[DataFrame], DataFrame]
ROUNDS, SNAP = 3, 45


@dataclass(frozen=True)
class Sampling:
    """Seconds of a window, seconds between starts, frames of a window."""

    window: float
    step: float
    frames: int


#: Fixed defaults of the flows, and frames of a scene request.
STEPS, TASKS, ACTIONS, SCENE_FRAMES = Sampling(10, 5, 12), Sampling(12, 6, 12), Sampling(6, 3, 8), 16


def ranges(episodes: DataFrame) -> DataFrame:
    return episodes.where("n > 0").select("episode", F.lit(0).cast("long").alias("low"), F.col("n").cast("long").alias("high"), F.when(F.col("fps") > 0, F.col("fps")).otherwise(30.0).cast("double").alias("fps"))


def jobs(rows: DataFrame, sampling: Sampling, template: P.Template, custom_id: Column, legacy: bool = False, **places: Column) -> DataFrame:
    """Windows of the ranges with custom_id and prompt. Further columns of the ranges may be used by both. Frames that repeat
    in a window are shown once."""
    got = cuts.windows(rows, sampling.window, sampling.step, sampling.frames, legacy)
    span = P.images(F.size(F.array_distinct("frame_ids")), F.col("start_frame"), F.col("end_frame"), F.col("fps"))
    return got.withColumns({"custom_id": custom_id, "prompt": template.column(**span, **places)})


def scene_requests(episodes: DataFrame) -> DataFrame:
    r = ranges(episodes)
    prompt = P.SCENE.column(n=F.least(F.lit(SCENE_FRAMES), F.col("high")), seconds=tenths(F.col("high") / F.col("fps")))
    return r.select(F.concat(F.col("episode").cast("string"), F.lit("/scene")).alias("custom_id"), prompt.alias("prompt"))


def scenes(episodes: DataFrame, answers: DataFrame) -> DataFrame:
    """episode, scene: unknown without a readable answer."""
    said = answers.select("custom_id", T.column(T.scene(SPARK, "text")).alias("scene"))
    return episodes.select("episode", F.concat(F.col("episode").cast("string"), F.lit("/scene")).alias("custom_id")).join(said, "custom_id", "left").select("episode", F.coalesce("scene", F.lit("unknown")).alias("scene"))


def _object(text: str, fenced: bool) -> Column:
    """The answer's JSON object as a variant: from the first brace to the last; or, if fenced, also in a fence, or the first value that decodes."""
    whole = T.column(f"try_parse_json({T.greedy_json(SPARK, text)})")
    if fenced:
        direct = F.expr(f"try_parse_json({text})")
        direct = F.when(F.expr(f"schema_of_variant(try_parse_json({text})) LIKE 'OBJECT%'"), direct)
        whole = F.coalesce(direct, F.expr("try_parse_json(lenient_)"))
    return whole


def read_windows(windows: DataFrame, answers: DataFrame, field: str, fenced: bool = False) -> DataFrame:
    """Windows with transitions (null where the answer can't be read) and payloads: texts as they are, other values as
    canonical JSON. Of transitions that aren't numbers none counts; fractions are cut."""
    got = windows.join(answers.select("custom_id", "text"), "custom_id", "left")
    if fenced:
        # only answers that aren't an object as they are go through Python
        got = got.withColumn("lenient_", lenient.canonical_json(F.when(~F.coalesce(F.expr("schema_of_variant(try_parse_json(text)) LIKE 'OBJECT%'"), F.lit(False)), F.col("text"))))
    got = got.withColumn("v", _object("text", fenced)).withColumn("v", F.when(F.expr("schema_of_variant(v) LIKE 'OBJECT%'"), F.col("v")))
    numbers = "transform(filter(try_variant_get(v, '$.transitions', 'array<variant>'), t -> schema_of_variant(t) RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)'), t -> CAST(try_variant_get(t, '$', 'double') AS BIGINT))"
    said = f"transform(try_variant_get(v, '$.{field}', 'array<variant>'), x -> IF(schema_of_variant(x) = 'STRING', try_variant_get(x, '$', 'string'), to_json(x)))"
    empty = F.array().cast("array<long>")
    return got.withColumns({"transitions": F.when(F.col("v").isNotNull(), F.coalesce(F.expr(numbers), empty)), "payloads": F.coalesce(F.expr(said), F.array().cast("array<string>"))}).drop("v", "text", "prompt", *(["lenient_"] if fenced else []))


def unread(windows: DataFrame, answers: DataFrame) -> DataFrame:
    """Episodes none of whose answers could be read: episode, n, sample (the first three, as a report)."""
    failed = F.struct("window_id", F.concat_ws(" | ", "custom_id", F.concat(F.lit("status="), F.col("status_code").cast("string")), F.concat(F.lit("error="), F.col("error")), F.concat(F.lit("text="), F.left(F.regexp_replace(F.trim("text"), r"\s+", " "), F.lit(160)))).alias("said"))
    got = windows.join(answers, "custom_id", "left").groupBy("episode").agg(F.count(F.lit(1)).alias("n"), F.count("transitions").alias("read"), F.slice(F.array_sort(F.collect_list(failed)), 1, 3).alias("first"))
    return got.where("read = 0").select("episode", "n", F.array_join(F.transform("first", lambda x: x["said"]), "; ").alias("sample"))


def _ask(ask: Ask, *parts: DataFrame) -> DataFrame:
    requests = parts[0].select("custom_id", "prompt")
    for p in parts[1:]:
        requests = requests.unionByName(p.select("custom_id", "prompt"))
    return ask(requests)


def task_captions(episodes: DataFrame, ask: Ask, sampling: Sampling = STEPS, name: str | None = None) -> DataFrame:
    """One level of steps. Rows episode, scene, instruction (of the episode), step, s, e, caption, confidence, status.

    An episode without a readable answer has one row, with status error, the failed answers as caption, and no segment.
    """
    work = F.lit(f": {name}" if name else "")
    asked = kept(jobs(ranges(episodes), sampling, P.STEPS, F.format_string("%s/win_%d", F.col("episode").cast("string"), F.col("window_id")), task=work))
    answers = _ask(ask, asked, scene_requests(episodes))
    windows = kept(read_windows(asked, answers, "instructions", fenced=True))
    bad = unread(windows.select("episode", "window_id", "custom_id", "transitions"), answers)
    got = cuts.anchored(windows.join(bad.select("episode"), "episode", "left_anti"), ["episode"])
    whole = F.when(F.col("first_said").isNotNull(), F.col("first_said")).otherwise(name or "Full video")
    step = F.when(F.col("has_cuts"), F.col("step")).otherwise(1)
    got = got.select("episode", step.alias("step"), "s", "e", F.when(F.col("has_cuts"), F.coalesce("instruction", F.concat(F.lit("Step "), (F.col("step") + 1).cast("string")))).otherwise(whole).alias("caption"), "confidence", F.lit("ok").alias("status"))
    none = F.lit(None)
    failed = bad.select("episode", none.cast("long").alias("step"), none.cast("long").alias("s"), none.cast("long").alias("e"), F.concat(F.lit("no answer of "), F.col("n").cast("string"), F.lit(" could be read: "), F.col("sample")).alias("caption"), none.cast("double").alias("confidence"), F.lit("error").alias("status"))
    rows = kept(got.unionByName(failed))
    first = rows.where("status = 'ok'").groupBy("episode").agg(F.min_by("caption", "s").alias("instruction"))
    if name:
        first = first.withColumn("instruction", F.lit(name))
    return rows.join(scenes(episodes, answers), "episode").join(first, "episode", "left").select("episode", "scene", "instruction", "step", "s", "e", "caption", "confidence", "status")


def _listed(segments: DataFrame, text: Column) -> DataFrame:
    """episode, parts (structs s, e, instruction in order), and their JSON list for a prompt."""
    one = segments.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("s", "e", text.alias("instruction")))).alias("parts"))
    shown = F.transform("parts", lambda p, i: F.struct(i.alias("seg_id"), F.array(p["s"], p["e"]).alias("frame_interval"), p["instruction"].alias("instruction")))
    return one.withColumn("segments", F.to_json(shown))


def _proposals(parts: DataFrame, answers: DataFrame, steps: bool) -> DataFrame:
    """parts with `new` (structs s, e, instruction, step), null unless the answer is a list that keeps old bounds, the whole
    range, and no gap; with steps, numbers that never fall."""
    text = "regexp_extract(text, '(?s)\\\\[.*\\\\]', 0)"
    got = parts.join(answers.select("custom_id", "text"), "custom_id", "left").withColumn("items", F.expr(f"try_variant_get(try_parse_json({text}), '$', 'array<variant>')"))
    number = lambda i: f"CAST(try_variant_get(x, '$.frame_interval[{i}]', 'double') AS BIGINT)"
    exact = lambda i: f"IF(try_variant_get(x, '$.frame_interval[{i}]', 'double') = {number(i)}, {number(i)}, NULL)"
    # without steps bounds are read as whole numbers, with steps they must be such
    bound = exact if steps else number
    said = "try_variant_get(x, '$.instruction', 'string')"
    said = said if steps else f"CASE WHEN is_variant_null(try_variant_get(x, '$.instruction', 'variant')) THEN 'None' ELSE coalesce({said}, '') END"
    item = f"named_struct('s', {bound(0)}, 'e', {bound(1)}, 'instruction', {said}, 'step', try_variant_get(x, '$.sop_step_index', 'bigint'), 'n', size(try_variant_get(x, '$.frame_interval', 'array<variant>')))"
    got = got.withColumn("new", F.expr(f"transform(items, x -> {item})"))
    ends = "array_distinct(concat(transform(parts, p -> p.s), transform(parts, p -> p.e)))"
    sound = ["size(new) > 0", f"forall(new, x -> coalesce(x.n = 2 AND array_contains({ends}, x.s) AND array_contains({ends}, x.e), false))", "new[0].s = parts[0].s", "element_at(new, -1).e = element_at(parts, -1).e"]
    sound.append("forall(sequence(0, size(new) - 1), i -> i = 0 OR get(new, i).s = get(new, i - 1).e)")
    if steps:
        sound += ["forall(new, x -> x.step IS NOT NULL AND x.instruction IS NOT NULL)", "forall(sequence(0, size(new) - 1), i -> i = 0 OR get(new, i).step >= get(new, i - 1).step)"]
    # one after the other: the later rules need what the earlier ones say
    rule = "true"
    for s in reversed(sound):
        rule = f"IF(coalesce({s}, false), {rule}, false)"
    return got.withColumn("new", F.when(F.expr(rule), F.col("new"))).drop("items", "text")


def refine_tasks(segments: DataFrame, ask: Ask) -> DataFrame:
    """Segments (episode, s, e, caption) merged as the model says, in one call an episode of several; where it doesn't keep
    the rules, neighbours with one caption (trimmed, without case, not blank) are merged. `how`: kept, refined or merged."""
    said = F.trim("caption")
    parts = _listed(segments, F.when(said == "", F.lit(DEFAULT_TASK)).otherwise(said))
    many = kept(parts.where("size(parts) > 1").withColumns({"custom_id": F.concat(F.col("episode").cast("string"), F.lit("/refine_tasks")), "prompt": P.MERGE_TASKS.column(segments=F.col("segments"))}))
    told = kept(_proposals(many.select("episode", "parts", "custom_id"), _ask(ask, many), False))
    word = F.trim("x.instruction")
    good = told.where("new IS NOT NULL").select("episode", F.explode("new").alias("x")).select("episode", "x.s", "x.e", F.when(word == "", F.lit(DEFAULT_TASK)).otherwise(word).alias("caption"), F.lit("refined").alias("how"))
    bad = segments.join(told.where("new IS NULL").select("episode"), "episode", "left_semi").select("episode", "s", "e", "caption")
    key = F.lower(F.trim("caption"))
    exact = cuts.merged(bad, ["episode"], F.when(key != "", key), "caption").select("episode", "s", "e", "caption", F.lit("merged").alias("how"))
    alone = segments.join(many.select("episode"), "episode", "left_anti").select("episode", "s", "e", "caption", F.lit("kept").alias("how"))
    return good.unionByName(exact).unionByName(alone)


def two_level_captions(episodes: DataFrame, ask: Ask, tasks: Sampling = TASKS, actions: Sampling = ACTIONS) -> DataFrame:
    """Tasks, refined, then each task's actions in windows of its own range.

    Rows episode, scene, instruction (of the episode), task, s, e, caption, how, actions (structs caption, s, e, in order).
    """
    asked = kept(jobs(ranges(episodes), tasks, P.TASKS, F.format_string("%s/task_%d", F.col("episode").cast("string"), F.col("window_id"))))
    answers = _ask(ask, asked, scene_requests(episodes))
    default = '{"instruction":"' + DEFAULT_TASK + '"}'
    raw = cuts.chained(kept(read_windows(asked, answers, "tasks")), ["episode"], default, cuts.NOTHING)
    word = F.expr("try_variant_get(try_parse_json(payload), '$.instruction', 'string')")
    first = kept(raw.select("episode", "s", "e", F.coalesce(word, F.lit("")).alias("caption")))
    refined = refine_tasks(first, ask)
    word = F.when(F.col("caption") == "", F.lit(DEFAULT_TASK)).otherwise(F.trim("caption"))
    ordered = refined.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("s", "e", word.alias("caption"), "how"))).alias("t"))
    level = kept(ordered.select("episode", F.posexplode("t").alias("task", "x")).select("episode", F.col("task").cast("long").alias("task"), "x.*"))
    inner = level.join(ranges(episodes).select("episode", "fps"), "episode").select("episode", "task", F.col("s").alias("low"), F.col("e").alias("high"), "fps", F.col("caption").alias("of_task"))
    asked = kept(jobs(inner, actions, P.ACTIONS, F.format_string("%s/action_%d_%d", F.col("episode").cast("string"), F.col("task"), F.col("window_id")), task=F.col("of_task")))
    said = cuts.chained(kept(read_windows(asked, _ask(ask, asked), "actions")), ["episode", "task"], DEFAULT_ACTION, cuts.NOTHING)
    slug = T.column(T.slug(SPARK, "payload", DEFAULT_ACTION))
    listed = said.groupBy("episode", "task").agg(F.array_sort(F.collect_list(F.struct("s", "e", slug.alias("caption")))).alias("actions"))
    rows = level.join(listed, ["episode", "task"], "left").join(scenes(episodes, answers), "episode")
    words = ordered.select("episode", F.filter(F.transform("t", lambda x: F.trim(x["caption"])), lambda c: c != "").alias("words")).select("episode", F.when(F.size("words") > 0, F.array_join("words", "; ")).otherwise(DEFAULT_TASK).alias("instruction"))
    return rows.join(words, "episode").select("episode", "scene", "instruction", "task", "s", "e", "caption", "how", F.coalesce(F.transform("actions", lambda x: F.struct(x["caption"].alias("caption"), x["s"].alias("s"), x["e"].alias("e"))), F.array().cast("array<struct<caption:string,s:bigint,e:bigint>>")).alias("actions"))


def _steps_text(steps: Column) -> Column:
    return F.array_join(F.transform(steps, lambda s: F.concat(F.lit("  Step "), s["step"].cast("string"), F.lit(": "), s["description"])), "\n")


def refine_steps(segments: DataFrame, sops: DataFrame, ask: Ask, rounds: int = ROUNDS) -> DataFrame:
    """Segments (episode, s, e, instruction) mapped to steps of their procedure. Only episodes whose answer breaks a rule are
    asked again, up to `rounds` times; each round is written. Then neighbours with one instruction are merged and numbered.

    Rows episode, step (from 0), s, e, instruction, sop_step_index, attempts, how (refined or merged).
    """
    parts = _listed(segments, F.col("instruction")).join(sops.select("episode", "task_name", "steps"), "episode")
    prompt = P.MERGE_STEPS.column(task=F.col("task_name"), steps=_steps_text(F.col("steps")), segments=F.col("segments"))
    open_ = kept(parts.select("episode", "parts", prompt.alias("prompt")))
    good: DataFrame | None = None
    for k in range(1, rounds + 1):
        asked = open_.withColumn("custom_id", F.format_string("%s/refine_%d", F.col("episode").cast("string"), F.lit(k)))
        told = kept(_proposals(asked, _ask(ask, asked), True))
        got = told.where("new IS NOT NULL").select("episode", F.lit(k).cast("long").alias("attempts"), "new")
        good = got if good is None else good.unionByName(got)
        open_ = told.where("new IS NULL").select("episode", "parts", "prompt")
        if open_.isEmpty():
            break
    refined = good.select("episode", "attempts", F.posexplode("new").alias("step", "x")).select("episode", F.col("step").cast("long").alias("step"), "x.s", "x.e", "x.instruction", F.col("x.step").alias("sop_step_index"), "attempts", F.lit("refined").alias("how"))
    left = cuts.merged(open_.select("episode", F.explode("parts").alias("x")).select("episode", "x.s", "x.e", "x.instruction"), ["episode"], F.col("instruction"), "instruction")
    order = left.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct("s", "e", "instruction"))).alias("p")).select("episode", F.posexplode("p").alias("step", "x"))
    merged = order.select("episode", F.col("step").cast("long").alias("step"), "x.s", "x.e", "x.instruction", (F.col("step") + 1).cast("long").alias("sop_step_index"), F.lit(rounds).cast("long").alias("attempts"), F.lit("merged").alias("how"))
    return refined.unionByName(merged)


def sop_captions(episodes: DataFrame, sops: DataFrame, valleys: DataFrame, ask: Ask, sampling: Sampling = STEPS, snap: int = SNAP, rounds: int = ROUNDS) -> DataFrame:
    """Steps of a procedure: legacy windows, cuts moved to the nearest valley of the hands' motion, then refinement by rounds.

    sops: episode, task_name, steps (array of struct step, description); valleys: episode, mark. Rows as of `refine_steps`,
    with scene and task_name. Episodes without a procedure are left out.
    """
    base = ranges(episodes).join(sops, "episode")
    asked = kept(jobs(base, sampling, P.SOP_STEPS, F.format_string("%s/desc_win_%d", F.col("episode").cast("string"), F.col("window_id")), legacy=True, task=F.col("task_name"), steps=_steps_text(F.col("steps"))))
    wanted = episodes.join(sops.select("episode"), "episode", "left_semi")
    answers = _ask(ask, asked, scene_requests(wanted))
    windows = kept(read_windows(asked.drop("steps", "task_name"), answers, "instructions"))
    got = cuts.anchored(windows, ["episode"], valleys, snap).join(sops.select("episode", "task_name", "steps"), "episode")
    place = F.least((F.col("step") + 1).cast("int"), F.size("steps"))
    own = F.get(F.filter("steps", lambda s: s["step"] == place), F.lit(0))["description"]
    fallback = F.coalesce(own, F.concat(F.lit("Step "), place.cast("string")))
    said = F.when(F.col("has_cuts"), F.coalesce("instruction", fallback)).otherwise(F.coalesce("first_said", "task_name"))
    segments = kept(got.select("episode", "s", "e", said.alias("instruction")))
    return refine_steps(segments, sops, ask, rounds).join(scenes(wanted, answers), "episode").join(sops.select("episode", "task_name"), "episode").select("episode", "scene", "task_name", "step", "s", "e", "instruction", "sop_step_index", "attempts", "how")
