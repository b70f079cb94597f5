"""Model calls behind a pluggable backend: requests in, answers out, a bounded pool a task, one failure never fails the rest.

A backend maps a list of request texts to a list of answers (an exception stands for a failed request). Answers are keyed
by custom_id, so a task that runs again gives the same rows; where a backend has side effects, switch speculation off.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.functions.text import SCENES
from framelake.sources.sinks import kept

ANSWER = "custom_id string, text string, prompt_tokens long, completion_tokens long, status_code int, error string"


class Backend(Protocol):
    """A backend may have `reply(custom_id, prompt)` instead."""

    def answer(self, prompt: str) -> str: ...


class Stub:
    """Deterministic answers from the prompt's hash; every `fail`-th prompt fails."""

    def __init__(self, fail: int = 0):
        self.fail = fail

    def answer(self, prompt: str) -> str:
        x = int(hashlib.sha256(prompt.encode()).hexdigest()[:8], 16)
        if self.fail and x % self.fail == 0:
            raise RuntimeError("stub failure")
        return json.dumps({"ego_hand_count": x % 3, "active_manipulation": "yes" if x % 2 else "no", "scene": "household"})


class Scripted:
    """Stand-in for the caption flows: answers follow from the digits of the hash of id and prompt, and many are faulty."""

    def reply(self, custom_id: str, prompt: str) -> str:
        d = [int(c, 16) for c in hashlib.sha256(f"{custom_id}\n{prompt}".encode()).hexdigest()]
        if '"scene"' in prompt:
            return self.scene(d)
        if '"frame_interval"' in prompt:
            return self.merge(d, json.loads(prompt[prompt.index("Segments:\n") + 10 :]), '"sop_step_index"' in prompt)
        return self.window(d, next(f for f in ("instructions", "tasks", "actions") if f'"{f}"' in prompt))

    def window(self, d: list[int], field: str) -> str:
        if d[0] == 0:
            raise RuntimeError("no answer")
        k = d[1] % 3
        said = [d[5 + i] % 4 for i in range(k + (d[9] > 0))]
        word = {"instructions": lambda w: f"step {w}" if w < 3 else "", "tasks": lambda w: {"instruction": f"task {w}"} if w < 3 else {}, "actions": lambda w: f"Do {w}!" if w < 3 else ""}[field]
        body = json.dumps({"thought": "t", "transitions": [d[2 + i] for i in range(k)], field: [word(w) for w in said]})
        return ["", "nothing to see", f"```json\n{body}\n```", f"Here: {body} done."][d[0]] if d[0] < 4 else body

    def scene(self, d: list[int]) -> str:
        if d[0] == 10:
            raise RuntimeError("no answer")
        return json.dumps({"scene": f" {SCENES[d[0]].upper()}"}) if d[0] < 10 else "???"

    def merge(self, d: list[int], old: list[dict], steps: bool) -> str:
        mode = d[0] % 6
        if mode == 0:
            raise RuntimeError("no answer")
        pairs = [old[i : i + 2] for i in range(0, len(old), 2)]
        new = [{"frame_interval": [p[0]["frame_interval"][0], p[-1]["frame_interval"][1]], "instruction": f"merged {i}" if i % 3 < 2 else " "} | ({"sop_step_index": i + 1 if mode < 5 else -i} if steps else {}) for i, p in enumerate(pairs)]
        if mode == 3:
            new[0]["frame_interval"][1] += 1
        if mode == 4:
            del new[1:2]
        return "no list" if mode == 1 else f"Merged: {json.dumps(new)}"


def call(requests: DataFrame, make: Callable[[], Backend], workers: int = 8, tries: int = 1, wait: float = 0.3) -> DataFrame:
    """ANSWER rows for requests (custom_id, prompt). A backend is made once a task; after the last try a request has status 500 and
    the error. Requests are dealt to all tasks: they are few bytes and much waiting, so they aren't put together by size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = make()

        reply = getattr(backend, "reply", lambda _, prompt: backend.answer(prompt))

        def one(custom_id: str | None, prompt: str | None) -> tuple[str | None, int, str | None]:
            for k in range(tries):
                try:
                    return reply(custom_id, prompt or ""), 200, None
                except Exception as e:  # noqa: BLE001  a request's failure is a row
                    error = str(e) or type(e).__name__
                    if k + 1 < tries:
                        time.sleep(wait * 1.5**k)
            return None, 500, error

        with ThreadPoolExecutor(workers) as pool:
            for b in batches:
                prompts = b.column(1).to_pylist()
                got = list(pool.map(one, b.column(0).to_pylist(), prompts))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([len((p or "").split()) for p in prompts], pa.int64()), pa.array([len((g[0] or "").split()) for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.string())],
                    [c.split()[0] for c in ANSWER.split(", ")],
                )

    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return requests.select("custom_id", "prompt").repartition(parts, "custom_id").mapInArrow(run, ANSWER)


@dataclass(frozen=True)
class Direct:
    """Asks at once. A request's answer is written before it is used."""

    make: Callable[[], Backend]
    workers: int = 8
    tries: int = 1

    def __call__(self, requests: DataFrame) -> DataFrame:
        return kept(call(requests, self.make, self.workers, self.tries))


def retry_failed(requests: DataFrame, first: DataFrame, make: Callable[[], Backend]) -> DataFrame:
    """Answers with those that failed asked once more; `retried` says which. Both are written before they are used, so no call runs twice."""
    first = kept(first)
    again = call(requests.join(first.where("status_code <> 200").select("custom_id"), "custom_id", "left_semi"), make)
    again = kept(again)
    names = [c.split()[0] for c in ANSWER.split(", ")][1:]
    second = again.select("custom_id", F.struct(*names).alias("_b"), F.lit(True).alias("_again"))
    both = first.join(second, "custom_id", "left")
    return both.select("custom_id", *(F.when(F.col("_again"), F.col(f"_b.{c}")).otherwise(F.col(c)).alias(c) for c in names), F.coalesce("_again", F.lit(False)).alias("retried"))


def messages(images: str = "images", prompt: str = "prompt"):
    """Multimodal content: images that aren't empty, then the text."""
    part = "named_struct('type', '{}', 'text', {}, 'image_url', {})"
    pictures = f"transform(filter({images}, x -> coalesce(x, '') <> ''), x -> {part.format('image_url', 'CAST(NULL AS STRING)', 'x')})"
    return F.expr(f"concat({pictures}, array({part.format('text', prompt, 'CAST(NULL AS STRING)')}))")


def request_lines(requests: DataFrame, model: str) -> DataFrame:
    """Batch-request lines (one JSON object a row), to be written with `write.text`."""
    return requests.select(F.to_json(F.struct("custom_id", F.lit(model).alias("model"), F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("messages"))).alias("value"))


def read_answers(lines: DataFrame) -> DataFrame:
    """custom_id, text, status_code of batch-output lines (`value`); blank lines are skipped, the status is 200 unless given."""
    spec = "struct<custom_id:string,response:struct<status_code:int,body:struct<choices:array<struct<message:struct<content:string>>>,usage:struct<prompt_tokens:bigint,completion_tokens:bigint>>>>"
    got = lines.where("trim(value) <> ''").select(F.from_json("value", spec).alias("r")).where("r.custom_id IS NOT NULL")
    return got.selectExpr("r.custom_id", "get(r.response.body.choices, 0).message.content AS text", "coalesce(r.response.status_code, 200) AS status_code", "r.response.body.usage.prompt_tokens AS prompt_tokens", "r.response.body.usage.completion_tokens AS completion_tokens")
