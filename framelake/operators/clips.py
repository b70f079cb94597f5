"""Cutting clips and encoding files: what is there already, stream copy first, else encoding anew; each command runs once.

A runner executes a command in a task and says whether it succeeded, how many bytes its output has (null: no file), and
what it wrote on failure. A command that fails is a row, not a failed job.
"""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.sources.sinks import kept

#: An output counts if it has more bytes than this; what a command says is cut at so many characters.
LEAST_BYTES, MOST_TEXT = 0, 2000


class Runner(Protocol):
    def run(self, command: str, output: str) -> tuple[bool, int | None, str]: ...


class Shell:
    """Commands as processes of the worker, with outputs on a shared disk."""

    def run(self, command: str, output: str) -> tuple[bool, int | None, str]:
        got = subprocess.run(command.split(), capture_output=True, text=True, check=False)
        at = Path(output)
        return got.returncode == 0, at.stat().st_size if at.exists() else None, got.stderr


def executed(rows: DataFrame, key: list[str], command: str, output: str, make: Callable[[], Runner]) -> DataFrame:
    """key, ok, bytes, said of each row's command, run once and written."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runner = make()
        for batch in batches:
            got = [runner.run(c, o) for c, o in zip(batch.column(len(key)).to_pylist(), batch.column(len(key) + 1).to_pylist(), strict=True)]
            ok, size, said = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], pa.array(ok, pa.bool_()), pa.array(size, pa.int64()), pa.array(said, pa.string())], [*key, "ok", "bytes", "said"])

    return kept(rows.select(*key, command, output).mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in key) + ", ok boolean, bytes long, said string"))


def _tried(rows: DataFrame, due: Column, command: str, mark: str, make: Callable[[], Runner]) -> DataFrame:
    """rows, written, with ok, bytes and said (and the mark) of the command in place of it, run once where it is due; null
    elsewhere. Rows go along with what came of them, so nothing is joined again."""
    kept_ = [c for c in rows.columns if c != command]
    got = [T.StructField(f"ok{mark}", T.BooleanType()), T.StructField(f"bytes{mark}", T.LongType()), T.StructField(f"said{mark}", T.StringType())]
    schema = T.StructType([rows.schema[c] for c in kept_] + got)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runner = make()
        for batch in batches:
            commands, outputs, dues = (batch.column(c).to_pylist() for c in (command, "output", "due_"))
            came = [runner.run(c, o) if d else (None, None, None) for c, o, d in zip(commands, outputs, dues, strict=True)]
            ok, size, said = zip(*came, strict=True) if came else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept_), pa.array(ok, pa.bool_()), pa.array(size, pa.int64()), pa.array(said, pa.string())], schema.names)

    return kept(rows.withColumn("due_", due).mapInArrow(run, schema))


def cut_fps(caption: Column, average: Column, real: Column) -> Column:
    """Frames a second for cutting: the caption's own, else the average rate, else the real rate; null if none is over 0."""
    given = lambda c: F.when(c > 0, c.cast("double"))
    read = lambda c: F.when(c.rlike(r"^\s*[0-9.]+\s*/\s*[0-9.]+\s*$"), F.try_divide(F.split(c, "/")[0].try_cast("double"), F.split(c, "/")[1].try_cast("double"))).otherwise(c.try_cast("double"))
    return F.coalesce(given(caption), given(read(average)), given(read(real)))


def _enough(c: str = "bytes") -> Column:
    return F.coalesce(F.col(c) > LEAST_BYTES, F.lit(False))


def _cut(text: Column, most: int = MOST_TEXT) -> Column:
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.lit("..."), F.right(text, F.lit(most))))


def cut_clips(plan: DataFrame, existing: DataFrame, make: Callable[[], Runner]) -> DataFrame:
    """How each clip of a plan came about. plan: episode, segment, segment_id, output, copy, encode (commands), reason (why it
    can't be cut, or null); existing: output, bytes.

    Rows episode, segment, segment_id, output, how (cached, copy, reencode or failed), reason, message. A clip that is there is
    not cut again; one that copying didn't make is encoded anew.
    """
    key = ["episode", "segment"]
    # smaller parts than the session's: a task sorts whole commands
    parts = 4 * int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    there = existing.where(_enough()).select("output", F.lit(True).alias("there"))
    rows = plan.repartition(parts, "output").join(there.repartition(parts, "output"), "output", "left").select(*key, "segment_id", "output", "copy", "encode", "reason", F.coalesce("there", F.lit(False)).alias("there"))
    first = _tried(rows, F.expr("reason IS NULL AND NOT there"), "copy", "1", make)
    second = _tried(first, F.expr("reason IS NULL AND NOT there") & ~_enough("bytes1"), "encode", "2", make)
    got = second.withColumns({"copied": _enough("bytes1"), "said1": F.when(~F.col("ok1"), F.col("said1"))})
    how = F.when(F.col("reason").isNotNull(), "failed").when(F.col("there"), "cached").when(F.col("copied"), "copy").when(F.col("ok2") & _enough("bytes2"), "reencode").otherwise("failed")
    both = F.when(F.coalesce("said1", F.lit("")) != "", F.concat(F.lit("stream-copy failed first:\n"), "said1", F.lit("\n\nre-encode failed:\n"), "said2")).otherwise(F.col("said2"))
    why = F.when(F.col("reason").isNotNull(), F.col("reason")).when(how == "failed", F.when(F.col("ok2"), "output_too_small").otherwise("ffmpeg_failed"))
    message = F.when(why == "ffmpeg_failed", _cut(both)).when(why == "output_too_small", F.concat(F.lit("output file missing or too small: "), F.coalesce("bytes2", F.lit(0)).cast("string"), F.lit(" bytes")))
    return got.select(*key, "segment_id", "output", how.alias("how"), why.alias("reason"), message.alias("message"))


def manifest(clips: DataFrame, sample: int = 3) -> DataFrame:
    """Counters of an episode's clips, its status, and the first failures, as a report shows them."""
    n = lambda *how: F.count_if(F.col("how").isin(*how))
    failures = F.slice(F.array_sort(F.collect_list(F.when(F.col("how") == "failed", F.struct("segment", "segment_id", "reason", "message")))), 1, sample)
    got = clips.groupBy("episode").agg(F.count(F.lit(1)).alias("requested"), n("cached", "copy", "reencode").alias("successful"), n("failed").alias("failed"), n("copy", "reencode").alias("cut"), n("cached").alias("cached"), n("copy").alias("copied"), n("reencode").alias("reencoded"), failures.alias("failures"))
    return got.withColumn("status", F.when(F.col("successful") == 0, "failed").when(F.col("failed") > 0, "partial").otherwise("ok"))


def transcoded(plan: DataFrame, make: Callable[[], Runner], probe: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Executes plans (media, spec, output, command, error) and records what came of them: media, spec, output, status (ok,
    error or skipped), error, and the probe (made of the outputs that are there, by media and spec) as `after`."""
    key = ["media", "spec"]
    ran = executed(plan.where("error IS NULL"), key, "command", "output", make)
    good = ran.where(F.col("ok") & _enough()).select(*key).join(plan.select(*key, "output"), key)
    after = probe(good)
    after = after.select(*key, F.struct(*[c for c in after.columns if c not in key]).alias("after"))
    got = plan.select(*key, "output", "error").join(ran.select(*key, "ok", "bytes", "said"), key, "left").join(after, key, "left")
    status = F.when(F.col("error").isNotNull(), "skipped").when(F.col("ok") & _enough(), "ok").otherwise("error")
    said = F.when(F.col("error").isNotNull(), F.col("error")).when(~F.col("ok"), _cut(F.col("said"))).when(~_enough(), F.lit("no output"))
    return got.select(*key, "output", status.alias("status"), said.alias("error"), "after")
