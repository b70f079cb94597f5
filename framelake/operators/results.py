"""Results of a run for the host that started it: artifacts by port, an aggregate manifest, logs, one JSON document a run.

Artifacts: run, input (its number from 1), place (within the input), name, type, path, port, port_name, data (struct),
metadata (struct). Rows of `dag.run` become artifacts by `from_steps`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed names: of an operator's ports the id, the name, and the type of what comes out.
PORTS = {"caption": ("out-1", "result", "json"), "segments": ("out-2", "segments", "json"), "segment_video": ("out-3", "segment_video", "video")}
KEPT = {"ignoreNullFields": "false"}


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def from_steps(results: DataFrame, runs: DataFrame, ports: dict[str, tuple[str, str, str]] = PORTS) -> DataFrame:
    """Artifacts of the outputs of steps that have a port. results as of `dag.run`; runs: run, work, input."""
    table = F.create_map(*(x for k, v in ports.items() for x in (F.lit(k), F.struct(*(F.lit(y).alias(n) for n, y in zip(("port", "port_name", "type"), v, strict=True))))))
    order = F.create_map(*(x for i, k in enumerate(ports) for x in (F.lit(k), F.lit(i))))
    rows = results.join(runs, "work").withColumn("p", F.try_element_at(table, "operator")).where("p IS NOT NULL").withColumn("step", F.try_element_at(order, "operator"))
    count = runs.groupBy("run").agg(F.count(F.lit(1)).alias("inputs"))
    rows = rows.join(count, "run").select("*", F.posexplode("outputs").alias("at", "path"))
    return rows.select(
        "run", "input", (F.col("step") * 1_000_000 + F.col("at")).cast("long").alias("place"), file_name(F.col("path")).alias("name"), "p.type", "path", "p.port", "p.port_name",
        F.struct(F.col("path").alias("payloadPath"), "status").alias("data"), F.struct(F.col("work").alias("inputPath"), F.col("input").alias("inputIndex"), F.col("inputs").alias("inputCount"), (F.col("at") + 1).alias("outputIndex"), F.size("outputs").alias("outputCount")).alias("metadata"),
    )


def step_documents(results: DataFrame, runs: DataFrame, logs: DataFrame, ports: dict[str, tuple[str, str, str]] = PORTS, aggregate: str = "caption_manifest.json", folder: str = "/output") -> DataFrame:
    """The documents of `from_steps`' artifacts. What is gathered by run is the steps; each artifact's JSON is made in the
    gathered row, so its text isn't shuffled."""
    table = F.create_map(*(x for i, (k, v) in enumerate(ports.items()) for x in (F.lit(k), F.struct(*(F.lit(y).alias(n) for n, y in zip(("port", "port_name", "type", "step"), (*v, i), strict=True))))))
    asked = runs.select("run", "work", "input", F.count(F.lit(1)).over(Window.partitionBy("run")).alias("inputs"))
    rows = results.where(F.col("operator").isin(*ports) & (F.size("outputs") > 0)).select("work", "operator", "status", "outputs").join(asked, "work")
    got = rows.groupBy("run").agg(F.max("inputs").alias("asked"), F.collect_list(F.struct("input", "operator", "status", "work", "outputs")).alias("steps"))

    def made(x: Column) -> Column:
        p = F.try_element_at(table, x["operator"])
        metadata = lambda at: F.struct(x["work"].alias("inputPath"), x["input"].alias("inputIndex"), F.col("asked").alias("inputCount"), (at + 1).alias("outputIndex"), F.size(x["outputs"]).alias("outputCount"))
        item = lambda path, at: F.struct(file_name(path).alias("name"), p["type"].alias("type"), path.alias("path"), p["port"].alias("portId"), p["port_name"].alias("portName"), F.struct(path.alias("payloadPath"), x["status"].alias("status")).alias("data"), metadata(at).alias("metadata"))
        return F.transform(x["outputs"], lambda path, at: F.struct(x["input"].alias("input"), (p["step"] * 1_000_000 + at).cast("long").alias("place"), F.to_json(item(path, at), KEPT).alias("v_"), path.alias("path"), (p["port"] == "out-1").alias("first")))

    got = got.select("run", F.array_sort(F.flatten(F.transform("steps", made))).alias("all"))
    captions = F.array_sort(F.transform(F.filter("all", lambda x: x["first"]), lambda x: F.struct(x["input"], x["place"], x["path"].alias("path"))))
    got = got.select("run", F.transform("all", lambda x: x["v_"]).alias("items"), F.size(F.array_distinct(F.transform("all", lambda x: x["input"]))).cast("long").alias("inputs"), F.transform(captions, lambda x: x["path"]).alias("captions"))
    return _whole(got, logs, aggregate, folder)


def status(requested: Column, made: Column, failed: Column) -> Column:
    """Of a cut: failed if nothing was made of what was asked, partial if some failed."""
    return F.when((requested > 0) & (made == 0), "failed").when(failed > 0, "partial").otherwise("ok")


def documents(artifacts: DataFrame, logs: DataFrame, aggregate: str = "caption_manifest.json", folder: str = "/output") -> DataFrame:
    """run and `value`, its JSON: logs in order, artifacts by input and place, and, of several inputs, an aggregate of those of
    the first port. logs: run, at (text), level, message, operator. A run without artifacts has its logs only.

    One aggregation a side; a run's artifacts are a document, so they are gathered in a row.
    """
    item = F.struct("name", "type", "path", F.col("port").alias("portId"), F.col("port_name").alias("portName"), "data", "metadata")
    first = F.when(F.col("port") == "out-1", F.struct("input", "place", F.col("path")))
    got = artifacts.groupBy("run").agg(_ordered(["input", "place"], F.to_json(item, KEPT)).alias("items"), F.count_distinct("input").alias("inputs"), F.transform(F.array_sort(F.collect_list(first)), lambda x: x["path"]).alias("captions"))
    return _whole(got, logs, aggregate, folder)


def _ordered(order: list[str], value: Column) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("v_")))), lambda x: x["v_"])


def _whole(got: DataFrame, logs: DataFrame, aggregate: str, folder: str) -> DataFrame:
    """run and value of run, items (JSON, in order), inputs and captions, with the runs' logs."""
    path = F.lit(f"{folder}/{aggregate}")
    data = F.struct(F.col("inputs").alias("inputCount"), F.col("captions"))
    whole = F.to_json(F.struct(F.lit(aggregate).alias("name"), F.lit("json").alias("type"), path.alias("path"), F.lit("out-1").alias("portId"), F.lit("result").alias("portName"), data.alias("data"), F.struct(F.col("inputs").alias("inputCount")).alias("metadata")), KEPT)
    got = got.withColumn("items", F.when(F.col("inputs") > 1, F.array_append("items", whole)).otherwise(F.col("items")))
    said = logs.groupBy("run").agg(_ordered(["at", "message"], F.to_json(F.struct(F.col("at").alias("timestamp"), "level", "message", "operator"), KEPT)).alias("lines"))
    rows = got.join(said, "run", "full")
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), ","), F.lit("]"))
    return rows.select("run", F.concat(F.lit('{"logs":'), listed("lines"), F.lit(',"artifacts":'), listed("items"), F.lit(',"resourceSeries":[]}')).alias("value"))


def runtime_args(row: list[str], labels: dict[str, str]) -> Column:
    """A log line of a run's arguments: `label=value`, empty ones as <empty>."""
    return F.concat_ws(", ", *(F.concat(F.lit(f"{labels.get(c, c)}="), F.coalesce(F.when(F.col(c).cast("string") != "", F.col(c).cast("string")), F.lit("<empty>"))) for c in row))
