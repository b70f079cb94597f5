"""Sinks: a table of materialised frames that grows by what is missing, keyed merges, JSON documents."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of our own where all runs in one process (tests). Set for the session's checkpoints, too."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def kept(df: DataFrame) -> DataFrame:
    """The rows, computed once and written to the shared folder of spark.checkpoint.dir; for what must not run twice, as model calls."""
    shared(df.sparkSession)
    return df.checkpoint()


def fill(wanted: DataFrame, path: str, make: Callable[[DataFrame], DataFrame], key: tuple[str, ...] = ("episode", "frame_idx")) -> DataFrame:
    """Reads wanted rows through a Parquet table: what it lacks is made by `make` and appended, then all is read by join."""
    spark = wanted.sparkSession
    wanted = wanted.select(*key).distinct()
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)
    missing = wanted.join(spark.read.parquet(path).select(*key), list(key), "left_anti") if there else wanted
    make(missing).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(wanted, list(key), "left_semi")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both by key; the new row wins."""
    names = [c for c in old.columns if c != key]
    b = new.select(key, F.struct(*names).alias("_new"))
    both = old.join(b, key, "full_outer")
    return both.select(key, *(F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in names))


def documents(df: DataFrame, key: str) -> DataFrame:
    """key and one JSON document of each row's other columns, for `write.partitionBy(key).text`."""
    return df.select(key, F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("value"))


def concat_ready(segments: DataFrame) -> DataFrame:
    """Episodes of which every segment (episode, segment, output, ready) is ready, with the outputs in order; one is a copy."""
    got = segments.groupBy("episode").agg(F.bool_and("ready").alias("all_ready"), F.sort_array(F.collect_list(F.struct("segment", "output"))).alias("parts"))
    return got.where("all_ready").select("episode", F.transform("parts", lambda p: p["output"]).alias("outputs"), F.when(F.size("parts") == 1, "copy").otherwise("concat").alias("how"))
