"""Shared parts of the operators: tables in the shared folder, fixed-size row filters, components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set and all runs in one process (tests), one of our own."""
    got = spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        got = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker is sent at a time, so that two workers and their executor fit in little memory. Kept for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that, when it is done, gives freed memory back to the system: workers are used again by later
    stages, and what allocators keep adds up beside the executor's own memory."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL(None).malloc_trim(0)

    return whole


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001  the session may be gone; the folder is a scratch folder
        pass


def stash(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """df written once to the shared folder as Parquet and read again: cuts the lineage, survives lost executors. It stays until
    the session's end, or until `drop`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")  # its shuffles aren't needed once it is written
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stash = path
    return out


def drop(*tables: DataFrame) -> None:
    """Removes stashed tables from the shared folder. Nothing that isn't written yet may come from them."""
    for t in tables:
        _remove(t.sparkSession, t._stash)


#: Cells of a row filter; what is broadcast for one is at most so many small integers, however many rows there are.
CELLS = 1 << 20


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with a suffix where a column has them already."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def split_by(df: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of df whose doc_id may be among `ids` (a column of longs), and the others; neither is shuffled.

    Ids are hashed to CELLS cells, and the cells in use are broadcast: at most CELLS integers.
    """
    (cell,) = unused(df.columns, "cell")
    hashed = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(CELLS)).cast("int")
    cells = F.broadcast(ids.select(hashed(ids.columns[0]).alias(cell)).distinct())
    marked = df.withColumn(cell, hashed("doc_id"))
    return tuple(marked.join(cells, cell, how).select(*df.columns) for how in ("left_semi", "left_anti"))


def attach(docs: DataFrame, found: DataFrame, value: str, by_text: bool = False) -> tuple[DataFrame, str]:
    """docs and the name of a new last column: found's `value` of the row's doc_id (and of the hash of its text, if
    by_text), null if there is none. found has each doc_id (and text_hash) once. Documents without one aren't shuffled."""
    name, id_, hash_ = unused(docs.columns, value, "doc_id", "text_hash")
    near, far = split_by(docs, found.select("doc_id"))
    other = found.select(F.col("doc_id").alias(id_), *([F.col("text_hash").alias(hash_)] if by_text else []), F.col(value).alias(name))
    on = F.col("doc_id").cast("long") == F.col(id_)
    if by_text:
        on &= F.xxhash64("text") == F.col(hash_)
    near = near.join(other.hint("shuffle_hash"), on, "left").select(*docs.columns, name)
    return near.union(far.withColumn(name, F.lit(None).cast(found.schema[value].dataType))), name


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node, component (its least node) for the ends of edges (a, b); longs.

    Alternating large and small stars: every round each node tells its neighbours of the least node it knows, by
    aggregation and join, so a node with many neighbours is never gathered in one row. Rounds are logarithmic in the
    length of the longest path; each is written to the shared folder.
    """
    def put(df: DataFrame) -> tuple[DataFrame, tuple]:
        """df written, with a count and a hash sum of its rows that are taken as they are written."""
        seen = Observation()
        out = stash(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
        got = seen.get
        return out, (got["n"], got["h"])

    e, last = put(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    for _ in range(most if last[0] else 0):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        before = e
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # small star: all of a node's lesser neighbours, and itself, go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e, now = put(large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct())
        drop(before)
        if now == last:
            break
        last = now
    else:
        if last[0]:
            raise RuntimeError("components did not settle")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def merged(known: DataFrame, edges: DataFrame) -> DataFrame:
    """`known` (node, component; written) with the groups that edges (a, b; written) connect made one. Only groups with new edges
    go through the rounds of `components`; what is known is joined with the result once, and dropped when that is written."""
    if edges.isEmpty():
        return known
    for end in ("a", "b"):
        to = known.select(F.col("node").alias(end), F.col("component").alias("to"))
        edges = edges.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    now = stash(components(edges))
    moved = known.join(now.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    out = stash(moved.union(now.join(known, "node", "left_anti")))
    drop(known, now)
    return out


#: At most so many keys can each hold more than the HEAVY-th part of all rows.
HEAVY = 1024


def facts(rows: DataFrame, table: DataFrame, key: list[str], n: str, value: str) -> DataFrame:
    """rows with `table`'s value of their key, null where it has none. table is written, has a key once, and counts in `n`
    how many rows have it.

    Keys over the HEAVY-th part of the counted rows, at most HEAVY of them, come by broadcast; of the others, rows whose key
    isn't there are told by a broadcast of at most CELLS cells and stay where they are, and the rest is shuffled by key. So
    no task gets more than a small part of the rows by one key.
    """
    hot, cell = unused([*rows.columns, *table.columns], "hot", "cell")
    total = table.agg(F.sum(n)).first()[0] or 0
    heavy, light = (table.where(x).select(*key, value) for x in (F.col(n) > total // HEAVY, F.col(n) <= total // HEAVY))
    hashed = F.pmod(F.xxhash64(*key), F.lit(CELLS)).cast("int").alias(cell)
    cells = F.broadcast(light.select(hashed).distinct())
    marked = rows.join(F.broadcast(heavy.withColumnRenamed(value, hot)), key, "left").withColumn(cell, F.when(F.col(hot).isNull(), hashed))
    here = marked.join(cells, cell, "left_anti").select(*rows.columns, F.col(hot).alias(value))
    near = marked.join(cells, cell, "left_semi").join(light.hint("shuffle_hash"), key, "left")
    return here.union(near.select(*rows.columns, value))
