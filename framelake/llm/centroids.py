"""Centroid clustering of vectors, exact in whole numbers.

A vector's component x counts as floor(1024 * x). Centroids start as the `k` vectors with the smallest hash of their id;
in each round every vector goes to its nearest centroid (squared distance; of ties the smaller number), and a centroid
with vectors becomes the floor of their mean. A last pass assigns once more.

Vectors are packed once into blocks of BLOCK rows, written to the shared folder. A round is a `treeAggregate` over the
blocks, which brings k counts and k sums to the driver. Distances of a block are |x|^2 - 2 x.c + |c|^2 with one float64
matrix product. With m and n the greatest magnitudes in the block and in the centroids, no sum, in whatever order it is
taken, exceeds dims * (m + n)^2; under 2^53 each of its terms and sums is a whole number that a float64 holds, so the
result is exact. A block beyond this bound is done in int64 differences, and beyond 2^62 in Python's whole numbers.

Cases: vectors that are null, of another length, or with a null or non-finite component are left out. Rows with a null
vec_id take part, with nothing after the prefix in their hash. Rows that share a vec_id are several vectors; of equal
hashes the lesser vector comes first. With fewer than k vectors each is a centroid; a table without any gives no rows.
Distances and inertias beyond a long are null, while clusters and centroids stay exact. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import spread

DIMS, CLUSTERS, ROUNDS, SCALE, PREFIX = 64, 8, 10, 1024, "3:"
BLOCK = 4096
EXACT, WIDE = 1 << 53, 1 << 62
LONG = (1 << 63) - 1


def usable(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(f"size(embedding) = {dims} AND forall(embedding, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity'))")


def pack(vectors: DataFrame, dims: int = DIMS, block: int = BLOCK) -> DataFrame:
    """Blocks (ids, x, narrow): ids of up to `block` vectors and their bytes, as float32 if that loses nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        parts: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            x = np.concatenate(parts)
            with np.errstate(over="ignore"):
                small = x.astype(np.float32)
            narrow = bool((small == x).all())
            names = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), pa.array([(small if narrow else x).tobytes()], pa.binary()), pa.array([narrow])], ["ids", "x", "narrow"])

        for batch in batches:
            values = batch.column(1)
            x = np.asarray(values.flatten()).reshape(len(values), dims)
            at = 0
            while at < len(x):
                n = min(block - held, len(x) - at)
                ids.append(batch.column(0).slice(at, n))
                parts.append(x[at : at + n])
                held, at = held + n, at + n
                if held == block:
                    yield out()
                    ids, parts, held = [], [], 0
        if held:
            yield out()

    return vectors.select("vec_id", "embedding").mapInArrow(run, "ids array<long>, x binary, narrow boolean")


def whole(raw: bytes, narrow: bool, dims: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of a block: whole float64 numbers, or Python's where the product leaves float64's range."""
    x = np.frombuffer(raw, np.float32 if narrow else np.float64).reshape(-1, dims).astype(np.float64)
    with np.errstate(over="ignore"):
        got = np.floor(x * scale)
    if np.isfinite(got).all():
        return got
    exact = np.empty(x.shape, object)
    exact.flat = [int(v) * scale if abs(v) >= EXACT else math.floor(v * scale) for v in x.ravel().tolist()]
    return exact


def _top(x: np.ndarray) -> int:
    return int(max(abs(x.max()), abs(x.min()))) if x.size else 0


def _objects(x: np.ndarray) -> np.ndarray:
    if x.dtype == object:
        return x
    out = np.empty(x.shape, object)
    out.flat = [int(v) for v in x.ravel().tolist()]
    return out


def distances(x: np.ndarray, centres: list[list[int]]) -> np.ndarray:
    """Squared distances of each row to each centre: float64 by a matrix product if exact, else int64, else Python's numbers."""
    far = max((abs(v) for c in centres for v in c), default=0)
    bound = x.shape[1] * (_top(x) + far) ** 2
    if bound < EXACT:
        c = np.array(centres, np.float64).reshape(len(centres), x.shape[1])
        return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
    if bound < WIDE:
        y = x.astype(np.int64)
        return np.stack([((y - np.array(c, np.int64)) ** 2).sum(1) for c in centres], 1)
    y = _objects(x)
    return np.stack([((y - np.array(c, object)) ** 2).sum(1) for c in centres], 1)


def sums(x: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and component sums (Python's numbers) of each cluster in a block."""
    n = np.bincount(cluster, minlength=k)
    if x.dtype != object and len(x) * _top(x) < EXACT:
        hot = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float64)
        return _objects(n), _objects(hot @ x)
    y = _objects(x)
    return _objects(n), np.stack([y[cluster == j].sum(0) if n[j] else np.full(x.shape[1], 0, object) for j in range(k)])


def _merge(a, b):
    if a is None or b is None:
        return b if a is None else a
    return tuple(p + q for p, q in zip(a, b, strict=True))


def _total(blocks: RDD, centres: list[list[int]], dims: int, of) -> tuple | None:
    """Sums over all blocks of `of(x, distances, cluster)`, combined by a tree; None without blocks."""
    shared = blocks.context.broadcast(centres)

    def add(acc, block):
        x = whole(bytes(block[0]), block[1], dims)
        d = distances(x, shared.value)
        return _merge(acc, of(x, d, d.argmin(1)))

    return blocks.treeAggregate(None, add, _merge)


def _inertia(k: int):
    def of(x, d, cluster):
        least = _objects(d[np.arange(len(d)), cluster])
        return (np.array([sum(least[cluster == j].tolist()) for j in range(k)], object),)

    return of


def starts(vectors: DataFrame, k: int = CLUSTERS, prefix: str = PREFIX) -> list[list[int]]:
    """The first centroids: k rows at most, by the hash of the id."""
    key = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).collect()
    return [_objects(whole(np.array(r.embedding, np.float64).tobytes(), False, len(r.embedding)))[0].tolist() for r in rows]


def fit(blocks: DataFrame, centres: list[list[int]], rounds: int = ROUNDS) -> list[list[int]]:
    """The centroids after `rounds` passes over the blocks; empty ones stay where they are."""
    if not centres:
        return centres
    k, dims = len(centres), len(centres[0])
    rdd = blocks.select("x", "narrow").rdd
    for _ in range(rounds):
        got = _total(rdd, centres, dims, lambda x, d, cluster: sums(x, cluster, k))
        if got is None:
            break
        n, total = got
        moved = [[int(v) // int(n[j]) for v in total[j].tolist()] if n[j] else centres[j] for j in range(k)]
        if moved == centres:  # later rounds change nothing
            break
        centres = moved
    return centres


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and the centroid's components of each vector."""
    spark = vectors.sparkSession
    spread.small_batches(spark)
    rows = usable(vectors, dims)
    blocks = spread.stash(pack(rows, dims))
    centres = fit(blocks, starts(rows, k), rounds)
    got = _total(blocks.select("x", "narrow").rdd, centres, dims, _inertia(len(centres))) if centres else None
    each = got[0].tolist() if got else []
    fits = lambda v: int(v) if abs(v) <= LONG else None
    each, all_ = [fits(v) for v in each], fits(sum(each))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    small = [[fits(v) for v in c] for c in centres]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw, narrow in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                d = distances(whole(raw.as_py(), narrow.as_py(), dims), centres)
                near = d.argmin(1)
                least = [fits(v) for v in d[np.arange(len(d)), near].tolist()]
                of = near.tolist()
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(near.astype(np.int32)), pa.array(least, pa.int64()), pa.array([each[j] for j in of], pa.int64()), pa.array([all_] * len(of), pa.int64()), pa.array([digests[j] for j in of], pa.string()), pa.array([small[j] for j in of], pa.list_(pa.int64()))],
                    ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"],
                )

    return blocks.mapInArrow(run, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("centroid")


def oracle(k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS) -> str:
    """The same in SQL: a table a round. Centroids are lists; distances are whole doubles under 2^53."""
    floor = "CAST(floor(CAST(sum(v.x[j]) AS DOUBLE) / count(*)) AS BIGINT)"
    steps = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda y: CAST(floor({SCALE} * CAST(y AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{PREFIX}' || vec_id)) - 1 AS INTEGER) AS c, x AS m FROM v ORDER BY sha256('{PREFIX}' || vec_id) LIMIT {k})",
    ]
    # of equal distances the smaller number: both are whole, and numbers are under k
    near = f"SELECT v.r, arg_min(c.c, d.d * {k} + c.c) AS c, min(d.d) AS d FROM v, {{c}} c, LATERAL (SELECT list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c.m[i]) * (v.x[i] - c.m[i]))) AS d) d GROUP BY v.r"
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({near.format(c=f'c{i}')})")
        mean = f"SELECT c, list(s ORDER BY j) AS m FROM (SELECT a.c, j, {floor} AS s FROM a{i} a JOIN v ON v.r = a.r, range(1, {dims + 1}) t(j) GROUP BY a.c, j) q GROUP BY c"
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN ({mean}) n ON n.c = o.c)")
    steps.append(f"z AS MATERIALIZED ({near.format(c=f'c{rounds}')})")
    return f"""WITH {', '.join(steps)} SELECT v.vec_id, z.c AS cluster, CAST(z.d AS BIGINT) AS distance, CAST(sum(z.d) OVER (PARTITION BY z.c) AS BIGINT) AS cluster_inertia, CAST(sum(z.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.m, ',')) AS centroid_sha256
        FROM z JOIN v ON v.r = z.r JOIN c{rounds} c ON c.c = z.c"""
