"""A table of decoded frames, read through: what is wanted and not there is decoded once, for all who want it.

Frames lie in `buckets` folders by a hash of their episode, sorted by episode and number, so a lookup reads the folders of
its episodes only, and of a file the row groups of its numbers. Rows: bucket, episode, profile, frame_idx, image (binary).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME = ["episode", "profile", "frame_idx"]


@dataclass(frozen=True)
class FrameTable:
    """`decode` makes image rows (FRAME, image) of wanted rows (FRAME)."""

    path: str
    decode: Callable[[DataFrame], DataFrame]
    buckets: int = 64

    def _there(self, spark: SparkSession) -> bool:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64("episode"), F.lit(self.buckets)).cast("int"))

    def _of(self, wanted: DataFrame) -> DataFrame:
        """The table's rows in the wanted rows' buckets; at most `buckets` numbers come to the driver."""
        used = [r.bucket for r in self._bucketed(wanted.select("episode").distinct()).select("bucket").distinct().collect()]
        return wanted.sparkSession.read.parquet(self.path).where(F.col("bucket").isin(used))

    def ensure(self, wanted: DataFrame) -> None:
        """Decodes what of `wanted` (FRAME) isn't there yet, each frame once however often it is wanted."""
        rows = self._bucketed(wanted.select(*FRAME).distinct())
        if self._there(wanted.sparkSession):
            rows = rows.join(self._of(wanted).select("bucket", *FRAME), ["bucket", *FRAME], "left_anti")
        made = self._bucketed(self.decode(rows.select(*FRAME)))
        made.repartition("bucket").sortWithinPartitions("bucket", *FRAME).write.partitionBy("bucket").mode("append").parquet(self.path)

    def get(self, wanted: DataFrame, by: list[str]) -> DataFrame:
        """wanted (FRAME and the columns `by` of a request) with image; of a request that isn't complete no row, as half a
        sample would be taken for a whole one."""
        rows = wanted.distinct()
        found = rows.join(self._of(wanted).drop("bucket").dropDuplicates(FRAME), FRAME, "left")
        whole = found.groupBy(*by).agg(F.count(F.lit(1)).alias("n_"), F.count("image").alias("have_")).where("n_ = have_").select(*by)
        return found.join(whole, by, "left_semi")

    def provide(self, wanted: DataFrame, by: list[str]) -> DataFrame:
        """`ensure`, then `get`."""
        self.ensure(wanted)
        return self.get(wanted, by)

    def get_base64(self, wanted: DataFrame, by: list[str]) -> DataFrame:
        """One row a request: its images in order as base64 texts."""
        got = self.get(wanted, by)
        return got.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("frame_idx", F.regexp_replace(F.base64("image"), r"\s", "").alias("b")))), lambda x: x["b"]).alias("images"))
