"""Joins of ranges as equi joins: both sides are dealt to buckets of whole numbers, and a pair meets in its first common one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _buckets(low: Column, high: Column, width: int) -> Column:
    of = lambda c: F.floor(c / F.lit(width)).cast("long")
    return F.sequence(of(low), of(high))


def overlaps(left: DataFrame, right: DataFrame, on: list[str], a: tuple[str, str], b: tuple[str, str], width: int) -> DataFrame:
    """Pairs of equal `on` whose ranges a (of left) and b (of right), ends included, meet; each pair once.

    A range makes a row for each `width` numbers it touches, so that no task compares all ranges of one key with each other.
    Ranges with an end before their start meet those that hold both ends. Columns other than `on` differ by name.
    """
    low = lambda x: F.least(*x)
    high = lambda x: F.greatest(*x)
    bucket = "bucket_"
    x, y = (t.withColumn(bucket, F.explode(_buckets(low(s), high(s), width))) for t, s in ((left, a), (right, b)))
    first = F.floor(F.greatest(low(a), low(b)) / F.lit(width)).cast("long")
    return x.join(y, [*on, bucket]).where((F.col(a[0]) <= F.col(b[1])) & (F.col(a[1]) >= F.col(b[0])) & (F.col(bucket) == first)).drop(bucket)


def nearest(points: DataFrame, marks: DataFrame, on: list[str], at: str, mark: str, most: int) -> DataFrame:
    """points (distinct) with `mark` as the nearest of marks within `most`, the first in order of ties; null if none is so near.

    Marks are dealt to the bucket of most + 1 numbers they lie in and to its neighbours, so a point meets those of three.
    """
    width = most + 1
    of = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    near = marks.select(*on, F.col(mark).alias("mark_"), F.explode(F.array(of(mark) - 1, of(mark), of(mark) + 1)).alias("bucket_"))
    far = F.abs(F.col("mark_") - F.col(at))
    met = points.withColumn("bucket_", of(at)).join(near, [*on, "bucket_"]).where(far <= most).groupBy(*on, at).agg(F.min_by("mark_", F.struct(far, F.col("mark_"))).alias(mark))
    return points.join(met, [*on, at], "left")
