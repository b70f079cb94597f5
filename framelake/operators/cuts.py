"""From window answers to segments, by two rules: `chained` (clusters by the last cut, votes by frame) and `anchored`
(clusters by the first cut, votes by span).

Windows: key columns, window_id, n_windows, frame_ids (long array), transitions (long array, null where the model gave
nothing), payloads (string array), low, high, fps. A recording's cuts are one array; what lies in a segment is found by
`ranges.overlaps`, so that no window or join takes a whole recording at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions.ranges import nearest, overlaps

#: Seconds within which cuts are one, and that a segment lasts at least.
CLUSTER, LEAST = 2.0, 0.8
#: Frames of a bucket in which votes and segments meet.
BUCKET = 512
#: Canonical JSON of values that count as nothing.
NOTHING = ("", '""', "{}", "[]", "null", "0", "0.0", "false")


def windows(ranges: DataFrame, window_sec: float | Column, step_sec: float | Column, per_window: int | Column, legacy: bool = False) -> DataFrame:
    """Rows of ranges (keys, low, high, fps) with window_id, n_windows, start_frame, end_frame (included) and frame_ids, a row
    a window. One window if the range isn't longer; else starts at every step up to the first window that reaches the end.

    Legacy windows cut lengths in frames instead of rounding them, and a range that is one window has all `per_window`
    frames, though numbers may repeat.
    """
    wide, starts = _starts(window_sec, step_sec, legacy)
    rows = ranges.where("high > low").withColumn("starts", starts)
    rows = rows.select(*ranges.columns, F.size("starts").cast("long").alias("n_windows"), F.posexplode("starts").alias("window_id", "start_frame"))
    rows = rows.withColumns({"window_id": F.col("window_id").cast("long"), "end_frame": _end(F.col("start_frame"), wide)})
    most = F.lit(per_window).cast("long")
    fixed = F.when(F.col("high") - F.col("low") <= wide, most) if legacy else None
    return rows.withColumn("frame_ids", _spread(F.col("start_frame"), F.col("end_frame"), most, fixed))


def _starts(window_sec: float | Column, step_sec: float | Column, legacy: bool = False) -> tuple[Column, Column]:
    """A window's length in frames, and the array of first frames over [low, high)."""
    whole = (lambda x: x.cast("long")) if legacy else (lambda x: F.rint(x).cast("long"))
    frames = lambda sec: F.greatest(F.lit(1), whole(F.lit(sec) * F.col("fps")))
    wide, step = frames(window_sec), frames(step_sec)
    return wide, F.when(F.col("high") - F.col("low") <= wide, F.array("low")).otherwise(F.filter(F.sequence("low", F.col("high") - 1, step), lambda s: (s == F.col("low")) | (s - step + wide < F.col("high"))))


def _end(start: Column, wide: Column) -> Column:
    return F.least(start + wide - 1, F.col("high") - 1)


def _spread(a: Column, b: Column, most: Column, fixed: Column | None = None) -> Column:
    """At most `most` frames evenly from a to b; `fixed`, where it isn't null, says how many."""
    k = F.least(most, b - a + 1)
    k = k if fixed is None else F.coalesce(fixed, k)
    at = lambda i: F.when(i == k - 1, F.when(k == 1, a).otherwise(b)).otherwise(F.floor(a + i * ((b - a).cast("double") / (k - 1))).cast("long"))
    return F.transform(F.sequence(F.lit(0).cast("long"), k - 1), at)


def sampled(window_sec: float | Column, step_sec: float | Column, per_window: int | Column) -> Column:
    """The frames of all `windows` of a row's range, as one array; frames of overlapping windows repeat."""
    wide, starts = _starts(window_sec, step_sec)
    return F.flatten(F.transform(starts, lambda s: _spread(s, _end(s, wide), F.lit(per_window).cast("long"))))


def _weight() -> Column:
    """The inner places of a Hann window over all windows; one window weighs 1."""
    n, i = F.col("n_windows"), F.col("window_id")
    return F.when(n == 1, F.lit(1.0)).otherwise(F.lit(0.5) + F.lit(0.5) * F.cos(F.pi() * (1 - (n + 2) + 2 * (i + 1)) / (n + 1)))


def pieces(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A row a piece of a window: from one place to the next, `a` to `b`, with what is said of it (null: nothing)."""
    n = F.size("frame_ids")
    valid = F.filter("transitions", lambda t: (t >= 0) & (t < n))
    got = rows.where("transitions IS NOT NULL AND size(frame_ids) > 0").withColumn("valid", valid).withColumn("piece", F.explode(F.sequence(F.lit(0), F.size("valid"))))
    a = F.when(F.col("piece") == 0, F.lit(0)).otherwise(F.get("valid", F.col("piece") - 1)).cast("int")
    b = F.when(F.col("piece") == F.size("valid"), n - 1).otherwise(F.get("valid", F.col("piece"))).cast("int")
    said = F.when(F.col("piece") < F.size("payloads"), F.coalesce(F.get("payloads", F.col("piece")), F.lit("")))
    return got.select(*keys, "window_id", "piece", a.alias("a"), b.alias("b"), said.alias("payload"), "frame_ids", _weight().alias("w"))


def _centres(radius: str, by: str) -> str:
    """Weighted centres of the clusters of `cuts`, sorted structs (frame, window_id, piece, w): a cut joins while it is at most
    `radius` from the cluster's first or last cut. The list grows once a cluster."""
    centre = "CAST(round(x.sf / x.sw, 9) AS BIGINT)".replace("x.", "s.")
    return f"""aggregate(cuts, named_struct('done', CAST(array() AS ARRAY<BIGINT>), 'edge', CAST(0 AS BIGINT), 'sw', 0D, 'sf', 0D),
        (s, c) -> CASE WHEN s.sw > 0 AND c.frame - s.edge <= {radius} THEN named_struct('done', s.done, 'edge', {'s.edge' if by == 'first' else 'c.frame'}, 'sw', s.sw + c.w, 'sf', s.sf + c.frame * c.w)
            ELSE named_struct('done', IF(s.sw > 0, array_append(s.done, {centre}), s.done), 'edge', c.frame, 'sw', c.w, 'sf', c.frame * c.w) END,
        s -> IF(s.sw > 0, array_append(s.done, {centre}), s.done))"""


def _greedy(least: str) -> str:
    """Of the sorted `centres` those at least `least` after the one before, from `low`; the last goes if the tail is shorter."""
    kept = f"""aggregate(centres, named_struct('done', CAST(array() AS ARRAY<BIGINT>), 'edge', low),
        (s, c) -> IF(c - s.edge >= {least}, named_struct('done', array_append(s.done, c), 'edge', c), s),
        s -> IF(size(s.done) > 0 AND high - s.edge < {least}, slice(s.done, 1, size(s.done) - 1), s.done))"""
    return kept


def clusters(rows: DataFrame, keys: list[str], by: str, cluster: float = CLUSTER) -> DataFrame:
    """keys, low, high, fps, centres (null without any cut), one row a key."""
    radius = f"CAST({cluster} * fps AS BIGINT)"
    radius = f"greatest(1, {radius})" if by == "last" else radius
    cut = F.transform(F.filter(F.arrays_zip(F.sequence(F.lit(0), F.size("transitions") - 1).alias("i"), F.col("transitions").alias("t")), lambda x: (x["t"] >= 0) & (x["t"] < F.size("frame_ids"))), lambda x: F.struct(F.get("frame_ids", x["t"].cast("int")).alias("frame"), F.col("window_id").alias("window_id"), x["i"].alias("piece"), F.col("w").alias("w")))
    told = rows.withColumn("w", _weight()).withColumn("cut", F.when(F.size("transitions") > 0, cut))
    one = told.groupBy(*keys).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("fps").alias("fps"), F.max("n_windows").alias("n_windows"), F.array_sort(F.flatten(F.collect_list("cut"))).alias("cuts"))
    return one.withColumn("centres", F.when(F.size("cuts") > 0, F.expr(_centres(radius, by)))).drop("cuts")


def bounded(found: DataFrame, keys: list[str], by: str, least_sec: float = LEAST) -> DataFrame:
    """keys, has_cuts, n_windows, step, s, e from clusters' centres."""
    least = f"CAST({least_sec} * fps AS BIGINT)"
    least = f"greatest(1, {least})" if by == "last" else least
    centres = F.array_sort(F.array_distinct(F.coalesce("centres", F.array().cast("array<long>"))))
    if by == "last":
        centres = F.filter(centres, lambda c: (c > F.col("low")) & (c < F.col("high")))
    ends = F.concat(F.array("low"), F.expr(_greedy(least)), F.array("high"))
    rows = found.withColumn("has_cuts", F.col("centres").isNotNull()).withColumn("centres", centres).withColumn("ends", ends)
    return rows.select(*keys, "fps", "n_windows", "has_cuts", "ends", F.explode(F.sequence(F.lit(0), F.size("ends") - 2)).alias("step")).select(*keys, "has_cuts", "n_windows", F.col("step").cast("long").alias("step"), F.get("ends", F.col("step")).alias("s"), F.get("ends", F.col("step") + 1).alias("e"))


def _middle() -> tuple[Column, Column]:
    long = F.col("e") - F.col("s")
    return F.col("s") + (F.lit(0.4) * long).cast("long"), F.col("s") + (F.lit(0.6) * long).cast("long")


def merged(rows: DataFrame, keys: list[str], same: Column, value: str) -> DataFrame:
    """Neighbours (keys, s, e, value) that are the `same` as the one before become one, with the first's value."""
    order = Window.partitionBy(*keys).orderBy("s")
    run = F.sum(F.when(F.coalesce(same == F.lag(same).over(order), F.lit(False)), 0).otherwise(1)).over(order)
    return rows.withColumn("run_", run).groupBy(*keys, "run_").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min_by(value, "s").alias(value)).drop("run_")


def chained(rows: DataFrame, keys: list[str], default: str, nothing: tuple[str, ...] = ("",), cluster: float = CLUSTER, least: float = LEAST) -> DataFrame:
    """keys, s, e, payload. Cuts within the radius of the one before form a cluster, whose weighted centre is a cut if it lies
    strictly inside the range. A segment's payload is the most frequent at the frames of its middle fifth, else at all of
    its frames (of ties the first seen), else, or where it is `nothing`, the default. Neighbours with one payload are merged.
    """
    segments = bounded(clusters(rows, keys, "last", cluster), keys, "last", least)
    line = pieces(rows, keys).where("payload IS NOT NULL AND a <= b").withColumn("k", F.explode(F.sequence("a", "b")))
    line = line.select(*keys, F.get("frame_ids", F.col("k")).alias("frame"), "window_id", "piece", "k", "payload").withColumn("until", F.col("frame"))
    inside = overlaps(segments.where("has_cuts").withColumn("last", F.col("e") - 1), line, keys, ("s", "last"), ("frame", "until"), BUCKET)
    a, b = _middle()
    mid = F.col("frame").between(a, b)
    order = F.struct("frame", "window_id", "piece", "k")
    votes = inside.groupBy(*keys, "s", "e", "payload").agg(F.count(F.lit(1)).alias("all"), F.count_if(mid).alias("mid"), F.min(order).alias("first"), F.min(F.when(mid, order)).alias("mid_first"))
    won = votes.groupBy(*keys, "s", "e").agg(F.min_by("payload", F.struct(-F.col("all"), "first")).alias("of_all"), F.min_by(F.when(F.col("mid") > 0, F.col("payload")), F.struct(-F.col("mid"), "mid_first")).alias("of_mid"))
    said = F.coalesce("of_mid", "of_all")
    told = segments.select(*keys, "s", "e").join(won, [*keys, "s", "e"], "left").select(*keys, "s", "e", F.when(said.isNull() | said.isin(*nothing), F.lit(default)).otherwise(said).alias("payload"))
    return merged(told, keys, F.col("payload"), "payload")


def anchored(rows: DataFrame, keys: list[str], marks: DataFrame | None = None, most: int = 45) -> DataFrame:
    """keys, step (from 0), s, e, instruction (null: nobody says), first_said (of all windows), has_cuts, confidence.

    Cuts within the radius of a cluster's first form the cluster. With marks (keys, mark), a centre moves to the nearest mark
    within `most` frames. A segment is what most of the spans that touch its middle fifth say, of ties the first.
    """
    found = clusters(rows, keys, "first").withColumn("n_clusters", F.coalesce(F.size("centres"), F.lit(0)))
    if marks is not None:
        points = found.where("centres IS NOT NULL").select(*keys, F.explode(F.array_distinct("centres")).alias("at"))
        moved = nearest(points, marks, keys, "at", "mark", most).groupBy(*keys).agg(F.collect_list(F.coalesce("mark", "at")).alias("moved"))
        found = found.join(moved, keys, "left").withColumn("centres", F.coalesce("moved", "centres")).drop("moved")
    n = F.when(F.col("n_clusters") > F.col("step"), F.least(F.lit(1.0), F.col("n_clusters") / F.col("n_windows"))).otherwise(0.0)
    segments = bounded(found, keys, "first").join(found.select(*keys, "n_clusters"), keys)
    spans = pieces(rows, keys).where("payload IS NOT NULL").select(*keys, F.get("frame_ids", F.col("a")).alias("span_s"), F.get("frame_ids", F.col("b")).alias("span_e"), "window_id", "piece", "payload")
    a, b = _middle()
    met = overlaps(segments.withColumns({"mid_s": a, "mid_e": b}), spans, keys, ("mid_s", "mid_e"), ("span_s", "span_e"), BUCKET)
    votes = met.groupBy(*keys, "s", "payload").agg(F.count(F.lit(1)).alias("votes"), F.min(F.struct("window_id", "piece")).alias("first"))
    won = votes.groupBy(*keys, "s").agg(F.min_by("payload", F.struct(-F.col("votes"), "first")).alias("instruction"))
    first = spans.groupBy(*keys).agg(F.min_by("payload", F.struct("window_id", "piece")).alias("first_said"))
    confidence = F.when(F.col("has_cuts"), n).otherwise(1.0)
    return segments.join(won, [*keys, "s"], "left").join(first, keys, "left").select(*keys, "step", "s", "e", "instruction", "first_said", "has_cuts", confidence.alias("confidence"))
