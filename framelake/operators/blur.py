"""The blur driver: which frames are looked at, what is found there, and the blurred pictures.

A detector is made once a task and finds boxes [x1, y1, x2, y2] of faces and of plates in a frame; it loads the picture
itself. With sampling, every `step`-th frame is looked at, and from a hit on both ways while something is found. What lies
between two samples is then one piece of work, which no other piece shares: forward from the lower sample if it is a
hit, back from the upper. So pieces run side by side, and no frame is looked at that the rule doesn't ask for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions import pixels
from framelake.sources.sinks import kept

Box = list[float]


class Detector(Protocol):
    def faces(self, episode: int, frame_idx: int) -> list[Box]: ...
    def plates(self, episode: int, frame_idx: int) -> list[Box]: ...


#: Fixed names: detector backends, and modes of looking.
MERGING, DEDUPING = "egoblur", "yolo"
SAMPLED, EVERY = "sampling_expand", "legacy_per_frame"


def overlap(a: Box, b: Box) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    area = lambda x: max(0.0, x[2] - x[0]) * max(0.0, x[3] - x[1])
    whole = area(a) + area(b) - w * h
    return w * h / whole if whole > 0 else 0.0


def distinct(boxes: list[Box], most: float = 0.9) -> list[Box]:
    """Boxes in order, without those that overlap an earlier one by `most` or more."""
    out: list[Box] = []
    for b in boxes:
        if all(overlap(b, x) < most for x in out):
            out.append(b)
    return out


@dataclass(frozen=True)
class Look:
    """How to look: the backend, its detector, what is wanted, the mode, and the step between samples. The merging backend
    keeps all boxes of both kinds, the other drops near repeats. Boxes are scaled from the detector's size to the frame's."""

    make: Callable[[], Detector]
    backend: str = MERGING
    faces: bool = True
    plates: bool = True
    mode: str = SAMPLED
    step: int = 1
    fx: float = 1.0
    fy: float = 1.0

    def __post_init__(self):
        if self.backend not in (MERGING, DEDUPING):
            raise ValueError(f"backend must be {MERGING} or {DEDUPING}, not {self.backend!r}")
        if self.mode not in (SAMPLED, EVERY):
            raise ValueError(f"mode must be {SAMPLED} or {EVERY}, not {self.mode!r}")

    def boxes(self, detector: Detector, episode: int, frame_idx: int) -> list[Box]:
        got = (list(detector.faces(episode, frame_idx)) if self.faces else []) + (list(detector.plates(episode, frame_idx)) if self.plates else [])
        got = distinct(got) if self.backend == DEDUPING else got
        return [[b[0] * self.fx, b[1] * self.fy, b[2] * self.fx, b[3] * self.fy] for b in got]


_SEEN = "episode long, frame_idx long, sample boolean, boxes array<array<double>>"
_BOXES = pa.list_(pa.list_(pa.float64()))


def _seen(rows: list[tuple]) -> pa.RecordBatch:
    e, f, s, b = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()), pa.array(f, pa.int64()), pa.array(s, pa.bool_()), pa.array(b, _BOXES)], ["episode", "frame_idx", "sample", "boxes"])


def looked_at(frames: DataFrame, look: Look) -> DataFrame:
    """episode, frame_idx, sample (true), boxes of the frames (episode, frame_idx)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = look.make()
        for batch in batches:
            yield _seen([(e, f, True, look.boxes(detector, e, f)) for e, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)])

    return frames.select("episode", "frame_idx").mapInArrow(run, _SEEN)


def grown(gaps: DataFrame, look: Look) -> DataFrame:
    """Frames looked at in gaps (episode, low, high, up, down): up from `low` and down from `high`, both not included, until
    nothing is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = look.make()
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                f = r["low"] + 1
                while r["up"] and f < r["high"]:
                    found = look.boxes(detector, r["episode"], f)
                    out.append((r["episode"], f, False, found))
                    f += 1
                    if not found:
                        break
                g = r["high"] - 1
                while r["down"] and g >= f:
                    found = look.boxes(detector, r["episode"], g)
                    out.append((r["episode"], g, False, found))
                    g -= 1
                    if not found:
                        break
            yield _seen(out)

    return gaps.select("episode", "low", "high", "up", "down").mapInArrow(run, _SEEN)


def detections(episodes: DataFrame, look: Look) -> DataFrame:
    """_SEEN rows of every frame looked at, each once. Episodes: episode, n."""
    step = max(1, look.step) if look.mode == SAMPLED else 1
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1, F.lit(step).cast("long")))
    samples = kept(looked_at(episodes.where("n > 0").select("episode", at.alias("frame_idx")), look))
    if look.mode == EVERY or step == 1:
        return samples
    # a gap's upper end is the next sample, or the episode's length
    hits = samples.select("episode", "frame_idx", (F.size("boxes") > 0).alias("hit")).join(episodes.select("episode", F.col("n").cast("long").alias("n")), "episode")
    other = hits.select("episode", (F.col("frame_idx") - step).alias("low"), F.col("hit").alias("down"))
    gaps = hits.select("episode", F.col("frame_idx").alias("low"), F.least(F.col("frame_idx") + step, "n").alias("high"), F.col("hit").alias("up")).join(other, ["episode", "low"], "left")
    gaps = gaps.withColumn("down", F.coalesce("down", F.lit(False))).where("(up OR down) AND high - low > 1")
    return kept(samples.unionByName(grown(gaps, look)))


def ranges(seen: DataFrame) -> DataFrame:
    """episode, start_frame, end_frame of the runs of frames with boxes."""
    found = seen.where("size(boxes) > 0")
    island = F.col("frame_idx") - F.row_number().over(Window.partitionBy("episode").orderBy("frame_idx"))
    return found.withColumn("island", island).groupBy("episode", "island").agg(F.min("frame_idx").alias("start_frame"), F.max("frame_idx").alias("end_frame")).drop("island")


def summary(episodes: DataFrame, seen: DataFrame, look: Look) -> DataFrame:
    """One row an episode: counts of the report, and the ranges in order. Looking at every frame, nothing is sampled or grown."""
    sampled = look.mode == SAMPLED
    step = max(1, look.step)
    found = F.size("boxes") > 0
    counts = seen.groupBy("episode").agg(
        F.sum(F.size("boxes")).cast("long").alias("detections_total"), F.count_if(found).alias("frames_with_detections"), F.count_if(found & F.col("sample")).alias("sample_hit_frames"), F.count(F.lit(1)).alias("unique_detection_frames"),
    )
    listed = F.array_sort(F.collect_list(F.struct("start_frame", "end_frame")))
    of = ranges(seen).groupBy("episode").agg(listed.alias("positive_ranges"), F.sum(F.col("end_frame") - F.col("start_frame")).alias("grown"))
    none = F.array().cast("array<struct<start_frame:bigint,end_frame:bigint>>")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    rows = episodes.select("episode", F.col("n").cast("long").alias("total_frames")).join(counts, "episode", "left").join(of, "episode", "left")
    return rows.select(
        "episode", "total_frames", zero("detections_total").alias("detections_total"), zero("frames_with_detections").alias("frames_with_detections"), F.lit(look.backend).alias("detector_backend"), F.lit(look.mode).alias("detection_mode"),
        F.when(F.col("total_frames") > 0, F.ceil(F.col("total_frames") / step)).otherwise(0).cast("long").alias("sampled_frames"), (zero("sample_hit_frames") if sampled else F.lit(0).cast("long")).alias("sample_hit_frames"),
        zero("unique_detection_frames").alias("unique_detection_frames"), (zero("grown") if sampled else F.lit(0).cast("long")).alias("unique_expanded_frames"), (F.coalesce("positive_ranges", none) if sampled else none).alias("positive_ranges"),
    )


def regions(boxes: list[Box], width: int, height: int, scale: float) -> list[tuple[int, int, int, int]]:
    """Boxes grown about their centre, cut to whole numbers and to the picture; empty ones go."""
    out = []
    for x1, y1, x2, y2 in boxes:
        cx, cy, bw, bh = (x1 + x2) / 2, (y1 + y2) / 2, (x2 - x1) * scale, (y2 - y1) * scale
        r = max(int(cx - bw / 2), 0), max(int(cy - bh / 2), 0), min(int(cx + bw / 2), width), min(int(cy + bh / 2), height)
        if r[2] > r[0] and r[3] > r[1]:
            out.append(r)
    return out


def blurred(images: DataFrame, seen: DataFrame, scale: float = 1.0) -> DataFrame:
    """images (episode, frame_idx, w, h, px: bytes of gray or, three a pixel, of colours) with the ellipses of their boxes
    blurred. Pictures without a box pass as they are."""
    rows = images.join(seen.where("size(boxes) > 0").select("episode", "frame_idx", "boxes"), ["episode", "frame_idx"], "left").select("episode", "frame_idx", "w", "h", "px", "boxes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            px = batch.column(4).to_pylist()
            for i, (w, h, boxes) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 5)), strict=True)):
                if boxes:
                    image = np.frombuffer(px[i], np.uint8)
                    image = image.reshape(h, w) if len(px[i]) == w * h else image.reshape(h, w, -1)
                    px[i] = pixels.blur_boxes(image, regions(boxes, w, h, scale)).tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(px, pa.binary())], ["episode", "frame_idx", "w", "h", "px"])

    return rows.mapInArrow(run, "episode long, frame_idx long, w int, h int, px binary")


#: Encoders by codec, on a graphics card and without.
CARD = {"h264": "h264_nvenc", "hevc": "hevc_nvenc", "h265": "hevc_nvenc"}
PLAIN = {"h264": "libx264", "hevc": "libx265", "h265": "libx265", "vp9": "libvpx-vp9", "av1": "libsvtav1"}


def encode_args(codec: Column, pix_fmt: Column, bitrate: Column, card: bool = False) -> Column:
    """The writer's encoder arguments, after the source's codec, pixel format and bits a second (0: unknown)."""
    among = lambda table: F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), codec)
    on_card = among(CARD) if card else F.lit(None).cast("string")
    encoder = F.coalesce(on_card, among(PLAIN), F.lit("libx264"))
    known = F.coalesce(bitrate, F.lit(0)) > 0
    rate = bitrate.cast("long")
    text = lambda c: c.cast("string")
    fast = F.when(encoder == "libx264", F.when(known, " -preset veryfast -profile:v high").otherwise(" -crf 17 -preset veryfast")).when(encoder == "libx265", F.when(known, " -preset veryfast -profile:v main").otherwise(" -crf 18 -preset veryfast")).otherwise("")
    of_card = F.when(known, F.concat(F.lit(" -maxrate:v "), text((rate * 1.5).cast("long")), F.lit(" -bufsize:v "), text(rate * 2))).otherwise(" -cq 18 -preset p4")
    return F.concat(F.lit("-c:v "), encoder, F.lit(" -pix_fmt "), F.coalesce(F.nullif(pix_fmt, F.lit("")), F.lit("yuv420p")), F.when(known, F.concat(F.lit(" -b:v "), text(rate))).otherwise(""), F.when(on_card.isNotNull(), of_card).otherwise(fast))
