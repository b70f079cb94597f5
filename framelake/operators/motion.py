"""Camera motion between sampled frames of real size: a similarity (shift, turn, zoom) fitted to the brightness of both, coarse to
fine, by Gauss-Newton steps; then speeds, jitter and stability as for any tracker.

Frames: episode, frame_idx, w, h, px (gray bytes). A pair is a frame and the sampled one before it in its episode. Pairs of
which nothing can be told (a flat picture, other sizes, no agreement) are left out, as those without matched points are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.operators.quality import SHIFT_SPEED, TURN_SPEED

LEAST_SIDE, STEPS, FLAT = 24, 30, 1e-3


def _halves(x: np.ndarray) -> np.ndarray:
    h, w = x.shape[0] // 2 * 2, x.shape[1] // 2 * 2
    return x[:h, :w].reshape(h // 2, 2, w // 2, 2).mean((1, 3))


def _sampled(x: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values between pixels, and which places lie inside."""
    h, w = x.shape
    ok = (u >= 0) & (u <= w - 1.001) & (v >= 0) & (v <= h - 1.001)
    i, j = np.where(ok, v, 0).astype(int), np.where(ok, u, 0).astype(int)
    a, b = np.where(ok, v, 0) - i, np.where(ok, u, 0) - j
    top = x[i, j] * (1 - b) + x[i, j + 1] * b
    low = x[i + 1, j] * (1 - b) + x[i + 1, j + 1] * b
    return top * (1 - a) + low * a, ok


def similarity(before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, float] | None:
    """The 2 x 3 matrix that takes places of `before` to those of `after`, and the share of the picture that agrees; None if
    nothing can be told."""
    if before.shape != after.shape or min(before.shape) < 8:
        return None
    levels = [(before.astype(float), after.astype(float))]
    while min(levels[-1][0].shape) >= 2 * LEAST_SIDE:
        levels.append(tuple(map(_halves, levels[-1])))
    if levels[0][0].std() < FLAT or levels[0][1].std() < FLAT:
        return None
    p = np.zeros(4)  # zoom and turn of 1 + a, b; shift in the picture's half-widths
    for x, y in reversed(levels):
        h, w = x.shape
        half = max(h, w) / 2
        yy, xx = (np.mgrid[:h, :w] - np.array([(h - 1) / 2, (w - 1) / 2])[:, None, None]) / half
        gy, gx = np.gradient(y)
        for _ in range(STEPS):
            u = ((1 + p[0]) * xx - p[1] * yy + p[2]) * half + (w - 1) / 2
            v = (p[1] * xx + (1 + p[0]) * yy + p[3]) * half + (h - 1) / 2
            got, ok = _sampled(y, u, v)
            dx, dy = _sampled(gx, u, v)[0] * half, _sampled(gy, u, v)[0] * half
            if ok.mean() < 0.2:
                return None
            e = (x - got)[ok]
            jac = np.stack([(dx * xx + dy * yy)[ok], (dy * xx - dx * yy)[ok], dx[ok], dy[ok]], 1)
            wide = np.median(np.abs(e)) * 4 + 1.0  # what doesn't move with the rest counts less
            weight = 1 / (1 + (e / wide) ** 2)
            normal = jac.T @ (jac * weight[:, None])
            try:
                step = np.linalg.solve(normal + 1e-9 * np.trace(normal) * np.eye(4), jac.T @ (weight * e))
            except np.linalg.LinAlgError:
                return None
            p += step
            if np.abs(step).max() * half < 1e-3:
                break
    if not np.isfinite(p).all() or np.abs(p).max() > 1.5:
        return None
    h, w = before.shape
    half = max(h, w) / 2
    turn = np.array([[1 + p[0], -p[1]], [p[1], 1 + p[0]]])
    centre = np.array([(w - 1) / 2, (h - 1) / 2])
    shift = centre - turn @ centre + p[2:] * half
    agree = float((np.abs(e) < max(12.0, before.std() / 2)).mean() * ok.mean())
    return (np.column_stack([turn, shift]), agree) if agree > 0.3 else None


def pair_motion(frames: DataFrame, fps: Column | float = 30.0) -> DataFrame:
    """episode, frame_from, frame_to, frame_mid, dx, dy, da, agree, shift_speed, turn_speed, jitter. `fps` may be a column of frames."""
    order = Window.partitionBy("episode").orderBy("frame_idx")
    names = ["episode", "frame_from", "frame_to", "w", "h", "px", "w0", "h0", "px0", "fps"]
    rows = frames.withColumns({"fps": F.lit(fps).cast("double"), "frame_from": F.lag("frame_idx").over(order), "w0": F.lag("w").over(order), "h0": F.lag("h").over(order), "px0": F.lag("px").over(order)})
    rows = rows.where("frame_from IS NOT NULL").withColumnRenamed("frame_idx", "frame_to").select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for e, a, b, w, h, px, w0, h0, px0, rate in zip(*(batch.column(i).to_pylist() for i in range(10)), strict=True):
                got = similarity(np.frombuffer(px0, np.uint8).reshape(h0, w0), np.frombuffer(px, np.uint8).reshape(h, w)) if px and px0 else None
                if got is not None:
                    m, agree = got
                    out.append((e, a, b, float(m[0, 2]), float(m[1, 2]), float(np.arctan2(m[1, 0], m[0, 0])), agree, rate))
            cols = list(zip(*out, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 3 + [pa.float64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["episode", "frame_from", "frame_to", "dx", "dy", "da", "agree", "fps"])

    got = rows.mapInArrow(run, "episode long, frame_from long, frame_to long, dx double, dy double, da double, agree double, fps double")
    dt = F.when(F.coalesce(F.col("fps"), F.lit(0.0)) > 0, (F.col("frame_to") - F.col("frame_from")) / F.col("fps")).otherwise(1.0)
    speed = lambda c: F.when(dt > 0, c / dt).otherwise(0.0)
    shift, turn = speed(F.hypot("dx", "dy")), speed(F.abs("da"))
    return got.select("episode", "frame_from", "frame_to", F.floor((F.col("frame_from") + F.col("frame_to")) / 2).alias("frame_mid"), "dx", "dy", "da", "agree", shift.alias("shift_speed"), turn.alias("turn_speed"), ((shift > SHIFT_SPEED) | (turn > TURN_SPEED)).alias("jitter"))


def stability(episodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row an episode: spread of shifts and turns, the greatest speeds, jitters. Without a pair all is 0, and passes."""
    one = pairs.groupBy("episode").agg(F.count(F.lit(1)).alias("pairs"), F.sqrt(F.var_pop("dx") + F.var_pop("dy")).alias("translation_std"), F.stddev_pop("da").alias("rotation_std"), F.avg("agree").alias("mean_agreement"), F.max("shift_speed").alias("max_shift"), F.max("turn_speed").alias("max_turn"), F.count_if("jitter").alias("jitters"))
    rows = episodes.select("episode").distinct().join(one, "episode", "left")
    names = ["pairs", "translation_std", "rotation_std", "mean_agreement", "max_shift", "max_turn", "jitters"]
    return rows.select("episode", *(F.coalesce(c, F.lit(0)).alias(c) for c in names), (F.coalesce("jitters", F.lit(0)) == 0).alias("pass"))
