"""Pixel kernels in numpy for frames of real size, as Arrow-batched functions: quality metrics, rotation, area downscale, elliptical blur."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def _reflect(x: np.ndarray) -> np.ndarray:
    return np.pad(x, 1, "reflect") if min(x.shape) > 1 else np.pad(x, 1, "edge")


def laplacian_variance(gray: np.ndarray) -> float:
    p = _reflect(gray.astype(float))
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def tenengrad(gray: np.ndarray) -> float:
    p = _reflect(gray.astype(float))
    rows, cols = p[:-2] + 2 * p[1:-1] + p[2:], p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    gx, gy = rows[:, 2:] - rows[:, :-2], cols[2:] - cols[:-2]
    return float((gx * gx + gy * gy).mean())


def rotate(image: np.ndarray, degrees: int) -> np.ndarray:
    """Clockwise, by multiples of 90."""
    return np.rot90(image, -(degrees % 360) // 90)


def shrink(gray: np.ndarray, most_wide: int = 1920) -> np.ndarray:
    """Area averages, to at most so many columns; smaller images stay."""
    h, w = gray.shape
    if w <= most_wide:
        return gray
    nh, nw = max(1, round(h * most_wide / w)), most_wide

    def weights(n: int, m: int) -> np.ndarray:
        edge = np.arange(m + 1) * n / m
        i = np.arange(n)
        return np.clip(np.minimum(edge[1:, None], i + 1) - np.maximum(edge[:-1, None], i), 0, None) * m / n

    return np.rint(weights(h, nh) @ gray.astype(float) @ weights(w, nw).T).astype(gray.dtype)


def blur_boxes(image: np.ndarray, boxes: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Gaussian blur in the ellipse of each box (x1, y1, x2, y2); the kernel is odd, half the shorter side and 31 at least."""
    out = image.astype(float).copy()
    for x1, y1, x2, y2 in boxes:
        part = out[y1:y2, x1:x2]
        if not part.size:
            continue
        k = max((min(part.shape[:2]) // 2) | 1, 31)
        sigma = 0.3 * ((k - 1) * 0.5 - 1) + 0.8
        g = np.exp(-((np.arange(k) - k // 2) ** 2) / (2 * sigma * sigma))
        g /= g.sum()
        soft = part
        for axis in (0, 1):
            mode = "reflect" if soft.shape[axis] > 1 else "edge"
            padded = np.pad(soft, [(k // 2, k // 2) if a == axis else (0, 0) for a in range(soft.ndim)], mode)
            soft = np.lib.stride_tricks.sliding_window_view(padded, k, axis) @ g
        yy, xx = np.mgrid[: part.shape[0], : part.shape[1]]
        cy, cx = part.shape[0] // 2, part.shape[1] // 2
        inside = ((yy - cy) / max(cy, 0.5)) ** 2 + ((xx - cx) / max(cx, 0.5)) ** 2 <= 1
        out[y1:y2, x1:x2] = np.where(inside if part.ndim == 2 else inside[..., None], soft, part)
    return np.rint(out).astype(image.dtype)


def metrics(frames: DataFrame) -> DataFrame:
    """laplacian_var and tenengrad of frames (episode, frame_idx, w, h, px binary), a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, h, px = (b.column(i).to_pylist() for i in (2, 3, 4))
            grays = [np.frombuffer(p, np.uint8).reshape(y, x) for x, y, p in zip(w, h, px, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(map(laplacian_variance, grays), pa.float64()), pa.array(map(tenengrad, grays), pa.float64())], ["episode", "frame_idx", "laplacian_var", "tenengrad"])

    return frames.select("episode", "frame_idx", "w", "h", "px").mapInArrow(run, "episode long, frame_idx long, laplacian_var double, tenengrad double")
