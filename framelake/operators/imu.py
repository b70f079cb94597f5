"""Hand-motion valleys: Savitzky-Golay smoothing and peak finding by episode, in numpy on Arrow groups.

These two are sequential over a whole signal and have no SQL form. One group is one episode's signal, which a recording
bounds. Input: episode, pos, value. Episodes with fewer than ORDER + 2 samples aren't smoothed and have no valley.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WINDOW, ORDER, DISTANCE, PROMINENCE = 31, 3, 15, 0.3


def smooth(x: np.ndarray, window: int = WINDOW, order: int = ORDER) -> np.ndarray:
    """Least-squares polynomials over a sliding window; the ends are read off the first and the last window's polynomial."""
    n = len(x)
    window = min(window, n if n % 2 else n - 1)
    if window <= order:
        return x.astype(float)
    half = window // 2
    basis = np.vander(np.arange(-half, half + 1), order + 1, increasing=True).astype(float)
    fit = np.linalg.pinv(basis)
    out = np.convolve(x, fit[0][::-1], "same").astype(float)
    out[:half] = (basis @ (fit @ x[:window]))[:half]
    out[n - half :] = (basis @ (fit @ x[n - window :]))[half + 1 :]
    return out


def _tops(x: np.ndarray) -> np.ndarray:
    """Strict local maxima; of a flat top, its middle."""
    out, i, n = [], 1, len(x)
    while i < n - 1:
        if x[i - 1] < x[i]:
            j = i
            while j < n - 1 and x[j + 1] == x[i]:
                j += 1
            if j < n - 1 and x[j + 1] < x[i]:
                out.append((i + j) // 2)
            i = j
        i += 1
    return np.array(out, int)


def _apart(tops: np.ndarray, height: np.ndarray, distance: int) -> np.ndarray:
    keep = np.ones(len(tops), bool)
    for k in np.argsort(height, kind="stable")[::-1]:
        if keep[k]:
            near = np.abs(tops - tops[k]) < distance
            near[k] = False
            keep &= ~near
    return tops[keep]


def _prominence(x: np.ndarray, top: int) -> float:
    higher = np.flatnonzero(x > x[top])
    left, right = higher[higher < top], higher[higher > top]
    a = x[(left[-1] + 1 if len(left) else 0) : top + 1].min()
    b = x[top : (right[0] if len(right) else len(x))].min()
    return float(x[top] - max(a, b))


def peaks(x: np.ndarray, distance: int = DISTANCE, prominence: float = PROMINENCE) -> np.ndarray:
    """Local maxima, thinned by distance (the highest first), then by prominence."""
    tops = _tops(x)
    tops = _apart(tops, x[tops], distance)
    return np.array([t for t in tops.tolist() if _prominence(x, t) >= prominence], int)


def valleys(signal: DataFrame, window: int = WINDOW, distance: int = DISTANCE, prominence: float = PROMINENCE) -> DataFrame:
    """episode, pos, value of the smoothed signal's valleys."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna().sort_values("pos", kind="stable")
        x = smooth(pdf["value"].to_numpy(float), window)
        at = peaks(-x, distance, prominence) if len(x) > 2 else np.zeros(0, int)
        return pd.DataFrame({"episode": pdf["episode"].to_numpy()[at], "pos": pdf["pos"].to_numpy()[at], "value": x[at]})

    kind = signal.schema["episode"].dataType.simpleString()
    return signal.select("episode", "pos", "value").groupBy("episode").applyInPandas(run, f"episode {kind}, pos long, value double")


def read_signals(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """episode (the file's folder), pos, lh, rh of motion files `frames.parquet`: only the two columns are read. Files that
    can't be read, and columns that a file lacks, leave nothing or nulls."""
    schema = "lh_imu_accel array<double>, rh_imu_accel array<double>"
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(*([paths] if isinstance(paths, str) else paths))
    return rows.select(F.regexp_extract("_metadata.file_path", "([^/]*)/[^/]*$", 1).alias("episode"), F.col("_metadata.row_index").alias("pos"), F.col("lh_imu_accel").alias("lh"), F.col("rh_imu_accel").alias("rh"))


def magnitudes(signals: DataFrame) -> DataFrame:
    """episode, pos, value: the lengths of both hands' accelerations, each centred by its mean over the episode, added up.

    An episode in which a vector is missing, or vectors differ in length, has no signal.
    """
    size = F.size("lh") + F.size("rh") * 1000
    whole = signals.groupBy("episode").agg(F.bool_and(F.col("lh").isNotNull() & F.col("rh").isNotNull()).alias("all_"), F.min(size).alias("a_"), F.max(size).alias("b_"), F.max(F.size("lh")).alias("nl_"), F.max(F.size("rh")).alias("nr_"))
    good = whole.where("all_ AND a_ = b_").select("episode", "nl_", "nr_")
    # means by axis: a row an axis, pre-aggregated, so an episode's vectors are never gathered
    axes = signals.join(good, "episode", "left_semi").select("episode", F.explode(F.array(F.struct(F.lit("lh").alias("hand"), F.col("lh").alias("v")), F.struct(F.lit("rh").alias("hand"), F.col("rh").alias("v")))).alias("x"))
    means = axes.select("episode", "x.hand", F.posexplode("x.v").alias("axis", "v")).groupBy("episode", "hand", "axis").agg(F.avg("v").alias("m"))
    listed = lambda hand: F.transform(F.array_sort(F.collect_list(F.when(F.col("hand") == hand, F.struct("axis", "m")))), lambda x: x["m"]).alias(f"m_{hand}")
    means = means.groupBy("episode").agg(listed("lh"), listed("rh"))
    length = lambda hand: F.sqrt(F.aggregate(F.zip_with(hand, f"m_{hand}", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    return signals.join(means, "episode").select("episode", "pos", (length("lh") + length("rh")).alias("value"))


def hand_valleys(signals: DataFrame) -> DataFrame:
    """episode, mark: where both hands rest, of signals (episode, pos, lh, rh)."""
    return valleys(magnitudes(signals)).select("episode", F.col("pos").alias("mark"))
