"""Texts and small values against plain Python, and the choices of reports on cases written by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from framelake.functions import columns as C
from framelake.operators import reports as R


def test_percentages_like_python(spark):
    draw = random.Random(3)
    xs = [i / 16 for i in range(17)] + [i / 2000 for i in range(200)] + [draw.random() for _ in range(500)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", C.percent(F.col("x")), C.percent0(F.col("x")), C.tenths(F.col("x") * 37)).collect()
    for x, p, q, t in got:
        assert (p, q, t) == (f"{x * 100:.1f}%", f"{x * 100:.0f}%", f"{x * 37:.1f}")
    assert spark.range(1).select(C.percent(F.lit(None)), C.percent(F.lit("none"))).first() == ("0%", "0%")


def test_flags_boxes_and_matrices(spark):
    df = spark.createDataFrame([("both",), (" LP ",), ("license-plate",), ("Face",), (None,)], "t string")
    assert [tuple(r[0]) for r in df.select(C.blur_flags(F.col("t"), F.lit(True), F.lit(False))).collect()] == [(True, True), (False, True), (False, True), (True, False), (True, False)]
    with pytest.raises(Exception, match="not cats"):
        spark.createDataFrame([("cats",)], "t string").select(C.blur_flags(F.col("t"), F.lit(True), F.lit(True))).collect()
    box = F.array(*map(F.lit, (1.0, 2.0, 3.0, 4.25)))
    m = {"m00": F.lit(0.8), "m10": F.lit(0.6), "m02": F.lit(3.0), "m12": F.lit(4.0)}
    a, b, s = spark.range(1).select(C.rescale_box(box, F.lit(2.0), F.lit(0.5)), C.hand_box(box, F.lit(1.0)), C.shift_and_turn(m)).first()
    assert a == [2.0, 1.0, 6.0, 2.125] and b == [1.0, 2.0, 3.0, 4.2]
    assert s[0] == 5.0 and math.isclose(s[1], math.atan2(0.6, 0.8))


def test_frames_join_by_number(spark):
    frames = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "episode string, frame_idx long")
    one = "episode string, frame_idx long, det_idx int, x1 double, y1 double, x2 double, y2 double, conf double"
    face = spark.createDataFrame([("a", 1, 1, 1.0, 1.0, 2.0, 2.0, 0.5), ("a", 1, 0, 9.0, 9.0, 9.0, 9.0, 0.9), ("z", 5, 0, 0.0, 0.0, 1.0, 1.0, 1.0)], one)
    plate = spark.createDataFrame([("a", 1, 0, 3.0, 3.0, 4.0, 4.0, 0.7)], one)
    got = {(r.episode, r.frame_idx): [(b.source, b.det_idx) for b in r.boxes] for r in R.frame_detections(frames, face, plate).collect()}
    assert got == {("a", 0): [], ("a", 1): [(0, 0), (0, 1), (1, 0)], ("b", 0): []}
    first = spark.createDataFrame([("p", 3), ("q", 1), ("p", 0)], "path string, place int")
    assert {tuple(r) for r in R.first_of(first, "path", "place").collect()} == {("p", 0), ("q", 1)}


def test_sound_is_copied_only_where_it_lacks(spark):
    rows = [("e/x.v.mp4", None, "e/o.mp4", "aac"), ("e/y.mp4", "aac", "e/o.mp4", "aac"), ("e/z.mp4", "", "e/o.mp4", None)]
    got = [r.command for r in R.audio_remux(spark.createDataFrame(rows, "path string, audio_codec string, original string, original_audio string")).collect()]
    assert got[0][-1] == "e/x.v_audio_mux.mp4" and got[0][3:6] == ["e/x.v.mp4", "-i", "e/o.mp4"] and got[1:] == [None, None]


def test_lines_of_reports(spark):
    shape = "episode int, n_blurry int, blur_ratio double, laplacian double, jitter array<struct<translation double, rotation double>>, n_over int, over_ratio double, n_under int, under_ratio double"
    rows = [(1, 2, 0.0625, 7.25, [(3.0, 0.25), (9.5, None)], 0, 0.0, 1, None), (2, 1, 0.5, None, [], 0, None, 0, None), (3, 0, 0.0, 9.0, None, 0, 0.0, 0, 0.0)]
    got = [r.errors for r in R.quality_errors(spark.createDataFrame(rows, shape)).collect()]
    assert got[0] == ["模糊帧 2帧 (6.2%)，平均清晰度 lap=7.2", "剧烈抖动 2处，最大位移 9.5px，最大旋转 0.2500rad", "欠曝帧 1帧 (0%)"]
    assert got[1:] == [["模糊帧 1帧 (50.0%)"], []]
    hands = lambda *x: spark.range(1).select(R.hand_lines(*(F.lit(v).cast("double") for v in x))).first()[0]
    assert hands(0.5, 0.25, None, 0.125, *[None] * 5) == ["Hands visible in 50% of sampled frames (left 25%, right 0%, both 12%)"]
    assert hands(None, None, None, None, 0.25, 0.5, 0.25, 0.0, 1.0) == ["Ego hands visible in 75% of sampled frames (1 hand 50%, 2 hands 25%)", "Single-person operation in 100% of sampled frames"]
    assert len(hands(None, None, None, None, 0.25, 0.5, 0.25, 0.3, 1.0)) == 3


def test_compact_audit(spark):
    fields = ", ".join(f"{k}: double" for k in R.AUDIT)
    shape = f"episode int, summary struct<{fields}, extra: int>, frame_results array<struct<global_frame: int, time_sec: double, ego_hand_count: int, active_manipulation: boolean, single_person_operation: boolean, raw: string>>"
    got = R.compact_audit(spark.createDataFrame([(1, (4.0, None, 0.1, 0.2, 0.7, 0.5, 1.0, 9), [(3, None, 2, None, True, "x")]), (2, None, None)], shape)).collect()
    assert tuple(got[0].summary) == (4.0, 0.0, 0.1, 0.2, 0.7, 0.5, 1.0) and [tuple(x) for x in got[0].sampled_hand_counts] == [(3, 0.0, 2, None, True)]
    assert tuple(got[1].summary) == (0.0,) * 7 and got[1].sampled_hand_counts == []
