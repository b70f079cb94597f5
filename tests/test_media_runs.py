"""The blur driver against a frame-by-frame simulation with calls counted, its pictures, and commands that run once."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.functions import pixels
from framelake.operators import blur, clips


def detector(log, faces, plates):
    class Noting:
        def faces(self, episode, frame_idx):
            with open(log, "a") as f:
                f.write(f"{episode}/{frame_idx}\n")
            return [[1.0, 1.0, 9.0, 9.0]] if frame_idx in faces.get(episode, ()) else []

        def plates(self, episode, frame_idx):
            return [[1.0, 1.0, 9.0, 9.2], [20.0, 2.0, 30.0, 8.0]] if frame_idx in plates.get(episode, ()) else []

    return Noting


def simulate(n, step, faces, plates, dedupe):
    """Sample after sample, growing both ways, with a memory of what was looked at."""
    seen, ranges = {}, []

    def at(f):
        if f not in seen:
            got = ([1] if f in faces else []) + ([1, 2] if f in plates else [])
            seen[f] = sorted(set(got)) if dedupe else got
        return seen[f]

    grown = hits = 0
    for s in range(0, n, step):
        if not at(s):
            continue
        hits += 1
        if any(a <= s <= b for a, b in ranges):
            continue
        a = b = s
        while a > 0:
            new = a - 1 not in seen
            if not at(a - 1):
                break
            grown, a = grown + new, a - 1
        while b < n - 1:
            new = b + 1 not in seen
            if not at(b + 1):
                break
            grown, b = grown + new, b + 1
        ranges.append((a, b))
    found = [f for f, x in seen.items() if x]
    return n, sum(map(len, seen.values())), len(found), -(-n // step), hits, len(seen), grown, ranges


FACES = {1: {0, 1, 2, 7, 8, 20, 21, 22, 23, 24, 25, 26, 27, 28}, 2: {11}, 3: set(range(30)), 5: {4}}
PLATES = {1: {2, 3, 40}, 2: {12, 13, 14, 15, 16}, 4: {49}}
LENGTHS = {1: 45, 2: 30, 3: 30, 4: 50, 5: 5, 6: 0, 7: 12}


@pytest.mark.parametrize(("step", "backend"), [(5, blur.DEDUPING), (5, blur.MERGING), (1, blur.MERGING), (7, blur.DEDUPING)])
def test_sampling_looks_at_no_more_than_the_rule(spark, tmp_path, step, backend):
    log = tmp_path / "log"
    episodes = spark.createDataFrame(list(LENGTHS.items()), "episode long, n long")
    look = blur.Look(detector(str(log), FACES, PLATES), backend, step=step)
    seen = blur.detections(episodes, look)
    got = {r.episode: (r.total_frames, r.detections_total, r.frames_with_detections, r.sampled_frames, r.sample_hit_frames, r.unique_detection_frames, r.unique_expanded_frames, [tuple(x) for x in r.positive_ranges]) for r in blur.summary(episodes, seen, look).collect()}
    assert got == {e: simulate(n, step, FACES.get(e, ()), PLATES.get(e, ()), backend == blur.DEDUPING) for e, n in LENGTHS.items()}
    assert set(Counter(log.read_text().split()).values()) == {1} and len(log.read_text().split()) == sum(x[5] for x in got.values())


def test_looking_at_every_frame(spark, tmp_path):
    episodes = spark.createDataFrame(list(LENGTHS.items()), "episode long, n long")
    look = blur.Look(detector(str(tmp_path / "log"), FACES, PLATES), blur.DEDUPING, plates=False, mode=blur.EVERY, step=9, fx=2.0, fy=0.5)
    seen = blur.detections(episodes, look)
    assert {(r.episode, r.frame_idx) for r in seen.where("size(boxes) > 0").collect()} == {(e, f) for e, fs in FACES.items() for f in fs}
    assert seen.where("size(boxes) > 0").first().boxes == [[2.0, 0.5, 18.0, 4.5]]
    got = {r.episode: r for r in blur.summary(episodes, seen, look).collect()}
    assert (got[3].unique_detection_frames, got[3].sample_hit_frames, got[3].unique_expanded_frames, got[3].positive_ranges, got[6].total_frames) == (30, 0, 0, [], 0)
    for bad in ({"backend": "other"}, {"mode": "other"}):
        with pytest.raises(ValueError, match="must be"):
            blur.Look(detector("", {}, {}), **bad)


def test_pictures_are_blurred_where_boxes_are(spark):
    r = np.random.default_rng(1)
    gray, color = r.integers(0, 255, (40, 60), np.uint8), r.integers(0, 255, (40, 60, 3), np.uint8)
    images = spark.createDataFrame([(1, i, 60, 40, bytearray(x.tobytes())) for i, x in enumerate((gray, color, gray))], "episode long, frame_idx long, w int, h int, px binary")
    seen = spark.createDataFrame([(1, 0, True, [[10.0, 5.0, 40.0, 35.0]]), (1, 1, False, [[-20.0, 0.0, 10.0, 10.0], [70.0, 5.0, 90.0, 9.0]]), (1, 2, True, [])], "episode long, frame_idx long, sample boolean, boxes array<array<double>>")
    got = {x.frame_idx: np.frombuffer(bytes(x.px), np.uint8) for x in blur.blurred(images, seen, 1.0).collect()}
    first = got[0].reshape(40, 60)
    assert (first == pixels.blur_boxes(gray, [(10, 5, 40, 35)])).all() and (first[:5] == gray[:5]).all() and first[15:25, 20:30].std() < gray[15:25, 20:30].std() / 3
    assert (got[1].reshape(40, 60, 3)[:, 10:] == color[:, 10:]).all() and (got[1] != color.ravel()).any()
    assert (got[2] == gray.ravel()).all()
    assert blur.regions([[0, 0, 1, 1], [5, 5, 5, 9]], 100, 100, 1.0) == [(0, 0, 1, 1)]


def test_blurring_by_rows_equals_plain_convolution():
    x = np.random.default_rng(2).integers(0, 255, (50, 50), np.uint8)
    k, s = 31, 0.3 * (15 - 1) + 0.8
    g = np.exp(-((np.arange(k) - 15) ** 2) / (2 * s * s))
    g /= g.sum()
    p = np.pad(x.astype(float), 15, "reflect")
    want = np.array([[g @ p[i : i + k, j : j + k] @ g for j in range(50)] for i in range(50)])
    got = pixels.blur_boxes(x, [(0, 0, 50, 50)])
    assert np.abs(got[20:30, 20:30] - want[20:30, 20:30]).max() <= 0.5 + 1e-9


def test_clips_run_each_command_once(spark, tmp_path):
    log, out = tmp_path / "log", tmp_path / "out"
    out.mkdir()
    (out / "there").write_text("x")
    (out / "empty").write_text("")
    script = tmp_path / "tool.sh"
    script.write_text('#!/bin/sh\necho "$1 $2" >> ' + str(log) + '\ncase "$1$2" in copya|encodeb|copyempty) echo data > ' + str(out) + '/$2;; copyb|encodec) echo "no $1 of $2" >&2; exit 3;; esac\n')
    script.chmod(0o755)
    names = ["there", "a", "b", "c", "empty", "none", "bad"]
    rows = [(1, i, f"seg_{i:03d}", str(out / n), f"{script} copy {n}", f"{script} encode {n}", "non_positive_duration" if n == "bad" else None) for i, n in enumerate(names)]
    plan = spark.createDataFrame(rows, "episode long, segment long, segment_id string, output string, copy string, encode string, reason string")
    existing = spark.createDataFrame([(str(out / n), (out / n).stat().st_size) for n in ("there", "empty")], "output string, bytes long")
    cut = clips.cut_clips(plan, existing, clips.Shell)
    got = {r.segment: (r.how, r.reason, r.message) for r in cut.collect()}
    assert [got[i][0] for i in range(7)] == ["cached", "copy", "reencode", "failed", "copy", "failed", "failed"]
    assert got[3][1:] == ("ffmpeg_failed", "no encode of c\n") and got[5][1:] == ("output_too_small", "output file missing or too small: 0 bytes") and got[6][1:] == ("non_positive_duration", None)
    m = clips.manifest(cut).first()
    assert (m.requested, m.successful, m.failed, m.cut, m.cached, m.copied, m.reencoded, m.status, [f.segment for f in m.failures]) == (7, 4, 3, 3, 1, 2, 1, "partial", [3, 5, 6])
    assert set(Counter(log.read_text().splitlines()).values()) == {1}
    assert clips.manifest(clips.cut_clips(plan.limit(0), existing, clips.Shell)).count() == 0


def test_rates_for_cutting(spark):
    rows = [(25.0, "30/1", "60/1"), (None, "30000/1001", "60/1"), (0.0, "0/0", "24/1"), (None, "", "25"), (-1.0, None, "x")]
    df = spark.createDataFrame(rows, "c double, a string, r string").select(clips.cut_fps(F.col("c"), F.col("a"), F.col("r")).alias("fps"))
    assert [None if r.fps is None else round(r.fps, 3) for r in df.collect()] == [25.0, 29.97, 24.0, 25.0, None]


def test_transcodes_are_recorded(spark):
    class Runner:
        def run(self, command, output):
            return {"ok": (True, 9, ""), "bad": (False, None, "e" * 3000), "none": (True, None, "")}[command]

    plan = spark.createDataFrame([(1, 0, "o1", "ok", None), (2, 0, "o2", "bad", None), (3, 0, "o3", "none", None), (4, 0, "o4", None, "container")], "media long, spec int, output string, command string, error string")
    got = {r.media: r for r in clips.transcoded(plan, Runner, lambda df: df.select("media", "spec", F.lit("hevc").alias("codec"))).collect()}
    assert [(got[i].status, got[i].after and got[i].after.codec) for i in (1, 2, 3, 4)] == [("ok", "hevc"), ("error", None), ("error", None), ("skipped", None)]
    assert len(got[2].error) == 2003 and got[3].error == "no output" and got[4].error == "container"


def test_clips_go_along_with_what_came_of_them(spark, tmp_path):
    """Each command runs once, where it is due, and no join brings its result back to the clip."""

    class Counted:  # here, so that it goes to workers by value
        """Writes each command to a file: copying fails for odd names, encoding for those that end in 3."""

        def __init__(self, log):
            self.log = log

        def run(self, command, output):
            with open(self.log, "a") as f:
                f.write(command + "\n")
            what, k = command.split()
            return (int(k) % 2 == 0, 5 if int(k) % 2 == 0 else None, "no copy") if what == "copy" else (k[-1] != "3", 5 if k[-1] != "3" else None, "no code")

    log = str(tmp_path / "log")
    plan = spark.range(40).selectExpr("id DIV 10 AS episode", "id % 10 AS segment", "'s' AS segment_id", "concat('/c/', id) AS output", "concat('copy ', id) AS copy", "concat('encode ', id) AS encode", "IF(id % 10 = 7, 'bad', NULL) AS reason")
    existing = spark.createDataFrame([("/c/1", 4), ("/c/5", 0), ("/c/17", 4)], "output string, bytes long")
    cut = clips.cut_clips(plan, existing, lambda: Counted(log))
    assert "Join" not in cut._jdf.queryExecution().executedPlan().toString()
    how = {r.episode * 10 + r.segment: (r.how, r.reason, r.message) for r in cut.collect()}
    due = [i for i in range(40) if i % 10 != 7 and i != 1]
    failed = "stream-copy failed first:\nno copy\n\nre-encode failed:\nno code"
    want = {i: ("copy", None, None) if i % 2 == 0 else ("failed", "ffmpeg_failed", failed) if i % 10 == 3 else ("reencode", None, None) for i in due}
    assert how == want | {1: ("cached", None, None)} | {i: ("failed", "bad", None) for i in range(7, 40, 10)}
    assert sorted(open(log).read().split("\n")[:-1]) == sorted([f"copy {i}" for i in due] + [f"encode {i}" for i in due if i % 2])
