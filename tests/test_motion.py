"""Motion of textured pictures that were moved by known amounts."""

import numpy as np
import pytest

from framelake.operators import motion


def texture(h, w, seed=0):
    r = np.random.default_rng(seed)
    x = sum(np.kron(r.normal(0, 1, (h // k + 2, w // k + 2)), np.ones((k, k)))[:h, :w] * k**0.7 for k in (2, 4, 8, 16, 32))
    k = np.ones(5) / 5
    for axis in (0, 1):
        x = np.apply_along_axis(lambda v: np.convolve(v, k, "same"), axis, x)
    return np.clip(120 + 25 * x / x.std(), 0, 255)


def moved(big, h, w, dx, dy, turn, zoom=1.0):
    """The middle of a picture, and the same after places p went to A p + t about the crop's origin."""
    top, left = (big.shape[0] - h) // 2, (big.shape[1] - w) // 2
    yy, xx = np.mgrid[:h, :w].astype(float)
    c, s = zoom * np.cos(turn), zoom * np.sin(turn)
    inv = np.linalg.inv([[c, -s], [s, c]])
    u, v = inv[0, 0] * (xx - dx) + inv[0, 1] * (yy - dy), inv[1, 0] * (xx - dx) + inv[1, 1] * (yy - dy)
    got, ok = motion._sampled(big, u + left, v + top)
    assert ok.all()
    return big[top : top + h, left : left + w].astype(np.uint8), got.astype(np.uint8)


@pytest.mark.parametrize(("dx", "dy", "turn", "zoom"), [(0, 0, 0, 1), (3, -2, 0, 1), (12.5, 7, 0, 1), (2, 1, 0.03, 1), (-6, 4, -0.05, 1.02), (0.4, -0.3, 0.005, 1)])
def test_known_motion_is_found(dx, dy, turn, zoom):
    a, b = moved(texture(240, 320), 150, 200, dx, dy, turn, zoom)
    m, agree = motion.similarity(a, b)
    assert abs(m[0, 2] - dx) < 0.6 and abs(m[1, 2] - dy) < 0.6 and abs(np.arctan2(m[1, 0], m[0, 0]) - turn) < 0.004 and agree > 0.5


def test_a_part_that_moves_by_itself_does_not_mislead():
    a, b = moved(texture(240, 320), 150, 200, 5, -3, 0)
    b = b.copy()
    b[40:80, 60:110] = np.random.default_rng(1).integers(0, 255, (40, 50))
    m, _ = motion.similarity(a, b)
    assert abs(m[0, 2] - 5) < 0.7 and abs(m[1, 2] + 3) < 0.7


def test_nothing_is_told_of_flat_or_unlike_pictures():
    flat = np.full((60, 80), 9, np.uint8)
    assert motion.similarity(flat, flat) is None and motion.similarity(flat, np.zeros((60, 81), np.uint8)) is None and motion.similarity(flat[:4], flat[:4]) is None
    assert motion.similarity(texture(64, 64, 1).astype(np.uint8), texture(64, 64, 2).astype(np.uint8)) is None


def test_pairs_and_stability(spark):
    big, h, w = texture(240, 320), 120, 160
    views = [(1, 0, moved(big, h, w, 0, 0, 0)[1]), (1, 10, moved(big, h, w, 4, 2, 0)[1]), (1, 20, moved(big, h, w, 4, 2, 0)[1]), (1, 21, moved(big, h, w, -50, 2, 0)[1]), (2, 5, moved(big, h, w, 0, 0, 0)[1]), (3, 0, np.zeros((h, w), np.uint8)), (3, 9, np.zeros((h, w), np.uint8))]
    frames = spark.createDataFrame([(e, f, w, h, bytearray(x.tobytes())) for e, f, x in views], "episode long, frame_idx long, w int, h int, px binary")
    pairs = motion.pair_motion(frames, 30.0)
    got = {(r.frame_from, r.frame_to): r for r in pairs.collect()}
    assert set(got) == {(0, 10), (10, 20), (20, 21)}
    first, last = got[0, 10], got[20, 21]
    assert first.frame_mid == 5 and abs(first.shift_speed - np.hypot(4, 2) * 3) < 3 and not first.jitter
    assert last.frame_mid == 20 and last.jitter and abs(last.shift_speed - 54 * 30) < 60
    s = {r.episode: r for r in motion.stability(frames, pairs).collect()}
    assert (s[1].pairs, s[1].jitters, s[1]["pass"]) == (3, 1, False) and (s[2].pairs, s[2]["pass"]) == (0, True) and (s[3].pairs, s[3].max_shift) == (0, 0.0)
    assert motion.pair_motion(frames, 0.0).where("shift_speed > 100").count() == 0
