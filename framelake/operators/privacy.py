"""Privacy blur: expansion of sampled hits to whole ranges, interval unions, box arithmetic."""

from __future__ import annotations

from framelake.operators.quality import num
from framelake.plans.dialect import Spark


def _runs(every: int) -> str:
    return f"""SELECT episode, max(n) AS n, min(frame_idx) AS s, max(frame_idx) AS e, count_if(frame_idx % {every} = 0) AS hits FROM (
        SELECT episode, n, frame_idx, frame_idx - row_number() OVER (PARTITION BY episode ORDER BY frame_idx) AS island FROM {{frames}} WHERE detected) a GROUP BY episode, island"""


def positive_ranges(d: Spark, every: int = 5) -> str:
    """Ranges to blur: every `every`-th frame is sampled, a hit grows both ways while frames are detected, so the result is the runs of detected frames that hold a sample."""
    return f"SELECT episode, s AS start_frame, e AS end_frame, hits FROM ({_runs(every)}) r WHERE hits > 0"


def blur_summary(d: Spark, every: int = 5) -> str:
    runs = positive_ranges(d, every)
    return f"""SELECT t.episode, t.n AS frames, {d.idiv(f'(t.n + {every} - 1)', str(every))} AS sampled_frames, t.hits AS sample_hit_frames, coalesce(r.blurred, 0) AS frames_with_detections, coalesce(r.grown, 0) AS unique_expanded_frames, coalesce(r.ranges, 0) AS positive_ranges
        FROM (SELECT episode, max(n) AS n, count_if(detected AND frame_idx % {every} = 0) AS hits FROM {{frames}} GROUP BY episode) t
        LEFT JOIN (SELECT episode, CAST(sum(end_frame - start_frame + 1) AS BIGINT) AS blurred, CAST(sum(end_frame - start_frame + 1 - hits) AS BIGINT) AS grown, count(*) AS ranges FROM ({runs}) p GROUP BY episode) r ON t.episode = r.episode"""


def interval_union(d: Spark) -> str:
    """Union of closed intervals; those that touch as whole numbers merge. Intervals: k / 10 frames from each detected frame."""
    return f"""SELECT episode, min(s) AS s, max(e) AS e, count(*) AS parts FROM (SELECT episode, s, e, sum(new) OVER (PARTITION BY episode ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM (
        SELECT episode, s, e, CASE WHEN s <= 1 + max(e) OVER (PARTITION BY episode ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM (
            SELECT episode, frame_idx AS s, frame_idx + {d.idiv('k', '10')} % 4 AS e FROM {{frames}} WHERE detected AND frame_idx % 3 = 0) i) j) k GROUP BY episode, run"""


def iou(a: str, b: str) -> str:
    """Intersection over union of two boxes; 0 if they are apart."""
    w = f"greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
    h = f"greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    area = lambda x: f"({x}.x2 - {x}.x1) * ({x}.y2 - {x}.y1)"
    return f"({w} * {h} / greatest({area(a)} + {area(b)} - {w} * {h}, 1e-9))"


def box_dedupe(d: Spark, most: float = 0.3) -> str:
    """Greedy: by confidence (ties by place), a box stays unless it overlaps a kept box too much. A fold over each frame's boxes."""
    fields = {"o": "-conf", "det_idx": "det_idx", "x1": "x1", "y1": "y1", "x2": "x2", "y2": "y2"}
    boxes = d.sort(("collect_list" if d.name == "spark" else "list") + f"({d.fields(**fields)})")
    if d.name == "spark":
        kept = f"aggregate(slice(boxes, 2, greatest(size(boxes) - 1, 0)), slice(boxes, 1, 1), (a_, b_) -> CASE WHEN exists(a_, k_ -> {iou('k_', 'b_')} > {num(most)}) THEN a_ ELSE array_append(a_, b_) END)"
    else:
        kept = f"list_reduce(list_transform(boxes, lambda y_: [y_]), lambda a_, b_: CASE WHEN len(list_filter(a_, lambda k_: {iou('k_', 'b_[1]')} > {num(most)})) > 0 THEN a_ ELSE list_concat(a_, b_) END)"
    return f"SELECT episode, frame_idx, CAST({d.size('boxes')} AS BIGINT) AS n_boxes, {d.join(d.map(kept, 'z_', 'CAST(z_.det_idx AS STRING)'))} AS kept FROM (SELECT episode, frame_idx, {boxes} AS boxes FROM {{boxes}} GROUP BY episode, frame_idx) b"


def box_blur_region(d: Spark, scale: float = 1.3, width: int = 100, height: int = 90) -> str:
    """Boxes scaled about their centre, truncated and clipped; empty ones go. The kernel is odd and 31 at least."""
    t = d.whole
    return f"""SELECT episode, frame_idx, det_idx, bx1, by1, bx2, by2, greatest(CASE WHEN half % 2 = 0 THEN half + 1 ELSE half END, 31) AS kernel FROM (
        SELECT *, {d.idiv('least(by2 - by1, bx2 - bx1)', '2')} AS half FROM (
            SELECT episode, frame_idx, det_idx, greatest(0, {t(f'cx - hw * {num(scale)}')}) AS bx1, greatest(0, {t(f'cy - hh * {num(scale)}')}) AS by1, least({width}, {t(f'cx + hw * {num(scale)}')}) AS bx2, least({height}, {t(f'cy + hh * {num(scale)}')}) AS by2
            FROM (SELECT episode, frame_idx, det_idx, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, (x2 - x1) / 2 AS hw, (y2 - y1) / 2 AS hh FROM {{boxes}}) a) b WHERE bx2 > bx1 AND by2 > by1) c"""
