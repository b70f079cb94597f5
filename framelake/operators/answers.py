"""Model requests and answers: keyed joins, lenient parsing, hand audits, token usage.

Inputs: requests (custom_id, conv_id, turn, prompt), responses (custom_id, text, completion_tokens), frames.
"""

from __future__ import annotations

from framelake.functions import text as T
from framelake.operators.quality import num
from framelake.plans.dialect import Spark


def response_join(d: Spark) -> str:
    """Each request with its answer; a missing one has null text."""
    return "SELECT q.custom_id, q.conv_id, q.turn, r.text, r.text IS NULL AS missing FROM {requests} q LEFT JOIN {responses} r ON q.custom_id = r.custom_id"


def parse_json_greedy(d: Spark) -> str:
    body = T.greedy_json(d, "text")
    return f"SELECT custom_id, {d.sole_json(body, 'thought')} AS thought, {T.scene(d, 'text')} AS scene FROM {{responses}}"


def parse_audit(d: Spark) -> str:
    """Hand count and flags of each answer; rows without all three aren't valid."""
    return f"SELECT custom_id, conv_id, hands, active, single, hands IS NOT NULL AND active IS NOT NULL AND single IS NOT NULL AS valid FROM (SELECT custom_id, conv_id, {T.hand_count(d, 'text')} AS hands, {T.active(d, 'text')} AS active, {T.single(d, 'text')} AS single FROM {{responses}}) a"


def hand_vlm_summary(d: Spark) -> str:
    r = lambda what: f"round(CAST(count_if(valid AND {what}) AS DOUBLE) / greatest(count_if(valid), 1), 4)"
    return f"""SELECT q.conv_id AS episode, count(*) AS sampled, count_if(coalesce(a.valid, false)) AS valid, count(*) - count_if(coalesce(a.valid, false)) AS failed, coalesce(round(avg(CASE WHEN valid THEN CAST(hands AS DOUBLE) END), 3), {num(0)}) AS avg_hands,
        count_if(valid AND hands = 0) AS none_frames, count_if(valid AND hands >= 1) AS any_frames, count_if(valid AND hands >= 2) AS both_frames,
        {r('hands = 1')} AS one, {r('hands >= 1')} AS at_least_one, {r('hands = 2')} AS both, {r('hands = 0')} AS none, {r('active')} AS active_ratio, {r('single')} AS single_ratio
        FROM {{requests}} q LEFT JOIN ({parse_audit(d)}) a ON q.custom_id = a.custom_id GROUP BY q.conv_id"""


def hand_summaries(d: Spark) -> str:
    """Detections and audits in one shape, a row an episode and backend; what a backend can't tell is null."""
    ratio = "CAST(NULL AS DOUBLE)"
    return f"""SELECT 'yolo' AS backend, episode, frames AS sampledFrames, frames AS validFrames, CAST(0 AS BIGINT) AS failedFrames, round(CAST(left_frames + right_frames AS DOUBLE) / frames, 3) AS avgEgoHandCount, any_frames AS framesWithAtLeastOneHand, any_ratio AS atLeastOneHandRatio, both_frames AS framesWithBothHands, both_ratio AS bothHandsRatio, none_frames AS framesWithNoHands, {ratio} AS noHandsRatio, {ratio} AS activeManipulationRatio, {ratio} AS singlePersonOperationRatio FROM ({hand_yolo_summary(d)}) y
        UNION ALL SELECT 'vlm', episode, sampled, valid, failed, avg_hands, any_frames, round(v.one + v.both, 6), both_frames, v.both, none_frames, v.none, active_ratio, single_ratio FROM ({hand_vlm_summary(d)}) v"""


def hand_retry_merge(d: Spark) -> str:
    """Frames of which the first answer failed take the second's; retried says so. First answers fail where k % 4 = 0, second where k % 8 = 0."""
    return "SELECT f.episode, f.frame_idx, coalesce(a.k, b.k) AS k, a.k IS NULL AS retried, a.k IS NULL AND b.k IS NULL AS failed FROM {frames} f LEFT JOIN (SELECT episode, frame_idx, k FROM {frames} WHERE k % 4 <> 0) a ON f.episode = a.episode AND f.frame_idx = a.frame_idx LEFT JOIN (SELECT episode, frame_idx, k FROM {frames} WHERE k % 8 <> 0) b ON f.episode = b.episode AND f.frame_idx = b.frame_idx"


def hand_best_box(d: Spark, least_conf: float = 0.05) -> str:
    """The most confident box of each side (class 0 left, any other right) in a group of 4 frames; the earliest of ties."""
    return f"""SELECT episode, frame, side, frame_idx AS det_idx, round(conf, 6) AS conf FROM (
        SELECT episode, {d.idiv('frame_idx', '4')} AS frame, CASE WHEN cls = 0 THEN 'left' ELSE 'right' END AS side, frame_idx, conf, row_number() OVER (PARTITION BY episode, {d.idiv('frame_idx', '4')}, CASE WHEN cls = 0 THEN 'left' ELSE 'right' END ORDER BY conf DESC, frame_idx) AS place
        FROM {{frames}} WHERE conf >= {num(least_conf)}) a WHERE place = 1"""


def hand_yolo_summary(d: Spark) -> str:
    r = lambda what: f"round(CAST({what} AS DOUBLE) / count(*), 4)"
    side = lambda s: f"count_if(side = '{s}') > 0"
    return f"""SELECT episode, count(*) AS frames, count_if(l) AS left_frames, count_if(r) AS right_frames, count_if(l OR r) AS any_frames, count_if(l AND r) AS both_frames, count_if(NOT l AND NOT r) AS none_frames,
        {r('count_if(l OR r)')} AS any_ratio, {r('count_if(l AND r)')} AS both_ratio, count_if(l) + count_if(r) AS hands_detected, max(CASE WHEN l AND r THEN 2 WHEN l OR r THEN 1 ELSE 0 END) AS max_hands FROM (
        SELECT f.episode, f.frame, {side('left')} AS l, {side('right')} AS r FROM (SELECT DISTINCT episode, {d.idiv('frame_idx', '4')} AS frame FROM {{frames}}) f LEFT JOIN ({hand_best_box(d, 0.5)}) b ON f.episode = b.episode AND f.frame = b.frame GROUP BY f.episode, f.frame) a GROUP BY episode"""


def token_usage(d: Spark) -> str:
    return "SELECT q.conv_id, count(*) AS calls, CAST(sum(length(q.prompt)) AS BIGINT) AS input_chars, CAST(coalesce(sum(coalesce(nullif(r.completion_tokens, 0), length(r.text), 0)), 0) AS BIGINT) AS output_tokens FROM {requests} q LEFT JOIN {responses} r ON q.custom_id = r.custom_id GROUP BY q.conv_id"


def run_summary(d: Spark) -> str:
    """Statuses by operator; fail and skipped are neither ok nor errors."""
    return "SELECT kind AS operator, count(DISTINCT episode) AS episodes, count_if(k % 5 < 3) AS ok, count_if(k % 5 = 3) AS errors, count_if(k % 5 = 4) AS other, round(sum(CAST(frame_idx AS DOUBLE)) / 30, 2) AS elapsed, count_if(k % 5 = 3) > 0 AS exit_code FROM {frames} GROUP BY kind"


def all_failed(d: Spark) -> str:
    """Whether every answer of a conversation is unreadable, or only some."""
    return f"SELECT conv_id, count_if(thought IS NULL) = count(*) AS all_failed, count_if(thought IS NULL) AS failed FROM (SELECT conv_id, {d.sole_json(T.greedy_json(d, 'text'), 'thought')} AS thought FROM {{responses}}) a GROUP BY conv_id"
