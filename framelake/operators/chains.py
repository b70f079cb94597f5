"""From window answers to caption trees: segments with payloads, refined tasks, two levels.

Inputs: windows (episode, window_id, n_windows, frame_ids, transitions, payloads, low, high): a window's sampled frames, the
local places where something new starts, and what happens from one such place to the next; transitions are null where the
model gave nothing. Segments (episode, s, e, instruction) have exclusive ends.

Cut clusters and timelines are windows over an episode's sorted rows: a frame finds its segment by the last boundary before
it, without a join by range.
"""

from __future__ import annotations

from framelake.functions import text as T
from framelake.operators.quality import num
from framelake.plans.dialect import Spark

DEFAULT_TASK, DEFAULT_ACTION = "perform the current task", "act"


def _pieces(d: Spark, rows: str, keys: str) -> str:
    """A row a piece: from one place to the next, both included, with the weight of its window."""
    n = d.size("frame_ids")
    weight = f"CASE WHEN n_windows = 1 THEN {num(1)} ELSE 0.5e0 + 0.5e0 * cos(pi() * (1 - (n_windows + 2) + 2 * (window_id + 1)) / (n_windows + 1)) END"
    valid = d.keep("transitions", "t_", f"t_ >= 0 AND t_ < {n}")
    a, b = f"CASE WHEN piece = 0 THEN 0 ELSE {d.at('valid', 'piece - 1')} END", f"CASE WHEN piece = {d.size('valid')} THEN {n} - 1 ELSE {d.at('valid', 'piece')} END"
    return f"""SELECT {keys}, low, high, window_id, frame_ids, w, piece, {a} AS a, {b} AS b, CASE WHEN piece < {d.size('payloads')} THEN coalesce({d.at('payloads', 'piece')}, '') END AS payload, piece < {d.size('payloads')} AS told FROM (
        SELECT *, {d.explode(d.seq('0', d.size('valid')))} AS piece FROM (SELECT {keys}, low, high, window_id, frame_ids, payloads, {weight} AS w, {valid} AS valid FROM {rows} WHERE transitions IS NOT NULL AND {n} > 0) v_) p_"""


def segments(d: Spark, rows: str, radius: int, least: int, default: str, keys: str = "episode") -> str:
    """Segments of [low, high) by key: keys, s, e, payload; neighbours with one payload are merged.

    Cuts within `radius` of the one before form a cluster, whose weighted centre is the cut if it lies strictly inside the
    range; a segment has `least` frames or more. A segment's payload is the most frequent in its middle fifth, else in all of
    it (of ties the first seen), else the default. Without any cut the range is one segment with the default; without
    windows there is none.
    """
    part = f"PARTITION BY {keys}"
    pieces = _pieces(d, rows, keys)
    place = d.at("frame_ids", "a")
    raw = f"SELECT {keys}, low, high, {place} AS frame, w FROM ({pieces}) c1_ WHERE piece > 0"
    gap = f"SELECT *, CASE WHEN frame - lag(frame) OVER ({part} ORDER BY frame) > {radius} THEN 1 ELSE 0 END AS gap FROM ({raw}) c2_"
    centre = f"SELECT DISTINCT {keys}, centre FROM (SELECT {keys}, {d.whole('round(sum(frame * w) / sum(w), 9)')} AS centre, max(low) AS low, max(high) AS high FROM (SELECT *, sum(gap) OVER ({part} ORDER BY frame) AS cluster FROM ({gap}) c3_) c4_ GROUP BY {keys}, cluster) c5_ WHERE low < centre AND centre < high"
    has = f"SELECT {keys}, min(low) AS low, max(high) AS high, max(CASE WHEN {d.size('coalesce(transitions, ' + _none(d) + ')')} > 0 AND {_some(d)} THEN 1 ELSE 0 END) AS has_cuts FROM {rows} GROUP BY {keys}"
    spots = f"SELECT {keys}, low AS centre FROM ({has}) c6_ UNION ALL SELECT {keys}, centre FROM ({centre}) c7_"
    folded = d.trunc_fold("spots", f"b_ - LAST >= {least}")
    last = d.at("kept", f"{d.size('kept')} - 1")
    kept = f"""SELECT {keys}, low, high, has_cuts, CASE WHEN {d.size('kept')} > 1 AND high - {last} < {least} THEN {d.keep('kept', 'z_', f'z_ < {last}')} ELSE kept END AS kept FROM (
        SELECT h.*, {folded} AS kept FROM ({has}) h JOIN (SELECT {keys}, {d.listed('centre', 'centre')} AS spots FROM ({spots}) c8_ GROUP BY {keys}) c9_ USING ({keys})) k_"""
    bounds = f"SELECT *, coalesce(lead(s) OVER ({part} ORDER BY s), high) AS e FROM (SELECT {keys}, high, has_cuts, {d.explode('kept')} AS s FROM ({kept}) b1_) b2_"
    line = f"SELECT {keys}, {d.at('frame_ids', 'k')} AS frame, window_id, piece, k, payload FROM (SELECT {keys}, window_id, frame_ids, piece, payload, {d.explode(d.seq('a', 'b'))} AS k FROM ({pieces}) l1_ WHERE told) l2_"
    none = "CAST(NULL AS BIGINT)"
    both = f"SELECT {keys}, s AS frame, s, e, has_cuts, CAST(-1 AS BIGINT) AS window_id, {none} AS piece, {none} AS k, CAST(NULL AS STRING) AS payload FROM ({bounds}) u1_ UNION ALL SELECT {keys}, frame, {none}, {none}, CAST(NULL AS INT), window_id, CAST(piece AS BIGINT), CAST(k AS BIGINT), payload FROM ({line}) u2_"
    # the last boundary so far holds, and as starts and ends rise, the greatest is the last
    order = f"OVER ({part} ORDER BY frame, window_id, piece, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    seen = f"SELECT {keys}, frame, window_id, payload, max(s) {order} AS s, max(e) {order} AS e, max(has_cuts) {order} AS has_cuts, row_number() OVER ({part} ORDER BY frame, window_id, piece, k) AS place FROM ({both}) s1_"
    a, b = (f"s + {d.whole(f'{num(x)} * (e - s)')}" for x in (0.4, 0.6))
    votes = f"""SELECT {keys}, s, e, payload, max(has_cuts) AS has_cuts, count_if(window_id >= 0) AS all_votes, count_if(window_id >= 0 AND frame >= {a} AND frame <= {b}) AS mid_votes,
        min(CASE WHEN window_id >= 0 THEN place END) AS all_first, min(CASE WHEN window_id >= 0 AND frame >= {a} AND frame <= {b} THEN place END) AS mid_first
        FROM ({seen}) v1_ WHERE s IS NOT NULL AND frame < e AND (window_id < 0 OR payload IS NOT NULL) GROUP BY {keys}, s, e, payload"""
    told = f"""SELECT {keys}, s, e, CASE WHEN max(has_cuts) = 0 THEN '{default}' ELSE coalesce(nullif(CASE WHEN sum(mid_votes) > 0 THEN {d.argmax('payload', ('mid_votes', '-coalesce(mid_first, 0)'))} WHEN sum(all_votes) > 0 THEN {d.argmax('payload', ('all_votes', '-coalesce(all_first, 0)'))} END, ''), '{default}') END AS payload
        FROM ({votes}) t1_ GROUP BY {keys}, s, e"""
    return f"SELECT {keys}, min(s) AS s, max(e) AS e, min(payload) AS payload FROM ({_runs(keys, 'payload', told)}) m_ GROUP BY {keys}, run"


def _none(d: Spark) -> str:
    return "CAST(array() AS ARRAY<BIGINT>)" if d.name == "spark" else "CAST([] AS BIGINT[])"


def _some(d: Spark) -> str:
    """Whether a window has a transition that counts."""
    return f"{d.size(d.keep('transitions', 't_', f't_ >= 0 AND t_ < ' + d.size('frame_ids')))} > 0"


def _runs(keys: str, value: str, rows: str) -> str:
    """Rows with a run number: it grows where the value differs from that of the segment before."""
    return f"SELECT *, sum(new) OVER (PARTITION BY {keys} ORDER BY s) AS run FROM (SELECT *, CASE WHEN {value} = lag({value}) OVER (PARTITION BY {keys} ORDER BY s) THEN 0 ELSE 1 END AS new FROM ({rows}) r1_) r2_"


def generic_segments(d: Spark, radius: int = 20, least: int = 25) -> str:
    return segments(d, "{windows}", radius, least, DEFAULT_TASK)


def refined_tasks(d: Spark) -> str:
    """Segments {parts} (episode, s, e, instruction) as a model merged them, {proposals} (episode, place, s, e, instruction).

    A proposal holds if it starts and ends with the episode's segments, has no gap, and every end is an old one; else, and
    where there is none, neighbours with one instruction (trimmed, without case, not blank) are merged. An episode of one
    segment stays as it is.
    """
    spans = "SELECT episode, min(s) AS lo, max(e) AS hi, count(*) AS n FROM {parts} GROUP BY episode"
    ends = "SELECT episode, s AS b FROM {parts} UNION SELECT episode, e AS b FROM {parts}"
    rows = "SELECT *, lag(e) OVER (PARTITION BY episode ORDER BY place) AS before_e, lead(s) OVER (PARTITION BY episode ORDER BY place) AS next_s FROM {proposals}"
    good = f"""SELECT episode FROM (SELECT p.episode, count_if(x.b IS NULL OR y.b IS NULL) AS unknown, count_if(CASE WHEN p.before_e IS NULL THEN p.s <> z.lo ELSE p.s <> p.before_e END OR (p.next_s IS NULL AND p.e <> z.hi)) AS broken, max(z.n) AS n
        FROM ({rows}) p JOIN ({spans}) z ON z.episode = p.episode LEFT JOIN ({ends}) x ON x.episode = p.episode AND x.b = p.s LEFT JOIN ({ends}) y ON y.episode = p.episode AND y.b = p.e GROUP BY p.episode) g_ WHERE unknown = 0 AND broken = 0 AND n > 1"""
    key = "lower(trim(instruction))"
    merged = f"SELECT episode, min(s) AS s, max(e) AS e, {d.argmin('instruction', ('s',))} AS instruction, 'merged' AS how FROM ({_runs('episode', 'key_', f'SELECT *, nullif({key}, {chr(39) * 2}) AS key_ FROM {{parts}}')}) m_ GROUP BY episode, run"
    return f"""SELECT m.episode, m.s, m.e, m.instruction, m.how FROM ({merged}) m LEFT JOIN ({good}) g ON g.episode = m.episode WHERE g.episode IS NULL
        UNION ALL SELECT p.episode, p.s, p.e, coalesce(nullif(trim(p.instruction), ''), '{DEFAULT_TASK}') AS instruction, 'refined' AS how FROM {{proposals}} p JOIN ({good}) g ON g.episode = p.episode"""


def two_level_captions(d: Spark, radius: int = 20, least: int = 25) -> str:
    """Both levels: an episode's tasks from {windows}, then each task's actions from {inner} (as windows, whose frames are
    of the whole episode; those that start inside a task are its own). A row a task: caption, s, e, actions in order."""
    tasks = f"SELECT episode, CAST(row_number() OVER (PARTITION BY episode ORDER BY s) - 1 AS BIGINT) AS task, s, e, payload AS caption FROM ({segments(d, '{windows}', radius, least, DEFAULT_TASK)}) t_"
    # a window's task by the last start before it, as for frames
    order = "OVER (PARTITION BY episode ORDER BY at_, side_ ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    first = d.at("frame_ids", "0")
    null = "CAST(NULL AS BIGINT)"
    own = f"SELECT episode, window_id, max(task) {order} AS task, max(s) {order} AS low, max(e) {order} AS high, side_ FROM (SELECT episode, s AS at_, 0 AS side_, {null} AS window_id, task, s, e FROM ({tasks}) o1_ UNION ALL SELECT episode, {first}, 1, window_id, {null}, {null}, {null} FROM {{inner}}) o2_"
    dealt = f"""(SELECT i.episode, o.task, CAST(row_number() OVER (PARTITION BY i.episode, o.task ORDER BY i.window_id) - 1 AS BIGINT) AS window_id, count(*) OVER (PARTITION BY i.episode, o.task) AS n_windows, i.frame_ids, i.transitions, i.payloads, o.low, o.high
        FROM {{inner}} i JOIN ({own}) o ON o.episode = i.episode AND o.window_id = i.window_id WHERE o.side_ = 1 AND o.task IS NOT NULL) d_"""
    acts = segments(d, dealt, max(1, radius // 4), max(1, least // 4), DEFAULT_ACTION, "episode, task")
    listed = d.join(d.listed(f"concat({T.slug(d, 'payload', DEFAULT_ACTION)}, ':', CAST(s AS STRING), '-', CAST(e AS STRING))", "s"), ";")
    return f"SELECT t.episode, t.task, t.caption, t.s, t.e, coalesce(a.actions, '') AS actions FROM ({tasks}) t LEFT JOIN (SELECT episode, task, {listed} AS actions FROM ({acts}) a_ GROUP BY episode, task) a ON a.episode = t.episode AND a.task = t.task"
