"""From window cuts to segments: position weights, cut clustering, minimum length, majority votes, merging.

Inputs: frames (episode, frame_idx, n, kind, cut). Sequential rules are folds over a sorted array of an episode's cuts.
"""

from __future__ import annotations

from framelake.operators.quality import num
from framelake.plans.dialect import Spark


def _weights(d: Spark) -> str:
    return f"SELECT episode, frame_idx, n, kind, cut, CASE WHEN n = 1 THEN {num(1)} ELSE 0.5e0 + 0.5e0 * cos(pi() * (1 - (n + 2) + 2 * (frame_idx + 1)) / (n + 1)) END AS w FROM {{frames}}"


def hanning_weights(d: Spark) -> str:
    """The inner weights of a Hann window over all n places."""
    return f"SELECT episode, frame_idx, round(w, 9) AS w FROM ({_weights(d)}) a"


def _cuts(d: Spark) -> str:
    return f"SELECT episode, {d.listed('frame_idx', 'frame_idx')} AS cuts FROM {{frames}} WHERE cut GROUP BY episode"


def cut_clusters_anchor(d: Spark, radius: int = 6) -> str:
    """A cut joins the cluster while it is at most `radius` from the cluster's FIRST cut; centres are weighted,
    truncated after rounding to nine places (so a cut alone is its own centre)."""
    anchors = d.trunc_fold("cuts", f"b_ - LAST > {radius}")
    return f"""SELECT episode, anchor, count(*) AS size, {d.whole('round(sum(frame_idx * w) / sum(w), 9)')} AS centre FROM (
        SELECT f.episode, f.frame_idx, f.w, max(a.anchor) AS anchor FROM ({_weights(d)}) f JOIN (SELECT episode, {d.explode(anchors)} AS anchor FROM ({_cuts(d)}) c) a ON f.episode = a.episode AND f.frame_idx >= a.anchor AND f.frame_idx <= a.anchor + {radius}
        WHERE f.cut GROUP BY f.episode, f.frame_idx, f.w) g GROUP BY episode, anchor"""


def cut_clusters_chain(d: Spark, radius: int = 2) -> str:
    """A cut joins the cluster while it is at most `radius` from the cluster's LAST cut."""
    return f"""SELECT episode, min(frame_idx) AS first_frame, max(frame_idx) AS last_frame, count(*) AS size, {d.whole('round(sum(frame_idx * w) / sum(w), 9)')} AS centre FROM (
        SELECT episode, frame_idx, w, sum(gap) OVER (PARTITION BY episode ORDER BY frame_idx) AS cluster FROM (
            SELECT episode, frame_idx, w, CASE WHEN frame_idx - lag(frame_idx) OVER (PARTITION BY episode ORDER BY frame_idx) > {radius} THEN 1 ELSE 0 END AS gap FROM ({_weights(d)}) a WHERE cut) b) c GROUP BY episode, cluster"""


def _kept(d: Spark, least: int) -> str:
    """Cuts kept by the greedy minimum length, from 0; the last goes if the tail is shorter. A 0 stands first."""
    folded = d.trunc_fold("cuts0", f"b_ - LAST >= {least}")
    return f"""SELECT episode, n, CASE WHEN {d.size('kept')} > 1 AND n - {d.at('kept', d.size('kept') + ' - 1')} < {least} THEN {d.keep('kept', 'z_', f"z_ < {d.at('kept', d.size('kept') + ' - 1')}")} ELSE kept END AS kept FROM (
        SELECT episode, n, {folded} AS kept FROM (SELECT episode, max(n) AS n, {d.listed('c', 'c')} AS cuts0 FROM (
            SELECT episode, n, frame_idx AS c FROM {{frames}} WHERE cut AND frame_idx > 0 UNION ALL SELECT DISTINCT episode, n, CAST(0 AS BIGINT) AS c FROM {{frames}}) u GROUP BY episode) a) b"""


def cut_min_length(d: Spark, least: int = 5) -> str:
    return f"SELECT episode, n, {d.join(d.map('kept', 'z_', 'CAST(z_ AS STRING)'))} AS boundaries, CAST({d.size('kept')} AS BIGINT) AS n_segments FROM ({_kept(d, least)}) k"


def _segments(d: Spark, least: int) -> str:
    return f"SELECT episode, s, coalesce(lead(s) OVER (PARTITION BY episode ORDER BY s), n) AS e FROM (SELECT episode, n, {d.explode('kept')} AS s FROM ({_kept(d, least)}) k) x"


def _centre(d: Spark) -> tuple[str, str]:
    return tuple(f"(g.s + {d.whole(f'{num(x)} * (g.e - g.s)')})" for x in (0.4, 0.6))


def _winner(d: Spark, rows: str) -> str:
    """The most frequent value; of ties the one first seen."""
    return f"SELECT episode, s, e, {d.argmax('kind', ('votes', '-first_seen'))} AS instruction, max(votes) AS votes FROM (SELECT episode, s, e, kind, count(*) AS votes, min(pos) AS first_seen FROM ({rows}) v GROUP BY episode, s, e, kind) w GROUP BY episode, s, e"


def segment_vote_overlap(d: Spark, least: int = 5, span: int = 3) -> str:
    """Segments with the majority of the spans that overlap their middle fifth. Spans: `span` frames from each frame."""
    low, high = _centre(d)
    rows = f"SELECT g.episode, g.s, g.e, f.kind, f.frame_idx AS pos FROM ({_segments(d, least)}) g JOIN {{frames}} f ON f.episode = g.episode AND f.frame_idx <= {high} AND f.frame_idx + {span} >= {low}"
    return f"SELECT g.episode, g.s, g.e, coalesce(w.instruction, 'none') AS instruction, coalesce(w.votes, 0) AS votes FROM ({_segments(d, least)}) g LEFT JOIN ({_winner(d, rows)}) w ON g.episode = w.episode AND g.s = w.s"


def segment_vote_timeline(d: Spark, least: int = 5, every: int = 4) -> str:
    """Majority over a timeline of every `every`-th frame in the middle fifth; where there is none, in the whole segment."""
    low, high = _centre(d)
    line = f"(SELECT * FROM {{frames}} WHERE frame_idx % {every} = 0)"
    mid = f"SELECT g.episode, g.s, g.e, f.kind, f.frame_idx AS pos FROM ({_segments(d, least)}) g JOIN {line} f ON f.episode = g.episode AND f.frame_idx BETWEEN {low} AND {high}"
    all_ = f"SELECT g.episode, g.s, g.e, f.kind, f.frame_idx AS pos FROM ({_segments(d, least)}) g JOIN {line} f ON f.episode = g.episode AND f.frame_idx >= g.s AND f.frame_idx < g.e"
    return f"SELECT g.episode, g.s, g.e, coalesce(m.instruction, a.instruction, 'default') AS instruction, coalesce(m.votes, a.votes, 0) AS votes FROM ({_segments(d, least)}) g LEFT JOIN ({_winner(d, mid)}) m ON g.episode = m.episode AND g.s = m.s LEFT JOIN ({_winner(d, all_)}) a ON g.episode = a.episode AND g.s = a.s"


def merge_adjacent(d: Spark, fold_case: bool = False) -> str:
    """Neighbouring segments with equal instructions become one; with fold_case, trimmed, without case, and never blank ones."""
    key = "lower(trim(kind))" if fold_case else "kind"
    blank = f" AND {key} <> ''" if fold_case else ""
    return f"""SELECT episode, CAST(row_number() OVER (PARTITION BY episode ORDER BY s) AS BIGINT) AS step, s, e, instruction, parts FROM (
        SELECT episode, min(frame_idx) AS s, max(frame_idx) + 1 AS e, {d.argmin('kind', ('frame_idx',))} AS instruction, count(*) AS parts FROM (
            SELECT episode, frame_idx, kind, sum(new) OVER (PARTITION BY episode ORDER BY frame_idx) AS run FROM (
                SELECT episode, frame_idx, kind, CASE WHEN {key} = lag({key}) OVER (PARTITION BY episode ORDER BY frame_idx){blank} THEN 0 ELSE 1 END AS new FROM {{frames}}) a) b GROUP BY episode, run) c"""


def merge_adjacent_ci(d: Spark) -> str:
    return merge_adjacent(d, True).replace("{frames}", "(SELECT episode, frame_idx, CASE WHEN frame_idx % 2 = 0 THEN upper(kind) WHEN frame_idx % 7 = 3 THEN ' ' ELSE kind END AS kind FROM {frames})")


def task_segments(d: Spark, radius: int = 6, least: int = 5) -> str:
    """The whole task method: anchor clusters' centres as cuts, minimum length, overlap votes; an episode without cuts is one segment."""
    centres = f"SELECT DISTINCT episode, centre FROM ({cut_clusters_anchor(d, radius)}) k"
    cut = f"(SELECT f.episode, f.frame_idx, f.n, f.kind, c.centre IS NOT NULL AS cut FROM {{frames}} f LEFT JOIN ({centres}) c ON f.episode = c.episode AND f.frame_idx = c.centre)"
    return segment_vote_overlap(d, least).replace("{frames}", cut)
