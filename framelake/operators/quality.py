"""Frame quality, exposure and stability: metrics by frame, summaries and verdicts by episode.

Inputs: frames (episode, frame_idx, px). Thresholds and sizes are parameters; `blur` is the Laplacian variance under
which a frame is blurry. An episode without frames has no row; ratios of no frames are null.
"""

from __future__ import annotations

from framelake.functions import kernels as K
from framelake.plans.dialect import Spark

#: Fixed thresholds of exposure and stability flags.
OVER, OVER_LIGHT, UNDER, UNDER_LIGHT = 0.05, 0.55, 0.20, 0.35
SHIFT_SPEED, TURN_SPEED = 1500.0, 0.50
#: Fixed: the Laplacian variance under which a frame of real size is blurry.
BLURRY = 60.0


def num(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def frame_quality(d: Spark, blur: float = BLURRY, w: int = 8, h: int = 8) -> str:
    return f"""SELECT episode, frame_idx, round(lap, 6) AS laplacian_var, round(ten, 6) AS tenengrad, round(light / 255, 6) AS mean_brightness, lap < {num(blur)} AS is_blurry
        FROM (SELECT episode, frame_idx, {K.variance(d, 'l')} AS lap, {K.mean(d, 'g')} AS ten, {K.mean(d, K.doubles(d))} AS light
            FROM (SELECT episode, frame_idx, px, {K.laplacian(d, w=w, h=h)} AS l, {K.gradient(d, w=w, h=h)} AS g FROM {{frames}}) a) b"""


def quality_summary(d: Spark, most: float = 0.5, fps: float = 30, **kw) -> str:
    blurry = d.listed(f"concat(CAST(frame_idx AS STRING), '@', CAST(CAST(round(frame_idx / {num(fps)} * 100, 0) AS BIGINT) AS STRING))", "frame_idx")
    return f"""SELECT q.episode, q.n, q.laplacian, q.tenengrad, q.brightness, q.blur_ratio, q.pass, coalesce(b.blurry, '') AS blurry FROM
        (SELECT episode, count(*) AS n, round(avg(laplacian_var), 2) AS laplacian, round(avg(tenengrad), 2) AS tenengrad, round(avg(mean_brightness), 2) AS brightness,
            round(avg(CASE WHEN is_blurry THEN 1.0 ELSE 0.0 END), 4) * 1e0 AS blur_ratio, count_if(is_blurry) <= {num(most)} * count(*) AS pass FROM ({frame_quality(d, **kw)}) x GROUP BY episode) q
        LEFT JOIN (SELECT episode, {d.join(blurry)} AS blurry FROM ({frame_quality(d, **kw)}) y WHERE is_blurry GROUP BY episode) b ON q.episode = b.episode""".replace("1.0 ELSE 0.0", "CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE)").replace(" * 1e0", "")


def frame_exposure(d: Spark) -> str:
    return f"""SELECT episode, frame_idx, round(light, 6) AS mean_brightness, over_ratio, under_ratio, round(spread, 6) AS dynamic_range, round(bits, 6) AS histogram_entropy,
            over_ratio > {num(OVER)} AND light > {num(OVER_LIGHT)} AS over_exposed, under_ratio > {num(UNDER)} AND light < {num(UNDER_LIGHT)} AS under_exposed
        FROM (SELECT episode, frame_idx, {K.mean(d, K.doubles(d))} / 255 AS light, {K.share(d, 'px', 'z_ > 220')} AS over_ratio, {K.share(d, 'px', 'z_ < 30')} AS under_ratio,
            ({K.percentile(d, 'px', 0.99)} - {K.percentile(d, 'px', 0.01)}) / 255 AS spread, {K.entropy(d)} AS bits FROM {{frames}}) a"""


def exposure_summary(d: Spark) -> str:
    lists = [f"{d.join(d.keep(d.listed(f'CASE WHEN {k} THEN CAST(frame_idx AS STRING) END', 'frame_idx'), 'z_', 'z_ IS NOT NULL'))} AS {k}_frames" for k in ("over_exposed", "under_exposed")]
    return f"""SELECT episode, round(avg(mean_brightness), 4) AS brightness, round(avg(over_ratio), 4) AS over_ratio, round(avg(under_ratio), 4) AS under_ratio, round(avg(dynamic_range), 4) AS dynamic_range,
        NOT bool_or(over_exposed OR under_exposed) AS pass, {', '.join(lists)} FROM ({frame_exposure(d)}) x GROUP BY episode"""


def pair_motion(d: Spark, fps: float = 30, scale: float = 100, w: int = 8, h: int = 8) -> str:
    """Motion between consecutive frames. The tracker is pluggable; this stand-in takes the shift of the brightness centroid."""
    return f"""SELECT episode, lag_idx AS frame_from, frame_idx AS frame_to, {d.idiv('(lag_idx + frame_idx)', '2')} AS frame_mid, round(dx, 6) AS dx, round(dy, 6) AS dy, round(da, 6) AS da,
            round(sqrt(dx * dx + dy * dy) / dt, 4) AS shift_speed, round(abs(da) / dt, 4) AS turn_speed, sqrt(dx * dx + dy * dy) / dt > {num(SHIFT_SPEED)} OR abs(da) / dt > {num(TURN_SPEED)} AS jitter
        FROM (SELECT episode, frame_idx, lag_idx, {num(scale)} * (x - lag_x) AS dx, {num(scale)} * (y - lag_y) AS dy, (x - lag_x) / {num(w)} AS da, CASE WHEN {num(fps)} <= 0 THEN {num(1)} ELSE (frame_idx - lag_idx) / {num(fps)} END AS dt
            FROM (SELECT episode, frame_idx, x, y, lag(frame_idx) OVER o AS lag_idx, lag(x) OVER o AS lag_x, lag(y) OVER o AS lag_y
                FROM (SELECT episode, frame_idx, {K.moment(d, 'px', w, h, 'x')} AS x, {K.moment(d, 'px', w, h, 'y')} AS y FROM {{frames}}) a WINDOW o AS (PARTITION BY episode ORDER BY frame_idx)) b
            WHERE lag_idx IS NOT NULL) c"""


def stability_summary(d: Spark) -> str:
    return f"""SELECT e.episode, coalesce(m.pairs, 0) AS pairs, coalesce(round(m.translation_std, 4), {num(0)}) AS translation_std, coalesce(round(m.rotation_std, 4), {num(0)}) AS rotation_std, coalesce(m.max_shift, {num(0)}) AS max_shift, coalesce(m.jitters, 0) AS jitters, coalesce(m.jitters, 0) = 0 AS pass
        FROM (SELECT DISTINCT episode FROM {{frames}}) e LEFT JOIN (SELECT episode, count(*) AS pairs, sqrt(var_pop(dx) + var_pop(dy)) AS translation_std, stddev_pop(da) AS rotation_std, max(shift_speed) AS max_shift, count_if(jitter) AS jitters FROM ({pair_motion(d)}) x GROUP BY episode) m ON e.episode = m.episode"""


def quality_verdict(d: Spark, checks: tuple[str, ...] = ("blur", "exposure", "stability"), blur: float = BLURRY) -> str:
    """A missing sub-check passes; those not enabled don't count."""
    parts = [f"coalesce({k}_pass, true)" for k in checks] or ["true"]
    return f"""SELECT q.episode, q.pass AS blur_pass, x.pass AS exposure_pass, s.pass AS stability_pass, {' AND '.join(p.replace('blur_pass', 'q.pass').replace('exposure_pass', 'x.pass').replace('stability_pass', 's.pass') for p in parts)} AS pass
        FROM ({quality_summary(d, blur=blur)}) q LEFT JOIN ({exposure_summary(d)}) x ON q.episode = x.episode LEFT JOIN ({stability_summary(d)}) s ON q.episode = s.episode"""


def flagged_frames(d: Spark, blur: float = BLURRY) -> str:
    """One category a frame: under- over over-exposed, these over blurry; jitter marks the middle frame, unless it is blurry or has another flag."""
    return f"""SELECT episode, frame_idx, CASE max(CASE kind WHEN 'under' THEN 4 WHEN 'over' THEN 3 WHEN 'blurry' THEN 2 ELSE 1 END) WHEN 4 THEN 'underexposed' WHEN 3 THEN 'overexposed' WHEN 2 THEN 'blurry' ELSE 'jitter' END AS category FROM (
        SELECT episode, frame_idx, 'blurry' AS kind FROM ({frame_quality(d, blur=blur)}) a WHERE is_blurry
        UNION ALL SELECT episode, frame_idx, 'over' AS kind FROM ({frame_exposure(d)}) b WHERE over_exposed UNION ALL SELECT episode, frame_idx, 'under' AS kind FROM ({frame_exposure(d)}) c WHERE under_exposed
        UNION ALL SELECT episode, frame_mid AS frame_idx, 'jitter' AS kind FROM ({pair_motion(d)}) e WHERE jitter) f GROUP BY episode, frame_idx"""
