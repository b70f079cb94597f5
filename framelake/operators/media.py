"""Media planning: transcode, cut and blur commands as columns. Nothing here runs a tool; an executor may, where there is one.

Inputs: probes (media, codec, width, height, fps, bitrate_kbps, pix_fmt, container, audio_codec, duration_ms, size_bytes), specs (spec, codec,
container, resolution, bitrate, fps, pix_fmt), outputs (media, codec, width, height, size_bytes, duration_sec).
"""

from __future__ import annotations

from framelake.functions import text as T
from framelake.operators.quality import num
from framelake.plans.dialect import Spark

# Encoders, codec families, arguments and container rules that commands must match.
ENCODERS = {"h264": "libx264", "h265": "libx265", "hevc": "libx265", "ffv1": "ffv1", "prores": "prores_ks", "vp9": "libvpx-vp9", "av1": "libsvtav1", "copy": "copy"}
FAMILIES = {"h264": ("h264",), "h265": ("hevc", "h265"), "hevc": ("hevc", "h265"), "ffv1": ("ffv1",), "prores": ("prores",), "vp9": ("vp9",), "av1": ("av1",)}
LOSSLESS = {
    "libx264": "-crf 0 -preset veryslow",
    "libx265": "-x265-params lossless=1 -preset veryslow",
    "ffv1": "-level 3 -slicecrc 1",
    "prores_ks": "-profile:v 4 -qscale:v 0",
    "libvpx-vp9": "-lossless 1",
    "libsvtav1": "",
}
QUALITY = {
    "libx264": "-preset veryslow -profile:v high",
    "libx265": "-preset veryslow -profile:v main",
    "libvpx-vp9": "-quality best -speed 0",
    "libsvtav1": "-preset 2",
    "prores_ks": "-profile:v 4",
    "ffv1": "-level 3 -slicecrc 1",
}
CONTAINERS = {
    "mp4": ("libx264", "libx265", "libsvtav1", "copy"),
    "mkv": ("libx264", "libx265", "ffv1", "libvpx-vp9", "libsvtav1", "copy"),
    "mov": ("libx264", "libx265", "prores_ks", "copy"),
    "avi": ("libx264", "ffv1", "copy"),
    "webm": ("libvpx-vp9", "libsvtav1", "copy"),
    "mxf": ("libx264", "libx265", "prores_ks", "copy"),
}
CUT_ENCODERS = {"h264": "libx264", "hevc": "libx265", "h265": "libx265", "mpeg4": "mpeg4", "vp8": "libvpx", "vp9": "libvpx-vp9"}


def _pick(x: str, table: dict[str, str], default: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {default} END"


def _among(x: str, key: str, table: dict[str, tuple[str, ...]], default: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN {x} IN ({', '.join(repr(y) for y in v)})" for k, v in table.items()) + f" ELSE {default} END"


def _plain(x: str) -> str:
    """A whole or decimal number as text, the same in either engine."""
    return f"CAST(CAST({x} AS DECIMAL(10, 2)) AS STRING)"


def transcode_plan(d: Spark) -> str:
    """One row for each probe and spec: whether to encode, with what, the command's arguments, or why not."""
    video = f"""CASE WHEN encoder = 'copy' THEN '-c:v copy' ELSE concat('-c:v ', encoder,
        CASE WHEN resize OR refps THEN concat(' -vf ', CASE WHEN resize THEN concat('scale=', CAST(tw AS STRING), ':', CAST(th AS STRING), ':flags=lanczos') ELSE '' END, CASE WHEN resize AND refps THEN ',' ELSE '' END, CASE WHEN refps THEN concat('fps=', {_plain('sfps')}) ELSE '' END) ELSE '' END,
        CASE WHEN spix IS NOT NULL THEN concat(' -pix_fmt ', spix) ELSE '' END,
        CASE WHEN sbit IS NOT NULL THEN concat(' -b:v ', sbit, coalesce(concat(' ', {_pick('encoder', QUALITY)}), '')) ELSE coalesce(concat(' ', {_pick('encoder', LOSSLESS)}), '') END) END"""
    audio = "CASE WHEN audio_codec IS NULL THEN '-an' WHEN target = 'webm' AND audio_codec NOT IN ('opus', 'vorbis') THEN '-c:a libopus -b:a 192k' ELSE '-c:a copy' END"
    error = f"CASE WHEN unknown THEN 'unknown codec' WHEN encoder = 'copy' AND (resize OR refps OR repix) THEN 'copy with change' WHEN NOT ({_among('encoder', 'target', CONTAINERS, 'true')}) THEN 'container' END"
    return f"""SELECT media, spec, encoder, reencode, resize, target, error, CASE WHEN error IS NULL THEN concat({video}, ' ', {audio}, ' -map_metadata 0') END AS args FROM (
        SELECT *, {error} AS error FROM (
            SELECT *, CASE WHEN NOT reencode THEN 'copy' WHEN wanted IS NOT NULL THEN wanted ELSE coalesce({_pick('codec', {k: v for k, v in ENCODERS.items() if k != 'copy'})}, 'libx264') END AS encoder FROM (
                SELECT *, resize OR recodec OR repix OR refps OR sbit IS NOT NULL AS reencode FROM (
                    SELECT p.media, s.spec, p.codec, p.audio_codec, s.bitrate AS sbit, s.fps AS sfps, s.pix_fmt AS spix, coalesce(s.container, p.container) AS target, {_pick('lower(s.codec)', ENCODERS)} AS wanted, s.codec IS NOT NULL AND {_pick('lower(s.codec)', ENCODERS)} IS NULL AS unknown,
                        {T.side(d, 's.resolution', 1)} AS tw, {T.side(d, 's.resolution', 2)} AS th, coalesce({T.side(d, 's.resolution', 1)} <> p.width OR {T.side(d, 's.resolution', 2)} <> p.height, false) AS resize,
                        coalesce(s.codec IS NOT NULL AND lower(s.codec) <> 'copy' AND NOT ({_among('p.codec', 'lower(s.codec)', FAMILIES, 'true')}), false) AS recodec, coalesce(s.pix_fmt <> p.pix_fmt, false) AS repix, coalesce(abs(s.fps - p.fps) > {num(0.01)}, false) AS refps
                    FROM {{probes}} p CROSS JOIN {{specs}} s) a) b) c) e"""


def encoder_choice(d: Spark) -> str:
    """Encoders of a probe for cutting and blurring, with their arguments."""
    args = "concat('-c:v ', encoder, CASE WHEN codec IN ('h264', 'hevc', 'h265') THEN ' -preset veryfast' ELSE '' END, CASE WHEN codec IN ('hevc', 'h265') THEN ' -tag:v hvc1' ELSE '' END, CASE WHEN bitrate_kbps > 1500 THEN concat(' -b:v ', CAST(bitrate_kbps * 1000 AS STRING)) WHEN codec IN ('h264', 'hevc', 'h265') THEN ' -crf 18' ELSE '' END, ' -pix_fmt ', pix_fmt)"
    return f"SELECT media, encoder, {args} AS args FROM (SELECT media, codec, bitrate_kbps, pix_fmt, {_pick('codec', CUT_ENCODERS, repr('libx264'))} AS encoder FROM {{probes}}) p"


def cut_commands(d: Spark) -> str:
    """The stream-copy command of each probe's first seconds."""
    return f"SELECT media, concat('-ss 0.000000 -t ', {_plain('fps / 10')}, ' -map 0:v:0 -map 0:a? -c copy -avoid_negative_ts make_zero', CASE WHEN codec IN ('hevc', 'h265') THEN ' -tag:v hvc1' ELSE '' END) AS args FROM {{probes}}"


def verify_output(d: Spark) -> str:
    """Before and after of a transcode: sizes in MB, codecs, resolutions, and how far the lengths are apart; over half a second is a warning."""
    mb = lambda x: f"round(CAST({x} AS DOUBLE) / 1048576, 2)"
    size = lambda t: f"concat(CAST({t}.width AS STRING), 'x', CAST({t}.height AS STRING))"
    apart = f"round(abs(o.duration_sec - CAST(p.duration_ms AS DOUBLE) / {num(1000)}), 3)"
    return f"SELECT p.media, {mb('p.size_bytes')} AS input_size_mb, {mb('o.size_bytes')} AS output_size_mb, p.codec AS input_codec, o.codec AS output_codec, {size('p')} AS input_resolution, {size('o')} AS output_resolution, {apart} AS duration_diff_sec, {apart} > {num(0.5)} AS warn FROM {{probes}} p JOIN {{outputs}} o ON o.media = p.media"


def effective_spec(d: Spark) -> str:
    """What a spec asks for, and for the rest what the original has."""
    return "SELECT p.media, s.spec, coalesce(s.codec, p.codec) AS codec, coalesce(s.container, p.container) AS container, coalesce(s.resolution, concat(CAST(p.width AS STRING), 'x', CAST(p.height AS STRING))) AS resolution, coalesce(s.pix_fmt, p.pix_fmt) AS pix_fmt, coalesce(s.bitrate, concat(CAST(p.bitrate_kbps AS STRING), 'k')) AS bitrate FROM {probes} p CROSS JOIN {specs} s"
