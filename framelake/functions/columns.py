"""Small values as Columns: names, keys, digests, percentages, boxes, sizes. Null in, null out unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names under which a method, a codec and a blur target are known.
METHODS = {"segment_v2t": "task", "task_v2t": "task", "task_action_v2t": "atomic_action", "atomic": "atomic_action", "atomic-action": "atomic_action"}
CODECS = {"h264": "h264", "hevc": "h265", "h265": "h265", "ffv1": "ffv1", "vp9": "vp9", "av1": "av1"}
TARGETS = {"both": (True, True), "face": (True, False), "lp": (False, True), "plate": (False, True), "license_plate": (False, True), "license-plate": (False, True)}
CACHE, VIDEO_SUFFIX = ".frame_cache", r"(?i)\.(mp4|mov|mkv|avi|webm|m4v)$"


def _known(key: Column, names: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[key]


def method_key(c: Column) -> Column:
    """A caption method by its own name; null and the empty text are `task`, unknown names stay."""
    key = F.lower(F.trim(F.coalesce(F.nullif(c, F.lit("")), F.lit("task"))))
    return F.coalesce(_known(key, METHODS), key)


def codec_key(c: Column) -> Column:
    """The codec that a probe's name stands for; null if it is none of ours."""
    key = F.lower(c)
    return F.coalesce(_known(key, CODECS), F.when(key.startswith("prores"), F.lit("prores")))


def blur_flags(targets: Column, face: Column, plate: Column) -> Column:
    """Struct (face, plate): what is blurred; without targets the two flags as given. Raises for an unknown target."""
    key = F.lower(F.trim(targets))
    out = F.when(targets.isNull(), F.struct(face.alias("face"), plate.alias("plate")))
    for name, (f, p) in TARGETS.items():
        out = out.when(key == name, F.struct(F.lit(f).alias("face"), F.lit(p).alias("plate")))
    wrong = F.raise_error(F.concat(F.lit("blur targets are face, lp or both, not "), targets))
    return out.otherwise(F.struct(wrong.cast("boolean").alias("face"), wrong.cast("boolean").alias("plate")))


def short_digest(c: Column, n: int = 12) -> Column:
    return F.substring(F.sha1(c.cast("binary")), 1, n)


def episode_root(path: Column) -> Column:
    """The episode's folder, also of a folder `.../segments/x` in it."""
    return F.regexp_replace(path, r"/segments/[^/]+$", "")


def segment_prefix(path: Column) -> Column:
    """`x_` for a folder `.../segments/x`, else empty."""
    name = F.regexp_extract(path, r"(?:^|/)segments/([^/]+)$", 1)
    return F.when(name != "", F.concat(name, F.lit("_"))).otherwise(F.when(path.isNotNull(), F.lit("")))


def stem(path: Column) -> Column:
    """A file's name without folders and without its last suffix."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")


def folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def cache_root(path: Column) -> Column:
    """Where frames are cached: in the episode's folder, or, of a video, in a folder of its stem beside it."""
    return F.when(path.rlike(VIDEO_SUFFIX), F.concat_ws("/", folder(path), F.lit(CACHE), stem(path))).otherwise(F.concat_ws("/", path, F.lit(CACHE)))


def default_output(video: Column, base: Column, by_episode: Column, name: str) -> Column:
    """Where a result goes that was given no place: the episode's folder, or beside the video."""
    return F.concat_ws("/", F.when(by_episode, base).otherwise(folder(video)), F.lit(name))


def default_blurred(video: Column, base: Column, by_episode: Column) -> Column:
    """`rgb_blurred.mp4` of an episode; of a single video its own name with `_blurred`."""
    beside = F.concat(folder(video), F.lit("/"), stem(video), F.lit("_blurred"), F.regexp_extract(video, r"(?<=[^/])(\.[^./]*)$", 1))
    return F.when(by_episode, F.concat(base, F.lit("/rgb_blurred.mp4"))).otherwise(beside)


def tenths(x: Column) -> Column:
    """A double with one decimal as text: exact halves go to the even digit, others by the number's exact value."""
    a, b = x * 8, x * 2
    y = a + b
    lost = (a - (y - (y - a))) + (b - (y - a))  # what adding has rounded off
    whole = F.when((y - F.floor(y) == 0.5) & (lost != 0), F.when(lost > 0, F.ceil(y)).otherwise(F.floor(y))).otherwise(F.rint(y))
    return F.format_string("%.1f", whole.cast("double") / 10)


def percent(c: Column) -> Column:
    """A ratio as a percentage with one decimal; 0% if it is null or no number."""
    x = c.try_cast("double")
    return F.when(x.isNull(), F.lit("0%")).otherwise(F.concat(tenths(x * 100), F.lit("%")))


def percent0(c: Column) -> Column:
    """A ratio as a whole percentage; null counts as 0."""
    return F.concat(F.rint(F.coalesce(c.cast("double"), F.lit(0.0)) * 100).cast("long").cast("string"), F.lit("%"))


def even(c: Column) -> Column:
    """The size itself if even, else one more."""
    return c + F.pmod(c, F.lit(2))


def shift_and_turn(a: dict[str, Column]) -> Column:
    """Struct (translation, rotation) of an affine matrix with entries m00, m02, m10, m12."""
    return F.struct(F.hypot(a["m02"], a["m12"]).alias("translation"), F.atan2(a["m10"], a["m00"]).alias("rotation"))


def rescale_box(box: Column, fx: Column, fy: Column) -> Column:
    """[x1, y1, x2, y2] by a factor for each axis."""
    return F.array(box[0] * fx, box[1] * fy, box[2] * fx, box[3] * fy)


def hand_box(box: Column, factor: Column) -> Column:
    """A hand's box by one factor, to one decimal."""
    return F.transform(box, lambda v: tenths(v * factor).cast("double"))


def rounded(x: Column, k: int) -> Column:
    """A double to k decimals as its exact binary value says, exact halves to the even digit.

    The product with 10^k is taken with what rounding it loses, by splitting both factors; it tells a half from almost one.
    """
    if k > 8:
        raise ValueError("more decimals than a product can be told apart at")
    s = float(10**k)
    split = lambda c: c * 134217729.0 - (c * 134217729.0 - c)
    a = x.cast("double")
    p = a * F.lit(s)
    hi, s_hi = split(a), s * 134217729.0 - (s * 134217729.0 - s)
    lo, s_lo = a - hi, s - s_hi
    lost = ((hi * s_hi - p) + hi * s_lo + lo * s_hi) + lo * s_lo
    whole = F.when((p - F.floor(p) == 0.5) & (lost != 0), F.when(lost > 0, F.ceil(p)).otherwise(F.floor(p)).cast("double")).otherwise(F.rint(p))
    return F.when(F.abs(p) < 2.0**51, whole / F.lit(s)).otherwise(a)


def utc_now() -> Column:
    """The time of the query in UTC, to the second."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
