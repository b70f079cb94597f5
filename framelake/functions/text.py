"""Text functions: slugs, masks, rates, lenient readers of model answers; SQL over a dialect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake.plans.dialect import Spark

#: Fixed scene labels.
SCENES = ("household", "commercial", "industrial", "medical", "public_service", "education", "outdoor", "transportation", "entertainment", "unknown")


def column(sql: str) -> Column:
    """An expression of this module as a Column: its braces are doubled, as texts with places need them."""
    return F.expr(sql.replace("{{", "{").replace("}}", "}"))


def slug(d: Spark, x: str, default: str = "clip") -> str:
    s = d.strip(d.replace(f"lower(trim({x}))", "[^a-z0-9]+", "_"), "_")
    return f"coalesce(nullif({s}, ''), '{default}')"


def tail(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE concat('...', right({x}, {n})) END"


def head(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE concat(left({x}, {n}), '...') END"


def mask(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN '' WHEN length({x}) <= 8 THEN concat(left({x}, 2), '***') ELSE concat(left({x}, 4), '***', right({x}, 4)) END"


def rate(d: Spark, x: str) -> str:
    """A frame rate `a/b` or a number; blank, 0/0 and a zero denominator are null."""
    a, b = d.number(d.search(x, "^([^/]*)/", 1)), d.number(d.search(x, "/(.*)$", 1))
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' OR {x} = '0/0' THEN NULL WHEN {x} LIKE '%/%' THEN CASE WHEN {b} <> 0 THEN {a} / {b} END ELSE {d.number(x)} END"


def side(d: Spark, x: str, which: int) -> str:
    """Width (1) or height (2) of `WxH`; null unless there are two whole numbers."""
    return f"CAST({d.search(f'lower({x})', '^([0-9]+)x([0-9]+)$', which)} AS INT)"


def truthy(x: str) -> str:
    return f"lower(trim({x})) IN ('1', 'true', 'yes', 'y', 'on')"


def greedy_json(d: Spark, x: str) -> str:
    """From the first brace to the last, null if there is none."""
    return d.search(x, r"(?s)\{.*\}", 0)


def scene(d: Spark, x: str) -> str:
    label = f"lower(trim({d.sole_json(greedy_json(d, x), 'scene')}))"
    return f"CASE WHEN {label} IN ({', '.join(repr(s) for s in SCENES)}) THEN {label} ELSE 'unknown' END"


# Keys and patterns that answers are read by.
COUNT_KEYS = ("hand_count", "ego_hand_count", "count")
SINGLE_KEYS = ("single_person_operation", "single_operator_only")


def _flag(d: Spark, t: str, key: str) -> str:
    """A JSON answer's field: true or false, or the words yes or no; the strings "true" and "false" are neither."""
    got = f"lower({d.sole_json(t, key)})"
    bare = d.search(t, rf'"{key}"\s*:\s*(true|false)', 1)
    return f"CASE WHEN {got} IN ('yes', 'no') THEN {got} = 'yes' WHEN {got} IN ('true', 'false') AND {bare} IS NOT NULL THEN {got} = 'true' END"


def _keyed(d: Spark, t: str, key: str) -> str:
    got = d.search(t, rf'"{key}"\s*:\s*"(yes|no)"', 1)
    return f"CASE WHEN {got} IS NOT NULL THEN {got} = 'yes' END"


def hand_count(d: Spark, x: str) -> str:
    """The first stand-alone 0, 1 or 2; else a JSON count (true and false are 1 and 0); else such a digit between other characters; else null."""
    t = d.lower(f"trim({x})")
    keyed = f"coalesce({', '.join(d.sole_json(t, k) for k in COUNT_KEYS)})"
    bare = d.search(t, rf'"({"|".join(COUNT_KEYS)})"\s*:\s*(true|false)', 2)
    said = f"CASE WHEN {bare} IS NOT NULL AND {keyed} = 'true' THEN '1' WHEN {bare} IS NOT NULL AND {keyed} = 'false' THEN '0' END"
    return f"CAST(coalesce({d.search(t, r'\b([012])\b', 1)}, {said}, {d.search(t, r'[^0-9]([012])([^0-9]|$)', 1)}) AS INT)"


def active(d: Spark, x: str) -> str:
    """Bare yes or no; JSON field; keyed text; the first yes or no as a word; else null."""
    t = d.lower(f"trim({x})")
    word = d.search(t, r"\b(yes|no)\b", 1)
    return f"CASE WHEN {t} IN ('yes', 'no') THEN {t} = 'yes' ELSE coalesce({_flag(d, t, 'active_manipulation')}, {_keyed(d, t, 'active_manipulation')}, {word} = 'yes') END"


def single(d: Spark, x: str) -> str:
    """Whether one person acts: JSON field, by either of two names, then keyed text; else null."""
    t = d.lower(f"trim({x})")
    return f"coalesce({', '.join(_flag(d, t, k) for k in SINGLE_KEYS)}, {', '.join(_keyed(d, t, k) for k in SINGLE_KEYS)})"
