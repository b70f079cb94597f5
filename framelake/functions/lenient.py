"""Lenient readers of JSON in model answers that expressions can't do: a Pandas UDF, only for answers that from_json can't read."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_FENCE = re.compile(r"^\s*```[A-Za-z]*\s*\n?(.*?)\n?\s*```\s*$", re.S)


def first_object(text: str | None) -> dict | None:
    """The text, without a code fence, as JSON; else the first value that decodes at a brace or bracket. A dict, or the first dict of a list."""
    if not text:
        return None
    m = _FENCE.match(text)
    text = m[1] if m else text
    decoder = json.JSONDecoder()
    for at in [0, *(m.start() for m in re.finditer(r"[{\[]", text))]:
        try:
            value = json.loads(text) if not at else decoder.raw_decode(text, at)[0]
        except ValueError:
            try:
                value = decoder.raw_decode(text, at)[0]
            except ValueError:
                continue
        if isinstance(value, list):
            value = next((x for x in value if isinstance(x, dict)), None)
        if isinstance(value, dict):
            return value
    return None


def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if (x := first_object(t)) is None else json.dumps(x, sort_keys=True, ensure_ascii=False, separators=(",", ":")))


def canonical_json(text: Column) -> Column:
    """The answer's object with sorted keys, as text; null if it has none."""
    return F.pandas_udf(_canonical, "string")(text)


def array_json(text: str | None) -> list | None:
    """From the first bracket to the last, a list; else null."""
    m = re.search(r"\[.*\]", text or "", re.S)
    try:
        value = json.loads(m[0]) if m else None
    except ValueError:
        return None
    return value if isinstance(value, list) else None
