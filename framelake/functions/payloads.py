"""Bodies of model providers as VARIANT expressions: answer texts and token counts of two shapes, requests in the second.

A chat body has `choices`, a response body `output_text` or `output`. Names are fixed values of the public interfaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _get(v: str, path: str, kind: str = "variant") -> str:
    return f"try_variant_get({v}, '{path}', '{kind}')"


def _texts(items: str, types: tuple[str, ...]) -> str:
    """Texts that aren't empty of a variant list's items of these types, joined by lines; null if there is none."""
    of = ", ".join(f"'{t}'" for t in types)
    kept = f"filter({items}, x -> try_variant_get(x, '$.type', 'string') IN ({of}) AND coalesce(try_variant_get(x, '$.text', 'string'), '') <> '')"
    return f"nullif(array_join(transform({kept}, x -> try_variant_get(x, '$.text', 'string')), '\\n'), '')"


def chat_text(v: str) -> str:
    """The first choice's content: a text, the text parts of a list, else its JSON; null without one."""
    content = _get(v, "$.choices[0].message.content")
    kind = f"schema_of_variant({content})"
    return f"CASE WHEN {content} IS NULL OR is_variant_null({content}) THEN NULL WHEN {kind} = 'STRING' THEN {_get(content, '$', 'string')} ELSE coalesce({_texts(_get(content, '$', 'array<variant>'), ('text',))}, to_json({content})) END"


def response_text(v: str) -> str:
    """`output_text` if it isn't blank; else the texts in the contents of `output`."""
    said = f"IF(schema_of_variant({_get(v, '$.output_text')}) = 'STRING', {_get(v, '$.output_text', 'string')}, NULL)"
    inner = f"flatten(transform({_get(v, '$.output', 'array<variant>')}, o -> coalesce(try_variant_get(o, '$.content', 'array<variant>'), array())))"
    return f"coalesce(IF(trim({said}) <> '', {said}, NULL), {_texts(inner, ('output_text', 'text'))})"


def tokens(v: str, names: tuple[str, str]) -> str:
    """The first of two counts that is there and not 0; else 0."""
    return "coalesce(" + ", ".join(f"nullif({_get(v, f'$.usage.{n}', 'bigint')}, 0)" for n in names) + ", 0)"


def is_chat(v: str) -> str:
    return f"{_get(v, '$.choices')} IS NOT NULL"


def answers(lines: DataFrame, text: str = "value") -> DataFrame:
    """custom_id, text, prompt_tokens, completion_tokens, status_code, error of batch-output lines, whatever shape their bodies
    have. Blank lines and lines without a custom_id are skipped; the status is 200 unless given; a body without an answer has
    a null text."""
    got = lines.where(f"trim({text}) <> ''").select(F.expr(f"try_parse_json({text})").alias("v")).select("v", F.expr(_get("v", "$.custom_id", "string")).alias("custom_id"), F.expr(f"coalesce({_get('v', '$.response.body')}, {_get('v', '$.body')})").alias("b"))
    said = f"CASE WHEN {is_chat('b')} THEN {chat_text('b')} ELSE {response_text('b')} END"
    return got.where("custom_id IS NOT NULL").select(
        "custom_id", F.expr(said).alias("text"), F.expr(tokens("b", ("prompt_tokens", "input_tokens"))).alias("prompt_tokens"), F.expr(tokens("b", ("completion_tokens", "output_tokens"))).alias("completion_tokens"),
        F.expr(f"coalesce({_get('v', '$.response.status_code', 'int')}, {_get('v', '$.status_code', 'int')}, 200)").alias("status_code"), F.expr(f"coalesce({_get('v', '$.error.message', 'string')}, nullif(to_json({_get('v', '$.error')}), 'null'))").alias("error"),
    )


def response_input(messages: Column) -> Column:
    """Messages (array of struct role, content array of struct type, text, image_url) as a response request's input: text parts
    stay, images without an address are left out, other parts, too."""
    part = lambda kind, text, url: F.struct(F.lit(kind).alias("type"), text.alias("text"), url.alias("image_url"))
    none = F.lit(None).cast("string")

    def items(content: Column) -> Column:
        kept = F.filter(content, lambda x: (x["type"] == "text") | ((x["type"] == "image_url") & (F.coalesce(x["image_url"], F.lit("")) != "")))
        return F.transform(kept, lambda x: F.when(x["type"] == "text", part("input_text", F.coalesce(x["text"], F.lit("")), none)).otherwise(part("input_image", none, x["image_url"])))

    return F.transform(messages, lambda m: F.struct(F.coalesce(m["role"], F.lit("user")).alias("role"), items(m["content"]).alias("content")))
