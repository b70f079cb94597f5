"""Secret scans with DataFrame functions only.

Base kinds are fixed patterns. The method adds `random` spans: runs of 20 or more token characters that a character
Markov model of random strings explains better than one of ordinary identifiers. Both models are first-order, over the
66 token characters and a start symbol, with add-one smoothing, and are trained from the labelled samples of `samples`
(random: digests in hex, upper-case and base64 form; ordinary: words joined as identifiers and paths). Their log ratio
is kept in thousandths as integers, so scores are exact sums.

Positions come from the texts between matches: split() and regexp_extract_all() see the same matches, so a match starts
at the summed lengths (in code points) of what stands before it. Cheap tests for a match's constant parts go first.

No shuffle; one scan. Cases: null texts are empty; null doc_ids stay; repeated rows give repeated results; an empty
table gives none; other columns are ignored; very long texts cost time in proportion, and the square of the number of
spans found.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET) + 1
#: Mean log ratio in thousandths a character from which a run counts as random.
THRESHOLD = 500
#: Different characters that a random run has at least; rulers of one character are neither random nor ordinary.
DISTINCT = 8

#: Words of the ordinary sample.
WORDS = (
    "get set is has make build read write open close start stop user name value count index table column row batch frame window stream file path "
    "list map key node tree graph edge model train score label text token line word page time date size limit total config default client server "
    "request response handler factory manager buffer offset length width height filter join group order merge split parse format encode decode "
    "load save cache update delete insert select query result error message event state action thread worker pool task job stage plan source sink "
    "international administration documentation implementation responsibility understanding environment development performance organization"
).split()
N_SAMPLES = 3000


def samples(spark: SparkSession) -> DataFrame:
    """The labelled samples: text, random (boolean). Derived from row numbers by digests, so the same everywhere."""
    rows = spark.range(N_SAMPLES).select("id", F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("d"))
    words = F.array(*map(F.lit, WORDS))
    pick = [F.element_at(words, (F.conv(F.substring("d", 1 + 4 * i, 4), 16, 10).cast("int") % len(WORDS)) + 1) for i in range(4)]
    camel = F.concat(pick[0], *map(F.initcap, pick[1:]))
    ordinary = F.array(camel, F.initcap(camel), F.concat_ws("_", *pick), F.upper(F.concat_ws("_", *pick)), F.concat_ws("-", *pick), F.concat_ws("/", *pick), F.concat(*pick))
    random = F.array(F.substring("d", 1, 40), F.upper(F.substring("d", 1, 32)), F.base64(F.unhex("d")))
    return rows.select(F.explode(ordinary).alias("text"), F.lit(False).alias("random")).union(rows.select(F.explode(random).alias("text"), F.lit(True).alias("random")))


def ratios(spark: SparkSession) -> list[int]:
    """Log ratios in thousandths of random over ordinary for each pair of characters, first * SIZE + second."""
    chars = samples(spark).select("random", F.expr(f"transform(split(text, ''), c -> locate(c, '{ALPHABET}'))").alias("c"))
    pairs = chars.select("random", F.explode(F.expr("transform(sequence(0, size(c) - 1), i -> IF(i = 0, 0, c[i - 1]) * 100 + c[i])")).alias("p"))
    n = {(r.p // 100, r.p % 100, r.random): r.n for r in pairs.groupBy("p", "random").agg(F.count("*").alias("n")).collect()}
    return _table(n)


def _table(n: dict[tuple[int, int, bool], int]) -> list[int]:
    out = [0] * (SIZE * SIZE)
    for a in range(SIZE):
        total = {r: sum(n.get((a, b, r), 0) for b in range(1, SIZE)) + SIZE - 1 for r in (True, False)}
        for b in range(1, SIZE):
            p, q = ((n.get((a, b, r), 0) + 1) / total[r] for r in (True, False))
            out[a * SIZE + b] = round(1000 * math.log(p / q))
    return out


def ratios_in_python() -> list[int]:
    """The same table without Spark, for the SQL oracle."""
    n: dict[tuple[int, int, bool], int] = {}

    def add(text: str, random: bool) -> None:
        a = 0
        for c in text:
            b = ALPHABET.index(c) + 1
            n[a, b, random] = n.get((a, b, random), 0) + 1
            a = b

    import base64

    for i in range(N_SAMPLES):
        d = hashlib.sha256(str(i).encode()).hexdigest()
        w = [WORDS[int(d[4 * j : 4 * j + 4], 16) % len(WORDS)] for j in range(4)]
        camel = w[0] + "".join(x.capitalize() for x in w[1:])
        for x in (camel, camel.capitalize(), "_".join(w), "_".join(w).upper(), "-".join(w), "/".join(w), "".join(w)):
            add(x, False)
        for x in (d[:40], d[:32].upper(), base64.b64encode(bytes.fromhex(d)).decode()):
            add(x, True)
    return _table(n)


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(kind: int, pattern: str, keep: str) -> str:
    """SQL for the array of (start, end, kind) of the matches m of a pattern in `text` that meet `keep`."""
    p = _sql(pattern)
    return f"""aggregate(
        zip_with(split(text, {p}, -1), regexp_extract_all(text, {p}, 0), (g, m) -> named_struct('gap', g, 'm', m)),
        named_struct('at', 0, 'out', CAST(array() AS array<struct<s:int,k:int,e:int>>)),
        (a, x) -> named_struct(
            'at', a.at + length(x.gap) + coalesce(length(x.m), 0),
            'out', CASE WHEN x.m IS NOT NULL AND ({keep})
                THEN array_append(a.out, named_struct('s', a.at + length(x.gap), 'k', {kind}, 'e', a.at + length(x.gap) + length(x.m)))
                ELSE a.out END),
        a -> a.out)"""


NONE = "CAST(array() AS array<struct<s:int,k:int,e:int>>)"


def _score(token: str, table: list[int]) -> str:
    values = ",".join(map(str, table))
    return f"""aggregate(
        transform(split({token}, ''), c -> locate(c, '{ALPHABET}')), named_struct('p', 0, 'v', 0),
        (b, c) -> named_struct('p', c, 'v', b.v + CAST(split('{values}', ',') AS array<int>)[b.p * {SIZE} + c]),
        b -> b.v)"""


def scan(docs: DataFrame, table: list[int]) -> DataFrame:
    """doc_id and `spans`, an array of (s, k, e) in order: start, place of the kind in KINDS, end (exclusive), in code points."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    guard = {
        0: " OR ".join(f"contains(lower(text), '{w}')" for w in ("password", "passwd", "secret", "token", "apikey", "api_key")),
        1: "contains(text, 'AKIA')",
        2: f"text RLIKE {_sql('[0-9a-f]{16}')}",
        3: f"text RLIKE {_sql(RUN)}",
    }
    keep = {
        0: f"length(regexp_extract(x.m, {_sql(ASSIGN)}, 2)) >= 12",
        1: "true", 2: "true",
        3: f"size(array_distinct(split(x.m, ''))) >= {DISTINCT} AND {_score('x.m', table)} >= {THRESHOLD} * length(x.m)",
    }
    parts = [f"IF({guard[k]}, {_found(k, p, keep[k])}, {NONE})" for k, p in enumerate((ASSIGN, ACCESS, HEX, RUN))]
    return rows.select("doc_id", F.expr(f"array_sort(concat({', '.join(parts)}))").alias("spans"))


def _joined(spans: str) -> str:
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, x -> concat({kinds}[x.k], ':', x.s, ':', x.e)), ',')"


def op10_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), ratios(spark))
    counts = [F.expr(f"CAST(size(filter(spans, x -> x.k = {i})) AS bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    base = F.sha2(F.expr(_joined("filter(spans, x -> x.k < 3)")).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, F.expr(_joined("spans")).alias("spans"))


def oracle() -> str:
    """DuckDB SQL for op10_markov_secrets."""
    values = ", ".join(map(str, ratios_in_python()))
    q = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for k, (p, keep) in enumerate((
        (ASSIGN, f"length(regexp_extract(m, {q(ASSIGN)}, 2)) >= 12"), (ACCESS, "true"), (HEX, "true"),
        ("[A-Za-z0-9+/_=-]{20,}", f"len(list_distinct(string_split(m, ''))) >= {DISTINCT} AND list_sum(list_transform(range(1, length(m) + 1), lambda i: v[(CASE WHEN i = 1 THEN 0 ELSE instr('{ALPHABET}', m[i - 1]) END) * {SIZE} + instr('{ALPHABET}', m[i]) + 1])) >= {THRESHOLD} * length(m)"),
    )):
        parts.append(f"""SELECT rid, {k} AS k, s, s + length(m) AS e FROM (
            SELECT rid, m, (sum(length(gap)) OVER w + coalesce(sum(length(m)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::bigint AS s
            FROM (SELECT rid, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gaps[: len(ms)]) AS gap
                FROM (SELECT rid, regexp_extract_all(text, {q(p)}) AS ms, string_split_regex(text, {q(p)}) AS gaps FROM docs) WHERE len(ms) > 0)
            WINDOW w AS (PARTITION BY rid ORDER BY i)), model WHERE {keep}""")
    kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    text = f"{kinds}[k + 1] || ':' || s || ':' || e"
    return f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, CAST(doc_id AS bigint) AS doc_id, coalesce(text, '') AS text FROM documents),
        model AS MATERIALIZED (SELECT [{values}] AS v),
        spans AS ({' UNION ALL '.join(parts)}),
        sums AS (SELECT rid, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS c,
            string_agg({text}, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg({text}, ',' ORDER BY s, k) AS spans FROM spans GROUP BY rid)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN sums USING (rid)"""
