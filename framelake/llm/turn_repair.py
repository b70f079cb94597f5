"""Conversation structure repair: the cheapest edits that give roles a legal order, found on a DAG of tight arcs.

Nodes are (rows read, state of the role pattern `(s?(ua)+)?`); arcs are edits: Keep a row, Rerole it, Delete it, Insert an
empty one. Forward and backward minimum costs tell which arcs are tight, that is, on a cheapest path. A frontier of nodes
then walks from the start and takes, at each step, the least edit letter on a tight arc out of it; the letters are the
audit.

1. Equal rows of a conversation are counted, so that repeats make one row with a number; a row's first place in its
   conversation comes by `spread.facts`.
2. Rows are sorted by conversation, turn, role and text over range partitions. A conversation may span many of these.
3. Each task walks its sorted rows. Conversations inside it are solved at once. The first and the last of a task, and those
   over BLOCK rows, are cut into blocks; a block's costs from state to state are a 4 x 4 matrix of the (min, +) algebra.
4. The matrices of a conversation's pieces, at most one a partition, are multiplied from both ends, which gives each block
   the forward costs at its start and the backward costs at its end. Blocks are then walked side by side, for each state in
   which a cheapest path may enter.
5. A last pass goes through a conversation's blocks in their order, follows the states, and puts letters and hash together.
   It streams: SHA-256 is sequential, so one task passes a conversation's repaired text block by block, and holds one block.

Damage (`damaged`) is part of the query; `repair` takes any conversations.

Cases: null role or text counts as one space, a null turn comes before all others, rows with a null conv_id are one
conversation. Rows of one turn are taken by role and text, a repeat next to its row. A role without letters has no
initial, and can't be kept. Every conv_id of the input is returned, those without rows with zeros, an empty audit and the
hash of nothing. A gap count that a long can't hold is null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import spread

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
BLOCK, BYTES = 4096, 2 << 20
FAR = 1 << 60
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after s, after u, after a. A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = range(4), (START, ASSISTANT)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: What an inserted or reroled row becomes in a state.
BECOMES = {q: "assistant" if q == USER else "user" for q in STATES}
KEYS = ["known", "conv"]


def arcs(initial: str, forced: bool, cut: bool) -> list[tuple[int, int, int, str]]:
    """Edits of a row: from state, to state, cost, letter."""
    out = [(q, q, DELETE, "D") for q in STATES]
    if not forced:
        more = TRUNCATED if cut else 0
        out += [(q, NEXT[q, initial], more, "K") for q in STATES if (q, initial) in NEXT]
        out += [(q, NEXT[q, BECOMES[q][0]], REROLE + more, "R") for q in STATES]
    return out


INSERTS = [(q, NEXT[q, BECOMES[q][0]], INSERT, "I") for q in (START, SYSTEM, ASSISTANT, USER)]
ARCS = {(i, f, c): arcs(i, f, c) for i in ("s", "u", "a", "") for f in (False, True) for c in (False, True)}


def ahead(costs: list[int]) -> list[int]:
    """Forward costs with the inserts that may follow."""
    out = list(costs)
    for q, r, c, _ in INSERTS:
        out[r] = min(out[r], out[q] + c)
    return out


def behind(costs: list[int]) -> list[int]:
    """Backward costs with the inserts that may come first."""
    out = list(costs)
    for q, r, c, _ in reversed(INSERTS):
        out[q] = min(out[q], out[r] + c)
    for q, r, c, _ in reversed(INSERTS):
        out[q] = min(out[q], out[r] + c)
    return out


def forward(rows: list[tuple], costs: list[int]) -> list[list[int]]:
    out = [costs]
    for key in rows:
        got = [FAR] * 4
        for q, r, c, _ in ARCS[key]:
            got[r] = min(got[r], costs[q] + c)
        costs = ahead(got)
        out.append(costs)
    return out


def backward(rows: list[tuple], costs: list[int]) -> list[list[int]]:
    out = [costs]
    for key in reversed(rows):
        got = [FAR] * 4
        for q, r, c, _ in ARCS[key]:
            got[q] = min(got[q], costs[r] + c)
        costs = behind(got)
        out.append(costs)
    return out[::-1]


FIRST = ahead([0, FAR, FAR, FAR])
LAST = behind([0 if q in ENDS else FAR for q in STATES])


def matrix(rows: list[tuple]) -> list[list[int]]:
    """Costs through a block, from each state to each."""
    return [forward(rows, ahead([0 if q == p else FAR for q in STATES]))[-1] for p in STATES]


def product(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    return [[min(FAR, *(a[p][k] + b[k][q] for k in STATES)) for q in STATES] for p in STATES]


def walk(rows: list[tuple], fore: list[list[int]], back: list[list[int]], state: int, final: bool) -> tuple[str, list[int], int]:
    """Letters from (0, state) through all rows, the state before each letter, and the last state.

    A frontier of nodes: all have read the same rows, as each letter but I reads one. The least letter on a tight arc is taken.
    """
    total = min(f + b for f, b in zip(fore[0], back[0], strict=True))
    n, i, frontier = len(rows), 0, {state}
    letters: list[str] = []
    states: list[int] = []
    while i < n or final:
        here = [(letter, q, r) for q, r, c, letter in INSERTS if q in frontier and fore[i][q] + c + back[i][r] == total]
        if i < n:
            here += [(letter, q, r) for q, r, c, letter in ARCS[rows[i]] if q in frontier and fore[i][q] + c + back[i + 1][r] == total]
        if not here:
            break
        least = min(here)[0]
        states.append(min(q for letter, q, _ in here if letter == least))
        frontier = {r for letter, _, r in here if letter == least}
        letters.append(least)
        i += least != "I"
    return "".join(letters), states, min(frontier)


def rendered(rows: list[tuple[str | None, str | None]], letters: str, states: list[int]) -> list[str]:
    """`role:text` of what the edits leave of rows (role, text)."""
    out, i = [], 0
    for letter, q in zip(letters, states, strict=True):
        if letter == "I":
            out.append(f"{BECOMES[q]}:")
            continue
        role, text = rows[i]
        i += 1
        if letter != "D":
            out.append(f"{role if letter == 'K' else BECOMES[q]}:{text}")
    return out


class Block:
    """Rows of one conversation in their order, and what is counted of them."""

    def __init__(self):
        self.keys: list[tuple] = []
        self.rows: list[tuple[str | None, str | None]] = []
        self.size = self.blank = self.duplicate = self.truncated = 0

    def add(self, role: str, text: str, again: bool) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        seen = text.strip(SPACE)
        blank = not seen
        forced = blank or again
        cut = not forced and seen[-1] not in ".!?"
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut
        self.keys.append((initial, forced, cut))
        self.rows.append((role, None if forced else text))
        self.size += len(role) + (0 if forced else len(text))

    @property
    def illegal(self) -> int:
        return sum((a[0], b[0]) not in LEGAL for a, b in zip(self.keys, self.keys[1:], strict=False))


DONE = "audit string, cost long, blank long, duplicate long, truncated long, illegal long, repaired_sha256 string"
SWEPT = f"known int, conv long, {DONE}, piece int, place int, initials array<string>, forced array<boolean>, cut array<boolean>, roles array<string>, texts array<string>, through array<long>"


def solved(b: Block) -> dict:
    fore, back = forward(b.keys, FIRST), backward(b.keys, LAST)
    letters, states, _ = walk(b.keys, fore, back, START, True)
    text = "\n".join(rendered(b.rows, letters, states))
    return {"audit": letters, "cost": back[0][START], "blank": b.blank, "duplicate": b.duplicate, "truncated": b.truncated, "illegal": b.illegal, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kind = lambda t: pa.list_(kinds[t[6:-1]]) if t.startswith("array<") else kinds[t]
    return pa.schema([(c.split()[0], kind(c.split()[1])) for c in ddl.split(", ")])


def sweep(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """SWEPT rows of sorted partitions (known, conv, role, text, copies, again): results of conversations that lie in one,
    and blocks (`piece` not null) of those that may not."""
    schema = _arrow(SWEPT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        now, first, opened, place = None, True, False, 0
        b = Block()
        ready: list[dict] = []

        def cut() -> dict:
            nonlocal b, place, opened
            out = {
                "known": now[0], "conv": now[1], "blank": b.blank, "duplicate": b.duplicate, "truncated": b.truncated, "illegal": b.illegal, "piece": piece, "place": place, "initials": [k[0] for k in b.keys], "forced": [k[1] for k in b.keys],
                "cut": [k[2] for k in b.keys], "roles": [r for r, _ in b.rows], "texts": [t for _, t in b.rows], "through": [c for r in matrix(b.keys) for c in r],
            }
            b, place, opened = Block(), place + 1, True
            return out

        def end(last: bool) -> Iterator[dict]:
            if now is not None and b.keys:
                yield cut() if first or last or opened else {"known": now[0], "conv": now[1], **solved(b)}

        for batch in batches:
            for known, conv, role, text, copies, again in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (known, conv) != now:
                    ready += end(False)
                    first = now is None
                    now, b, opened, place = (known, conv), Block(), False, 0
                for i in range(copies):
                    b.add(role, text, again or i > 0)
                    if len(b.keys) >= block or b.size >= BYTES:
                        yield _batch([cut()], schema)
            if ready:
                yield _batch(ready, schema)
                ready = []
        ready += end(True)
        if ready:
            yield _batch(ready, schema)

    return rows.select("known", "conv", "role", "text", "copies", "again").mapInArrow(run, SWEPT)


def _square(flat) -> list[list[int]]:
    return [[int(x) for x in flat[4 * i : 4 * i + 4]] for i in STATES]


def pieces(blocks: DataFrame) -> DataFrame:
    """known, conv, piece, and `through`: its blocks' matrices in order. A piece is of one partition."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct("place", "through"))), lambda x: x["through"])
    return blocks.groupBy("known", "conv", "piece").agg(listed.alias("through"))


def vectors(parts: DataFrame) -> DataFrame:
    """known, conv, piece, place, fore (costs at the block's start), back (costs at its end), final (the conversation's last)."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for all_ in batch.column(3):
                m = None
                for flat in all_.as_py():
                    m = _square(flat) if m is None else product(m, _square(flat))
                out.append([c for r in m for c in r])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int64()))], ["known", "conv", "piece", "through"])

    def both(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of a conversation's pieces, at most one a partition, from both ends."""
        pdf = pdf.sort_values("piece")
        steps = [_square(x) for x in pdf["through"]]
        fore, back = [FIRST], [LAST]
        for m in steps[:-1]:
            fore.append([min(fore[-1][p] + m[p][q] for p in STATES) for q in STATES])
        for m in steps[:0:-1]:
            back.append([min(m[p][q] + back[-1][q] for q in STATES) for p in STATES])
        return pd.DataFrame({"known": pdf["known"], "conv": pdf["conv"], "piece": pdf["piece"], "fore": fore, "back": back[::-1], "final": [False] * (len(steps) - 1) + [True]})

    small = parts.mapInArrow(shrink, "known int, conv long, piece int, through array<long>")
    ends = small.groupBy("known", "conv").applyInPandas(both, "known int, conv long, piece int, fore array<long>, back array<long>, final boolean")

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow("known int, conv long, piece int, place int, fore array<long>, back array<long>, final boolean")
        for batch in batches:
            for r in batch.to_pylist():
                steps = [_square(x) for x in r["through"]]
                fore, back = [r["fore"]], [r["back"]]
                for m in steps[:-1]:
                    fore.append([min(fore[-1][p] + m[p][q] for p in STATES) for q in STATES])
                for m in steps[:0:-1]:
                    back.append([min(m[p][q] + back[-1][q] for q in STATES) for p in STATES])
                yield _batch([{"known": r["known"], "conv": r["conv"], "piece": r["piece"], "place": i, "fore": f, "back": b, "final": r["final"] and i + 1 == len(steps)} for i, (f, b) in enumerate(zip(fore, back[::-1], strict=True))], schema)

    return parts.join(ends.hint("shuffle_hash"), [*KEYS, "piece"]).select(*KEYS, "piece", "through", "fore", "back", "final").mapInArrow(spread_out, "known int, conv long, piece int, place int, fore array<long>, back array<long>, final boolean")


TRACED = "known int, conv long, piece int, place int, blank long, duplicate long, truncated long, illegal long, first string, last string, cost long, starts array<int>, ends array<int>, audits array<string>, any array<boolean>, texts array<string>"


def trace(blocks: DataFrame, block_vectors: DataFrame) -> DataFrame:
    """TRACED rows: a block's letters and repaired text for each state in which a cheapest path may enter it."""
    schema = _arrow(TRACED)
    met = blocks.join(block_vectors.hint("shuffle_hash"), [*KEYS, "piece", "place"])
    names = [*KEYS, "piece", "place", "blank", "duplicate", "truncated", "illegal", "initials", "forced", "cut", "roles", "texts", "fore", "back", "final"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                r = batch.slice(i, 1).to_pylist()[0]
                keys = list(zip(r["initials"], r["forced"], r["cut"], strict=True))
                rows = list(zip(r["roles"], r["texts"], strict=True))
                fore, back = forward(keys, r["fore"]), backward(keys, r["back"])
                total = min(f + b for f, b in zip(fore[0], back[0], strict=True))
                out = {k: r[k] for k in names[:8]} | {"first": keys[0][0], "last": keys[-1][0], "cost": total, "starts": [], "ends": [], "audits": [], "any": [], "texts": []}
                for q in STATES:
                    if fore[0][q] + back[0][q] == total:
                        letters, states, end = walk(keys, fore, back, q, r["final"])
                        lines = rendered(rows, letters, states)
                        for k, v in (("starts", q), ("ends", end), ("audits", letters), ("any", bool(lines)), ("texts", "\n".join(lines))):
                            out[k].append(v)
                yield _batch([out], schema)

    return met.select(*names).mapInArrow(run, TRACED)


def assemble(traced: DataFrame) -> DataFrame:
    """Results of the conversations in blocks, one at a time, a block at a time."""
    ddl = f"known int, conv long, {DONE}"
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None

        def done() -> pa.RecordBatch:
            return _batch([{k: now[k] for k in ("known", "conv", "cost", "blank", "duplicate", "truncated", "illegal")} | {"audit": "".join(now["letters"]), "repaired_sha256": now["hash"].hexdigest()}], schema)

        for batch in batches:
            for r in batch.to_pylist():
                if now is None or (r["known"], r["conv"]) != (now["known"], now["conv"]):
                    if now is not None:
                        yield done()
                    now = {"known": r["known"], "conv": r["conv"], "cost": r["cost"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "letters": [], "hash": hashlib.sha256(), "state": START, "last": None, "any": False}
                for k in ("blank", "duplicate", "truncated", "illegal"):
                    now[k] += r[k]
                now["illegal"] += now["last"] is not None and (now["last"], r["first"]) not in LEGAL
                i = r["starts"].index(now["state"])
                now["letters"].append(r["audits"][i])
                if r["any"][i]:
                    now["hash"].update((("\n" if now["any"] else "") + r["texts"][i]).encode())
                    now["any"] = True
                now["state"], now["last"] = r["ends"][i], r["last"]
        if now is not None:
            yield done()

    return traced.repartition(*KEYS).sortWithinPartitions(*KEYS, "piece", "place").mapInArrow(run, ddl)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with `copies` (0: dropped), by the checksum of conversation and turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("kind"))
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of (conv_id,
    turn, role, text, and optionally `copies`, how often the row stands there)."""
    spark = conversations.sparkSession
    spread.small_batches(spark)
    copies = F.col("copies").cast("long") if "copies" in conversations.columns else F.lit(1).cast("long")
    rows = conversations.select(
        F.col("conv_id").isNotNull().cast("int").alias("known"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"),
    )
    there = F.when(F.col("copies") > 0, F.col("turn"))
    wide = lambda c: c.cast("decimal(20,0)")
    gaps = (wide(F.max(there)) - wide(F.min(there)) + 1 - F.count_distinct(there)).try_cast("long")
    ids = rows.groupBy(*KEYS).agg(F.when(F.count(there) > 0, gaps).otherwise(0).alias("gaps"))
    timed = F.struct(F.col("turn").isNotNull().alias("timed"), F.coalesce("turn", F.lit(0)).alias("turn"))
    one = rows.where("copies > 0").groupBy(*KEYS, timed.alias("at"), "role", "text").agg(F.sum("copies").alias("copies"))
    one = spread.stash(one.withColumns({"mark": F.xxhash64("role", "text"), "mark2": F.xxhash64(F.lit(1), "text", "role")}))
    key = [*KEYS, "mark", "mark2"]
    twice = spread.stash(one.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at")).where("n > 1"))
    told = spread.facts(one, twice, key, "n", "first_at").withColumn("again", F.coalesce(F.col("at") > F.col("first_at"), F.lit(False)))
    order = [*KEYS, "at", "role"]
    dealt = told.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    swept = spread.stash(sweep(dealt, block))
    blocks = swept.where("piece IS NOT NULL")
    traced = trace(blocks, spread.stash(vectors(spread.stash(pieces(blocks)))))
    done = [c.split()[0] for c in DONE.split(", ")]
    results = swept.where("piece IS NULL").select(*KEYS, *done).unionByName(assemble(traced))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return ids.join(results, KEYS, "left").select(
        F.when(F.col("known") == 1, F.col("conv")).alias("conv_id"), "gaps", *(zero(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_tight_arcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
