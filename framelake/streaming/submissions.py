"""Submitted batches as state: submit, poll, done, failed, expired, cleared.

Events: work, at (timestamp), kind (submit, poll or clear), batch, status (of a poll). A work's events come in the order of
`at`. A submission is pending until a poll finds it in a final state, until it is cleared, until the work is submitted
anew, or until `window` has passed. Rows come out for polls with a final state, for polls of a work with nothing pending
(status error), and for submissions that expire.

`stream` keeps one small state a work and an event-time timer for its expiry; `table` gives the same rows of a whole
table, by windows. What happens at or after a submission's expiry finds it expired, so rows don't depend on how events
are dealt to micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framelake.sources.batches import FINAL

OUT = "work long, batch string, status string, at timestamp, polls long"
NO_STATE = "error"


class _Submissions(StatefulProcessor):
    def __init__(self, window_ms: int):
        self.window = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("pending", "batch string, submitted long, polls long")

    def _forget(self, submitted: int) -> None:
        self.state.clear()
        self.handle.deleteTimer(submitted + self.window)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        (work,) = key
        for r in sorted(rows, key=lambda r: r.ms):
            now = self.state.get() if self.state.exists() else None
            if now is not None and r.ms >= now[1] + self.window:
                yield self._row(work, now[0], "expired", now[1] + self.window, now[2])
                self._forget(now[1])
                now = None
            if r.kind == "submit":
                if now is not None:
                    self._forget(now[1])
                self.state.update((r.batch, r.ms, 0))
                self.handle.registerTimer(r.ms + self.window)
            elif r.kind == "clear":
                if now is not None:
                    self._forget(now[1])
            elif now is None:
                yield self._row(work, None, NO_STATE, r.ms, 0)
            elif r.status in FINAL:
                yield self._row(work, now[0], r.status, r.ms, now[2] + 1)
                self._forget(now[1])
            else:
                self.state.update((now[0], now[1], now[2] + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = self.state.get() if self.state.exists() else None
        if now is not None and now[1] + self.window <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._row(key[0], now[0], "expired", now[1] + self.window, now[2])
            self.state.clear()

    def close(self) -> None:
        pass

    def _row(self, work, batch, status, ms, polls) -> Row:
        return Row(work=work, batch=batch, status=status, ms=ms, polls=polls)


def stream(events: DataFrame, window_sec: int = 86400, late: str = "0 seconds") -> DataFrame:
    """OUT rows of a stream of events. Needs the RocksDB state store."""
    rows = events.withWatermark("at", late).select("work", "at", F.unix_millis("at").alias("ms"), "kind", "batch", "status")
    got = rows.groupBy("work").transformWithState(_Submissions(window_sec * 1000), "work long, batch string, status string, ms long, polls long", "Append", "EventTime")
    return got.select("work", "batch", "status", F.timestamp_millis("ms").alias("at"), "polls")


def table(events: DataFrame, window_sec: int = 86400) -> DataFrame:
    """OUT rows of a whole table; what is pending at the last event of all has expired if its window is over by then."""
    e = events.select("work", F.unix_millis("at").alias("ms"), "kind", "batch", "status")
    wide = window_sec * 1000
    order = Window.partitionBy("work").orderBy("ms")
    e = e.withColumn("sub", F.sum(F.when(F.col("kind") == "submit", 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy("work", "sub").orderBy("ms")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    final = (F.col("kind") == "poll") & F.col("status").isin(*FINAL)
    e = e.withColumns({
        "submitted": F.when(F.col("sub") > 0, F.min("ms").over(Window.partitionBy("work", "sub"))),
        "name": F.when(F.col("sub") > 0, F.first("batch").over(own)),
        "ended": F.coalesce(F.max(F.when(final | (F.col("kind") == "clear"), 1)).over(before), F.lit(0)),
        "polls": F.count(F.when(F.col("kind") == "poll", 1)).over(own.rowsBetween(Window.unboundedPreceding, 0)),
    })
    alive = (F.col("sub") > 0) & (F.col("ended") == 0) & (F.col("ms") < F.col("submitted") + wide)
    polls = e.where("kind = 'poll'").withColumn("alive", alive)
    done = polls.where(F.col("alive") & final).select("work", F.col("name").alias("batch"), "status", "ms", "polls")
    lost = polls.where(~F.col("alive")).select("work", F.lit(None).cast("string").alias("batch"), F.lit(NO_STATE).alias("status"), "ms", F.lit(0).cast("long").alias("polls"))
    over = F.col("submitted") + wide
    inside = F.col("ms") < over
    subs = e.where("sub > 0").groupBy("work", "sub", "submitted").agg(F.first("name").alias("batch"), F.max(F.when(inside & (final | (F.col("kind") == "clear")), 1)).alias("closed"), F.count(F.when(inside & (F.col("kind") == "poll"), 1)).alias("polls"))
    subs = subs.withColumn("next", F.lead("submitted").over(Window.partitionBy("work").orderBy("sub")))
    end = e.agg(F.max("ms").alias("end"))  # one row
    expired = subs.crossJoin(F.broadcast(end)).where(F.col("closed").isNull() & (F.coalesce("next", "end") >= over)).select("work", "batch", F.lit("expired").alias("status"), over.alias("ms"), "polls")
    return done.union(lost).union(expired).select("work", "batch", "status", F.timestamp_millis("ms").alias("at"), "polls")
