"""Submission state: a stream that is stopped and goes on gives the rows of the table, whatever the micro-batches."""

import time
from datetime import datetime, timedelta

import pytest

from framelake.plans import inputs
from framelake.streaming import submissions

EVENT = "work long, at timestamp, kind string, batch string, status string"


def plain(rows, window, end):
    """One event after the other."""
    out, state = [], {}
    for w, at, kind, batch, status in sorted(rows, key=lambda r: (r[1], r[0])):
        now = state.get(w)
        if now and at >= now[1] + window:
            out.append((w, now[0], "expired", now[1] + window, now[2]))
            now = state[w] = None
        if kind == "submit":
            state[w] = (batch, at, 0)
        elif kind == "clear":
            state[w] = None
        elif not now:
            out.append((w, None, "error", at, 0))
        elif status in ("completed", "failed", "expired", "cancelled"):
            out.append((w, now[0], status, at, now[2] + 1))
            state[w] = None
        else:
            state[w] = (now[0], now[1], now[2] + 1)
    out += [(w, s[0], "expired", s[1] + window, s[2]) for w, s in state.items() if s and s[1] + window <= end]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return inputs.submissions_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def found(df):
    return sorted(((r.work, r.batch, r.status, r["at"], r.polls) for r in df.collect()), key=repr)


def test_table(spark, events):
    millis = lambda t: t.replace(microsecond=t.microsecond // 1000 * 1000)
    rows = [(r.work, millis(r["at"]), r.kind, r.batch, r.status) for r in events.collect()]
    got = found(submissions.table(events, inputs.PATIENCE))
    assert got == plain(rows, timedelta(seconds=inputs.PATIENCE), max(r[1] for r in rows))
    assert {r[2] for r in got} == {"error", "completed", "failed", "expired"}
    assert submissions.table(events.limit(0)).count() == 0


def test_stream_goes_on_after_a_stop(spark, events, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rows = sorted(events.collect(), key=lambda r: r["at"])
        rows.append((-1, datetime(2030, 1, 1), "clear", None, None))  # moves the watermark past all
        for i in range(4):
            part = rows[i * len(rows) // 4 : (i + 1) * len(rows) // 4]
            spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            time.sleep(1.1)  # files are taken by their time

        def start(**once):
            source = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            out = submissions.stream(source, inputs.PATIENCE).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
            return (out.trigger(**once) if once else out).start()

        q = start()
        end = time.monotonic() + 60
        while (q.lastProgress is None or q.lastProgress["batchId"] < 1) and time.monotonic() < end:
            time.sleep(0.1)
        q.stop()
        start(availableNow=True).awaitTermination(120)
        assert found(spark.read.parquet(str(tmp_path / "out"))) == found(submissions.table(spark.createDataFrame(rows, EVENT), inputs.PATIENCE))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_what_happens_at_the_end_of_the_wait(spark):
    t = datetime(2024, 1, 1)
    at = lambda s: t + timedelta(seconds=s)
    rows = [(1, at(0), "submit", "a", None), (1, at(10), "poll", None, "completed"), (2, at(0), "submit", "b", None), (2, at(9), "poll", None, "completed"), (3, at(0), "submit", "c", None), (3, at(5), "submit", "d", None), (3, at(14), "poll", None, "in_progress"), (4, at(0), "submit", "e", None), (4, at(1), "clear", None, None), (4, at(2), "poll", None, "failed"), (5, at(20), "poll", None, "expired")]
    got = found(submissions.table(spark.createDataFrame(rows, EVENT), 10))
    assert got == plain(rows, timedelta(seconds=10), at(20))
    assert {r[2] for r in got if r[0] == 1} == {"error", "expired"}
