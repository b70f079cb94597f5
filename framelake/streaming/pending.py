"""Streams: pending requests that later answers complete, and counts over sliding windows of event time.

The same functions work on a batch, which is what the tests compare a stream with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_answers(requests: DataFrame, answers: DataFrame, wait: str = "1 day") -> DataFrame:
    """Requests (custom_id, asked timestamp) joined with answers (answer_id, text, answered timestamp) within `wait`.

    On streams both sides have a watermark, so the state holds what is at most `wait` old; unanswered requests come out
    with null text once the watermark has passed (left outer join).
    """
    if requests.isStreaming:
        requests = requests.withWatermark("asked", wait)
    if answers.isStreaming:
        answers = answers.withWatermark("answered", wait)
    on = F.expr(f"custom_id = answer_id AND answered >= asked AND answered <= asked + INTERVAL {wait}")
    return requests.join(answers, on, "left").select("custom_id", "asked", "text", F.when(F.col("text").isNull(), "pending").otherwise("ok").alias("status"))


def hopping_counts(events: DataFrame, size: str = "10 minutes", step: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Events (ts, event_type, value) by sliding window and type."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    return events.groupBy(F.window("ts", size, step), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select("window.start", "window.end", "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "2 minutes", late: str = "10 minutes") -> DataFrame:
    """Chains of a user's events with no gap of `gap` or more: the streaming form of chain clustering."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    return events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("session_window.start", "session_window.end", "user_id", "n")
