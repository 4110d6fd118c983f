"""Stream of topic messages appended to the raw table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pacewatch.schema import TOPIC_SCHEMA
from pacewatch.sources.events import decode_events

# First start reads the whole topic; offsets lost to retention do not stop the query.
TOPIC_READ_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
QUERY_NAME = "bronze_transactions_ingest"


def read_events_stream(
    spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Messages of a topic, or of files that hold the same columns."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.options(**TOPIC_READ_OPTIONS)
    else:
        reader = reader.schema(TOPIC_SCHEMA)
    return reader.options(**(options or {})).load()


def trigger(mode: str, interval: str) -> dict[str, object]:
    """``once`` drains what is there and stops; ``continuous`` polls at an interval."""
    if mode == "once":
        return {"availableNow": True}
    if mode == "continuous":
        return {"processingTime": interval}
    raise ValueError("mode is 'once' or 'continuous'")


def start_bronze(
    events: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    mode: str = "continuous",
    interval: str = "10 seconds",
    fmt: str = "parquet",
    query_name: str = QUERY_NAME,
) -> StreamingQuery:
    """Append decoded events to files or to a named table; restarts resume."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    writer = (
        events.writeStream.format(fmt)
        .outputMode("append")
        .queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(mode, interval))
    )
    return writer.toTable(table) if table else writer.start(path)


def run_batches(query: StreamingQuery, feed: Iterable[Callable[[], None]], seconds: float = 600) -> int:
    """Drive a stream that polls at an interval: feed it step by step, let each be taken in, then stop.

    Each step of ``feed`` puts messages where the stream finds them; the next one waits until
    progress shows that all there is was taken in, so every step is a batch or more. The
    stream is stopped between two batches. Returns the number of batches with rows. Raises
    ``TimeoutError`` if a step is not taken in within ``seconds``, and the stream's own error.
    """
    for step in feed:
        before = _batches(query)
        step()
        until = time.monotonic() + seconds
        while _batches(query) == before or query.status["isDataAvailable"] or query.status["isTriggerActive"]:
            if query.exception() is not None:
                raise query.exception()
            if time.monotonic() > until:
                query.stop()
                raise TimeoutError(f"no batch within {seconds} s")
            time.sleep(0.05)
    query.stop()
    return _batches(query)


def _batches(query: StreamingQuery) -> int:
    return len({p.batchId for p in query.recentProgress if p.numInputRows})


def bronze_stream(
    spark: SparkSession,
    topic: str,
    checkpoint: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    **sink,
) -> StreamingQuery:
    """Topic -> decoded events -> raw table. ``sink`` goes to :func:`start_bronze`."""
    topic_options = {"subscribe": topic} if fmt == "kafka" else {}
    messages = read_events_stream(spark, fmt, {**topic_options, **(options or {})})
    return start_bronze(decode_events(messages, topic), checkpoint, **sink)
