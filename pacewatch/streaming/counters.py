"""Counters of an ingest stream as rows: one for each batch that reported them."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, run string, batch long, at string, sent long, positives long, errors long, rate double"


class IngestCounters(StreamingQueryListener):
    """Turns what :func:`pacewatch.sources.events.observe_ingest` observes into appended rows.

    Rows are held until ``flush_rows`` have come or a query ends, then appended under
    ``path``. A batch that is run again after a restart reports again; :func:`read_counters`
    keeps its last report.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "ingest", flush_rows: int = 100):
        super().__init__()
        self.spark, self.path, self.name, self.flush_rows = spark, path, name, flush_rows
        self.pending: list[tuple] = []
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        # A trigger without data reports no counters.
        if seen is None or p.numInputRows == 0:
            return
        seconds = p.batchDuration / 1000
        rate = seen.sent / seconds if seconds > 0 else 0.0
        self.pending.append((str(p.id), str(p.runId), p.batchId, p.timestamp, seen.sent, seen.positives, seen.errors, rate))
        if len(self.pending) >= self.flush_rows:
            self.flush()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.flush()
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def flush(self) -> None:
        rows, self.pending = self.pending, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(self.path)

    def wait(self, run: str, seconds: float = 60) -> bool:
        """Wait until the end of a run was heard of; all its rows are written then."""
        with self.changed:
            return self.changed.wait_for(lambda: run in self.ended, seconds)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch, at, sent, positives, errors, rate), the last report of each batch."""
    rows = spark.read.schema(SCHEMA).json(path)
    last = (F.max_by(name, "at").alias(name) for name in ("at", "sent", "positives", "errors", "rate"))
    return rows.groupBy("query", "batch").agg(*last)
