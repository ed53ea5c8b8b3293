"""Pipeline event log for streams: a ``StreamingQueryListener``.

The source pipeline printed start/end lines on the driver when a plan was
*built*.  Here Spark itself reports what ran: every started, progressed and
terminated stream is recorded (query name, batch id, input rows, durations,
error), and ``events()`` returns the records so a job can persist them as a
table or ship them to monitoring.
"""

from __future__ import annotations

import datetime as _dt
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class PipelineEvents(StreamingQueryListener):
    """Collects stream lifecycle and progress events in driver memory
    (one small record per micro-batch)."""

    def __init__(self):
        super().__init__()
        self._lock = threading.Lock()
        self._events: list[dict] = []

    def _add(self, **rec):
        rec["logged_at"] = _dt.datetime.now(_dt.timezone.utc).isoformat()
        with self._lock:
            self._events.append(rec)

    def onQueryStarted(self, event):
        self._add(event_type="START", query=event.name or str(event.id), status="RUNNING")

    def onQueryProgress(self, event):
        p = event.progress
        self._add(event_type="PROGRESS", query=p.name or str(p.id), status="RUNNING",
                  batch_id=p.batchId, input_rows=p.numInputRows,
                  duration_ms=(p.durationMs or {}).get("triggerExecution"))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._add(event_type="END", query=str(event.id),
                  status="FAILED" if event.exception else "SUCCESS",
                  message=event.exception or "")

    def events(self) -> list[dict]:
        with self._lock:
            return list(self._events)


def attach(spark: SparkSession) -> PipelineEvents:
    """Register a fresh event collector on the session's stream manager."""
    listener = PipelineEvents()
    spark.streams.addListener(listener)
    return listener


def detach(spark: SparkSession, listener: PipelineEvents) -> None:
    spark.streams.removeListener(listener)
