"""What streams did: a table of starts, batches, ends and errors that a listener writes, and the rule that a stream which
has failed three times in a row does not start again until someone resumes it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.rows import top_rows

#: Failures in a row after which a stream is suspended.
MOST_FAILURES = 3
_TEXT, _LONG = T.StringType(), T.LongType()
EVENTS = T.StructType().add("stream", _TEXT).add("run_id", _TEXT).add("at", T.TimestampType()).add("event", _TEXT).add("batch", _LONG).add("rows", _LONG).add("seconds", T.DoubleType()).add("error", _TEXT)
STARTED, BATCH, SUCCEEDED, FAILED, RESUMED = "STARTED", "BATCH", "SUCCEEDED", "FAILED", "RESUMED"


class Suspended(RuntimeError):
    """The stream has failed too often in a row."""


class _Listener(StreamingQueryListener):
    def __init__(self, history: StreamHistory) -> None:
        self.history, self.names = history, {}

    def onQueryStarted(self, event) -> None:
        if event.name and event.name.startswith(self.history.prefix):
            self.names[str(event.runId)] = event.name
            self.history.add(event.name, STARTED, run_id=str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) in self.names and p.numInputRows:
            self.history.add(self.names[str(p.runId)], BATCH, run_id=str(p.runId), batch=p.batchId, rows=p.numInputRows, seconds=p.batchDuration / 1000)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self.names.pop(str(event.runId), None)
        if name:
            self.history.add(name, FAILED if event.exception else SUCCEEDED, run_id=str(event.runId), error=event.exception)


class StreamHistory:
    """The events of streams whose name starts with prefix, in a folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str, prefix: str = "") -> None:
        self.spark, self.folder, self.prefix = spark, folder, prefix

    def add(self, stream: str, event: str, *, run_id: str | None = None, batch: int | None = None, rows: int | None = None, seconds: float | None = None, error: str | None = None) -> None:
        row = (stream, run_id, dt.datetime.now(), event, batch, rows, seconds, error)
        self.spark.createDataFrame([row], EVENTS).coalesce(1).write.mode("append").parquet(self.folder)

    @contextmanager
    def watching(self) -> Iterator[StreamHistory]:
        """Streams that start and end inside are recorded; events still on their way at the end are waited for."""
        listener = _Listener(self)
        self.spark.streams.addListener(listener)
        try:
            yield self
        finally:
            self._settle()
            self.spark.streams.removeListener(listener)

    def _settle(self) -> None:
        """Events come some time after what they tell of: wait for those of all queries that have ended."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def events(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).parquet(self.folder)

    def check(self, stream: str) -> None:
        """Raise Suspended where the stream has failed MOST_FAILURES times since it last ended well or was resumed."""
        self._settle()
        row = failures_in_a_row(self.events().where(F.col("stream") == stream)).first()
        if row is not None and row.failures_in_a_row >= MOST_FAILURES:
            raise Suspended(f"{stream} has failed {row.failures_in_a_row} times in a row, last with: {row.last_error}")

    def resume(self, stream: str) -> None:
        self.add(stream, RESUMED)


def failures_in_a_row(events: DataFrame) -> DataFrame:
    """(stream, failures_in_a_row, last_error): failures since the last end without one, or since the stream was resumed."""
    ends = events.where(F.col("event").isin(SUCCEEDED, FAILED, RESUMED))
    good = F.max(F.when(F.col("event") != FAILED, F.col("at"))).over(W.Window.partitionBy("stream"))
    since = ends.withColumn("_good", good)
    recent = (F.col("event") == FAILED) & (F.col("_good").isNull() | (F.col("at") > F.col("_good")))
    return since.groupBy("stream").agg(F.count_if(recent).alias("failures_in_a_row"), F.max_by(F.when(recent, F.col("error")), F.when(recent, F.col("at"))).alias("last_error"))


def runs(events: DataFrame) -> DataFrame:
    """(stream, run_id, started_at, ended_at, state, batches, rows, seconds): one row per run; state is RUNNING until it ends."""
    of = lambda which, c: F.max(F.when(F.col("event").isin(*which), F.col(c)))
    done = (SUCCEEDED, FAILED)
    return events.where(F.col("run_id").isNotNull()).groupBy("stream", "run_id").agg(
        of((STARTED,), "at").alias("started_at"), of(done, "at").alias("ended_at"), F.coalesce(of(done, "event"), F.lit("RUNNING")).alias("state"), F.count_if(F.col("event") == BATCH).alias("batches"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.sum("seconds").alias("seconds"),
    )


def stream_summary(events: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Of the runs of the last hours, per stream: runs, failures, rows, mean_seconds of the runs that did something, and
    whether the stream is suspended, which rests on all events."""
    recent = runs(events).where(F.col("started_at") >= now - F.expr(f"interval {hours} hours"))
    out = recent.groupBy("stream").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("state") == FAILED).alias("failures"), F.sum("rows").alias("rows"), F.round(F.avg("seconds"), 3).alias("mean_seconds"))
    state = failures_in_a_row(events).select("stream", "failures_in_a_row", (F.col("failures_in_a_row") >= MOST_FAILURES).alias("suspended"))
    return out.join(state, "stream", "left").fillna({"failures_in_a_row": 0, "suspended": False})


def last_errors(events: DataFrame) -> DataFrame:
    """(stream, at, error) of the latest failure of each stream."""
    return top_rows(events.where(F.col("event") == FAILED), ["stream"], [F.col("at").desc()]).select("stream", "at", "error")
