"""Captures as streaming queries: start, throttle, replay, stop, counters, sinks."""

from __future__ import annotations

import contextlib
import logging
import os
import tempfile
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from traceframe.operators.manifest import local_table
from traceframe.operators.sinks import format_event, to_console
from traceframe.streaming import files
from traceframe.streaming.callback import Delivery

logger = logging.getLogger(__name__)


def shared_folder(spark: SparkSession, purpose: str, name: str | None = None) -> str:
    """A folder that all executors can reach: a new one, or always the same for a ``name``.

    It lies under ``spark.checkpoint.dir``. Only on a local master, as in tests, may that be
    unset; then a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), f"traceframe-{spark.sparkContext.applicationId}")
    return os.path.join(base, f"{purpose}-{name or uuid.uuid4()}")


def with_dead_letters(fn: Callable[[DataFrame, int], None], path: str):
    """A batch function whose failing batches are kept under ``path`` and do not end the capture.

    Each such batch is stored whole, as ``batch=<id>``, with the error logged. What cannot
    even be stored, as when decoding itself fails, does end it.
    """

    def call(batch: DataFrame, batch_id: int) -> None:
        try:
            fn(batch, batch_id)
        except Exception:
            logger.exception("batch %d goes to %s", batch_id, path)
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return call


def observed(df: DataFrame) -> DataFrame:
    """Count rows and errors of a decoded stream as it runs."""
    return df.observe(
        "trace",
        F.count(F.lit(1)).alias("events"),
        F.count_if("record_parse_error").alias("record_errors"),
        F.count_if("field_parse_error").alias("field_errors"),
    )


class Capture:
    """A capture session over a stream of raw records.

    ``transform`` turns raw records into events (a :class:`~traceframe.plans.trace.Trace`,
    or any function of a frame, which then replaces the built-in chain). ``on_batch``
    gets every micro-batch of events. ``batch_filter`` runs first in each micro-batch, on
    raw records, for rules that may change meanwhile (:func:`~traceframe.streaming.rules.live_rules`
    keeps to one version of them when a batch is run again).

    A running query of the same name is reused as it is, and is not stopped by this
    session; with ``reuse=False`` it is an error. A named session's checkpoint is found
    again by its name, so that a new start goes on where the last one ended.

    A batch that ``on_batch`` fails on ends the capture, to be run again at the next start;
    with ``dead_letters`` it is stored in that folder and the capture goes on. Counters of all batches are
    kept beside the checkpoint, or at ``counters_path``.
    """

    def __init__(
        self,
        records: DataFrame,
        transform: Callable[[DataFrame], DataFrame],
        on_batch: Callable[[DataFrame, int], None],
        name: str | None = None,
        checkpoint: str | None = None,
        trigger: dict | None = None,
        batch_filter: Callable[[DataFrame], DataFrame] | None = None,
        reuse: bool = True,
        dead_letters: str | None = None,
        counters_path: str | None = None,
    ):
        self.records, self.transform, self.on_batch = records, transform, on_batch
        self.name = name or f"capture-{uuid.uuid4()}"
        self.checkpoint = checkpoint or shared_folder(records.sparkSession, "checkpoint", name)
        self.trigger = trigger or {"processingTime": "1 second"}
        self.batch_filter, self.reuse = batch_filter, reuse
        self.dead_letters = dead_letters
        self.counters_path = counters_path or f"{self.checkpoint}-counters"
        self.progress = ProgressLog(records.sparkSession, self.counters_path)
        self.query: StreamingQuery | None = None
        self.started_here = False

    def start(self) -> StreamingQuery:
        if self.query is not None:
            return self.query
        running = [q for q in self.records.sparkSession.streams.active if q.name == self.name]
        if running:
            if not self.reuse:
                raise RuntimeError(f"a capture named {self.name} is running")
            self.query = running[0]
            return self.query
        fn = with_dead_letters(self.on_batch, self.dead_letters) if self.dead_letters else self.on_batch
        if self.batch_filter is None:
            stream, step = self.transform(self.records), fn
        else:
            # Rules are read per batch, so the whole chain runs inside the batch.
            stream = self.records

            pinned = getattr(self.batch_filter, "for_batch", None)

            def step(batch: DataFrame, batch_id: int) -> None:
                kept = pinned(batch, batch_id, self.checkpoint) if pinned else self.batch_filter(batch)
                fn(self.transform(kept), batch_id)

        self.progress.name = self.name
        self.records.sparkSession.streams.addListener(self.progress)
        self.query = (
            stream.writeStream.queryName(self.name)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**self.trigger)
            .foreachBatch(step)
            .start()
        )
        self.started_here = True
        return self.query

    def wait(self, seconds: int | None = None) -> None:
        """Wait for a query that ends by itself (a replay)."""
        self.query.awaitTermination(seconds) if seconds else self.query.awaitTermination()
        if not self.query.isActive:
            self._close()

    def stop(self, seconds: float = 600) -> None:
        """Finish the work that is there, for ``seconds`` at most, then stop.

        Only if this session started it. What is not done by then is done at the next start.
        """
        if self.query is None or not self.started_here:
            return
        if self.query.isActive:
            end = time.monotonic() + seconds
            work = threading.Thread(target=self._finish, daemon=True)
            work.start()
            work.join(max(0.0, end - time.monotonic()))
            self.query.stop()
        self.query.awaitTermination()
        self._close()

    def _finish(self) -> None:
        # A query that fails or is stopped meanwhile tells so in awaitTermination.
        with contextlib.suppress(Exception):
            self.query.processAllAvailable()

    def _close(self) -> None:
        spark = self.records.sparkSession
        self.progress.wait_for(self.query)
        spark.streams.removeListener(self.progress)

    def counters(self) -> DataFrame:
        """One row a batch of this capture, of earlier runs too; see :data:`PROGRESS`."""
        return counters(self.records.sparkSession, self.counters_path)

    def __enter__(self) -> Capture:
        self.start()
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.stop()


def replay(records: DataFrame, transform, path: str, checkpoint: str, **options) -> DataFrame:
    """Run a stored trace through the streaming chain to its end, into a Parquet table.

    The file sink commits each batch once, so a lost executor or a restart from the
    checkpoint neither drops nor repeats events.
    """
    query = (
        transform(records)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = records.sparkSession
    return spark.read.parquet(path)


def throttle(files_per_trigger: int, interval: str) -> tuple[dict, dict]:
    """Reader options and trigger that bound the pace. Nothing is dropped; it waits."""
    return {"maxFilesPerTrigger": files_per_trigger}, {"processingTime": interval}


PROGRESS = """
    batch_id BIGINT, input_rows BIGINT, input_rows_per_second DOUBLE,
    processed_rows_per_second DOUBLE, events BIGINT, dropped BIGINT, record_errors BIGINT,
    field_errors BIGINT
"""


def counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters kept at ``path``, one row a batch: a batch that was run again has its last."""
    stored = f"reported BIGINT, {PROGRESS}"
    if not files.names(spark, path):
        return local_table(spark, [], PROGRESS)
    rows = spark.read.schema(stored).parquet(path)
    names = [f.name for f in rows.schema if f.name != "batch_id"]
    last = rows.groupBy("batch_id").agg(F.max(F.struct(*names)).alias("last"))
    return last.select("batch_id", *[f"last.{n}" for n in names if n != "reported"])


class ProgressLog(StreamingQueryListener):
    """Counters of all batches of the query called ``name``, a few numbers each, in a table at ``path``.

    ``dropped`` are rows that filters kept from the output; error counts need
    :func:`observed` events. What has been reported is written in the background and then
    forgotten here, so a long capture does not fill the driver.
    """

    def __init__(self, spark: SparkSession, path: str, name: str | None = None):
        self.spark, self.path, self.name, self.last = spark, path, name, -1
        self.waiting: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or p.batchId <= self.last:
            return
        seen = p.observedMetrics.get("trace")
        counts = seen.asDict() if seen is not None else {}
        events = counts.get("events")
        row = (
            time.time_ns(), p.batchId, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond, events,
            None if events is None else p.numInputRows - events,
            counts.get("record_errors"), counts.get("field_errors"),
        )
        with self.lock:
            self.waiting.append(row)
            self.last = p.batchId
            alone = len(self.waiting) == 1
        if alone:
            threading.Thread(target=self.flush, daemon=True).start()

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> None:
        """Write what waits. What cannot be written stays for the next time."""
        with self.lock:
            rows = list(self.waiting)
            if not rows:
                return
            try:
                table = local_table(self.spark, rows, f"reported BIGINT, {PROGRESS}")
                table.coalesce(1).write.mode("append").parquet(self.path)
            except Exception:
                logger.exception("counters of %d batches are kept for later", len(rows))
            else:
                del self.waiting[: len(rows)]

    def wait_for(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Wait until the last batch of an ended query has been reported and written."""
        done = query.lastProgress
        end = time.monotonic() + seconds
        while done is not None and self.last < done.batchId and time.monotonic() < end:
            time.sleep(0.05)
        self.flush()


# --- sinks ----------------------------------------------------------------------------


def to_callback(
    stream: DataFrame, fn, checkpoint: str, trigger: dict | None = None, dead_letters: str | None = None
):
    """Hand each micro-batch of events to ``fn(events, batch_id)``; failures as in :class:`Capture`."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .foreachBatch(with_dead_letters(fn, dead_letters) if dead_letters else fn)
        .start()
    )


def to_event_callback(stream: DataFrame, handler, path: str, checkpoint: str, trigger: dict | None = None):
    """Hand each event to ``handler`` on the executors; see :class:`~traceframe.streaming.callback.Delivery`."""
    return to_callback(stream, Delivery(path, handler), checkpoint, trigger)


def to_log_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append event text to a log directory."""
    return (
        format_event(stream)
        .select(F.concat("line", F.lit("\n")).alias("value"))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def to_console_stream(stream: DataFrame, checkpoint: str, trigger: dict | None = None):
    """Print every event of every micro-batch."""
    return to_callback(stream, lambda batch, _: to_console(batch), checkpoint, trigger)


def to_memory_stream(stream: DataFrame, name: str, trigger: dict | None = None):
    """Events as an in-memory table on the driver: for small captures and tests."""
    return (
        stream.writeStream.format("memory")
        .queryName(name)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
