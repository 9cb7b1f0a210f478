"""A user function for every event, on the executors.

An event that the function fails on costs that event alone: it is kept with its error, the
others are handled. What became of each event is a table with one folder an epoch (a
micro-batch). An epoch whose table is whole is not delivered again when a restarted capture
repeats it. If a capture dies inside an epoch, its events may be delivered twice: ``open``
gets partition and epoch, so that a handler with its own store can tell.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe.operators.sinks import event_json
from traceframe.streaming import files
from traceframe.workers import visible

logger = logging.getLogger(__name__)

OUTCOME = "record_id BIGINT, event_id BIGINT, status STRING, result STRING, error STRING, event STRING"
_ARROW = pa.schema(
    [("record_id", pa.int64()), ("event_id", pa.int64())] + [(n, pa.string()) for n in ("status", "result", "error", "event")]
)


class Handler:
    """What is done with events. One object for each partition of each epoch."""

    def open(self, partition_id: int, epoch_id: int) -> bool:
        """Called first; False passes the whole partition over."""
        return True

    def process(self, event_id: int, event: dict) -> str | None:
        """One event: header, payload fields and the rest, as in the event text. What is returned is kept."""

    def close(self, error: Exception | None) -> None:
        """Called last, also after a failure outside of ``process``."""


class _Function(Handler):
    def __init__(self, fn: Callable[[int, dict], str | None]):
        self.process = fn


def outcomes(events: DataFrame, handler: Handler | Callable[[int, dict], str | None], epoch: int = 0) -> DataFrame:
    """``OUTCOME`` of each event: ``handled``, ``failed`` (with error and event text) or ``skipped``.

    Events are delivered whenever the result is computed: write it, once.
    """
    visible(events.sparkSession)
    one = handler if isinstance(handler, Handler) else _Function(handler)

    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, error = one.open(TaskContext.get().partitionId(), epoch), None
        try:
            for batch in batches:
                rows = [_deliver(one, wanted, row) for row in batch.to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
        except Exception as e:
            error = e
            raise
        finally:
            one.close(error)

    given = events.select(F.col("record_id").cast("bigint"), F.col("event_id").cast("bigint"), event_json().alias("event"))
    return given.mapInArrow(deliver, OUTCOME)


def _deliver(handler: Handler, wanted: bool, row: dict) -> dict:
    out = {"record_id": row["record_id"], "event_id": row["event_id"], "status": "skipped"}
    if wanted:
        try:
            result = handler.process(row["event_id"], json.loads(row["event"]))
            out |= {"status": "handled", "result": None if result is None else str(result)}
        except Exception as e:  # the user's: it costs this event
            out |= {"status": "failed", "error": f"{type(e).__name__}: {e}", "event": row["event"]}
    return out


class Delivery:
    """A batch function that delivers events one by one and keeps what became of them under ``path``."""

    def __init__(self, path: str, handler: Handler | Callable[[int, dict], str | None]):
        self.path, self.handler = path, handler

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        folder = f"{self.path}/epoch={epoch}"
        if files.is_written(batch.sparkSession, folder):
            logger.info("epoch %d has been delivered", epoch)
            return
        outcomes(batch, self.handler, epoch).write.mode("overwrite").parquet(folder)

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """All outcomes so far, with their ``epoch``."""
        epochs = [n for n in files.names(spark, self.path) if files.is_written(spark, f"{self.path}/{n}")]
        read = spark.read.schema(f"{OUTCOME}, epoch BIGINT").option("basePath", self.path)
        if not epochs:
            return spark.createDataFrame([], f"{OUTCOME}, epoch BIGINT")
        return read.parquet(*[f"{self.path}/{n}" for n in epochs])

    def dead_letters(self, spark: SparkSession) -> DataFrame:
        """Events that the function failed on, as text, with the error."""
        return self.outcomes(spark).where("status = 'failed'").select("epoch", "record_id", "event_id", "error", "event")
