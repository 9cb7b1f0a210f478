"""Event text, and where events go from a batch frame. Streams: traceframe.streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _members(json: Column) -> Column:
    """The inside of a JSON object."""
    return F.substring(json, F.lit(2), F.length(json) - 2)


def event_json() -> Column:
    """One event as one JSON object: header, payload fields at top level, the rest."""
    keep_nulls = {"ignoreNullFields": "false"}
    head = F.to_json(F.struct(F.col("EventHeader"), F.col("task_name").alias("Task Name")))
    # The event's own members win over payload fields of the same name.
    own = ("EventHeader", "Task Name", "Description", "EventExtendedData", "UserData")
    payload = F.to_json(F.map_filter("payload", lambda name, _: ~name.isin(*own)), keep_nulls)
    rest = F.to_json(
        F.struct(
            F.col("description").alias("Description"),
            F.col("EventExtendedData"),
            F.hex("UserData").alias("UserData"),
        )
    )
    parts = F.filter(
        F.array(_members(head), _members(F.coalesce(payload, F.lit("{}"))), _members(rest)),
        lambda part: part != "",
    )
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def format_event(df: DataFrame) -> DataFrame:
    """``record_id`` and ``line``: id and task, a line break, the event."""
    head = F.concat(F.col("event_id").cast("string"), F.lit(" ("), F.col("task_name"), F.lit(")\n"))
    return df.select("record_id", F.concat(head, event_json()).alias("line"))


def to_log(df: DataFrame, path: str) -> None:
    """Append the event text to a log directory, one blank line between events."""
    lines = format_event(df).select(F.concat("line", F.lit("\n")).alias("value"))
    lines.write.mode("append").text(path)


class BatchLog:
    """A log directory that holds the event text of each numbered batch once: a batch function.

    A batch that is run again replaces its own lines.
    """

    def __init__(self, path: str):
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        lines = format_event(batch).select(F.concat("line", F.lit("\n")).alias("value"))
        lines.write.mode("overwrite").text(f"{self.path}/batch={batch_id}")

    def lines(self, spark: SparkSession) -> DataFrame:
        """All lines, with their ``batch``."""
        return spark.read.schema("value STRING, batch BIGINT").text(self.path)


def to_console(df: DataFrame) -> None:
    """Print every event; the driver holds one partition at a time."""
    for row in format_event(df).select("line").toLocalIterator():
        print(row.line)


def to_memory(df: DataFrame, name: str) -> DataFrame:
    """Keep the events in the executors' memory (and on their disks), queryable by name in this session.

    They are decoded once, on first use. ``spark.catalog.uncacheTable(name)`` lets them go.
    """
    df.createOrReplaceTempView(name)
    df.sparkSession.catalog.cacheTable(name)
    return df.sparkSession.table(name)
