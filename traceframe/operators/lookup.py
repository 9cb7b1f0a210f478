"""Finding events of a task, and time order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _time(df: DataFrame):
    return F.col("TimeStamp") if "TimeStamp" in df.columns else F.col("EventHeader.TimeStamp")


def all_events(task: str, trace=None):
    """Events of a task: of decoded events, or of raw records by way of ``trace``.

    With the trace only this task's records are decoded; the name of a decoded event
    depends on the outcome, so a filter on it cannot pass below the decode by itself.
    """

    def apply(df: DataFrame) -> DataFrame:
        events = df if trace is None else trace.only(task)(df)
        return events.where(F.col("task_name") == task)

    return apply


def first_event(task: str, trace=None):
    """Earliest event of a task; no row if there is none. Each task keeps one row."""

    def apply(df: DataFrame) -> DataFrame:
        found = all_events(task, trace)(df)
        return found.orderBy(_time(found), "record_id").limit(1)

    return apply


def chronological(df: DataFrame) -> DataFrame:
    """Time order over the whole frame: a range shuffle, so no task sees it all.

    ``record_id`` breaks ties, so even one instant shared by many records is split.
    """
    return df.orderBy(_time(df), "record_id")
