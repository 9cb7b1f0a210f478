"""Raw record tables: batch replay and live file-drop streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe import schema
from traceframe.constants import UNIX_EPOCH_TICKS
from traceframe.operators.header import normalize_ids

TICKS_PER_DAY = 864_000_000_000


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """A stored trace. The schema is given, so no file is opened to infer it."""
    return spark.read.schema(schema.RAW_EVENTS).parquet(path)


def read_events_by_date(spark: SparkSession, path: str) -> DataFrame:
    """A trace stored with ``by_date``: filter on ``event_date`` to read only those days."""
    return spark.read.schema(f"{schema.RAW_EVENTS.rstrip().rstrip(',')}, event_date DATE").parquet(path)


def read_events_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A live capture: files of raw records as they are dropped into a folder."""
    reader = spark.readStream.schema(schema.RAW_EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def merge_sessions(*frames: DataFrame) -> DataFrame:
    """Records of several providers that were stored apart, as one session."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def write_events(df: DataFrame, path: str, by_date: bool = False) -> None:
    """Store raw records so that provider filters, and date filters, prune whole directories.

    Ids get their one spelling here, where that does not keep a filter from the scan. With
    ``by_date`` there is a further column ``event_date``, the day of ``TimeStamp`` in UTC.
    """
    df = normalize_ids(df)
    if by_date:
        days = F.floor((F.col("TimeStamp") - UNIX_EPOCH_TICKS) / TICKS_PER_DAY).cast("int")
        df = df.withColumn("event_date", F.date_from_unix_date(days))
    parts = ["ProviderId", "event_date"] if by_date else ["ProviderId"]
    df.write.mode("append").partitionBy(*parts).parquet(path)
