"""Output modes, error flags and the quarantine split.

====  ==============  ============  ===================  ==============
mode  id/pid filters  task filter   payload              UserData
====  ==============  ============  ===================  ==============
0     yes             yes           yes                  never
1     yes             no            never (no decode)    always
2     yes             yes           yes                  on error
4     yes             yes           unless field error   on error
8     no              no            never (no decode)    inside record
====  ==============  ============  ===================  ==============
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe import schema
from traceframe.operators.header import effective_event_id, header_struct, resolved_name

MODES = (C.MODE_DECODED, C.MODE_RAW, C.MODE_RAW_ON_ERROR, C.MODE_ONLY_RAW_ON_ERROR, C.MODE_UNFORMATTED)


def check_mode(mode: int) -> int:
    """0 or exactly one mode; combinations and other numbers are refused."""
    if isinstance(mode, bool) or mode not in MODES:
        raise ValueError(f"output mode {mode!r} is not one of {MODES}")
    return mode


def has_error() -> Column:
    return F.col("record_parse_error") | F.col("field_parse_error")


def output_mode(mode: int):
    """Shape decoded (or, for modes 1 and 8, raw) records into output events."""
    check_mode(mode)
    if mode == C.MODE_UNFORMATTED:
        return lambda df: df.select(F.lit(0).alias("event_id"), *df.drop("event_id").columns)
    if mode == C.MODE_RAW:
        return _raw_only

    def apply(df: DataFrame) -> DataFrame:
        merged = ~F.col("field_parse_error") if mode == C.MODE_ONLY_RAW_ON_ERROR else F.lit(True)
        whole = merged & ~F.col("record_parse_error")
        raw = F.lit(None).cast("binary") if mode == C.MODE_DECODED else F.when(has_error(), F.col("UserData"))
        return df.select(
            "record_id",
            effective_event_id().alias("event_id"),
            header_struct().alias("EventHeader"),
            F.coalesce(F.when(whole, resolved_name()), F.col("ProviderId")).alias("task_name"),
            F.when(whole, F.coalesce("EventMessage", F.lit(""))).alias("description"),
            F.when(merged, F.col("payload")).alias("payload"),
            F.when(whole, F.col("EventExtendedData")).alias("EventExtendedData"),
            raw.alias("UserData"),
            "record_parse_error",
            "field_parse_error",
        )

    return apply


def _raw_only(df: DataFrame) -> DataFrame:
    def none(kind: str) -> Column:
        return F.lit(None).cast(kind)

    return df.select(
        "record_id",
        effective_event_id().alias("event_id"),
        header_struct().alias("EventHeader"),
        F.col("ProviderId").alias("task_name"),
        none("string").alias("description"),
        none("map<string,string>").alias("payload"),
        none(schema.EXTENDED_DATA.strip()).alias("EventExtendedData"),
        "UserData",
        none("boolean").alias("record_parse_error"),
        none("boolean").alias("field_parse_error"),
    )


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rows with an error. Two filters: read both only if you need both."""
    return df.where(~has_error()), df.where(has_error())


def write_quarantine(df: DataFrame, path: str) -> None:
    """Both sides in one pass over the input: one table, partitioned by the flag."""
    (
        df.withColumn("quarantined", has_error())
        .write.mode("append")
        .partitionBy("quarantined")
        .parquet(path)
    )


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The table again; a filter on ``quarantined`` reads one side only."""
    return spark.read.parquet(path).withColumn("quarantined", F.col("quarantined").cast("boolean"))
