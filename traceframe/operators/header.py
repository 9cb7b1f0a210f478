"""Header projections: nested header, flags, event id, task name, description, ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe.functions import guid_norm, ticks_to_timestamp
from traceframe.operators.manifest import (
    Manifest,
    attach_manifest,
    drop_manifest,
    effective_event_id,
)


def with_event_id(df: DataFrame) -> DataFrame:
    if "event_id" in df.columns:
        return df
    return df.withColumn("event_id", effective_event_id())


def header_struct() -> Column:
    descriptor = F.struct(
        effective_event_id().alias("Id"),
        *[F.col(c) for c in ("Version", "Channel", "Level", "Opcode", "Task", "Keyword")],
    )
    return F.struct(
        *[F.col(c) for c in ("Size", "HeaderType", "Flags", "EventProperty", "ThreadId",
                             "ProcessId", "TimeStamp", "ProviderId")],
        descriptor.alias("EventDescriptor"),
        F.col("KernelTime"), F.col("UserTime"), F.col("ActivityId"),
    )


def project_header(df: DataFrame) -> DataFrame:
    """Header columns as one ``EventHeader`` struct with a nested descriptor."""
    return df.withColumn("EventHeader", header_struct())


def decode_flags(df: DataFrame) -> DataFrame:
    """One truth column per header flag, and the pointer size in bytes."""
    flags = F.col("Flags")
    return df.withColumns(
        {
            **{name: flags.bitwiseAND(F.lit(bit)) != 0 for name, bit in C.HEADER_FLAGS.items()},
            "ptr_size": F.when(flags.bitwiseAND(F.lit(C.FLAG_32_BIT_HEADER)) != 0, 4).otherwise(8),
        }
    )


def with_timestamp(df: DataFrame) -> DataFrame:
    """Add ``ts``, the record time as TIMESTAMP. Not for raw-clock recordings."""
    return df.withColumn("ts", ticks_to_timestamp(F.col("TimeStamp")))


def normalize_ids(df: DataFrame) -> DataFrame:
    """Bring provider and activity ids to their canonical spelling."""
    return df.withColumns({c: guid_norm(F.col(c)) for c in ("ProviderId", "ActivityId")})


def resolved_name() -> Column:
    """Upper-case task name, else provider name, with outer white space removed.

    NULL where the event kind is unknown.
    """
    name = F.coalesce("TaskName", "ProviderName")
    return F.upper(F.regexp_replace(name, r"^\s+|\s+$", ""))


def resolve_task_name(manifest: Manifest):
    """Add ``task_name``; the provider id stands in when the event kind is unknown."""

    def apply(df: DataFrame) -> DataFrame:
        attached = "manifest_missing" in df.columns
        out = attach_manifest(manifest)(df).withColumn(
            "task_name", F.coalesce(resolved_name(), F.col("ProviderId"))
        )
        return out if attached else drop_manifest(out)

    return apply


def resolve_description(manifest: Manifest):
    """Add ``description``: the event's message, or an empty string."""

    def apply(df: DataFrame) -> DataFrame:
        attached = "manifest_missing" in df.columns
        out = attach_manifest(manifest)(df).withColumn(
            "description", F.coalesce("EventMessage", F.lit(""))
        )
        return out if attached else drop_manifest(out)

    return apply


def flatten_payload(fields: list[str]):
    """Payload fields as top-level columns, replacing columns of the same name."""

    def apply(df: DataFrame) -> DataFrame:
        return df.withColumns({name: F.col("payload")[name] for name in fields})

    return apply


def trim_context(df: DataFrame) -> DataFrame:
    """Drop what was added for context: description and task name."""
    return df.drop("description", "task_name")
