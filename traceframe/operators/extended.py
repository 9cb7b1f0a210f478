"""Extended items: a tagged array of binary items -> one struct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe import schema
from traceframe.functions import guid_text, sid_text
from traceframe.functions.bits import le_uint, let, slice_bytes, unsigned_decimal
from traceframe.functions.reuse import per_application
from traceframe.functions.text import sid_size


def _u64(data: Column, offset=0) -> Column:
    return let(le_uint(data, offset, 8), unsigned_decimal)


def _numbers(data: Column, offset: int, width: int) -> Column:
    """As many whole numbers as follow ``offset``."""
    count = F.floor((F.length(data) - offset) / F.lit(width)).cast("int")
    read = (lambda i: _u64(data, i * 8 + offset)) if width == 8 else (
        lambda i: le_uint(data, i * 4 + offset, 4)
    )
    kind = "array<decimal(20,0)>" if width == 8 else "array<bigint>"
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), read)).otherwise(
        F.array().cast(kind)
    )


def _stack(data: Column, width: int) -> Column:
    return F.struct(_u64(data).alias("MatchId"), _numbers(data, 8, width).alias("Address"))


def _instance(data: Column) -> Column:
    return F.struct(
        le_uint(data, 0, 4).alias("InstanceId"),
        le_uint(data, 4, 4).alias("ParentInstanceId"),
        guid_text(data, 8).alias("ParentGuid"),
    )


# Output name, item kind, fewest bytes, rule.
_ITEMS = (
    ("RelatedActivityID", C.EXT_RELATED_ACTIVITY, 16, guid_text),
    ("SID", C.EXT_SID, 8, lambda d: sid_text(d, 0)),
    ("TSID", C.EXT_TS_ID, 4, lambda d: le_uint(d, 0, 4)),
    ("InstanceInfo", C.EXT_INSTANCE_INFO, 24, _instance),
    ("StackTrace32", C.EXT_STACK_TRACE32, 8, lambda d: _stack(d, 4)),
    ("StackTrace64", C.EXT_STACK_TRACE64, 8, lambda d: _stack(d, 8)),
    ("PebsIndex", C.EXT_PEBS_INDEX, 8, _u64),
    ("PMCCounters", C.EXT_PMC_COUNTERS, 0, lambda d: _numbers(d, 0, 8)),
    ("EventKey", C.EXT_EVENT_KEY, 8, _u64),
    ("StartKey", C.EXT_PROCESS_START_KEY, 8, _u64),
)


def _last(items: Column, kind: int, least: int) -> Column:
    """Bytes of the last readable item of a kind; items too short for it are skipped."""

    def wanted(item: Column) -> Column:
        size = F.least(F.length(item["Data"]), item["DataSize"])
        fits = (item["ExtType"] == kind) & (size >= least)
        return fits & (size >= sid_size(item["Data"], 0)) if kind == C.EXT_SID else fits

    found = F.filter(items, wanted)
    item = F.try_element_at(found, F.lit(-1))
    return slice_bytes(item["Data"], 0, item["DataSize"])


def _extract(items: Column, kind: int, least: int, rule) -> Column:
    """One output field; most events lack most kinds, so look for the kind first."""
    there = F.exists(items, lambda item: item["ExtType"] == kind)
    found = let(_last(items, kind, least), lambda data: F.when(data.isNotNull(), rule(data)))
    return F.when(there, found)


def decode_extended(df: DataFrame) -> DataFrame:
    """Add ``EventExtendedData``; NULL unless the header announces extended items.

    Unknown kinds give nothing, and one bad item leaves the others alone.
    """
    return df.withColumn("EventExtendedData", _extended_struct())


@per_application
def _extended_struct() -> Column:
    items = F.col("ExtendedData")
    fields = [_extract(items, kind, least, rule).alias(name) for name, kind, least, rule in _ITEMS]
    announced = F.col("Flags").bitwiseAND(F.lit(C.FLAG_EXTENDED_INFO)) != 0
    return F.when(announced, F.struct(*fields)).cast(schema.EXTENDED_DATA.strip())
