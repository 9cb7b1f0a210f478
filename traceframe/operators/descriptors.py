"""Provider-side filter descriptors, as row filters scoped to a provider.

Several descriptors of one provider are combined with AND. A descriptor is a function
``DataFrame -> DataFrame`` over all rows; ``apply(df, scope)`` limits it to the rows for
which ``scope`` holds and passes the others untouched. Those of :func:`provider_params`
may be of any kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe.functions import norm_guid
from traceframe.operators.filters import keyword_test, level_test, member_join
from traceframe.operators.header import effective_event_id, resolved_name
from traceframe.operators.manifest import Manifest, attach_manifest, drop_manifest


class Descriptor:
    """A predicate on raw records; ``manifest`` is set when it needs event names."""

    def __init__(self, test: Column, manifest: Manifest | None = None):
        self.test, self.manifest = test, manifest

    def apply(self, df: DataFrame, scope: Column) -> DataFrame:
        keep = F.when(scope, F.coalesce(self.test, F.lit(False))).otherwise(True)
        if self.manifest is None:
            return df.where(keep)
        attached = "manifest_missing" in df.columns
        out = attach_manifest(self.manifest)(df).where(keep)
        return out if attached else drop_manifest(out)

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.manifest is None:
            return df.where(self.test)
        return self.apply(df, F.lit(True))


#: Lives of processes that may be broadcast, some 50 MB. Of more, only those that occur in the trace are.
MAX_LIVES = 1_000_000


def lives(processes: DataFrame) -> DataFrame:
    """``_member``, ``_from`` and ``_to``: when a process id stood for one of these processes.

    Lives of one id that touch or overlap are one, so a record is in one of them at most. An open
    start or end is NULL; ``_to`` is not part of the life. Ids are reused, so an id has many.
    """
    least, most = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    rows = processes.where("pid IS NOT NULL").select(
        F.col("pid").alias("_member"), F.coalesce(F.col("start_time").cast("bigint"), least).alias("_from"),
        F.coalesce(F.col("end_time").cast("bigint"), most).alias("_to"),
    ).where("_from < _to").distinct()
    by_id = Window.partitionBy("_member").orderBy("_from", "_to")
    before = F.max("_to").over(by_id.rowsBetween(Window.unboundedPreceding, -1))
    numbered = rows.withColumn("_new", F.when(before >= F.col("_from"), 0).otherwise(1))
    numbered = numbered.withColumn("_life", F.sum("_new").over(by_id))
    return numbered.groupBy("_member", "_life").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to")).drop("_life")


class Lives(Descriptor):
    """Rows of processes that are known by id and time: ``pid``, ``start_time``, ``end_time``."""

    def __init__(self, processes: DataFrame):
        self.lives = lives(processes)

    def _few(self, df: DataFrame) -> DataFrame:
        """The lives, to be broadcast if their number allows; records are not shuffled for them then."""
        if not self.lives.offset(MAX_LIVES).isEmpty():
            ids = df.select("ProcessId").distinct()
            occur = self.lives.join(ids, F.col("_member") == F.col("ProcessId"), "left_semi")
            return occur if not occur.offset(MAX_LIVES).isEmpty() else F.broadcast(occur)
        return F.broadcast(self.lives)

    @staticmethod
    def _lived() -> Column:
        return (
            (F.col("ProcessId") == F.col("_member")) & (F.col("TimeStamp") >= F.col("_from")) & (F.col("TimeStamp") < F.col("_to"))
        )

    def apply(self, df: DataFrame, scope: Column) -> DataFrame:
        found = df.join(self._few(df.where(scope)), self._lived() & scope, "left")
        return found.where(F.coalesce(~scope, F.lit(True)) | F.col("_member").isNotNull()).select(df.columns)

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.join(self._few(df), self._lived(), "left_semi")


class Members(Descriptor):
    """Rows of the processes in a table."""

    def __init__(self, members: DataFrame):
        self.members = members

    def apply(self, df: DataFrame, scope: Column) -> DataFrame:
        member = self.members.toDF("_member").distinct().withColumn("_in", F.lit(True))
        looked_up = df.join(member, (F.col("ProcessId") == F.col("_member")) & scope, "left")
        return looked_up.where(F.coalesce(~scope, F.lit(True)) | F.col("_in")).select(df.columns)

    def __call__(self, df: DataFrame) -> DataFrame:
        return member_join(df, F.col("ProcessId"), self.members, keep=True)


class Change(Descriptor):
    """A change of some columns, made only in scope; no row is dropped."""

    def __init__(self, change: dict[str, Column]):
        self.change = change

    def apply(self, df: DataFrame, scope: Column) -> DataFrame:
        return df.withColumns({c: F.when(scope, new).otherwise(F.col(c)) for c, new in self.change.items()})

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.change)


def event_id_descriptor(filter_in: bool, ids) -> Descriptor:
    """Include or exclude up to 64 event ids."""
    if len(ids) > C.MAX_DESCRIPTOR_EVENT_IDS:
        raise ValueError(
            f"an event-id descriptor takes {C.MAX_DESCRIPTOR_EVENT_IDS} ids, not {len(ids)}"
        )
    hit = effective_event_id().isin(*ids)
    return Descriptor(hit if filter_in else ~hit)


def level_kw_descriptor(any: int, all: int, level: int, filter_in: bool) -> Descriptor:  # noqa: A002
    """Level and keyword masks together, kept or removed."""
    hit = level_test(level) & keyword_test(any, all)
    return Descriptor(hit if filter_in else ~hit)


def event_name_descriptor(
    any: int, all: int, level: int, filter_in: bool, names, manifest: Manifest  # noqa: A002
) -> Descriptor:
    """Level, masks and a list of event names together, kept or removed."""
    named = F.coalesce(resolved_name().isin(*[n.upper() for n in names]), F.lit(False))
    hit = level_test(level) & keyword_test(any, all) & named
    return Descriptor(hit if filter_in else ~hit, manifest)


def pid_descriptor(pids) -> Descriptor:
    return Descriptor(F.col("ProcessId").isin(*pids))


def exe_descriptor(names, processes: DataFrame):
    """Events of processes running one of these images."""
    return _by_process("image_name", names, processes)


def package_descriptor(ids, processes: DataFrame):
    return _by_process("package_id", ids, processes)


def package_app_descriptor(ids, processes: DataFrame):
    return _by_process("package_app_id", ids, processes)


def _by_process(column: str, values, processes: DataFrame):
    """The processes that match, by id, or by id and time where the table has ``start_time`` and ``end_time``."""
    chosen = processes.where(F.col(column).isin(*values))
    if {"start_time", "end_time"} <= set(processes.columns):
        return Lives(chosen)
    return Members(chosen.select("pid"))


def payload_filter(condition: Column | str) -> Descriptor:
    """A predicate on decoded payload columns (a typed view or the payload map)."""
    return Descriptor(F.expr(condition) if isinstance(condition, str) else condition)


def _without_items(items: Column, kinds) -> Column:
    return F.filter(items, lambda item: ~item["ExtType"].isin(*kinds))


def stack_filter(ids) -> Descriptor:
    """Keep stack items only on events with these ids; no row is dropped."""
    items = F.col("ExtendedData")
    bare = _without_items(items, (C.EXT_STACK_TRACE32, C.EXT_STACK_TRACE64))
    return Change({"ExtendedData": F.when(effective_event_id().isin(*ids), items).otherwise(bare)})


def enable_properties(mask: int) -> Descriptor:
    """Keep the optional extended items that the mask asks for; others are not optional."""
    removed = [
        kind for bit, kinds in C.PROPERTY_ITEMS.items() if not mask & bit for kind in kinds
    ]
    return Change({"ExtendedData": _without_items(F.col("ExtendedData"), removed)} if removed else {})


def provider_params(provider_id: str, descriptors: list[Descriptor], properties: int | None = None):
    """All descriptors of one provider; events of other providers pass untouched."""
    mine = F.col("ProviderId") == norm_guid(provider_id)
    more = [] if properties is None else [enable_properties(properties)]

    def apply(df: DataFrame) -> DataFrame:
        for d in [*descriptors, *more]:
            df = d.apply(df, mine)
        return df

    return apply
