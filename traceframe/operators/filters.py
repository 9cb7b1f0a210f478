"""Row filters: event ids, processes, tasks, levels, keywords, providers.

All are plain predicates on header columns where the list is short, so Parquet row
groups can be skipped; long lists become semi or anti joins. Adaptive execution broadcasts
a joined list by its measured size, and splits a hot key of a shuffled one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe.functions import guid_norm, norm_guid
from traceframe.operators.header import resolved_name, with_event_id
from traceframe.operators.manifest import Manifest, attach_manifest, drop_manifest, local_table

# Longest list written into the plan as a literal.
MAX_LITERAL_LIST = 1000


def member_join(df: DataFrame, key: Column, members: DataFrame, keep: bool) -> DataFrame:
    """Rows whose ``key`` is (``keep``) or is not in the one-column ``members``.

    A row that matches several copies of a member is still one row: these are semi and
    anti joins. A NULL key is in no list. No job runs while planning.
    """
    member = members.toDF("_member").where(F.col("_member").isNotNull())
    return df.join(member, key == F.col("_member"), "left_semi" if keep else "left_anti")


def member_test(key: Column, members, keep: bool) -> Column:
    """The same for a short list. A NULL key is in no list."""
    hit = F.coalesce(key.isin(*members), F.lit(False))
    return key.isin(*members) if keep else ~hit


# --- consumer tier --------------------------------------------------------------------


def event_id_filter(ids):
    """Keep events with one of these effective ids; an empty list keeps all."""

    def apply(df: DataFrame) -> DataFrame:
        df = with_event_id(df)
        return df.where(F.col("event_id").isin(*ids)) if ids else df

    return apply


def provider_event_id_filter(rules: dict[str, list[int]]):
    """Per-provider id lists; providers without a list pass whole.

    Ids are normalised, so a provider given in lower case is found.
    """
    test = F.lit(True)
    for provider, ids in rules.items():
        mine = F.col("ProviderId") == norm_guid(provider)
        test = test & (~mine | F.col("event_id").isin(*ids))

    def apply(df: DataFrame) -> DataFrame:
        return with_event_id(df).where(test) if rules else df

    return apply


def pid_filter(allow=None, deny=None):
    """Process lists: Python collections or one-column tables of process ids.

    When there is an allow list the deny list is not looked at. An empty list is no list.
    """

    def apply(df: DataFrame) -> DataFrame:
        for chosen, keep in ((allow, True), (deny, False)):
            table = isinstance(chosen, DataFrame)
            pids = _first(chosen) if table else sorted(set(chosen or ()))
            if not pids:
                continue
            if len(pids) <= MAX_LITERAL_LIST:
                return df.where(member_test(F.col("ProcessId"), pids, keep))
            if not table:
                chosen = local_table(df.sparkSession, [(p,) for p in pids], "pid BIGINT")
            return member_join(df, F.col("ProcessId"), chosen, keep)
        return df

    return apply


def _first(members: DataFrame) -> list:
    """The members of a table, or enough of them to see that they are many: one small job."""
    named = members.toDF("pid").where("pid IS NOT NULL").distinct()
    return [r.pid for r in named.limit(MAX_LITERAL_LIST + 1).collect()]


def task_name_filter(names, manifest: Manifest):
    """Keep events of these tasks, and events of unknown kind.

    The resolved upper-case name is compared with the names as given.
    """

    def apply(df: DataFrame) -> DataFrame:
        if not names:
            return df
        attached = "manifest_missing" in df.columns
        out = attach_manifest(manifest)(df).where(
            F.col("manifest_missing") | resolved_name().isin(*names)
        )
        return out if attached else drop_manifest(out)

    return apply


# --- provider tier --------------------------------------------------------------------


def kernel_group_filter(manifest: Manifest, mask: int | None = None):
    """System-logger groups; without a mask: processes, threads, disk and network."""
    bits = mask or C.DEFAULT_KERNEL_MASK

    def apply(df: DataFrame) -> DataFrame:
        attached = "manifest_missing" in df.columns
        out = attach_manifest(manifest)(df).where(
            F.col("kernel_group").bitwiseAND(F.lit(bits)) != 0
        )
        return out if attached else drop_manifest(out)

    return apply


def level_number(level: int | str) -> int:
    if isinstance(level, str):
        return C.LEVELS[level]
    return level


def level_test(level: int | str = C.DEFAULT_LEVEL) -> Column:
    return F.col("Level") <= level_number(level)


def signed_mask(mask: int) -> int:
    """A 64-bit mask as the BIGINT that has the same bits."""
    mask &= (1 << 64) - 1
    return mask - (1 << 64) if mask >> 63 else mask


def keyword_test(any: int = 0, all: int = 0) -> Column:  # noqa: A002
    """``any``: at least one bit set (0 = no restriction); ``all``: every bit set."""
    test = F.lit(True)
    if any:
        test = test & (F.col("Keyword").bitwiseAND(F.lit(signed_mask(any))) != 0)
    if all:
        bits = F.lit(signed_mask(all))
        test = test & (F.col("Keyword").bitwiseAND(bits) == bits)
    return test


def level_filter(level: int | str = C.DEFAULT_LEVEL):
    return lambda df: df.where(level_test(level))


def keyword_filter(any: int = 0, all: int = 0):  # noqa: A002
    return lambda df: df.where(keyword_test(any, all))


# --- several providers ----------------------------------------------------------------


def provider_filter(providers: DataFrame):
    """Events of the providers in a config table, each with its own level and masks.

    A semi join with the table, of any length; Spark broadcasts it by its size. Where there
    are few providers their ids are also written into the plan and prune partitions.
    """
    rules = providers.select(
        guid_norm(F.col("ProviderId")).alias("_provider"), F.col("level").alias("_level"),
        F.coalesce("any_mask", F.lit(0)).alias("_any"), F.coalesce("all_mask", F.lit(0)).alias("_all"),
    )
    ids = _first(rules.select("_provider"))

    def apply(df: DataFrame) -> DataFrame:
        if len(ids) <= MAX_LITERAL_LIST:
            df = df.where(F.col("ProviderId").isin(*ids))
        level = F.col("_level").isNull() | (F.col("Level") <= F.col("_level"))
        some = (F.col("_any") == 0) | (F.col("Keyword").bitwiseAND(F.col("_any")) != 0)
        every = F.col("Keyword").bitwiseAND(F.col("_all")) == F.col("_all")
        return df.join(rules, (F.col("ProviderId") == F.col("_provider")) & level & some & every, "left_semi")

    return apply


def kernel_events(manifest: Manifest, enable_flags: int | None = None):
    """The system logger's events: its groups, with the opcode as event id."""

    def apply(df: DataFrame) -> DataFrame:
        return with_event_id(df.where("is_kernel").transform(kernel_group_filter(manifest, enable_flags)))

    return apply
