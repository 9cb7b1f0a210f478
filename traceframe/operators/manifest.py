"""The manifest: per-event-kind names and payload layouts, and how rows find theirs.

Manifest tables are metadata. They are read to the driver once, behind a size check, so
that layouts can be compiled to expressions; the event names travel to the executors as
a broadcast join side of the same checked size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe import schema
from traceframe.functions import fields
from traceframe.functions.guid import norm_guid

# By default, more event kinds than this are refused: the table would no longer be a safe
# broadcast. Whole operating systems register some tens of thousands of event kinds. Their
# properties and map entries, many for each kind, may be ``ROWS_PER_KIND`` times as many.
MAX_MANIFEST_ROWS = 500_000
ROWS_PER_KIND = 20

# At most this many layouts become generated code; see decode.py.
MAX_COMPILED_LAYOUTS = 24
MAX_COMPILED_FIELDS = 40
# Each string that ends with a terminator is searched for in all that is left of the payload.
MAX_COMPILED_STRINGS = 8


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """All rows of a small table, or an error when it is not small."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it cannot be metadata")
    return rows


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A literal table in the plan: no RDD, no Python worker, known size."""
    struct = spark.createDataFrame([], ddl).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(struct)
    columns = [
        pa.array([row[i] for row in rows], type=arrow.field(i).type)
        for i in range(len(struct))
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), struct)


@dataclass(frozen=True)
class Property:
    ordinal: int
    name: str
    in_type: int
    out_type: int = 0
    flags: int = 0
    map_name: str | None = None
    count: int = 1
    count_index: int | None = None
    length: int = 0
    length_index: int | None = None
    struct_start: int | None = None
    struct_members: int | None = None
    top_level: bool = True

    @property
    def is_struct(self) -> bool:
        return bool(self.flags & C.PROP_STRUCT)

    @property
    def is_array(self) -> bool:
        return not self.is_struct and (
            self.count > 1 or bool(self.flags & C.PROP_PARAM_COUNT)
        )


@dataclass
class Layout:
    layout_id: int
    key: tuple
    task_name: str | None
    properties: list[Property] = field(default_factory=list)
    maps: dict[str, tuple[bool, list[tuple[int, str]]]] = field(default_factory=dict)

    def map_of(self, p: Property) -> tuple[bool, list[tuple[int, str]]] | None:
        """The labels of a field. Only whole numbers have any."""
        return self.maps.get(p.map_name) if fields.is_whole_number(p.in_type) else None

    @property
    def top(self) -> list[Property]:
        return [p for p in self.properties if p.top_level]

    @property
    def compilable(self) -> bool:
        """Only plain fields of known types, and few enough of them."""
        strings = sum(p.in_type in (C.IN_UNICODESTRING, C.IN_ANSISTRING) and not p.length for p in self.top)
        if len(self.top) > MAX_COMPILED_FIELDS or strings > MAX_COMPILED_STRINGS:
            return False
        return all(
            not p.is_struct and not p.is_array and fields.known(p.in_type)
            for p in self.top
        )


class Manifest:
    """Manifest tables of a set of providers.

    ``events``, ``properties``, ``maps`` and ``keywords`` are DataFrames with the
    schemas of :mod:`traceframe.schema`. ``prefer`` lists ``(ProviderId, Id, Version)`` of
    frequent event kinds: they are compiled first when there are more layouts than can be.
    ``max_rows`` bounds the event kinds that are read to the driver.
    """

    def __init__(
        self,
        events: DataFrame,
        properties: DataFrame,
        maps: DataFrame,
        keywords: DataFrame | None = None,
        prefer=(),
        max_rows: int = MAX_MANIFEST_ROWS,
    ):
        self.spark = events.sparkSession
        self.keywords = keywords
        self.max_rows = max_rows
        self.layouts = self._load(events, properties, maps)
        self.compiled: dict = {}
        self.prefer = {(norm_guid(p), i, v) for p, i, v in prefer}

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Manifest:
        """Read ``manifest_event``, ``manifest_property``, ... Parquet tables."""
        names = ("manifest_event", "manifest_property", "manifest_map", "manifest_keyword")
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in names))

    @classmethod
    def of(cls, spark, events, properties, maps=(), keywords=()) -> Manifest:
        """A manifest from Python rows, for small hand-made ones."""
        return cls(
            local_table(spark, list(events), schema.MANIFEST_EVENT),
            local_table(spark, list(properties), schema.MANIFEST_PROPERTY),
            local_table(spark, list(maps), schema.MANIFEST_MAP),
            local_table(spark, list(keywords), schema.MANIFEST_KEYWORD),
        )

    def _load(self, events, properties, maps) -> list[Layout]:
        self._event_rows = sorted(
            bounded_rows(events, self.max_rows, "manifest_event"),
            key=lambda r: (norm_guid(r.ProviderId), r.Id, r.Version),
        )
        layouts, by_key = [], {}
        for i, row in enumerate(self._event_rows):
            key = (norm_guid(row.ProviderId), row.Id, row.Version)
            if key in by_key:
                raise ValueError(f"manifest_event has two rows for {key}")
            by_key[key] = Layout(i, key, row.TaskName or row.ProviderName)
            layouts.append(by_key[key])
        by_provider: dict[str, dict] = {}
        for row in bounded_rows(maps, self.max_rows * ROWS_PER_KIND, "manifest_map"):
            named = by_provider.setdefault(norm_guid(row.ProviderId), {})
            named.setdefault(row.map_name, (bool(row.is_bitmap), []))[1].append(
                (row.value, row.label)
            )
        for row in bounded_rows(properties, self.max_rows * ROWS_PER_KIND, "manifest_property"):
            layout = by_key.get((norm_guid(row.ProviderId), row.Id, row.Version))
            if layout is None:
                continue
            layout.properties.append(
                Property(
                    row.ordinal, row.name, row.in_type or 0, row.out_type or 0, row.flags or 0,
                    row.map_name, row["count"] or 0, row.count_index, row.length or 0,
                    row.length_index, row.struct_start, row.struct_members,
                    row.top_level is not False,
                )
            )
        for layout in layouts:
            layout.properties.sort(key=lambda p: p.ordinal)
            layout.maps = {
                # A value that is listed twice has its first label.
                name: (is_bitmap, sorted(entries) if is_bitmap else sorted(dict(sorted(entries, reverse=True)).items()))
                for name, (is_bitmap, entries) in by_provider.get(layout.key[0], {}).items()
            }
        return layouts

    def compiled_ids(self, wanted: list[Layout]) -> frozenset:
        """Which of the layouts in use become code; the others are decoded as data."""
        able = [x for x in wanted if x.compilable]
        able.sort(key=lambda x: (x.key not in self.prefer, x.layout_id))
        return frozenset(x.layout_id for x in able[:MAX_COMPILED_LAYOUTS])

    def lookup(self) -> DataFrame:
        """One row per event kind: key, layout id, names, kernel group."""
        rows = [
            (*layout.key, layout.layout_id, r.ProviderName, r.TaskName, r.EventMessage,
             r.kernel_group or 0)
            for layout, r in zip(self.layouts, self._event_rows)
        ]
        return local_table(
            self.spark,
            rows,
            "ProviderId STRING, Id INT, Version SMALLINT, layout_id INT, "
            "ProviderName STRING, TaskName STRING, EventMessage STRING, kernel_group BIGINT",
        )


def effective_event_id() -> Column:
    """System-logger events carry their id in ``Opcode``; all others in ``Id``."""
    return F.when(F.col("is_kernel"), F.col("Opcode").cast("int")).otherwise(F.col("Id"))


MANIFEST_COLUMNS = (
    "layout_id", "ProviderName", "TaskName", "EventMessage", "kernel_group", "manifest_missing",
)


def attach_manifest(manifest: Manifest):
    """Add layout id and names of each row's event kind; unknown kinds are kept.

    A left broadcast join: the manifest is bounded by its ``max_rows``, so no
    shuffle of the events is needed and a hot provider costs nothing extra. System-logger
    events, whose ``Id`` is 0, are found by their opcode.
    """

    def apply(df: DataFrame) -> DataFrame:
        if "manifest_missing" in df.columns:
            return df
        key = {c: f"_{c}" for c in ("ProviderId", "Id", "Version")}
        kinds = manifest.lookup().withColumnsRenamed(key)
        same = (
            (df["ProviderId"] == F.col("_ProviderId"))
            & (effective_event_id() == F.col("_Id"))
            & (df["Version"] == F.col("_Version"))
        )
        joined = df.join(F.broadcast(kinds), same, "left")
        return joined.select(
            *[df[c] for c in df.columns],
            *MANIFEST_COLUMNS[:-1],
            F.col("layout_id").isNull().alias("manifest_missing"),
        )

    return apply


def drop_manifest(df: DataFrame) -> DataFrame:
    return df.drop(*MANIFEST_COLUMNS)


def keyword_mask(keywords: DataFrame, provider_id: str, names: list[str] | None) -> DataFrame:
    """One row, one column ``mask``: OR of the named keywords' masks.

    Unknown names add nothing; no names give 0.
    """
    chosen = keywords.where(
        (F.col("ProviderId") == norm_guid(provider_id)) & F.col("keyword").isin(list(names or []))
    )
    return chosen.agg(F.coalesce(F.bit_or("mask"), F.lit(0)).cast("bigint").alias("mask"))


def keyword_mask_value(manifest: Manifest, provider_id: str, names: list[str] | None) -> int:
    """The same as a number, resolved once while planning, to embed as a literal."""
    return keyword_mask(manifest.keywords, provider_id, names).first().mask
