"""Text sources: event dumps and field catalogs, blocks separated by a blank line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe.operators.manifest import bounded_rows, local_table
from traceframe.operators.validate import base_task


def _blocks(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """One row per block. The files stay splittable: the separator is the record end.

    Blocks that are parted by other blank lines (blanks in them, the other line end) come
    apart afterwards.
    """
    rows = spark.read.option("lineSep", separator).text(path)
    parts = F.split(F.translate("value", "\r", ""), r"\n(?:[ \t]*\n)+")
    return rows.select(F.explode(parts).alias("value"))


def _lines(block: Column) -> Column:
    return F.split(F.trim(F.translate(block, "\r", ""), F.lit(_BLANK)), "\n")


_BLANK = " \t\r\n"


def _not_blank(block: Column) -> Column:
    return F.trim(block, F.lit(_BLANK)) != ""


def last_value_wins(entries: Column) -> Column:
    """Key-value structs to a map; a repeated key keeps its last value."""
    kept = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]
        ),
    )
    return F.map_from_entries(kept)


#: Fields whose value has further lines, each like a field.
HEADERS = "(?i)headers$"
#: Rows that a field catalog may have to be broadcast.
MAX_CATALOG = 100_000


def fields_of_tasks(catalog: DataFrame) -> DataFrame:
    """``_task`` (without START/STOP/FAIL endings) and ``_fields`` of a field catalog, as a bounded local table."""
    rows = bounded_rows(
        catalog.select(base_task(F.upper("task")).alias("task"), "field").distinct(), MAX_CATALOG, "field catalog"
    )
    fields: dict[str, list[str]] = {}
    for r in rows:
        fields.setdefault(r.task, []).append(r.field)
    return local_table(catalog.sparkSession, sorted(fields.items()), "_task STRING, _fields ARRAY<STRING>")


def parse_event_dump(df: DataFrame, block: str = "value", catalog: DataFrame | None = None) -> DataFrame:
    """Blocks of a task line and ``Name: value`` lines to ``task_name`` and ``payload``.

    A value may contain further colons. With a ``catalog`` (``task``, ``field``), lines after a field of
    headers belong to its value, joined by line feeds, up to the next line that names a field of the
    task or a hidden field (``_Name``). Without one, or for tasks that it does not list, each
    such line is a field of its own.
    """
    if catalog is not None:
        return _parse_with_catalog(df, block, catalog)
    others = [c for c in df.columns if c != block]
    lined = df.where(_not_blank(F.col(block))).select(
        *others, _lines(F.col(block)).alias("_lines")
    )
    body = F.slice("_lines", 2, F.size("_lines"))
    split = lined.select(
        *others,
        F.upper(F.trim(F.get("_lines", F.lit(0)))).alias("task_name"),
        F.transform(body, lambda line: F.substring_index(line, ":", 1)).alias("_keys"),
        F.transform(body, _after_colon).alias("_values"),
    )
    keys, values = F.col("_keys"), F.col("_values")
    entries = F.arrays_zip(keys.alias("key"), values.alias("value"))
    payload = F.when(
        F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, values)
    ).otherwise(last_value_wins(entries))
    return split.select(*others, "task_name", payload.alias("payload"))


def _parse_with_catalog(df: DataFrame, block: str, catalog: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c != block]
    lined = df.where(_not_blank(F.col(block))).select(*others, _lines(F.col(block)).alias("_lines"))
    named = lined.select(
        *others, F.upper(F.trim(F.get("_lines", F.lit(0)))).alias("task_name"),
        F.slice("_lines", 2, F.size("_lines")).alias("_body"),
    )
    known = F.broadcast(fields_of_tasks(catalog))
    joined = named.join(known, base_task(F.col("task_name")) == F.col("_task"), "left")

    key = lambda line: F.substring_index(line, ":", 1)
    # Places of lines that surely begin a field, and of those among them that open headers.
    begins = F.filter(
        F.transform(
            "_body",
            lambda line, i: F.when(
                F.array_contains("_fields", key(line)) | key(line).startswith("_"),
                F.struct(i.alias("i"), key(line).rlike(HEADERS).alias("opens")),
            ),
        ),
        lambda b: b.isNotNull(),
    )
    staged = joined.withColumn("_begins", F.coalesce(begins, F.array().cast("array<struct<i:int,opens:boolean>>")))

    def goes_on(i: Column) -> Column:
        """Whether line ``i`` is a further line of headers."""
        last = F.element_at(F.filter("_begins", lambda b: b["i"] <= i), -1)
        before = F.exists("_begins", lambda b: b["i"] <= i)
        return F.when(before, last["opens"] & (last["i"] < i)).otherwise(False)

    marked = staged.withColumn("_on", F.transform("_body", lambda _, i: goes_on(i)))
    starts = marked.withColumn("_at", F.filter(F.transform("_on", lambda on, i: F.when(~on, i)), lambda i: i.isNotNull()))

    def entry(i: Column, place: Column) -> Column:
        line = F.get("_body", i)
        end = F.coalesce(F.get("_at", place + 1), F.size("_body"))
        more = F.slice("_body", i + 2, F.greatest(end - i - 1, F.lit(0)))
        value = F.when(F.size(more) > 0, F.concat_ws("\n", _after_colon(line), more)).otherwise(_after_colon(line))
        return F.struct(key(line).alias("key"), value.alias("value"))

    entries = starts.select(*others, "task_name", F.transform("_at", entry).alias("_entries"))
    return entries.select(*others, "task_name", last_value_wins(F.col("_entries")).alias("payload"))


def _after_colon(line: Column) -> Column:
    """Text after the first colon and one blank; NULL without a colon."""
    at = F.instr(line, ":")
    blank = F.when(F.substring(line, at + 1, F.lit(1)) == " ", 2).otherwise(1)
    return F.when(at > 0, F.substring(line, at + blank, F.length(line)))


def read_event_dump(
    spark: SparkSession, path: str, separator: str = "\n\n", catalog: DataFrame | None = None
) -> DataFrame:
    """Events of dump files; ``separator`` is ``"\\r\\n\\r\\n"`` where lines end in CR LF."""
    return parse_event_dump(_blocks(spark, path, separator), catalog=catalog)


def parse_field_catalog(df: DataFrame, block: str = "value") -> DataFrame:
    """Blocks of a task line and ``- field`` lines to ``task``, ``ordinal``, ``field``."""
    lined = df.where(_not_blank(F.col(block))).select(
        _lines(F.col(block)).alias("_lines")
    )
    return lined.select(
        F.trim(F.get("_lines", F.lit(0))).alias("task"),
        F.posexplode_outer(F.slice("_lines", 2, F.size("_lines"))).alias("ordinal", "line"),
    ).where(F.col("line").isNotNull()).select("task", "ordinal", F.regexp_replace("line", r"^\s*-\s*|\s+$", "").alias("field"))


def read_field_catalog(spark: SparkSession, path: str, separator: str = "\n\n") -> DataFrame:
    """Fields of catalog files; ``separator`` as for :func:`read_event_dump`."""
    return parse_field_catalog(_blocks(spark, path, separator))
