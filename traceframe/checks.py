"""Registered queries: every operator over the whole ``events`` table, with its SQL.

The SQL never decodes bytes. It computes, from the source columns, what decoding the
records made of them must give.
"""

from __future__ import annotations

import os
import time
from collections import Counter
from collections.abc import Callable
from functools import lru_cache

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe.functions import guid_bytes, guid_norm, guid_text, is_null_guid, to_bool
from traceframe.operators import descriptors as desc
from traceframe.operators import filters, header, lookup, modes, sinks, validate
from traceframe.operators.decode import decode_payload, declared_fields, event_view
from traceframe.operators.extended import decode_extended
from traceframe.operators.manifest import Manifest, keyword_mask_value, local_table
from traceframe.plans.trace import Trace, preset
from traceframe.schema import PROVIDERS, RAW_EVENTS
from traceframe.sources import record_log, sample
from traceframe.sources.records import merge_sessions, read_events, read_events_stream, write_events
from traceframe.sources.text import (
    parse_event_dump,
    parse_field_catalog,
    read_event_dump,
    read_field_catalog,
)
from traceframe.streaming import capture as live
from traceframe.streaming import files
from traceframe.streaming.callback import Delivery
from traceframe.streaming.losses import LossLog
from traceframe.streaming.order import Reorder
from traceframe.streaming.rules import PidRules, live_rules

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The source columns and the record header each row turns into.
WITH = f"""
WITH e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents,
         epoch_us(ts) * 10 + {C.UNIX_EPOCH_TICKS} AS ticks
  FROM events
), r AS (
  SELECT *, event_id AS record_id, user_id AS pid,
    CASE event_type WHEN 'click' THEN '{C.WEB_CLIENT_PROVIDER}' WHEN 'view' THEN '{C.WEB_CLIENT_PROVIDER}'
      WHEN 'signup' THEN '{C.PROCESS_PROVIDER}' WHEN 'purchase' THEN '{C.PROCESS_PROVIDER}'
      ELSE '{C.REMOTE_CONNECTION_PROVIDER}' END AS provider,
    CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 1
      WHEN 'purchase' THEN 2 ELSE 3 END AS id,
    CASE event_type WHEN 'view' THEN 1 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END AS opcode,
    CASE event_type WHEN 'click' THEN 4 WHEN 'view' THEN 5 WHEN 'signup' THEN 4
      WHEN 'purchase' THEN 3 ELSE 2 END AS level,
    CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 16
      WHEN 'purchase' THEN 48 ELSE -9223372036854775808 END AS keyword,
    CASE WHEN event_id % 10 = 0 THEN 32 ELSE 64 END
      + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS flags,
    event_type = 'error' AND k % 5 = 0 AS unknown,
    CASE event_type WHEN 'click' THEN 65536 WHEN 'view' THEN 256 WHEN 'error' THEN 131072 ELSE 1 END AS kgroup,
    CASE event_type WHEN 'click' THEN 'WININET_READDATA' WHEN 'view' THEN 'WININET_CONNECT_HANDLE_CREATED'
      WHEN 'signup' THEN 'PROCESSSTART' WHEN 'purchase' THEN 'PROCESSSTOP'
      ELSE 'MICROSOFT-WINDOWS-TERMINALSERVICES-REMOTECONNECTIONMANAGER' END AS kind_name,
    (event_type = 'view' AND k % 7 = 0) OR (event_type = 'purchase' AND k % 11 = 0) AS field_error
  FROM e
), t AS (
  SELECT *, CASE WHEN unknown THEN provider ELSE kind_name END AS task,
         unknown OR field_error AS any_error
  FROM r
)
"""


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, the SQL that must agree with it."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = WITH + sql
        return fn

    return add


def _raw(spark: SparkSession, sf_dir: str, **more) -> DataFrame:
    return sample.raw_events(sample.read_source(spark, sf_dir), **more)


@lru_cache(maxsize=4)
def _manifests(application_id: str) -> tuple[Manifest, Manifest]:
    spark = SparkSession.active()
    return sample.sample_manifest(spark), sample.typed_manifest(spark)


def _manifest(spark: SparkSession) -> Manifest:
    return _manifests(spark.sparkContext.applicationId)[0]


def _typed(spark: SparkSession, sf_dir: str, kind: int) -> DataFrame:
    """Decoded events of one kind that covers a family of payload types."""
    manifest = _manifests(spark.sparkContext.applicationId)[1]
    raw = sample.typed_raw_events(sample.read_source(spark, sf_dir), kind)
    return raw.transform(decode_payload(manifest)).transform(header.resolve_task_name(manifest))


def _decoded(spark: SparkSession, sf_dir: str, mode: int = 0, **keep) -> DataFrame:
    return _raw(spark, sf_dir).transform(Trace(_manifest(spark), mode=mode, **keep))


def _h(*names: str) -> list:
    return [F.col(name).alias(_snake(name)) for name in names]


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name).lstrip("_")


# --- sources --------------------------------------------------------------------------


@query(
    "replay_of_stored_log",
    """SELECT record_id, pid AS process_id, event_id % 64 AS thread_id, ticks AS time_stamp,
         provider AS provider_id, id, level, keyword,
         CASE event_type WHEN 'click' THEN CASE WHEN event_id % 10 = 0 THEN 8 ELSE 12 END
           WHEN 'view' THEN 4 + 2 * CASE WHEN k % 7 = 0 THEN 0 ELSE length('host' || pid) END
           WHEN 'signup' THEN 26 + 2 * length('proc' || k || '.exe')
           WHEN 'purchase' THEN CASE WHEN k % 11 = 0 THEN 20 ELSE 24 END
           ELSE CASE WHEN k % 5 <> 0 AND k % 3 = 0 THEN 0 ELSE 4 END END AS user_data_length
       FROM r""",
)
def replay_of_stored_log(spark, sf_dir):
    path = os.path.join(live.shared_folder(spark, "trace"), "raw_events")
    write_events(_raw(spark, sf_dir), path)
    return read_events(spark, path).select(
        "record_id",
        *_h("ProcessId", "ThreadId", "TimeStamp", "ProviderId", "Id", "Level", "Keyword"),
        F.length("UserData").alias("user_data_length"),
    )


@query(
    "several_providers",
    f"""SELECT record_id, provider AS provider_id, level, keyword FROM r
       WHERE (provider = '{C.WEB_CLIENT_PROVIDER}' AND level <= 4)
          OR (provider = '{C.PROCESS_PROVIDER}' AND level <= 5 AND keyword & 16 <> 0 AND keyword & 32 = 32)""",
)
def several_providers(spark, sf_dir):
    table = local_table(
        spark,
        [
            ("web", C.WEB_CLIENT_PROVIDER.lower(), 4, 0, 0),
            ("process", C.PROCESS_PROVIDER, 5, 0x10, 0x20),
        ],
        PROVIDERS,
    )
    kept = _raw(spark, sf_dir).transform(filters.provider_filter(table))
    return kept.select("record_id", *_h("ProviderId", "Level", "Keyword"))


@query(
    "two_thousand_providers",
    f"SELECT record_id, provider AS provider_id FROM r WHERE provider = '{C.PROCESS_PROVIDER}' AND level <= 3",
)
def two_thousand_providers(spark, sf_dir):
    """A config table of any length; all but one of its providers have no events."""
    others = spark.range(2000).select(
        F.lit("p").alias("name"),
        F.format_string("{00000000-0000-0000-0001-%012x}", F.col("id")).alias("ProviderId"),
        F.lit(5).cast("smallint").alias("level"), F.lit(0).cast("bigint").alias("any_mask"),
        F.lit(0).cast("bigint").alias("all_mask"),
    )
    mine = local_table(spark, [("process", C.PROCESS_PROVIDER, 3, 0, 0)], PROVIDERS)
    kept = _raw(spark, sf_dir).transform(filters.provider_filter(others.toDF(*mine.columns).unionByName(mine)))
    return kept.select("record_id", *_h("ProviderId"))


@query(
    "deny_lists_keep_records_without_process",
    """SELECT record_id, length FROM (SELECT record_id, CASE WHEN k % 3 = 0 THEN NULL ELSE pid END AS p FROM r),
         (VALUES ('short'), ('long')) v(length) WHERE p IS NULL OR p NOT IN (2, 3)""",
)
def deny_lists_keep_records_without_process(spark, sf_dir):
    """A NULL process is in no list, however long the list is."""
    source = sample.with_helpers(sample.read_source(spark, sf_dir)).select(F.col("event_id").alias("record_id"), "k")
    raw = _raw(spark, sf_dir).join(source, "record_id")
    raw = raw.withColumn("ProcessId", F.when(F.col("k") % 3 != 0, F.col("ProcessId")))
    lists = {"short": [2, 3], "long": [2, 3, *range(10**9, 10**9 + 3000)]}
    short, long_ = [
        raw.transform(filters.pid_filter(deny=pids)).select("record_id", F.lit(name).alias("length"))
        for name, pids in lists.items()
    ]
    return short.unionByName(long_)


@query(
    "mixed_descriptors",
    f"""SELECT record_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS stacks FROM r
        WHERE provider <> '{C.PROCESS_PROVIDER}' OR (pid % 10 IN (1, 8) AND id = 1)""",
)
def mixed_descriptors(spark, sf_dir):
    """Descriptors of unlike kinds on one provider, by way of the trace."""
    processes = sample.process_table(sample.read_source(spark, sf_dir))
    listed = [
        desc.exe_descriptor(["proc1.exe", "proc8.exe"], processes), desc.stack_filter([1]),
        desc.event_id_descriptor(True, [1]),
    ]
    trace = Trace(_manifest(spark), mode=8, provider_params={C.PROCESS_PROVIDER.lower(): (listed, None)})
    return _item_counts(trace(_raw(spark, sf_dir))).select("record_id", "stacks")


@query(
    "merged_sessions",
    """SELECT provider AS provider_id, kernel AS is_kernel, CAST(count(*) AS BIGINT) AS n
       FROM r, (VALUES (true), (false)) v(kernel) GROUP BY 1, 2""",
)
def merged_sessions(spark, sf_dir):
    both = merge_sessions(_raw(spark, sf_dir), _raw(spark, sf_dir, kernel=True))
    return both.groupBy(F.col("ProviderId").alias("provider_id"), "is_kernel").agg(F.count("*").alias("n"))


@query(
    "kernel_logger_default_groups",
    "SELECT record_id, id AS event_id, kgroup AS kernel_group FROM r WHERE NOT unknown AND kgroup & 65795 <> 0",
)
def kernel_logger_default_groups(spark, sf_dir):
    manifest = _manifest(spark)
    records = merge_sessions(_raw(spark, sf_dir), _raw(spark, sf_dir, kernel=True))
    from traceframe.operators.manifest import attach_manifest

    return (
        records.transform(attach_manifest(manifest))
        .transform(filters.kernel_events(manifest))
        .select("record_id", "event_id", "kernel_group")
    )


@query(
    "kernel_logger_chosen_groups",
    "SELECT record_id, id AS event_id FROM r WHERE NOT unknown AND kgroup & 131073 <> 0",
)
def kernel_logger_chosen_groups(spark, sf_dir):
    mask = C.KERNEL_GROUPS["registry"] | C.KERNEL_GROUPS["process"]
    records = _raw(spark, sf_dir, kernel=True)
    return records.transform(filters.kernel_events(_manifest(spark), mask)).select("record_id", "event_id")


_CATALOG = """
  SELECT * FROM (VALUES
    ('click', 'WININET_READDATA', 0, 'Request'), ('click', 'WININET_READDATA', 1, 'Size'),
    ('view', 'WININET_CONNECT_HANDLE_CREATED', 0, '_ServerNameLength'),
    ('view', 'WININET_CONNECT_HANDLE_CREATED', 1, 'ServerName'),
    ('view', 'WININET_CONNECT_HANDLE_CREATED', 2, 'ServerPort'),
    ('signup', 'PROCESSSTART', 0, 'ProcessID'), ('signup', 'PROCESSSTART', 1, 'CreateTime'),
    ('signup', 'PROCESSSTART', 2, 'ParentProcessID'), ('signup', 'PROCESSSTART', 3, 'SessionID'),
    ('signup', 'PROCESSSTART', 4, 'Flags'), ('signup', 'PROCESSSTART', 5, 'ImageName'),
    ('purchase', 'PROCESSSTOP', 0, 'ProcessID'), ('purchase', 'PROCESSSTOP', 1, 'ExitCode'),
    ('purchase', 'PROCESSSTOP', 2, 'Elevated'), ('purchase', 'PROCESSSTOP', 3, 'Amount'),
    ('purchase', 'PROCESSSTOP', 4, 'TokenElevationType')) c(event_type, task, ordinal, field)
"""


def _catalog_blocks(decoded: DataFrame) -> DataFrame:
    """A catalog block per event, from its task and field names."""
    lines = F.transform(F.map_keys("payload"), lambda name: F.concat(F.lit("\t- "), name))
    return decoded.select(F.concat_ws("\n", F.array("task_name"), lines).alias("value"))


@query(
    "field_catalog_text",
    f"""SELECT task, ordinal, field, CAST(count(*) AS BIGINT) AS n FROM
         (SELECT c.task, c.ordinal, c.field FROM r JOIN ({_CATALOG}) c USING (event_type)
          UNION ALL
          SELECT kind_name, 0, 'Error' FROM r WHERE event_type = 'error' AND k % 5 <> 0 AND k % 3 <> 0)
       GROUP BY 1, 2, 3""",
)
def field_catalog_text(spark, sf_dir):
    catalog = parse_field_catalog(_catalog_blocks(_decoded(spark, sf_dir)))
    return catalog.groupBy("task", "ordinal", "field").agg(F.count("*").alias("n"))


# What the lines of the text dump hold.
_DUMP = WITH.rstrip() + """, d AS (
  SELECT *, '0x' || upper(to_hex(user_id + CASE WHEN k % 13 = 0 THEN 8589934592 ELSE 0 END)) AS handle,
    '10.0.' || k * 3 || '.' || user_id % 256 AS ip,
    CASE WHEN k % 6 = 0 THEN 'PATCH' ELSE 'GET' END AS verb,
    CASE event_type WHEN 'click' THEN 'WININET_READDATA' WHEN 'view' THEN 'WININET_CONNECT'
      WHEN 'signup' THEN 'WININET_HTTP_RESPONSE' WHEN 'purchase' THEN 'MICROSOFT-WINDOWS-WININET-CAPTURE'
      ELSE 'WININET_DNS_QUERY' END AS dump_task
  FROM r)
"""


def _events_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = sample.dump_blocks(sample.read_source(spark, sf_dir))
    return parse_event_dump(blocks).withColumn("EventExtendedData", F.lit(None).cast("string"))


@query("event_dump_text")
def event_dump_text(spark, sf_dir):
    names = ("Request", "Size", "LocalAddress", "Verb", "ContentLength", "AddressList", "Note", "Payload")
    return _events_from_text(spark, sf_dir).select(
        "record_id",
        "task_name",
        F.size("payload").alias("n_fields"),
        *[F.col("payload")[n].alias(_snake(n)) for n in names],
    )


SQL["event_dump_text"] = _DUMP + """
  SELECT record_id, dump_task AS task_name,
    CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 7 WHEN 'signup' THEN 7
      WHEN 'purchase' THEN CASE WHEN k % 4 = 0 THEN 5 ELSE 6 END ELSE 5 END AS n_fields,
    CASE WHEN event_type IN ('click', 'view') THEN handle END AS request,
    CASE WHEN event_type = 'click' THEN CAST(k * 170 AS VARCHAR) END AS size,
    CASE WHEN event_type = 'view' THEN ip || ':' || (53000 + user_id + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) END AS local_address,
    CASE WHEN event_type = 'signup' THEN verb END AS verb,
    CASE WHEN event_type = 'signup' THEN CAST(cents AS VARCHAR) END AS content_length,
    CASE WHEN event_type = 'error' THEN ip || ';' END AS address_list,
    CASE WHEN event_type = 'purchase' THEN 'a: b' END AS note,
    CASE WHEN event_type = 'purchase' AND k % 4 <> 0 THEN '00FF' END AS payload
  FROM d"""


@query(
    "event_dump_headers",
    """SELECT event_id AS record_id, CAST(6 AS INT) AS n_fields, 'http://h' || k || '.example/' AS url,
         'GET / HTTP/1.1' || chr(10) || 'User-Agent: agent' || user_id || CASE WHEN k % 2 = 0 THEN chr(10) || 'Host: h' || k ELSE '' END AS request_headers,
         'HTTP/1.1 ' || (200 + k) || chr(10) || 'Date: Fri, 10 Feb 2017 09:46:05 GMT' || chr(10) || 'Date: again' || chr(10) || 'no colon here' AS response_headers,
         CAST(k AS VARCHAR) AS status FROM e""",
)
def event_dump_headers(spark, sf_dir):
    """Header lines stay in the value of their field, which the field catalog knows."""
    task = "WININET_USAGELOGREQUESTSTOP"
    fields = ("URL", "Verb", "RequestHeaders", "ResponseHeaders", "Status", "Spare")
    catalog = local_table(spark, [(task, i, f) for i, f in enumerate(fields)], "task STRING, ordinal INT, field STRING")
    blocks = sample.header_blocks(sample.read_source(spark, sf_dir))
    payload = F.col("payload")
    return parse_event_dump(blocks, catalog=catalog).select(
        "record_id", F.size("payload").alias("n_fields"), payload["URL"].alias("url"), payload["RequestHeaders"].alias("request_headers"),
        payload["ResponseHeaders"].alias("response_headers"), payload["Status"].alias("status"),
    )


def _written(spark: SparkSession, blocks: DataFrame, name: str, end: str) -> str:
    """Text files of the blocks, with the given line end and a separator line with a blank now and then."""
    path = os.path.join(live.shared_folder(spark, name), "text")
    gap = F.when(F.crc32(F.col("value").cast("binary")) % 3 == 0, f"{end} ").otherwise(end)
    text = F.concat(F.regexp_replace("value", "\n", end), gap)
    blocks.select(text).write.option("lineSep", end).text(path)
    return path


@query("event_dump_files")
def event_dump_files(spark, sf_dir):
    """Dump files with either line end, through the reader."""
    blocks = sample.dump_blocks(sample.read_source(spark, sf_dir))
    found = [
        read_event_dump(spark, _written(spark, blocks, f"dump-{name}", end), end + end).withColumn("ends", F.lit(name))
        for name, end in (("lf", "\n"), ("crlf", "\r\n"))
    ]
    return (
        found[0].unionByName(found[1]).groupBy("ends", "task_name")
        .agg(F.count("*").alias("n"), F.sum(F.size("payload")).alias("n_fields"),
             F.sum(F.col("payload")["Size"].cast("bigint")).alias("sizes"),
             F.count_if(F.col("payload")["Verb"] == "PATCH").alias("patches"))
    )


SQL["event_dump_files"] = _DUMP + """
  SELECT ends, dump_task AS task_name, CAST(count(*) AS BIGINT) AS n,
    CAST(sum(CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 7 WHEN 'signup' THEN 7
      WHEN 'purchase' THEN CASE WHEN k % 4 = 0 THEN 5 ELSE 6 END ELSE 5 END) AS BIGINT) AS n_fields,
    CAST(sum(CASE WHEN event_type = 'click' THEN k * 170 END) AS BIGINT) AS sizes,
    CAST(count(*) FILTER (event_type = 'signup' AND verb = 'PATCH') AS BIGINT) AS patches
  FROM d, (VALUES ('lf'), ('crlf')) v(ends) GROUP BY 1, 2"""


@query("field_catalog_files", SQL["field_catalog_text"].removeprefix(WITH))
def field_catalog_files(spark, sf_dir):
    """The catalog as CR LF files, through the reader."""
    path = _written(spark, _catalog_blocks(_decoded(spark, sf_dir)), "catalog", "\r\n")
    return read_field_catalog(spark, path, "\r\n\r\n").groupBy("task", "ordinal", "field").agg(F.count("*").alias("n"))


# --- header projections ---------------------------------------------------------------


@query(
    "header_struct",
    f"""SELECT record_id, 0 AS size, flags, event_id % 64 AS thread_id, pid AS process_id, ticks AS time_stamp,
         provider AS provider_id, id, CASE WHEN unknown THEN 9 ELSE 0 END AS version, level, opcode, keyword,
         '{C.NULL_GUID}' AS activity_id, true AS null_activity FROM r""",
)
def header_struct(spark, sf_dir):
    h = header.project_header(_raw(spark, sf_dir)).select("record_id", "EventHeader.*")
    return h.select(
        "record_id",
        *_h("Size", "Flags", "ThreadId", "ProcessId", "TimeStamp", "ProviderId"),
        *[F.col(f"EventDescriptor.{c}").alias(c.lower()) for c in ("Id", "Version", "Level", "Opcode", "Keyword")],
        *_h("ActivityId"),
        is_null_guid(F.col("ActivityId")).alias("null_activity"),
    )


@query(
    "header_flags",
    """SELECT record_id, event_type = 'error' AS extended_info, event_id % 10 = 0 AS header_32_bit,
         event_id % 10 <> 0 AS header_64_bit, false AS classic_header,
         CASE WHEN event_id % 10 = 0 THEN 4 ELSE 8 END AS ptr_size FROM r""",
)
def header_flags(spark, sf_dir):
    return header.decode_flags(_raw(spark, sf_dir)).select(
        "record_id", "extended_info", "header_32_bit", "header_64_bit", "classic_header", "ptr_size"
    )


@query(
    "effective_event_id",
    """SELECT record_id, kernel AS is_kernel, CASE WHEN kernel THEN 0 ELSE id END AS id, id AS event_id
       FROM r, (VALUES (true), (false)) v(kernel)""",
)
def effective_event_id(spark, sf_dir):
    both = merge_sessions(_raw(spark, sf_dir), _raw(spark, sf_dir, kernel=True))
    return header.with_event_id(both).select("record_id", "is_kernel", *_h("Id"), "event_id")


@query(
    "kernel_decode",
    """SELECT record_id, task AS task_name, unknown AS record_parse_error,
         CASE WHEN event_type = 'click' THEN CAST(k AS VARCHAR) END AS size,
         CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(pid AS VARCHAR) END AS process_id,
         CASE WHEN event_type = 'signup' THEN 'proc' || k || '.exe' END AS image_name FROM t""",
)
def kernel_decode(spark, sf_dir):
    """System-logger records, whose Id is 0, decoded by their opcode."""
    out = _raw(spark, sf_dir, kernel=True).transform(Trace(_manifest(spark)))
    fields = {"size": "Size", "process_id": "ProcessID", "image_name": "ImageName"}
    return out.select(
        "record_id", "task_name", "record_parse_error", *[F.col("payload")[f].alias(n) for n, f in fields.items()]
    )


@query(
    "task_names_and_descriptions",
    """SELECT record_id, task AS task_name,
         CASE WHEN event_type = 'error' AND NOT unknown THEN 'An error occurred' ELSE '' END AS description FROM t""",
)
def task_names_and_descriptions(spark, sf_dir):
    m = _manifest(spark)
    named = _raw(spark, sf_dir).transform(header.resolve_task_name(m)).transform(header.resolve_description(m))
    return named.select("record_id", "task_name", "description")


@query(
    "flattened_payload",
    """SELECT record_id,
         CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(pid AS VARCHAR) END AS "ProcessID",
         CASE WHEN event_type = 'click' THEN CAST(k AS VARCHAR) END AS "Size",
         CASE WHEN event_type = 'view' THEN '80' END AS "ServerPort" FROM r""",
)
def flattened_payload(spark, sf_dir):
    flat = _decoded(spark, sf_dir).transform(header.flatten_payload(["ProcessID", "Size", "ServerPort"]))
    return flat.select("record_id", "ProcessID", "Size", "ServerPort")


@query(
    "trimmed_context",
    "SELECT record_id, id AS event_id, pid AS process_id FROM r",
)
def trimmed_context(spark, sf_dir):
    trimmed = header.trim_context(_decoded(spark, sf_dir))
    kept = [c for c in ("description", "task_name") if c in trimmed.columns]
    return trimmed.select("record_id", "event_id", F.col("EventHeader.ProcessId").alias("process_id"), *kept)


@query(
    "provider_id_spellings",
    """SELECT record_id, provider AS from_bytes, provider AS from_text,
         length(replace(replace(replace(provider, '-', ''), '{', ''), '}', '')) AS n_digits FROM r""",
)
def provider_id_spellings(spark, sf_dir):
    provider = F.col("ProviderId")
    data = guid_bytes(provider)
    loose = F.concat(F.lit(" "), F.lower(F.translate(provider, "{}", "")))
    return _raw(spark, sf_dir).select(
        "record_id",
        guid_text(data).alias("from_bytes"),
        guid_norm(loose).alias("from_text"),
        F.length(F.hex(data)).alias("n_digits"),
    )


@query("record_time", "SELECT record_id, epoch_us(ts) AS micros FROM r")
def record_time(spark, sf_dir):
    return header.with_timestamp(_raw(spark, sf_dir)).select("record_id", F.unix_micros("ts").alias("micros"))


# --- consumer filters -----------------------------------------------------------------


def _kept(df: DataFrame) -> DataFrame:
    return df.select("record_id", *_h("ProviderId", "Id", "ProcessId", "Level"))


_KEPT = "SELECT record_id, provider AS provider_id, id, pid AS process_id, level FROM t "


@query("event_id_filter", _KEPT + "WHERE id IN (1, 3)")
def event_id_filter(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(filters.event_id_filter([1, 3])))


@query(
    "provider_event_id_filter",
    _KEPT + f"""WHERE (provider <> '{C.WEB_CLIENT_PROVIDER}' OR id IN (2, 7))
                  AND (provider <> '{C.PROCESS_PROVIDER}' OR id = 1)""",
)
def provider_event_id_filter(spark, sf_dir):
    rules = {C.WEB_CLIENT_PROVIDER.lower(): [2, 7], C.PROCESS_PROVIDER: [1]}
    return _kept(_raw(spark, sf_dir).transform(filters.provider_event_id_filter(rules)))


_PIDS = (2, 3, 5, 7, 11, 13)


@query("pid_allow_list", _KEPT + "WHERE pid IN (2, 3, 5, 7, 11, 13)")
def pid_allow_list(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(filters.pid_filter(allow=_PIDS)))


@query("pid_deny_list", _KEPT + "WHERE pid NOT IN (2, 3, 5, 7, 11, 13)")
def pid_deny_list(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(filters.pid_filter(deny=_PIDS)))


@query("pid_allow_list_overrides_deny", _KEPT + "WHERE pid IN (2, 3, 5, 7, 11, 13)")
def pid_allow_list_overrides_deny(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(filters.pid_filter(allow=_PIDS, deny=(3, 5, 99))))


@query("pid_allow_table", _KEPT + "WHERE pid % 10 IN (3, 4)")
def pid_allow_table(spark, sf_dir):
    processes = sample.process_table(sample.read_source(spark, sf_dir))
    allowed = processes.where(F.col("image_name").isin("proc3.exe", "proc4.exe")).select("pid")
    return _kept(_raw(spark, sf_dir).transform(filters.pid_filter(allow=allowed)))


@query("pid_deny_table_shuffled", _KEPT + "WHERE pid % 10 NOT IN (3, 4)")
def pid_deny_table_shuffled(spark, sf_dir):
    """The form for lists too long to broadcast."""
    processes = sample.process_table(sample.read_source(spark, sf_dir))
    denied = processes.where(F.col("image_name").isin("proc3.exe", "proc4.exe")).select("pid")
    raw = _raw(spark, sf_dir)
    return _kept(filters.member_join(raw, F.col("ProcessId"), denied, keep=False))


@query(
    "task_name_filter",
    _KEPT + "WHERE unknown OR kind_name IN ('WININET_READDATA', 'PROCESSSTOP')",
)
def task_name_filter(spark, sf_dir):
    names = ["WININET_READDATA", "PROCESSSTOP", "ProcessStart"]
    return _kept(_raw(spark, sf_dir).transform(filters.task_name_filter(names, _manifest(spark))))


def _preset(name: str, **more):
    def run(spark, sf_dir):
        chosen = preset(name, _manifest(spark), **more)
        return _raw(spark, sf_dir).transform(chosen).select("record_id", "event_id", "task_name")

    return run


query(
    "preset_web_client",
    "SELECT record_id, id AS event_id, task AS task_name FROM t WHERE event_type = 'view'",
)(_preset("wininet", level="verbose"))
query(
    "preset_process",
    "SELECT record_id, id AS event_id, task AS task_name FROM t WHERE event_type IN ('signup', 'purchase')",
)(_preset("process", any_keywords=["WINEVENT_KEYWORD_PROCESS"]))
query(
    "preset_remote_desktop",
    "SELECT record_id, id AS event_id, task AS task_name FROM t WHERE event_type = 'error'",
)(_preset("rdp"))


# --- provider filters -----------------------------------------------------------------


@query("level_filter", _KEPT + "WHERE level <= 4")
def level_filter(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(filters.level_filter()))


@query("level_filter_by_name", _KEPT + "WHERE level <= 3")
def level_filter_by_name(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(filters.level_filter("warning")))


@query("keyword_match_any", _KEPT + "WHERE keyword & 32 <> 0 OR keyword < 0")
def keyword_match_any(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(filters.keyword_filter(any=0x20 | 1 << 63)))


@query("keyword_match_all", _KEPT + "WHERE keyword & 48 = 48")
def keyword_match_all(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(filters.keyword_filter(all=0x30)))


@query("keyword_names", _KEPT + f"WHERE provider = '{C.PROCESS_PROVIDER}' AND keyword & 32 <> 0")
def keyword_names(spark, sf_dir):
    m = _manifest(spark)
    mask = keyword_mask_value(m, C.PROCESS_PROVIDER, ["WINEVENT_KEYWORD_THREAD", "NO_SUCH_KEYWORD"])
    none = keyword_mask_value(m, C.PROCESS_PROVIDER, [])
    kept = _raw(spark, sf_dir).transform(filters.keyword_filter(any=mask, all=none))
    return _kept(kept.where(F.col("ProviderId") == C.PROCESS_PROVIDER))


@query("event_id_descriptor_in", _KEPT + "WHERE id IN (2, 54)")
def event_id_descriptor_in(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(desc.event_id_descriptor(True, [2, 54])))


@query("event_id_descriptor_out", _KEPT + "WHERE id NOT IN (2, 54)")
def event_id_descriptor_out(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(desc.event_id_descriptor(False, [2, 54])))


@query("level_keyword_descriptor", _KEPT + "WHERE level <= 4 AND keyword & 17 <> 0 AND keyword & 16 = 16")
def level_keyword_descriptor(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(desc.level_kw_descriptor(0x11, 0x10, 4, True)))


@query("level_keyword_descriptor_out", _KEPT + "WHERE NOT (level <= 4 AND keyword & 17 <> 0)")
def level_keyword_descriptor_out(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(desc.level_kw_descriptor(0x11, 0, 4, False)))


@query(
    "event_name_descriptor",
    _KEPT + "WHERE level <= 4 AND NOT unknown AND kind_name IN ('PROCESSSTOP', 'WININET_READDATA')",
)
def event_name_descriptor(spark, sf_dir):
    names = ["ProcessStop", "WININET_READDATA"]
    return _kept(
        _raw(spark, sf_dir).transform(desc.event_name_descriptor(0, 0, 4, True, names, _manifest(spark)))
    )


@query("pid_descriptor", _KEPT + "WHERE pid IN (2, 3, 5, 7, 11, 13)")
def pid_descriptor(spark, sf_dir):
    return _kept(_raw(spark, sf_dir).transform(desc.pid_descriptor(_PIDS)))


def _by_process(make, values):
    def run(spark, sf_dir):
        processes = sample.process_table(sample.read_source(spark, sf_dir))
        return _kept(_raw(spark, sf_dir).transform(make(values, processes)))

    return run


query("executable_descriptor", _KEPT + "WHERE pid % 10 IN (1, 8)")(
    _by_process(desc.exe_descriptor, ["proc1.exe", "proc8.exe"])
)
query("package_descriptor", _KEPT + "WHERE pid % 4 = 2")(_by_process(desc.package_descriptor, ["pkg2"]))
query("package_app_descriptor", _KEPT + "WHERE pid % 6 IN (0, 5)")(
    _by_process(desc.package_app_descriptor, ["app0", "app5"])
)


_LIVES = """SELECT record_id, provider AS provider_id FROM r, (SELECT (min(ticks) + max(ticks)) // 2 AS half FROM r)
  WHERE {0} (pid + (ticks >= half)::INT) % {1}"""


@query("executable_descriptor_by_time", _LIVES.format("", "10 IN (1, 8)"))
def executable_descriptor_by_time(spark, sf_dir):
    """Process ids that are used again: the image that an id stands for depends on the time."""
    lives = sample.process_lives(sample.read_source(spark, sf_dir))
    kept = _raw(spark, sf_dir).transform(desc.exe_descriptor(["proc1.exe", "proc8.exe"], lives))
    return kept.select("record_id", F.col("ProviderId").alias("provider_id"))


@query("package_descriptor_by_time", _LIVES.format(f"provider <> '{C.PROCESS_PROVIDER}' OR", "4 = 2"))
def package_descriptor_by_time(spark, sf_dir):
    """The same for one provider's events; those of others pass."""
    lives = sample.process_lives(sample.read_source(spark, sf_dir))
    one = desc.provider_params(C.PROCESS_PROVIDER, [desc.package_descriptor(["pkg2"], lives)])
    return _raw(spark, sf_dir).transform(one).select("record_id", F.col("ProviderId").alias("provider_id"))


@query(
    "payload_filter",
    "SELECT record_id, cents AS amount FROM r WHERE event_type = 'purchase' AND cents >= 2000 AND k % 2 = 1",
)
def payload_filter(spark, sf_dir):
    view = _decoded(spark, sf_dir, task_names=("PROCESSSTOP",)).transform(
        event_view("PROCESSSTOP", {"Amount": "bigint", "Elevated": "boolean"})
    )
    kept = view.transform(desc.payload_filter("Amount >= 2000 AND Elevated"))
    return kept.select("record_id", F.col("Amount").alias("amount"))


def _item_counts(df: DataFrame) -> DataFrame:
    def count(*kinds):
        return F.size(F.filter("ExtendedData", lambda i: i["ExtType"].isin(*kinds)))

    return df.select(
        "record_id",
        count(C.EXT_SID).alias("sids"),
        count(C.EXT_TS_ID).alias("sessions"),
        count(C.EXT_STACK_TRACE32, C.EXT_STACK_TRACE64).alias("stacks"),
        count(C.EXT_PROCESS_START_KEY).alias("start_keys"),
        F.size("ExtendedData").alias("items"),
    )


def _extended_raw(spark, sf_dir) -> DataFrame:
    return sample.extended_raw_events(sample.read_source(spark, sf_dir))


@query(
    "stack_filter",
    """SELECT record_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS sessions, 0 AS stacks,
         CASE WHEN event_type = 'error' THEN 3 ELSE 0 END AS items FROM r""",
)
def stack_filter(spark, sf_dir):
    bare = _raw(spark, sf_dir).transform(desc.stack_filter([1, 2]))
    return _item_counts(bare).select("record_id", "sessions", "stacks", "items")


@query(
    "enabled_properties",
    "SELECT record_id, 1 AS sids, 0 AS sessions, 2 AS stacks, 0 AS start_keys, 11 AS items FROM r",
)
def enabled_properties(spark, sf_dir):
    mask = C.PROPERTY_SID | C.PROPERTY_STACK_TRACE
    return _item_counts(_extended_raw(spark, sf_dir).transform(desc.enable_properties(mask)))


@query(
    "descriptor_list",
    _KEPT + f"WHERE provider <> '{C.PROCESS_PROVIDER}' OR (id IN (1, 2) AND level <= 3 AND pid NOT IN (2, 3))",
)
def descriptor_list(spark, sf_dir):
    out = desc.Descriptor(~desc.pid_descriptor([2, 3]).test)
    listed = [desc.event_id_descriptor(True, [1, 2]), desc.level_kw_descriptor(0, 0, 3, True), out]
    return _kept(_raw(spark, sf_dir).transform(desc.provider_params(C.PROCESS_PROVIDER, listed, 0)))


# --- decode ---------------------------------------------------------------------------


def _view(task: str, fields: dict, **names):
    def run(spark, sf_dir):
        view = _decoded(spark, sf_dir, task_names=(task,)).transform(event_view(task, fields))
        return view.select("record_id", *[F.col(f).alias(alias) for alias, f in names.items()])

    return run


query(
    "decode_pointer_by_header_width",
    """SELECT record_id, '0x' || upper(to_hex(event_id)) AS request_text,
         event_id AS request, k AS size FROM r WHERE event_type = 'click'""",
)(
    lambda spark, sf_dir: _decoded(spark, sf_dir)
    .where("task_name = 'WININET_READDATA'")
    .select(
        "record_id",
        F.col("payload")["Request"].alias("request_text"),
        F.conv(F.substring(F.col("payload")["Request"], 3, 16), 16, 10).cast("bigint").alias("request"),
        F.col("payload")["Size"].cast("int").alias("size"),
    )
)

query(
    "decode_carried_length",
    """SELECT record_id, CASE WHEN k % 7 = 0 THEN 0 ELSE length('host' || pid) END AS name_length,
         CASE WHEN k % 7 <> 0 THEN 'host' || pid END AS server_name, 80 AS server_port
       FROM r WHERE event_type = 'view'""",
)(
    _view(
        "WININET_CONNECT_HANDLE_CREATED",
        {"_ServerNameLength": "int", "ServerName": "string", "ServerPort": "int"},
        name_length="_ServerNameLength", server_name="ServerName", server_port="ServerPort",
    )
)


@query(
    "typed_view_of_process_start",
    """SELECT record_id, pid AS process_id, epoch_us(ts) AS create_micros, 2 * pid AS parent_process_id,
         k AS session_id, '0x' || upper(to_hex(k)) AS flags, 'proc' || k || '.exe' AS image_name
       FROM r WHERE event_type = 'signup'""",
)
def typed_view_of_process_start(spark, sf_dir):
    task = "PROCESSSTART"
    declared = declared_fields(_manifest(spark), task)
    fields = {**declared, "ProcessID": "bigint", "ParentProcessID": "bigint", "SessionID": "int"}
    view = _decoded(spark, sf_dir, task_names=(task,)).transform(event_view(task, fields))
    micros = F.unix_micros(F.try_to_timestamp(F.concat(F.substring("CreateTime", 1, 26), F.lit("Z"))))
    return view.select(
        "record_id", F.col("ProcessID").alias("process_id"), micros.alias("create_micros"),
        F.col("ParentProcessID").alias("parent_process_id"), F.col("SessionID").alias("session_id"),
        F.col("Flags").alias("flags"), F.col("ImageName").alias("image_name"),
    )


@query(
    "decode_signs_maps_and_cut_payloads",
    """SELECT record_id, pid AS process_id, -k AS exit_code, k % 2 = 1 AS elevated, cents AS amount,
         CASE WHEN k % 11 = 0 THEN NULL ELSE ['Default', 'Full', 'Limited'][1 + k % 3] END AS elevation
       FROM r WHERE event_type = 'purchase'""",
)
def decode_signs_maps_and_cut_payloads(spark, sf_dir):
    fields = {
        "ProcessID": "bigint", "ExitCode": "int", "Elevated": "boolean", "Amount": "bigint",
        "TokenElevationType": "string",
    }
    run = _view(
        "PROCESSSTOP", fields, process_id="ProcessID", exit_code="ExitCode", elevated="Elevated",
        amount="Amount", elevation="TokenElevationType",
    )
    return run(spark, sf_dir)


@query(
    "decode_empty_payload",
    """SELECT record_id, CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END AS n_fields,
         CASE WHEN k % 3 <> 0 THEN k END AS error FROM r WHERE event_type = 'error' AND NOT unknown""",
)
def decode_empty_payload(spark, sf_dir):
    task = C.PRESETS["rdp"]["tasks"][0]
    return (
        _decoded(spark, sf_dir)
        .where(F.col("task_name") == task)
        .select(
            "record_id",
            F.size("payload").alias("n_fields"),
            F.col("payload")["Error"].try_cast("int").alias("error"),
        )
    )


@query(
    "boolean_text",
    """SELECT record_id, CASE WHEN k % 4 = 0 THEN '1' WHEN k % 4 = 1 THEN 'TRUE' WHEN k % 4 = 2 THEN 'yes' ELSE event_type END AS text,
         k % 4 IN (0, 1) AS truth FROM r""",
)
def boolean_text(spark, sf_dir):
    k = F.col("k") % 4
    text = F.when(k == 0, "1").when(k == 1, "TRUE").when(k == 2, "yes").otherwise(F.col("event_type"))
    source = sample.with_helpers(sample.read_source(spark, sf_dir))
    return source.select(F.col("event_id").alias("record_id"), text.alias("text")).withColumn(
        "truth", to_bool(F.col("text"))
    )


def _text(*names: str) -> list:
    return [F.col("payload")[n].alias(_snake(n)) for n in names]


@query(
    "decode_number_types",
    f"""SELECT record_id, CAST(-k AS VARCHAR) AS i8, CAST(k + 100 AS VARCHAR) AS u8, CAST(-k * 300 AS VARCHAR) AS i16,
         CAST(k * 600 AS VARCHAR) AS u16, CAST(-event_id AS VARCHAR) AS i32, CAST(4294967295 - event_id AS VARCHAR) AS u32,
         CAST(-cents * 1000000 AS VARCHAR) AS i64, CAST(18446744073709551615 - event_id AS VARCHAR) AS u64,
         CAST(k + 1 AS DOUBLE) AS f32, CAST(cents + 1 AS DOUBLE) AS f64,
         CASE WHEN k % 2 = 1 THEN 'true' ELSE 'false' END AS truth,
         '{{0000000A-000B-000C-000D-' || lpad(upper(to_hex(event_id)), 12, '0') || '}}' AS id,
         '0x' || upper(to_hex(event_id)) AS address, '0x' || upper(to_hex(user_id)) AS span,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' AS start,
         '2024-' || lpad(CAST(1 + k % 12 AS VARCHAR), 2, '0') || '-' || lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0') || 'T'
           || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ':'
           || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || '.' || lpad(CAST(k * 10 AS VARCHAR), 3, '0') || 'Z' AS clock,
         '0x' || upper(to_hex(event_id)) AS h32, '0x' || upper(to_hex(-1 - event_id)) AS h64 FROM e
       JOIN (SELECT event_id AS record_id FROM events) x ON x.record_id = e.event_id""",
)
def decode_number_types(spark, sf_dir):
    d = _typed(spark, sf_dir, sample.NUMBERS)
    p = F.col("payload")
    names = {
        "i8": "I8", "u8": "U8", "i16": "I16", "u16": "U16", "i32": "I32", "u32": "U32", "i64": "I64",
        "u64": "U64", "truth": "Truth", "id": "Id", "address": "Address", "span": "Span",
        "start": "Start", "clock": "Clock", "h32": "H32", "h64": "H64",
    }
    return d.select(
        "record_id",
        *[p[field].alias(alias) for alias, field in names.items()],
        p["F32"].cast("double").alias("f32"),
        p["F64"].cast("double").alias("f64"),
    )


@query(
    "decode_string_types",
    """SELECT event_id AS record_id, 'näme' || k AS ansi, 'näme' || k AS wide_fixed, 'näme' || k AS ansi_fixed,
         'näme' || k AS counted, 'näme' || k AS counted_ansi, 'näme' || k AS reversed,
         'näme' || k AS reversed_ansi, 'ü' AS wide_char, 'Z' AS ansi_char, 'host' || user_id AS wide,
         'smile ' || chr(128512) || ' ' || k AS rest FROM e""",
)
def decode_string_types(spark, sf_dir):
    names = (
        "Ansi", "WideFixed", "AnsiFixed", "Counted", "CountedAnsi", "Reversed", "ReversedAnsi",
        "WideChar", "AnsiChar", "Wide", "Rest",
    )
    return _typed(spark, sf_dir, sample.STRINGS).select("record_id", *_text(*names))


@query(
    "decode_binary_types",
    """SELECT event_id AS record_id, CAST(length('host' || user_id) AS VARCHAR) AS body_size,
         upper(hex('host' || user_id)) AS body,
         '2001:db8::' || lower(to_hex(k + 1)) AS v6,
         '10.' || k || '.' || user_id % 256 || '.1:80' AS socket,
         '10.' || k || '.' || user_id % 256 || '.1' AS v4, '8080' AS port,
         'S-1-5-21-' || user_id || '-4294967295' AS sid, 'S-1-5-21-' || user_id || '-4294967295' AS wbem_sid,
         upper(hex('host' || user_id)) AS dump,
         CASE WHEN k % 8 = 0 THEN '0' ELSE
           array_to_string(list_filter([CASE WHEN k & 1 <> 0 THEN 'Read' END, CASE WHEN k & 2 <> 0 THEN 'Write' END,
             CASE WHEN k & 4 <> 0 THEN 'Run' END], lambda x: x IS NOT NULL), ' | ') END AS rights FROM e""",
)
def decode_binary_types(spark, sf_dir):
    names = ("BodySize", "Body", "V6", "Socket", "V4", "Port", "Sid", "WbemSid", "Dump", "Rights")
    return _typed(spark, sf_dir, sample.BLOBS).select("record_id", *_text(*names))


@query(
    "decode_arrays",
    """SELECT event_id AS record_id,
         '["' || user_id || '","' || (user_id + 1) || '","' || (user_id + 2) || '"]' AS triple,
         CAST(k % 4 AS VARCHAR) AS many,
         CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '["' || (event_id + 1) || '"]'
           WHEN 2 THEN '["' || (event_id + 1) || '","' || (event_id + 2) || '"]'
           ELSE '["' || (event_id + 1) || '","' || (event_id + 2) || '","' || (event_id + 3) || '"]' END AS items,
         '7' AS tail, k % 4 = 0 AS field_parse_error FROM e""",
)
def decode_arrays(spark, sf_dir):
    d = _typed(spark, sf_dir, sample.LISTS)
    return d.select("record_id", *_text("Triple", "Many", "Items", "Tail"), "field_parse_error")


@query(
    "decode_structs",
    """SELECT event_id AS record_id, CAST(1 + k % 3 AS VARCHAR) AS many, CAST(k AS VARCHAR) AS tail,
         '[' || array_to_string(list_transform(range(1, 2 + k % 3), lambda i:
            '{"Base":"' || (user_id + i) || '","Name":"m' || i || '"}'), ',') || ']' AS modules,
         false AS record_parse_error FROM e""",
)
def decode_structs(spark, sf_dir):
    d = _typed(spark, sf_dir, sample.STRUCTS)
    return d.select("record_id", *_text("Many", "Tail", "Modules"), "record_parse_error")


@lru_cache(maxsize=4)
def _layouts_manifest(application_id: str) -> Manifest:
    return sample.layouts_manifest(SparkSession.active())


@query(
    "decode_many_layouts",
    f"""SELECT event_id AS record_id, 'LAYOUT' || (event_id % {sample.LAYOUTS}) AS task_name, CAST(user_id AS VARCHAR) AS "user",
         array_to_string(list_transform(range(event_id % {sample.LAYOUTS} % 7), lambda i: 's-' || i || '-' || user_id), ',') AS strings,
         '["' || k || '","' || (k + 1) || '"]' AS pair, '9' AS last, false AS record_parse_error, false AS field_parse_error FROM e""",
)
def decode_many_layouts(spark, sf_dir):
    """A manifest of real size: none of its layouts is compiled."""
    manifest = _layouts_manifest(spark.sparkContext.applicationId)
    raw = sample.layout_raw_events(sample.read_source(spark, sf_dir))
    out = raw.transform(decode_payload(manifest)).transform(header.resolve_task_name(manifest))
    strings = F.array_join(F.array(*[F.col("payload")[f"S{i}"] for i in range(7)]), ",")
    return out.select(
        "record_id", "task_name", F.col("payload")["User"].alias("user"), strings.alias("strings"),
        *_text("Pair", "Last"), "record_parse_error", "field_parse_error",
    )


@query(
    "decode_long_arrays",
    f"""SELECT event_id // {sample.LONG} AS record_id, CAST(count(*) AS VARCHAR) AS many,
         md5('["' || string_agg(user_id, '","' ORDER BY event_id) || '"]') AS users,
         md5('["' || string_agg('u' || user_id, '","' ORDER BY event_id) || '"]') AS names,
         md5('[' || string_agg('{{"User":"' || user_id || '","Name":"p' || user_id || '"}}', ',' ORDER BY event_id) || ']') AS parts,
         '7' AS last, false AS field_parse_error FROM e GROUP BY 1""",
)
def decode_long_arrays(spark, sf_dir):
    """Arrays of up to 10,000 elements, of one size and of many, and as many structs."""
    manifest = _layouts_manifest(spark.sparkContext.applicationId)
    raw = sample.long_raw_events(sample.read_source(spark, sf_dir))
    payload = F.col("payload")
    return raw.transform(decode_payload(manifest)).select(
        "record_id", payload["Many"].alias("many"), *[F.md5(payload[n]).alias(n.lower()) for n in ("Users", "Names", "Parts")],
        payload["Last"].alias("last"), "field_parse_error",
    )


@query(
    "decode_goes_on_after_bad_field",
    """SELECT event_id AS record_id, CAST(user_id AS VARCHAR) AS before,
         CASE WHEN k % 2 = 0 THEN '2024-01-05T' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':00:00.000Z' END AS clock,
         CAST(k AS VARCHAR) AS after, false AS record_parse_error, k % 2 = 1 AS field_parse_error FROM e""",
)
def decode_goes_on_after_bad_field(spark, sf_dir):
    d = _typed(spark, sf_dir, sample.BROKEN)
    return d.select(
        "record_id", *_text("Before", "Clock", "After"), "record_parse_error", "field_parse_error"
    )


@query(
    "conversion_failure_ends_record",
    """SELECT event_id AS record_id, CAST(user_id AS VARCHAR) AS before,
         CASE WHEN k % 3 <> 0 THEN CAST(k AS VARCHAR) END AS number,
         CASE WHEN k % 3 <> 0 THEN CAST(k AS VARCHAR) END AS after,
         CASE WHEN k % 3 = 0 THEN 1 ELSE 3 END AS n_fields, k % 3 = 0 AS record_parse_error FROM e""",
)
def conversion_failure_ends_record(spark, sf_dir):
    d = _typed(spark, sf_dir, sample.MISTYPED)
    return d.select(
        "record_id", *_text("Before", "Number", "After"), F.size("payload").alias("n_fields"),
        "record_parse_error",
    )


@query(
    "fixed_count_is_rejected",
    """SELECT event_id AS record_id, CAST(user_id AS VARCHAR) AS before, 1 AS n_fields,
         true AS record_parse_error FROM e""",
)
def fixed_count_is_rejected(spark, sf_dir):
    d = _typed(spark, sf_dir, sample.FIXED_COUNT)
    return d.select("record_id", *_text("Before"), F.size("payload").alias("n_fields"), "record_parse_error")


# --- extended items -------------------------------------------------------------------


@query(
    "extended_items_on_errors",
    """SELECT record_id, CASE WHEN event_type = 'error' THEN pid END AS tsid,
         CASE WHEN event_type = 'error' THEN event_id END AS related_low,
         CASE WHEN event_type = 'error' THEN CAST(k AS VARCHAR) || ':' || event_id || ',' || (event_id + 1) END AS stack
       FROM r""",
)
def extended_items_on_errors(spark, sf_dir):
    x = F.col("EventExtendedData")
    low = F.conv(F.substring(x["RelatedActivityID"], 2, 8), 16, 10).cast("bigint")
    stack = F.concat(
        x["StackTrace64"]["MatchId"].cast("string"),
        F.lit(":"),
        F.array_join(x["StackTrace64"]["Address"].cast("array<string>"), ","),
    )
    return decode_extended(_raw(spark, sf_dir)).select(
        "record_id", x["TSID"].alias("tsid"), low.alias("related_low"), stack.alias("stack")
    )


@query(
    "extended_items_of_all_kinds",
    """SELECT record_id, 'S-1-5-21-' || pid || '-4294967295' AS sid, pid AS tsid, event_id AS instance_id,
         k AS parent_instance_id, CAST(k AS VARCHAR) || ':' || event_id || ',' || pid || ',' || k AS stack32,
         CAST(k AS VARCHAR) || ':' || (18446744073709551615 - event_id) AS stack64,
         CAST(18446744073709551615 - k AS VARCHAR) AS pebs_index, event_id || ',' || k AS counters,
         event_id * 3 AS event_key, CASE WHEN k % 2 = 0 THEN pid END AS start_key
       FROM r WHERE k % 10 <> 0
       UNION ALL
       SELECT record_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM r WHERE k % 10 = 0""",
)
def extended_items_of_all_kinds(spark, sf_dir):
    x = F.col("EventExtendedData")

    def stack(name: str):
        addresses = F.array_join(x[name]["Address"].cast("array<string>"), ",")
        return F.concat(x[name]["MatchId"].cast("string"), F.lit(":"), addresses)

    return decode_extended(_extended_raw(spark, sf_dir)).select(
        "record_id", x["SID"].alias("sid"), x["TSID"].alias("tsid"),
        x["InstanceInfo"]["InstanceId"].alias("instance_id"),
        x["InstanceInfo"]["ParentInstanceId"].cast("int").alias("parent_instance_id"),
        stack("StackTrace32").alias("stack32"), stack("StackTrace64").alias("stack64"),
        x["PebsIndex"].cast("string").alias("pebs_index"),
        F.array_join(x["PMCCounters"].cast("array<string>"), ",").alias("counters"),
        x["EventKey"].cast("bigint").alias("event_key"), x["StartKey"].cast("bigint").alias("start_key"),
    )


# --- errors and output modes ----------------------------------------------------------


@query(
    "error_flags",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS n,
         CAST(count(*) FILTER (unknown) AS BIGINT) AS record_errors,
         CAST(count(*) FILTER (field_error) AS BIGINT) AS field_errors FROM r GROUP BY 1""",
)
def error_flags(spark, sf_dir):
    kind = (
        F.when(F.col("event_id") == 3, "error")
        .when(F.col("EventHeader.ProviderId") == C.WEB_CLIENT_PROVIDER, F.when(F.col("event_id") == 1, "click").otherwise("view"))
        .otherwise(F.when(F.col("event_id") == 1, "signup").otherwise("purchase"))
    )
    return (
        _decoded(spark, sf_dir)
        .groupBy(kind.alias("event_type"))
        .agg(
            F.count("*").alias("n"),
            F.count_if("record_parse_error").alias("record_errors"),
            F.count_if("field_parse_error").alias("field_errors"),
        )
    )


@query(
    "unknown_events_pass_task_filter",
    "SELECT record_id, task AS task_name, unknown AS record_parse_error FROM t WHERE unknown OR kind_name = 'PROCESSSTART'",
)
def unknown_events_pass_task_filter(spark, sf_dir):
    kept = _decoded(spark, sf_dir, task_names=("PROCESSSTART",))
    return kept.select("record_id", "task_name", "record_parse_error")


@query(
    "quarantine_split",
    """SELECT any_error AS quarantined, task AS task_name, CAST(count(*) AS BIGINT) AS n,
         CAST(count(*) FILTER (any_error) AS BIGINT) AS with_bytes FROM t GROUP BY 1, 2""",
)
def quarantine_split(spark, sf_dir):
    path = os.path.join(live.shared_folder(spark, "quarantine"), "events")
    modes.write_quarantine(_decoded(spark, sf_dir, mode=2), path)
    return (
        modes.read_quarantine(spark, path)
        .groupBy("quarantined", "task_name")
        .agg(F.count("*").alias("n"), F.count("UserData").alias("with_bytes"))
    )


_MODE_SQL = """SELECT record_id, {task} AS task_name, {fields} AS n_fields, {raw} AS has_bytes,
  {description} AS description FROM (SELECT *,
    CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 3 WHEN 'signup' THEN 6 WHEN 'purchase' THEN 5
      ELSE CASE WHEN unknown OR k % 3 = 0 THEN 0 ELSE 1 END END AS n,
    CASE WHEN NOT unknown THEN CASE WHEN event_type = 'error' THEN 'An error occurred' ELSE '' END END AS message
  FROM t)"""


def _mode(mode: int):
    def run(spark, sf_dir):
        return _decoded(spark, sf_dir, mode=mode).select(
            "record_id",
            "task_name",
            F.size("payload").alias("n_fields"),
            F.col("UserData").isNotNull().alias("has_bytes"),
            "description",
        )

    return run


query(
    "mode_decoded", _MODE_SQL.format(task="task", fields="n", raw="false", description="message")
)(_mode(0))
query(
    "mode_raw",
    _MODE_SQL.format(
        task="provider", fields="CAST(NULL AS INT)", raw="true", description="CAST(NULL AS VARCHAR)"
    ),
)(_mode(1))
query(
    "mode_raw_on_error",
    _MODE_SQL.format(task="task", fields="n", raw="any_error", description="message"),
)(_mode(2))
query(
    "mode_only_raw_on_error",
    _MODE_SQL.format(
        task="CASE WHEN field_error THEN provider ELSE task END",
        fields="CASE WHEN NOT field_error THEN n END",
        raw="any_error",
        description="CASE WHEN NOT field_error THEN message END",
    ),
)(_mode(4))


@query(
    "mode_unformatted",
    "SELECT 0 AS event_id, record_id, provider AS provider_id, id, flags, pid AS process_id FROM r",
)
def mode_unformatted(spark, sf_dir):
    every = _decoded(spark, sf_dir, mode=8, event_ids=(2,), pid_allow=(1,), task_names=("NONE",))
    return every.select("event_id", "record_id", *_h("ProviderId", "Id", "Flags", "ProcessId"))


# --- sinks ----------------------------------------------------------------------------


@query(
    "event_lines",
    f"""SELECT record_id, '1 (WININET_READDATA)' || chr(10) || '{{"EventHeader":{{"Size":0,"HeaderType":0,"Flags":' || flags
         || ',"EventProperty":0,"ThreadId":' || event_id % 64 || ',"ProcessId":' || pid || ',"TimeStamp":' || ticks
         || ',"ProviderId":"' || provider || '","EventDescriptor":{{"Id":1,"Version":0,"Channel":0,"Level":4,"Opcode":0,'
         || '"Task":0,"Keyword":1}},"KernelTime":0,"UserTime":0,"ActivityId":"{C.NULL_GUID}"}},"Task Name":"WININET_READDATA",'
         || '"Request":"0x' || upper(to_hex(event_id)) || '","Size":"' || k || '","Description":""}}' AS line
       FROM r WHERE event_type = 'click'""",
)
def event_lines(spark, sf_dir):
    return sinks.format_event(_decoded(spark, sf_dir).where("task_name = 'WININET_READDATA'"))


@query(
    "log_file",
    """SELECT id || ' (' || task || ')' AS head, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY 1""",
)
def log_file(spark, sf_dir):
    path = os.path.join(live.shared_folder(spark, "log"), "events")
    sinks.to_log(_decoded(spark, sf_dir), path)
    lines = spark.read.text(path).where(F.col("value").rlike(r"^[0-9]+ \("))
    return lines.groupBy(F.col("value").alias("head")).agg(F.count("*").alias("n"))


@query(
    "log_of_batches",
    """SELECT CAST(record_id % 4 AS BIGINT) AS batch, id || ' (' || task || ')' AS head, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY 1, 2""",
)
def log_of_batches(spark, sf_dir):
    """A log by batch: the second batch fails after it was logged, and is run again."""
    folder = live.shared_folder(spark, "batch-log")
    (path, n), log, fails = _arrivals(spark, sf_dir, F.col("record_id") % 4, 4), sinks.BatchLog(f"{folder}/log"), [True]

    def save(batch: DataFrame, batch_id: int) -> None:
        log(batch, batch_id)
        if batch_id == 1 and fails.pop():
            fails.append(False)
            raise InterruptedError("not this time")

    for _ in range(2):
        session = live.Capture(
            read_events_stream(spark, path, n), Trace(_manifest(spark)), save, checkpoint=f"{folder}/checkpoint",
            trigger={"availableNow": True},
        )
        session.start()
        try:
            session.wait()
        except StreamingQueryException as e:
            if "not this time" not in str(e):
                raise
    lines = log.lines(spark).where(F.col("value").rlike(r"^[0-9]+ \("))
    return lines.groupBy("batch", F.col("value").alias("head")).agg(F.count("*").alias("n"))


@query("events_in_memory", "SELECT task AS task_name, CAST(count(*) AS BIGINT) AS n FROM t GROUP BY 1")
def events_in_memory(spark, sf_dir):
    table = sinks.to_memory(_decoded(spark, sf_dir), "captured_events")
    return table.groupBy("task_name").agg(F.count("*").alias("n"))


# --- lookups --------------------------------------------------------------------------


@query(
    "first_event_of_task",
    "SELECT record_id, ticks AS time_stamp FROM r WHERE event_type = 'signup' ORDER BY ticks, record_id LIMIT 1",
)
def first_event_of_task(spark, sf_dir):
    first = _raw(spark, sf_dir).transform(lookup.first_event("PROCESSSTART", Trace(_manifest(spark))))
    return first.select("record_id", F.col("EventHeader.TimeStamp").alias("time_stamp"))


@query("all_events_of_task", "SELECT record_id, pid AS process_id FROM r WHERE event_type = 'purchase'")
def all_events_of_task(spark, sf_dir):
    found = _raw(spark, sf_dir).transform(lookup.all_events("PROCESSSTOP", Trace(_manifest(spark))))
    return found.select("record_id", F.col("EventHeader.ProcessId").alias("process_id"))


@query("chronological_order", "SELECT record_id, ticks AS time_stamp FROM r ORDER BY ticks, record_id")
def chronological_order(spark, sf_dir):
    return lookup.chronological(_raw(spark, sf_dir)).select("record_id", *_h("TimeStamp"))


# --- streams --------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The ``events`` table as a file-drop stream of raw records."""
    reader = spark.readStream.schema(sample.EVENTS).option("pathGlobFilter", "events.parquet")
    parts = sample.tasks(sample.read_source(spark, sf_dir, 1))
    return sample.raw_events(sample.spread(reader.options(**options).parquet(sf_dir), parts))


def _run(spark, records, transform, **more) -> DataFrame:
    """Capture everything that is there; events of each batch go to their own folder.

    A batch that is run again after a failure overwrites its folder, so nothing doubles.
    """
    folder = live.shared_folder(spark, "capture")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/events/batch={batch_id}")

    session = live.Capture(
        records, transform, save, trigger={"availableNow": True}, **more
    )
    session.start()
    session.wait()
    return spark.read.parquet(f"{folder}/events").drop("batch")


_STREAMED = "SELECT record_id, id AS event_id, task AS task_name, unknown AS record_parse_error FROM t "


def _streamed(df: DataFrame) -> DataFrame:
    return df.select("record_id", "event_id", "task_name", "record_parse_error")


@query("live_capture", _STREAMED + "WHERE id IN (1, 3)")
def live_capture(spark, sf_dir):
    return _streamed(_run(spark, _stream(spark, sf_dir), Trace(_manifest(spark), event_ids=(1, 3))))


def _files(spark: SparkSession, sf_dir: str) -> int:
    """Files in a batch of a throttled stream that takes the records in four."""
    return -(-sample.tasks(sample.read_source(spark, sf_dir, 1)) // 4)


def _dropped(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """The records in four times so many files, and how many of them are a batch of a throttled stream."""
    path = os.path.join(live.shared_folder(spark, "drop"), "raw_events")
    n = _files(spark, sf_dir)
    if n == 1:
        _raw(spark, sf_dir).repartition(4).write.parquet(path)
    else:
        sample.raw_events(sample.read_source(spark, sf_dir, 4 * n)).write.parquet(path)
        _filled(spark, path, 4 * n)
    return path, n


def _filled(spark: SparkSession, path: str, n: int) -> None:
    """Add files without records until there are ``n``: a task without rows writes none."""
    there = sum(name.endswith(".parquet") for name in files.names(spark, path))
    for _ in range(n - there):
        local_table(spark, [], RAW_EVENTS).write.mode("append").parquet(path)


@query("file_drop_stream", _STREAMED)
def file_drop_stream(spark, sf_dir):
    return _streamed(_run(spark, read_events_stream(spark, *_dropped(spark, sf_dir)), Trace(_manifest(spark))))


@query(
    "throttled_capture",
    "SELECT count(*) AS n, 4 AS batches, CAST(sum(record_id) AS BIGINT) AS ids, true AS paced FROM t",
)
def throttled_capture(spark, sf_dir):
    """A fourth of the files a trigger: four batches, none sooner than the interval allows."""
    path, n = _dropped(spark, sf_dir)
    options, trigger = live.throttle(n, "1 second")
    folder = live.shared_folder(spark, "throttled")
    starts: list[float] = []

    def save(batch: DataFrame, batch_id: int) -> None:
        starts.append(time.monotonic())
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    records = read_events_stream(spark, path, options["maxFilesPerTrigger"])
    with live.Capture(records, Trace(_manifest(spark)), save, trigger=trigger):
        pass
    done = spark.read.parquet(folder)
    paced = starts[-1] - starts[0] >= 2
    return done.agg(
        F.count("*").alias("n"), F.count_distinct("batch").cast("int").alias("batches"),
        F.sum("record_id").alias("ids"),
    ).withColumn("paced", F.lit(paced))


@query(
    "rules_between_batches",
    "SELECT count(*) > 0 AS free_first, true AS no_rule_first, true AS only_allowed_later FROM r WHERE pid = 3",
)
def rules_between_batches(spark, sf_dir):
    """No rules at the start; an allow list from the second batch on."""
    rules = PidRules(spark, os.path.join(live.shared_folder(spark, "rules"), "pid_rules"))
    folder = live.shared_folder(spark, "ruled")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        if batch_id == 0:
            rules.add("allow", 3)

    records = read_events_stream(spark, *_dropped(spark, sf_dir))
    session = live.Capture(
        records, lambda raw: raw.select("record_id", "ProcessId"), save, trigger={"availableNow": True},
        batch_filter=live_rules(rules.path),
    )
    session.start()
    session.wait()
    done = spark.read.parquet(folder)
    first, mine = F.col("batch") == 0, F.col("ProcessId") == 3
    return done.agg(
        (F.count_if(first) > 0).alias("free_first"), (F.count_if(first & ~mine) > 0).alias("no_rule_first"),
        (F.count_if(~first & ~mine) == 0).alias("only_allowed_later"),
    )


@query("live_pid_rules", _STREAMED + "WHERE pid IN (1, 4)")
def live_pid_rules(spark, sf_dir):
    rules = PidRules(spark, os.path.join(live.shared_folder(spark, "rules"), "pid_rules"))
    rules.add("allow", 9)
    rules.reset("allow")
    rules.add("allow", 1, 2, 4)
    rules.add("deny", 1)
    rules.remove("allow", 2)
    trace = Trace(_manifest(spark))
    return _streamed(_run(spark, _stream(spark, sf_dir), trace, batch_filter=live_rules(rules.path)))


@query(
    "capture_counters",
    """SELECT CAST(4 AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS input_rows,
         CAST(count(*) FILTER (id <> 2) AS BIGINT) AS events, CAST(count(*) FILTER (id = 2) AS BIGINT) AS dropped,
         CAST(count(*) FILTER (unknown) AS BIGINT) AS record_errors,
         CAST(count(*) FILTER (field_error AND id <> 2) AS BIGINT) AS field_errors FROM t""",
)
def capture_counters(spark, sf_dir):
    """Several batches, some rows dropped by a filter."""
    trace = Trace(_manifest(spark), event_ids=(1, 3))
    session = live.Capture(
        read_events_stream(spark, *_dropped(spark, sf_dir)),
        lambda raw: live.observed(trace(raw)),
        lambda batch, _: batch.write.format("noop").mode("overwrite").save(),
        trigger={"availableNow": True},
    )
    session.start()
    session.wait()
    names = ("input_rows", "events", "dropped", "record_errors", "field_errors")
    batches = F.count("*").alias("batches")
    return session.counters().agg(batches, *[F.sum(c).cast("bigint").alias(c) for c in names])


@query("stream_replay", _STREAMED)
def stream_replay(spark, sf_dir):
    folder = live.shared_folder(spark, "replay")
    trace = Trace(_manifest(spark))
    done = live.replay(_stream(spark, sf_dir), trace, f"{folder}/events", f"{folder}/checkpoint")
    return _streamed(done)


@query(
    "custom_record_handler",
    "SELECT provider AS provider_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM r GROUP BY 1",
)
def custom_record_handler(spark, sf_dir):
    mine = _run(spark, _stream(spark, sf_dir), lambda raw: raw.select("record_id", "ProviderId"))
    return mine.groupBy(F.col("ProviderId").alias("provider_id")).agg(
        F.count("*").alias("n"), F.sum("record_id").alias("ids")
    )


@query(
    "event_callback",
    """SELECT record_id, CASE WHEN pid % 97 = 5 THEN 'failed' ELSE 'handled' END AS status,
         CASE WHEN pid % 97 <> 5 THEN id || ':' || task || ':' || pid END AS result,
         CASE WHEN pid % 97 = 5 THEN 'ValueError: not process ' || pid END AS error FROM t""",
)
def event_callback(spark, sf_dir):
    """A function for each event that fails on some; the capture is run twice, which delivers nothing twice."""

    def handle(event_id: int, event: dict) -> str:
        pid = event["EventHeader"]["ProcessId"]
        if pid % 97 == 5:
            raise ValueError(f"not process {pid}")
        return f"{event_id}:{event['Task Name']}:{pid}"

    folder, (path, n) = live.shared_folder(spark, "callback"), _dropped(spark, sf_dir)
    for _ in range(2):
        events = Trace(_manifest(spark))(read_events_stream(spark, path, n))
        live.to_event_callback(
            events, handle, f"{folder}/outcomes", f"{folder}/checkpoint", {"availableNow": True}
        ).awaitTermination()
    done = Delivery(f"{folder}/outcomes", handle).outcomes(spark)
    return done.select("record_id", "status", "result", "error")


def _arrivals(spark: SparkSession, sf_dir: str, part, parts: int) -> tuple[str, int]:
    """The records in ``parts`` arrivals that come one after the other, and the number of files of each.

    Arrival ``i`` has the records with ``part`` = i.
    """
    path = os.path.join(live.shared_folder(spark, "arrivals"), "raw_events")
    n = _files(spark, sf_dir)
    raw = sample.raw_events(sample.read_source(spark, sf_dir, n))
    for i in range(parts):
        mine = raw.where(part == i)
        (mine.coalesce(1) if n == 1 else mine).write.mode("append").parquet(path)
        _filled(spark, path, n * (i + 1))
    return path, n


# Each third of the records is a session of its own, with numbers from 0 on.
_NUMBERED = """SELECT CAST(event_id % 3 AS VARCHAR) AS session, event_id // 3 AS number FROM e
  WHERE event_id % 7 <> 3 AND event_id % 1000 NOT BETWEEN 500 AND 520"""


def _losses(spark: SparkSession, sf_dir: str) -> LossLog:
    """Some records never come, some come twice; the capture is started again between batches."""
    folder = live.shared_folder(spark, "losses")
    path, n = _arrivals(spark, sf_dir, F.col("record_id") % 4, 4)
    lost = (F.col("record_id") % 7 == 3) | (F.col("record_id") % 1000).between(500, 520)
    log = LossLog(f"{folder}/bitmaps", F.col("record_id") % 3, "number")
    stops = [True]

    def note(batch: DataFrame, batch_id: int) -> None:
        came = batch.where(~lost).withColumn("number", F.floor(F.col("record_id") / 3))
        log(came.unionByName(came.where("record_id % 11 = 0")), batch_id)
        if batch_id == 2 and stops.pop():
            raise InterruptedError("stopped between two batches")

    for _ in range(2):
        query_ = (
            read_events_stream(spark, path, n).writeStream.foreachBatch(note)
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        try:
            query_.awaitTermination()
        except StreamingQueryException as e:
            if "stopped between two batches" not in str(e):
                raise
        else:
            break
        stops.append(False)
    return log


@query(
    "lost_events",
    f"""SELECT session, min(number) AS first, max(number) AS last, CAST(count(*) AS BIGINT) AS received,
          CAST(count(*) FILTER ((number * 3 + CAST(session AS BIGINT)) % 11 = 0) AS BIGINT) AS repeated,
          max(number) - min(number) + 1 - CAST(count(*) AS BIGINT) AS lost FROM ({_NUMBERED}) GROUP BY session""",
)
def lost_events(spark, sf_dir):
    return _losses(spark, sf_dir).report(spark)


@query(
    "lost_event_numbers",
    f"""SELECT session, record_id FROM (
          SELECT session, unnest(range(min(number), max(number) + 1)) AS record_id FROM ({_NUMBERED}) GROUP BY session
        ) ANTI JOIN (SELECT session, number AS record_id FROM ({_NUMBERED})) USING (session, record_id)""",
)
def lost_event_numbers(spark, sf_dir):
    return _losses(spark, sf_dir).lost_numbers(spark)


@query(
    "paced_by_records",
    """SELECT CAST(batch AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n, CAST(sum(record_id) AS BIGINT) AS ids,
         CAST(1 + (batch = 2)::INT AS BIGINT) AS runs FROM (
           SELECT record_id, (row_number() OVER (ORDER BY half, record_id) - 1) // ((count(*) OVER () + 4) // 5) AS batch
           FROM (SELECT record_id, record_id % 2 AS half FROM r)
         ) GROUP BY batch""",
)
def paced_by_records(spark, sf_dir):
    """A record log of two appends, read in five batches of equal size; the third fails once and comes again."""
    folder = live.shared_folder(spark, "record-log")
    source = sample.read_source(spark, sf_dir, 1)
    n = max(3, sample.tasks(source))
    for half in range(2):
        mine = source.where(F.col("event_id") % 2 == half)
        mine = mine.repartitionByRange(n, "event_id").sortWithinPartitions("event_id")
        record_log.append(sample.raw_events(mine), f"{folder}/log")
    size = -(-source.count() // 5)
    runs: Counter[int] = Counter()

    def save(batch: DataFrame, batch_id: int) -> None:
        runs[batch_id] += 1
        batch.select("record_id").write.mode("overwrite").parquet(f"{folder}/batches/batch={batch_id}")
        if batch_id == 2 and runs[2] == 1:
            raise InterruptedError("not this time")

    for _ in range(2):
        stream = record_log.read_log_stream(
            spark, f"{folder}/log", progress=f"{folder}/progress", records_per_batch=size,
            records_per_task=min(-(-size // 4), sample.ROWS),
        )
        query_ = (
            stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(processingTime="0 seconds").start()
        )
        try:
            query_.processAllAvailable()
        except StreamingQueryException as e:
            if "not this time" not in str(e):
                raise
        finally:
            query_.stop()
    done = spark.read.schema("record_id BIGINT, batch BIGINT").parquet(f"{folder}/batches")
    counted = done.groupBy("batch").agg(F.count("*").alias("n"), F.sum("record_id").alias("ids"))
    return counted.withColumn("runs", F.element_at(F.create_map(*[F.lit(x).cast("bigint") for kv in runs.items() for x in kv]), F.col("batch")))


_DELAY = 36_000_000_000 * 24 * 3


@query(
    "ordered_stream",
    f"""SELECT batch, CAST(count(*) FILTER (given_in = batch AND NOT late) AS BIGINT) AS came_and_given,
          CAST(count(*) FILTER (late) AS BIGINT) AS late, CAST(count(*) FILTER (NOT late AND given_in > batch) AS BIGINT) AS held_first,
          true AS in_order
        FROM (
          SELECT r.batch, r.ticks <= coalesce((SELECT max(until) FROM marks m WHERE m.batch < r.batch), -1) AS late,
            coalesce((SELECT min(m.batch) FROM marks m WHERE m.batch >= r.batch AND r.ticks <= m.until), 4) AS given_in
          FROM (SELECT *, least(CAST(3 AS BIGINT), event_id * 4 // (SELECT max(event_id) + 1 FROM e)) AS batch FROM e) r
        ) GROUP BY batch""",
)
def ordered_stream(spark, sf_dir):
    """Records that come out of order in four batches; what a batch gives is in order, also against the one before."""
    folder = live.shared_folder(spark, "ordered")
    top = sample.read_source(spark, sf_dir).agg(F.max("event_id")).first()[0] + 1
    part = F.least(F.lit(3), F.floor(F.col("record_id") * 4 / top))
    path, n = _arrivals(spark, sf_dir, part, 4)

    def save(batch: DataFrame, batch_id: int) -> None:
        placed = batch.select("record_id", "TimeStamp", F.monotonically_increasing_id().alias("place"))
        placed.write.mode("overwrite").parquet(f"{folder}/given/batch={batch_id}")

    ordered = Reorder(save, f"{folder}/state", _DELAY)
    (
        read_events_stream(spark, path, n).writeStream.foreachBatch(ordered)
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    )
    ordered.flush(spark)
    given = spark.read.schema("record_id BIGINT, TimeStamp BIGINT, place BIGINT, batch BIGINT").parquet(f"{folder}/given")
    part = F.least(F.lit(3), F.floor(F.col("record_id") * 4 / top)).alias("came")
    # Windows of a batch's range partitions and of whole batches: neighbours in time order.
    within = Window.partitionBy("batch", F.shiftright("place", 33)).orderBy("place")
    steps = given.withColumn("before", F.lag("TimeStamp").over(within)).where("before > TimeStamp")
    edges = given.groupBy("batch", F.shiftright("place", 33).alias("piece")).agg(F.min("TimeStamp").alias("low"), F.max("TimeStamp").alias("high"))
    pieces = edges.withColumn("before", F.lag("high").over(Window.orderBy("batch", "piece"))).where("before > low")
    in_order = steps.isEmpty() and pieces.isEmpty()
    counted = given.select("batch", part).groupBy(F.col("came").alias("batch")).agg(
        F.count_if(F.col("batch") == F.col("came")).alias("came_and_given"), F.count_if(F.col("batch") > F.col("came")).alias("held_first")
    )
    late = ordered.late(spark).select(part).groupBy(F.col("came").alias("batch")).agg(F.count("*").alias("late"))
    return counted.join(late, "batch", "full").select(
        "batch", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("came_and_given", "held_first", "late")], F.lit(in_order).alias("in_order")
    )


SQL["ordered_stream"] = SQL["ordered_stream"].replace(
    ")\nSELECT batch,",
    f"""), marks AS (
  SELECT batch, CASE WHEN batch = 4 THEN newest ELSE newest - {_DELAY} END AS until FROM (
    SELECT b AS batch, max(ticks) AS newest FROM range(5) x(b), (
      SELECT ticks, least(CAST(3 AS BIGINT), event_id * 4 // (SELECT max(event_id) + 1 FROM e)) AS batch FROM e
    ) f WHERE f.batch <= b GROUP BY b)
)\nSELECT batch,""",
    1,
)


@query(
    "pinned_rules",
    """SELECT batch, CAST(count(*) AS BIGINT) AS n, CAST(sum(record_id) AS BIGINT) AS ids, CAST(1 + (batch = 1)::INT AS BIGINT) AS runs
       FROM (SELECT *, record_id % 4 AS batch FROM r) WHERE CASE WHEN batch <= 1 THEN pid % 5 <> 1 ELSE pid % 5 = 2 END GROUP BY batch""",
)
def pinned_rules(spark, sf_dir):
    """Rules change while a batch runs and then fails: run again, it sees the rules it began with."""
    folder = live.shared_folder(spark, "pinned")
    rules = PidRules(spark, f"{folder}/rules")
    pids = sorted(r.user_id for r in sample.read_source(spark, sf_dir).select("user_id").distinct().collect())
    rules.add("deny", *[p for p in pids if p % 5 == 1])
    path, n = _arrivals(spark, sf_dir, F.col("record_id") % 4, 4)
    runs: Counter[int] = Counter()

    def save(batch: DataFrame, batch_id: int) -> None:
        runs[batch_id] += 1
        batch.write.mode("overwrite").parquet(f"{folder}/kept/batch={batch_id}")
        if batch_id == 1 and runs[1] == 1:
            rules.add("allow", *[p for p in pids if p % 5 == 2])
            rules.compact()
            raise InterruptedError("not this time")

    for _ in range(2):
        session = live.Capture(
            read_events_stream(spark, path, n), lambda raw: raw.select("record_id", "ProcessId"), save,
            checkpoint=f"{folder}/checkpoint", trigger={"availableNow": True}, batch_filter=live_rules(rules.path),
        )
        session.start()
        try:
            session.wait()
        except StreamingQueryException as e:
            if "not this time" not in str(e):
                raise
    kept = spark.read.schema("record_id BIGINT, batch BIGINT").parquet(f"{folder}/kept")
    counted = kept.groupBy("batch").agg(F.count("*").alias("n"), F.sum("record_id").alias("ids"))
    return counted.withColumn("runs", F.element_at(F.create_map(*[F.lit(x).cast("bigint") for kv in runs.items() for x in kv]), F.col("batch")))


# --- validation -----------------------------------------------------------------------


@query("validation_report")
def validation_report(spark, sf_dir):
    seen = {
        "WININET_READDATA", "WININET_CONNECT", "WININET_DNS_QUERY", "WININET_HTTP_RESPONSE",
        "MICROSOFT-WINDOWS-WININET-CAPTURE", "THREADSTART",
    }
    rules = [r for r in validate.standard_rules() if r.task in seen]
    rules.append(validate.ip_valid("WININET_CONNECT", "Protocol"))
    return _events_from_text(spark, sf_dir).transform(validate.validate(rules))


def _verdicts() -> str:
    """SQL of the report: task, rule, which rows it looks at, which of them fail."""
    bad_ip = "(k * 3 > 255)"
    big = "(k % 13 = 0)"
    codes = ", ".join(map(str, C.HTTP_STATUS_CODES))
    rows = [
        ("WININET_READDATA", "required_fields", "true", "false"),
        ("WININET_READDATA", "field_count", "true", "false"),
        ("WININET_READDATA", "handle:Request", "true", big),
        ("WININET_READDATA", "between:Size", "true", "(k * 170 > 16384)"),
        ("WININET_CONNECT", "field_count", "true", "false"),
        ("WININET_CONNECT", "handle:Request", "true", big),
        ("WININET_CONNECT", "port:Socket", "true", "(53000 + user_id > 65535)"),
        ("WININET_CONNECT", "required_fields_of_variant", "true", "false"),
        ("WININET_CONNECT", "address_port:LocalAddress", "(k % 6 <> 0)", f"({bad_ip} OR k % 5 = 0)"),
        ("WININET_CONNECT", "address:RemoteAddress", "(k % 4 <> 0)", "(k % 9 = 1)"),
        ("WININET_DNS_QUERY", "required_fields_of_variant", "true", "false"),
        ("WININET_HTTP_RESPONSE", "between:ContentLength", "true", "(cents < 0)"),
        ("WININET_CONNECT", "ip:Protocol", "true", "true"),
        ("WININET_DNS_QUERY", "field_count", "true", "false"),
        ("WININET_DNS_QUERY", "required_fields", "true", "false"),
        ("WININET_DNS_QUERY", "length:HostName", "true", "false"),
        ("WININET_DNS_QUERY", "between:_HostNameLength", "true", "false"),
        ("WININET_DNS_QUERY", "handle:RequestHandle", "true", big),
        ("WININET_DNS_QUERY", "length:AddressList", "true", "(k % 8 = 0)"),
        ("WININET_DNS_QUERY", "address_list:AddressList", "true", bad_ip),
        ("WININET_HTTP_RESPONSE", "required_fields", "true", "false"),
        ("WININET_HTTP_RESPONSE", "field_count", "true", "false"),
        ("WININET_HTTP_RESPONSE", "http_status:ResponseCode", "true", f"(195 + k % 40 NOT IN ({codes}))"),
        ("WININET_HTTP_RESPONSE", "handle:RequestHandle", "true", big),
        ("WININET_HTTP_RESPONSE", "http_verb:Verb", "true", "(k % 6 = 0)"),
        ("WININET_HTTP_RESPONSE", "length:Verb", "true", "(k % 6 = 0)"),
        ("WININET_HTTP_RESPONSE", "length:ContentLength", "true", "false"),
        ("MICROSOFT-WINDOWS-WININET-CAPTURE", "required_fields", "true", "false"),
        ("MICROSOFT-WINDOWS-WININET-CAPTURE", "field_count", "true", "(k % 4 <> 0)"),
        ("MICROSOFT-WINDOWS-WININET-CAPTURE", "payload_bytes:Payload", "true", "(k % 4 = 0 AND k % 3 > 0)"),
    ]
    parts = [
        f"""SELECT '{task}' AS task, '{rule}' AS rule, CAST(count(*) FILTER ({looks}) AS BIGINT) AS checked,
              CAST(count(*) FILTER ({looks} AND {fails}) AS BIGINT) AS failed FROM d WHERE dump_task = '{task}'"""
        for task, rule, looks, fails in rows
    ]
    parts += [f"SELECT 'THREADSTART', '{rule}', 0, 0" for rule in ("required_fields", "field_count")]
    return "\nUNION ALL ".join(parts)


SQL["validation_report"] = _DUMP + _verdicts()


@query(
    "address_validity",
    """SELECT record_id, k * 3 <= 255 AS v4_ok, k % 4 <> 3 AS v6_ok FROM r""",
)
def address_validity(spark, sf_dir):
    source = sample.with_helpers(sample.read_source(spark, sf_dir))
    k, user = F.col("k"), F.col("user_id")
    v4 = F.concat(F.lit("10.0."), k * 3, F.lit("."), user % 256)
    v6 = (
        F.when(k % 4 == 0, F.concat(F.lit("fe80::"), F.lower(F.hex(user))))
        .when(k % 4 == 1, F.concat(F.lit("::ffff:10.0.0."), user % 256))
        .when(k % 4 == 2, F.concat_ws(":", *[F.lower(F.hex(user + i)) for i in range(8)]))
        .otherwise(F.concat(F.lit("1::"), F.hex(user), F.lit("::2")))
    )
    return source.select(
        F.col("event_id").alias("record_id"),
        validate.is_ip(v4).alias("v4_ok"),
        validate.is_ip(v6).alias("v6_ok"),
    )


@query(
    "catalog_conformance",
    f"""SELECT task, field, finding FROM (
          SELECT DISTINCT regexp_replace(c.task, '_?(START|STOP|FAIL|[0-9]+)+$', '') AS task, c.field, 'not_in_catalog' AS finding
            FROM r JOIN ({_CATALOG}) c USING (event_type) WHERE c.field IN ('Amount', 'Flags')
          UNION
          SELECT DISTINCT 'WININET_READDATA', 'Extra', 'not_seen' FROM r WHERE event_type = 'click')""",
)
def catalog_conformance(spark, sf_dir):
    """Checked against a catalog taken from the events, less two fields and plus one."""
    decoded = _decoded(spark, sf_dir)
    known = parse_field_catalog(_catalog_blocks(decoded)).where(~F.col("field").isin("Amount", "Flags"))
    known = known.select("task", "field").distinct()
    read = known.where("task = 'WININET_READDATA'").select("task", F.lit("Extra").alias("field")).distinct()
    return decoded.transform(validate.catalog_conformance(known.unionByName(read)))
