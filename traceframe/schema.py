"""Spark schemas (DDL) of the raw table, the manifest tables and the control tables."""

EXTENDED_ITEM = "STRUCT<ExtType: INT, DataSize: INT, Data: BINARY>"

RAW_EVENTS = f"""
    record_id BIGINT, is_kernel BOOLEAN,
    Size INT, HeaderType INT, Flags INT, EventProperty INT,
    ThreadId BIGINT, ProcessId BIGINT, TimeStamp BIGINT, ProviderId STRING,
    Id INT, Version SMALLINT, Channel SMALLINT, Level SMALLINT, Opcode SMALLINT,
    Task INT, Keyword BIGINT, KernelTime BIGINT, UserTime BIGINT, ActivityId STRING,
    ExtendedData ARRAY<{EXTENDED_ITEM}>, UserData BINARY
"""

HEADER_COLUMNS = (
    "Size", "HeaderType", "Flags", "EventProperty", "ThreadId", "ProcessId",
    "TimeStamp", "ProviderId", "Id", "Version", "Channel", "Level", "Opcode", "Task",
    "Keyword", "KernelTime", "UserTime", "ActivityId",
)

MANIFEST_EVENT = """
    ProviderId STRING, Id INT, Version SMALLINT, ProviderName STRING, TaskName STRING,
    EventMessage STRING, kernel_group BIGINT
"""

MANIFEST_PROPERTY = """
    ProviderId STRING, Id INT, Version SMALLINT, ordinal INT, name STRING, flags INT,
    in_type INT, out_type INT, map_name STRING, count INT, count_index INT,
    length INT, length_index INT, struct_start INT, struct_members INT,
    top_level BOOLEAN
"""

MANIFEST_MAP = """
    ProviderId STRING, map_name STRING, is_bitmap BOOLEAN, value BIGINT, label STRING
"""

MANIFEST_KEYWORD = "ProviderId STRING, keyword STRING, mask BIGINT"

PROVIDERS = "name STRING, ProviderId STRING, level INT, any_mask BIGINT, all_mask BIGINT"

PID_RULES = "kind STRING, pid BIGINT"

EXTENDED_DATA = """
    STRUCT<RelatedActivityID: STRING, SID: STRING, TSID: BIGINT,
           InstanceInfo: STRUCT<InstanceId: BIGINT, ParentInstanceId: BIGINT,
                                ParentGuid: STRING>,
           StackTrace32: STRUCT<MatchId: DECIMAL(20,0), Address: ARRAY<BIGINT>>,
           StackTrace64: STRUCT<MatchId: DECIMAL(20,0), Address: ARRAY<DECIMAL(20,0)>>,
           PebsIndex: DECIMAL(20,0), PMCCounters: ARRAY<DECIMAL(20,0)>,
           EventKey: DECIMAL(20,0), StartKey: DECIMAL(20,0)>
"""
