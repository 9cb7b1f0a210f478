"""Column functions; every one is a composition of Spark built-ins."""

from traceframe.functions.bits import (
    be_uint,
    hex_text,
    ieee_double,
    ieee_float,
    le_bytes,
    le_uint,
    sign_extend,
    unsigned_decimal,
    unsigned_text,
)
from traceframe.functions.guid import guid_bytes, guid_norm, guid_text, is_null_guid, norm_guid
from traceframe.functions.text import (
    filetime_text,
    ipv4_text,
    ipv6_text,
    sid_text,
    systemtime_text,
    ticks_to_timestamp,
    to_bool,
    utf16_bytes,
)

__all__ = [
    "be_uint",
    "filetime_text",
    "guid_bytes",
    "guid_norm",
    "guid_text",
    "hex_text",
    "ieee_double",
    "ieee_float",
    "ipv4_text",
    "ipv6_text",
    "is_null_guid",
    "le_bytes",
    "le_uint",
    "norm_guid",
    "sid_text",
    "sign_extend",
    "systemtime_text",
    "ticks_to_timestamp",
    "to_bool",
    "unsigned_decimal",
    "unsigned_text",
    "utf16_bytes",
]
