"""Text rules: UTF-16 and 8-bit strings, truth values, addresses, times, SIDs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traceframe.constants import UNIX_EPOCH_TICKS
from traceframe.functions.bits import be_uint, le_uint, let, unsigned_text

NUL = "\0"
TICKS_PER_SECOND = 10_000_000

# Hex text up to (not including) the first aligned terminator. The group has a fixed
# width and is possessive, so Java matches it in a loop and long payloads cannot
# overflow its stack.
WIDE_UNTIL_NUL = "^(?:(?!0000)[0-9A-F]{4})*+"
NARROW_UNTIL_NUL = "^(?:(?!00)[0-9A-F]{2})*+"


def wide_text(digits: Column, around: Column | None = None) -> Column:
    """Hex digits of UTF-16LE text to a string that ends at the first NUL.

    ``around`` may be cheaper digits that contain ``digits``; only they are searched for
    signs of surrogates.

    ``decode`` fails the whole job on a lone surrogate, so text that may hold surrogates
    goes through JSON escapes instead, which turn a lone one into ``?``.
    """
    escaped = F.concat(
        F.lit('["'), F.regexp_replace(digits, "(..)(..)", r"\\u$2$1"), F.lit('"]')
    )
    careful = F.get(F.from_json(escaped, "array<string>"), 0)
    plain = F.decode(F.unhex(digits), "UTF-16LE")
    return F.substring_index(
        F.when((digits if around is None else around).rlike("D[89A-F]"), careful).otherwise(plain),
        NUL,
        1,
    )


def narrow_text(digits: Column) -> Column:
    """Hex digits of 8-bit text to a string that ends at the first NUL."""
    return F.substring_index(F.decode(F.unhex(digits), "ISO-8859-1"), NUL, 1)


def utf16_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-16LE")


def to_bool(text: Column) -> Column:
    """``1`` and ``true`` in any case are true, all other text is false."""
    return F.lower(text).isin("1", "true")


def is_int_text(text: Column) -> Column:
    return text.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$")


def ticks_to_timestamp(ticks: Column) -> Column:
    """100 ns ticks since 1601 to TIMESTAMP (microseconds)."""
    return F.timestamp_micros(F.floor((ticks - F.lit(UNIX_EPOCH_TICKS)) / F.lit(10)))


def filetime_text(ticks: Column) -> Column:
    """ISO text with all seven fractional digits; independent of the session zone."""
    seconds = F.call_function("div", ticks, F.lit(TICKS_PER_SECOND))
    start = F.expr("timestamp_ntz'1601-01-01 00:00:00'")
    whole = F.timestamp_add("SECOND", seconds, start).cast("string")
    rest = F.lpad((ticks % F.lit(TICKS_PER_SECOND)).cast("string"), 7, "0")
    return F.when(
        ticks >= 0,
        F.concat(F.translate(whole, " ", "T"), F.lit("."), rest, F.lit("Z")),
    )


def systemtime_text(data: Column, offset) -> Column:
    """Eight 16-bit numbers to ISO text; NULL when they are not a valid time."""
    year, month, _, day, hour, minute, second, milli = (
        le_uint(data, offset + 2 * i, 2).cast("int") for i in range(8)
    )
    whole = F.try_make_timestamp_ntz(
        year, month, day, hour, minute, second.cast("decimal(16,6)")
    ).cast("string")
    return F.when(
        (milli < 1000) & (second < 60),
        F.concat(
            F.translate(whole, " ", "T"),
            F.lit("."),
            F.lpad(milli.cast("string"), 3, "0"),
            F.lit("Z"),
        ),
    )


def ipv4_text(data: Column, offset) -> Column:
    octets = [be_uint(data, offset + i, 1).cast("string") for i in range(4)]
    return F.concat_ws(".", *octets)


def ipv6_text(data: Column, offset) -> Column:
    """Lower-case groups, the longest run of two or more zero groups as ``::``."""
    groups = F.concat_ws(
        ":", *[F.lower(F.hex(be_uint(data, offset + 2 * i, 2))) for i in range(8)]
    )

    def shorten(plain: Column) -> Column:
        out = plain
        for run in range(2, 9):
            pattern = rf"^(.*?)(?:^|:)0(?::0){{{run - 1}}}(?::|$)(.*)$"
            short = F.regexp_replace(plain, pattern, "$1::$2")
            out = F.when(plain.rlike(pattern), short).otherwise(out)
        return out

    return let(groups, shorten)


def sid_text(data: Column, offset) -> Column:
    """``S-<revision>-<authority>-<sub-authority>...`` from its binary form."""
    count = be_uint(data, offset + 1, 1).cast("int")
    subs = F.when(count == 0, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
            lambda i: unsigned_text(le_uint(data, i * 4 + offset + 8, 4)),
        )
    )
    head = F.concat(
        F.lit("S-"),
        be_uint(data, offset, 1).cast("string"),
        F.lit("-"),
        be_uint(data, offset + 2, 6).cast("string"),
    )
    return F.concat_ws("-", head, subs)


def sid_size(data: Column, offset) -> Column:
    """Bytes taken by a SID; NULL when its own count byte is out of reach."""
    return be_uint(data, offset + 1, 1).cast("int") * 4 + 8
