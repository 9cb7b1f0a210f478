"""Provider and activity ids: 16 bytes (first three groups little-endian) <-> text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traceframe.constants import NULL_GUID
from traceframe.functions.bits import slice_bytes

# Byte positions in the order in which the text form shows them.
_GROUPS = ((3, 2, 1, 0), (5, 4), (7, 6), (8, 9), (10, 11, 12, 13, 14, 15))


def guid_text(data: Column, offset=0) -> Column:
    """``{XXXXXXXX-XXXX-XXXX-XXXX-XXXXXXXXXXXX}``; NULL when fewer than 16 bytes."""
    parts = [F.lit("{")]
    for i, group in enumerate(_GROUPS):
        if i:
            parts.append(F.lit("-"))
        if i < 3:
            parts.extend(F.hex(slice_bytes(data, offset + at, 1)) for at in group)
        else:
            parts.append(F.hex(slice_bytes(data, offset + group[0], len(group))))
    parts.append(F.lit("}"))
    return F.when(F.length(data) - offset >= 16, F.concat(*parts))


def guid_norm(text: Column) -> Column:
    """Any spelling of an id (case, blanks, missing braces) to the canonical text."""
    return F.concat(F.lit("{"), F.upper(F.translate(F.trim(text), "{}", "")), F.lit("}"))


def guid_bytes(text: Column) -> Column:
    """Canonical text to its 16 bytes."""
    digits = F.translate(text, "{}-", "")
    # Where each byte sits in the digits, in memory order.
    order = (3, 2, 1, 0, 5, 4, 7, 6)
    head = [F.substring(digits, 2 * at + 1, 2) for at in order]
    return F.unhex(F.concat(*head, F.substring(digits, 17, 16)))


def is_null_guid(text: Column) -> Column:
    return text == NULL_GUID


def norm_guid(text: str) -> str:
    """The same normalisation for an id given as a Python argument."""
    return "{" + text.strip().strip("{}").upper() + "}"
