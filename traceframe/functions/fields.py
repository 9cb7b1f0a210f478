"""Reading one payload field: where it ends, whether it fits, and its text.

The compiled decoder knows in- and out-type while planning and asks for the one matching
expression (:func:`read_field`, :func:`read_inline`). The table-driven decoder meets them
as data: :func:`reading_of` reduces the type codes to a few readers and forms while the
property rows are prepared, and :func:`read_row` is a ``CASE`` over those.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from traceframe import constants as C
from traceframe.functions import bits, text
from traceframe.functions.guid import guid_text


def choose(selector: int, cases, default: Callable[[], Column]) -> Column:
    """The first case whose codes hold ``selector``."""
    for codes, make in cases:
        if selector in codes:
            return make()
    return default()


@dataclass
class Source:
    """Where a field is read from. ``length`` is its declared or carried length."""

    data: Column
    offset: Column | int
    left: Column
    length: Column | int
    pointer: Column


READ_TYPE = "struct<used:bigint,text:string,number:bigint>"


@dataclass
class Value:
    """``fits``: the bytes are there. The rest may only be evaluated where it fits.

    ``read`` gives bytes used, text (NULL when undecodable) and raw number in one go;
    ``text`` and ``number`` are shorter forms of it for fields of fixed width.
    """

    fits: Column
    read: Callable[[], Column]
    text: Callable[[], Column] | None = None


def _reading(used, shown: Column, number: Column | None = None) -> Column:
    return F.struct(
        bits.as_col(used).cast("bigint").alias("used"),
        shown.alias("text"),
        (F.lit(None).cast("bigint") if number is None else number).alias("number"),
    )


# In-types of fixed width, in bytes. POINTER and SIZET take the pointer size instead.
FIXED_WIDTH = {
    C.IN_NULL: 0,
    C.IN_INT8: 1, C.IN_UINT8: 1, C.IN_INT16: 2, C.IN_UINT16: 2,
    C.IN_INT32: 4, C.IN_UINT32: 4, C.IN_INT64: 8, C.IN_UINT64: 8,
    C.IN_FLOAT: 4, C.IN_DOUBLE: 8, C.IN_BOOLEAN: 4, C.IN_GUID: 16,
    C.IN_FILETIME: 8, C.IN_SYSTEMTIME: 16, C.IN_HEXINT32: 4, C.IN_HEXINT64: 8,
    C.IN_UNICODECHAR: 2, C.IN_ANSICHAR: 1,
}
POINTER_TYPES = (C.IN_POINTER, C.IN_SIZET)
SIGNED = (C.IN_INT8, C.IN_INT16, C.IN_INT32, C.IN_INT64)
HEX_BY_DEFAULT = (C.IN_POINTER, C.IN_SIZET, C.IN_HEXINT32, C.IN_HEXINT64)
# Types whose text is NULL for some byte patterns although the bytes are there.
MAY_BE_INVALID = (C.IN_NULL, C.IN_FILETIME, C.IN_SYSTEMTIME)

_HEX_OUT = (C.OUT_HEXBINARY, C.OUT_HEXINT8, C.OUT_HEXINT16, C.OUT_HEXINT32, C.OUT_HEXINT64)
_DECIMAL_OUT = tuple(range(C.OUT_BYTE, C.OUT_UNSIGNEDLONG + 1)) + (
    C.OUT_PID, C.OUT_TID, C.OUT_ERRORCODE, C.OUT_WIN32ERROR, C.OUT_NTSTATUS, C.OUT_HRESULT,
)
_TIME_OUT = (
    C.OUT_DATETIME, C.OUT_CIMDATETIME, C.OUT_ETWTIME, C.OUT_CULTURE_INSENSITIVE_DATETIME,
)


def width_of(in_type: int) -> int | None:
    """Fixed byte width; the larger pointer size for pointers; None when variable."""
    return 8 if in_type in POINTER_TYPES else FIXED_WIDTH.get(in_type)


def _truth(value: Column) -> Column:
    return F.when(value != 0, F.lit("true")).otherwise(F.lit("false"))


def _integer(src: Source, in_type: int, out, label) -> Value:
    pointer = in_type in POINTER_TYPES
    fixed = FIXED_WIDTH.get(in_type)
    width = src.pointer if pointer else fixed

    def show(value: Column) -> Column:
        def decimal() -> Column:
            if in_type in SIGNED:
                return bits.sign_extend(value, fixed).cast("string")
            if in_type in (C.IN_UINT64, C.IN_HEXINT64) or pointer:
                return bits.unsigned_text(value)
            return value.cast("string")

        def default() -> Column:
            if in_type == C.IN_BOOLEAN:
                return _truth(value)
            return bits.hex_text(value) if in_type in HEX_BY_DEFAULT else decimal()

        cases = [
            (_DECIMAL_OUT, decimal),
            (_HEX_OUT, lambda: bits.hex_text(value)),
            ((C.OUT_BOOLEAN,), lambda: _truth(value)),
        ]
        if fixed == 2:
            port = bits.be_uint(src.data, src.offset, 2).cast("string")
            cases.append(((C.OUT_PORT,), lambda: port))
        if fixed == 4 and in_type != C.IN_BOOLEAN:
            cases.append(((C.OUT_IPV4,), lambda: text.ipv4_text(src.data, src.offset)))
        if fixed == 8:
            cases.append((_TIME_OUT, lambda: text.filetime_text(value)))
        plain = choose(out, cases, default)
        named = label(value) if label is not None else None
        return plain if named is None else F.coalesce(named, plain)

    raw = bits.le_uint(src.data, src.offset, width)
    return Value(
        src.left >= bits.as_col(width),
        lambda: bits.let(raw, lambda v: _reading(width, show(v), v)),
        lambda: bits.let(raw, show),
    )


def _fixed(src: Source, in_type: int, out) -> Value:
    width = FIXED_WIDTH[in_type]
    at, data = src.offset, src.data

    def show() -> Column:
        if in_type == C.IN_NULL:
            return F.lit(None).cast("string")
        if in_type == C.IN_DOUBLE:
            value = bits.let(bits.le_uint(data, at, 8), bits.ieee_double)
            return value.cast("string")
        if in_type == C.IN_FLOAT:
            return bits.let(bits.le_uint(data, at, 4), bits.ieee_float).cast("string")
        if in_type == C.IN_GUID:
            return guid_text(data, at)
        if in_type == C.IN_FILETIME:
            return bits.let(
                bits.le_uint(data, at, 8),
                lambda v: choose(
                    out,
                    [
                        (_DECIMAL_OUT, lambda: bits.unsigned_text(v)),
                        (_HEX_OUT, lambda: bits.hex_text(v)),
                    ],
                    lambda: text.filetime_text(v),
                ),
            )
        if in_type == C.IN_SYSTEMTIME:
            return text.systemtime_text(data, at)
        if in_type == C.IN_UNICODECHAR:
            return text.wide_text(F.hex(bits.slice_bytes(data, at, 2)))
        return text.narrow_text(F.hex(bits.slice_bytes(data, at, 1)))

    return Value(src.left >= width, lambda: _reading(width, show()), show)


def _show_text(digits: Column, wide: bool) -> Column:
    return text.wide_text(digits) if wide else text.narrow_text(digits)


def _string(src: Source, wide: bool) -> Value:
    """Fixed or carried length in characters; length 0 means NUL-terminated."""
    unit = 2 if wide else 1
    pattern = text.WIDE_UNTIL_NUL if wide else text.NARROW_UNTIL_NUL
    size = src.length * unit

    def terminated() -> Column:
        rest = F.hex(bits.slice_bytes(src.data, src.offset, src.left))

        def use(digits: Column) -> Column:
            taken = F.floor(F.length(digits) / 2).cast("int")
            # One terminator follows unless the payload ended first.
            end = taken + F.when(taken + unit <= src.left, unit).otherwise(0)
            return _reading(end, _show_text(digits, wide))

        return bits.let(F.regexp_extract(rest, pattern, 0), use)

    def sized() -> Column:
        digits = F.hex(bits.slice_bytes(src.data, src.offset, size))
        return bits.let(digits, lambda d: _reading(size, _show_text(d, wide)))

    if not isinstance(src.length, Column):
        if src.length == 0:
            return Value(F.lit(True), terminated)
        return Value(src.left >= size, sized)
    return Value(
        (src.length >= 0) & (src.left >= size),
        lambda: F.when(src.length == 0, terminated()).otherwise(sized()),
    )


def _counted(src: Source, wide: bool, little: bool) -> Value:
    """Two-byte prefix that counts bytes, then the text."""
    read = bits.le_uint if little else bits.be_uint
    count = read(src.data, src.offset, 2).cast("int")

    def use(n: Column) -> Column:
        body = n - n % 2 if wide else n
        digits = F.hex(bits.slice_bytes(src.data, src.offset + 2, body))
        return _reading(n + 2, bits.let(digits, lambda d: _show_text(d, wide)))

    return Value((src.left >= 2) & (src.left >= count + 2), lambda: bits.let(count, use))


def _rest(src: Source, wide: bool) -> Value:
    """Everything up to the end of the payload."""
    body = src.left - src.left % 2 if wide else src.left
    digits = F.hex(bits.slice_bytes(src.data, src.offset, body))
    return Value(
        F.lit(True),
        lambda: _reading(src.left, bits.let(digits, lambda d: _show_text(d, wide))),
    )


def _ipv6(src: Source) -> Column:
    return F.when(bits.as_col(src.length) == 16, text.ipv6_text(src.data, src.offset))


def _socket(src: Source) -> Column:
    """``address:port`` of a socket address; NULL for an unknown family."""
    size = bits.as_col(src.length)
    family = bits.le_uint(src.data, src.offset, 2)
    port = bits.be_uint(src.data, src.offset + 2, 2).cast("string")
    v4 = F.concat(text.ipv4_text(src.data, src.offset + 4), F.lit(":"), port)
    v6 = F.concat(F.lit("["), text.ipv6_text(src.data, src.offset + 8), F.lit("]:"), port)
    return F.when((family == 2) & (size >= 8), v4).when((family == 23) & (size >= 24), v6)


def _binary(src: Source, out: int) -> Value:
    size = bits.as_col(src.length)

    def show() -> Column:
        return choose(
            out,
            [((C.OUT_IPV6,), lambda: _ipv6(src)), ((C.OUT_SOCKETADDRESS,), lambda: _socket(src))],
            lambda: F.hex(bits.slice_bytes(src.data, src.offset, src.length)),
        )

    return Value((size >= 0) & (src.left >= size), lambda: _reading(size, show()))


def _hexdump(src: Source) -> Value:
    """Four-byte prefix that counts bytes, then the bytes."""
    count = bits.le_uint(src.data, src.offset, 4)
    return Value(
        (src.left >= 4) & (src.left >= count + 4),
        lambda: bits.let(
            count,
            lambda n: _reading(
                n + 4, F.hex(bits.slice_bytes(src.data, src.offset + 4, n))
            ),
        ),
    )


def _sid(src: Source, prefixed: bool) -> Value:
    """A SID, after two pointers in the WBEM form."""
    at = src.offset + src.pointer * 2 if prefixed else src.offset
    before = src.pointer * 2 if prefixed else F.lit(0)
    size = text.sid_size(src.data, at)
    return Value(
        (src.left >= before + 8) & (src.left >= before + size),
        lambda: _reading(before + size, text.sid_text(src.data, at)),
    )


def read_field(src: Source, in_type: int, out, label=None) -> Value | None:
    """The reading rule of one in-type; None for a type that does not exist."""
    if in_type in POINTER_TYPES or (
        in_type in FIXED_WIDTH
        and (C.IN_INT8 <= in_type <= C.IN_UINT64
             or in_type in (C.IN_BOOLEAN, C.IN_HEXINT32, C.IN_HEXINT64))
    ):
        return _integer(src, in_type, out, label)
    if in_type in FIXED_WIDTH:
        return _fixed(src, in_type, out)
    if in_type in (C.IN_UNICODESTRING, C.IN_ANSISTRING):
        return _string(src, in_type == C.IN_UNICODESTRING)
    if in_type == C.IN_BINARY:
        return _binary(src, out)
    if in_type in (C.IN_SID, C.IN_WBEMSID):
        return _sid(src, in_type == C.IN_WBEMSID)
    if in_type in (C.IN_COUNTEDSTRING, C.IN_COUNTEDANSISTRING):
        return _counted(src, in_type == C.IN_COUNTEDSTRING, True)
    if in_type in (C.IN_REVERSEDCOUNTEDSTRING, C.IN_REVERSEDCOUNTEDANSISTRING):
        return _counted(src, in_type == C.IN_REVERSEDCOUNTEDSTRING, False)
    if in_type in (C.IN_NONNULLTERMINATEDSTRING, C.IN_NONNULLTERMINATEDANSISTRING):
        return _rest(src, in_type == C.IN_NONNULLTERMINATEDSTRING)
    if in_type == C.IN_HEXDUMP:
        return _hexdump(src)
    return None


def _plain_number(src: Source, in_type: int, out, entries) -> Column:
    """Text of an integer, written so that generated code reads each byte once."""
    pointer = in_type in POINTER_TYPES

    def digits(width: int) -> Column:
        return bits.le_digits(src.data, src.offset, width)

    if pointer:
        raw = F.when(src.pointer == 4, digits(4)).otherwise(digits(8))
    else:
        raw = digits(FIXED_WIDTH[in_type])

    def decimal() -> Column:
        if in_type == C.IN_INT64:
            return F.conv(raw, 16, -10)
        if in_type in SIGNED:
            value = F.conv(raw, 16, 10).cast("bigint")
            return bits.sign_extend(value, FIXED_WIDTH[in_type]).cast("string")
        return F.conv(raw, 16, 10)

    def in_hex() -> Column:
        return F.concat(F.lit("0x"), F.conv(raw, 16, 16))

    def truth() -> Column:
        return F.when(raw.rlike("[^0]"), F.lit("true")).otherwise(F.lit("false"))

    def default() -> Column:
        if in_type == C.IN_BOOLEAN:
            return truth()
        return in_hex() if in_type in HEX_BY_DEFAULT else decimal()

    shown = choose(
        out, [(_DECIMAL_OUT, decimal), (_HEX_OUT, in_hex), ((C.OUT_BOOLEAN,), truth)], default
    )
    if entries:
        table = F.create_map(*[x for v, name in entries for x in (F.lit(v), F.lit(name))])
        value = F.conv(raw, 16, -10).cast("bigint")
        shown = F.coalesce(F.element_at(table, value), shown)
    return shown


def is_whole_number(in_type: int) -> bool:
    """Types that value maps and bitmaps apply to."""
    others = (
        C.IN_NULL, C.IN_FLOAT, C.IN_DOUBLE, C.IN_GUID, C.IN_FILETIME, C.IN_SYSTEMTIME,
        C.IN_UNICODECHAR, C.IN_ANSICHAR,
    )
    return in_type in POINTER_TYPES or (in_type in FIXED_WIDTH and in_type not in others)


def read_inline(src: Source, in_type: int, out: int, bitmap: bool, entries) -> Column | None:
    """Text of a field that needs no binding; None when it has to be read step by step.

    Covers every type of fixed width, and strings when nothing follows them.
    """
    special = (C.OUT_PORT, C.OUT_IPV4, *_TIME_OUT)
    if width_of(in_type) is not None:
        if is_whole_number(in_type) and out not in special and not bitmap:
            return _plain_number(src, in_type, out, entries)
        return None if entries else read_field(src, in_type, out).text()
    if isinstance(src.length, Column) or entries:
        return None
    if in_type in (C.IN_UNICODESTRING, C.IN_ANSISTRING):
        wide = in_type == C.IN_UNICODESTRING
        if src.length:
            digits = F.hex(bits.slice_bytes(src.data, src.offset, src.length * (2 if wide else 1)))
            return _show_text(digits, wide)
        rest = F.hex(bits.slice_bytes(src.data, src.offset, src.left))
        pattern = text.WIDE_UNTIL_NUL if wide else text.NARROW_UNTIL_NUL
        digits = F.regexp_extract(rest, pattern, 0)
        return text.wide_text(digits, around=rest) if wide else text.narrow_text(digits)
    if in_type in (C.IN_NONNULLTERMINATEDSTRING, C.IN_NONNULLTERMINATEDANSISTRING):
        wide = in_type == C.IN_NONNULLTERMINATEDSTRING
        body = src.left - src.left % 2 if wide else src.left
        return _show_text(F.hex(bits.slice_bytes(src.data, src.offset, body)), wide)
    return None


def inline_fits(src: Source, in_type: int) -> Column:
    """Whether the bytes of a field that :func:`read_inline` reads are there."""
    if in_type in POINTER_TYPES:
        return src.left >= src.pointer
    width = FIXED_WIDTH.get(in_type)
    if width is None and in_type in (C.IN_UNICODESTRING, C.IN_ANSISTRING):
        width = src.length * (2 if in_type == C.IN_UNICODESTRING else 1)
    return src.left >= width if width else F.lit(True)


# --------------------------------------------------------------------------------------
# types as data
# --------------------------------------------------------------------------------------

_STRINGS = {
    C.IN_UNICODESTRING: ("string", 2), C.IN_ANSISTRING: ("string", 1),
    C.IN_COUNTEDSTRING: ("counted", 2), C.IN_COUNTEDANSISTRING: ("counted", 1),
    C.IN_REVERSEDCOUNTEDSTRING: ("reversed", 2), C.IN_REVERSEDCOUNTEDANSISTRING: ("reversed", 1),
    C.IN_NONNULLTERMINATEDSTRING: ("rest", 2), C.IN_NONNULLTERMINATEDANSISTRING: ("rest", 1),
    C.IN_UNICODECHAR: ("char", 2), C.IN_ANSICHAR: ("char", 1),
}


def _number_form(in_type: int, out: int) -> str:
    width = FIXED_WIDTH.get(in_type)
    if in_type == C.IN_FLOAT:
        return "float"
    if in_type == C.IN_DOUBLE:
        return "double"
    if out in _DECIMAL_OUT:
        return "signed" if in_type in SIGNED else "unsigned"
    if out in _HEX_OUT:
        return "hex"
    if in_type == C.IN_FILETIME:
        return "time"
    if out == C.OUT_BOOLEAN:
        return "truth"
    if out == C.OUT_PORT and width == 2:
        return "port"
    if out == C.OUT_IPV4 and width == 4 and in_type != C.IN_BOOLEAN:
        return "ipv4"
    if out in _TIME_OUT and width == 8:
        return "time"
    if in_type == C.IN_BOOLEAN:
        return "truth"
    if in_type in HEX_BY_DEFAULT:
        return "hex"
    return "signed" if in_type in SIGNED else "unsigned"


def reading_of(in_type: int, out: int, mapped: bool) -> dict:
    """Reader, form, width, character size and conversion of a type pair."""
    reader, form, width, unit = None, None, FIXED_WIDTH.get(in_type), 1
    if in_type in _STRINGS:
        reader, unit = _STRINGS[in_type]
    elif in_type == C.IN_GUID:
        reader, form = "fixed", "guid"
    elif in_type == C.IN_SYSTEMTIME:
        reader, form = "fixed", "clock"
    elif in_type in POINTER_TYPES or in_type in FIXED_WIDTH and in_type != C.IN_NULL:
        reader, form = "number", _number_form(in_type, out)
    elif in_type == C.IN_BINARY:
        reader = "binary"
        form = {C.OUT_IPV6: "ipv6", C.OUT_SOCKETADDRESS: "socket"}.get(out, "hex")
    elif in_type in (C.IN_SID, C.IN_WBEMSID):
        reader, form = "sid", "prefixed" if in_type == C.IN_WBEMSID else "bare"
    elif in_type == C.IN_HEXDUMP:
        reader = "hexdump"
    conversion = None
    if may_not_convert(in_type, out, mapped):
        conversion = "int" if out in C.OUT_TO_INT else "float"
    elif out == C.OUT_BOOLEAN and form != "truth":
        conversion = "truth"
    return {
        "reader": reader, "form": form, "width": width, "unit": unit, "conversion": conversion,
    }


def _row_text(digits: Column, unit: Column) -> Column:
    return F.when(unit == 2, text.wide_text(digits)).otherwise(text.narrow_text(digits))


@dataclass(frozen=True)
class Kinds:
    """What occurs among some property rows, so that expressions hold no more than that."""

    readers: frozenset
    forms: frozenset
    units: frozenset
    conversions: frozenset
    labelled: bool
    repeated: bool

    @classmethod
    def of(cls, rows) -> Kinds:
        rows = list(rows)
        return cls(
            frozenset(r["reader"] for r in rows if r["kind"] != "struct" and r["reader"]),
            frozenset(r["form"] for r in rows if r["form"]),
            frozenset(r["unit"] for r in rows if r["reader"] in _TEXT_READERS),
            frozenset(r["conversion"] for r in rows if r["conversion"]),
            any(r["entries"] for r in rows),
            any(r["kind"] != "plain" for r in rows),
        )


_TEXT_READERS = ("string", "char", "counted", "reversed", "rest")


def _one_of(selector: Column, present, cases: dict[str, Callable[[], Column]], otherwise: Column | None = None) -> Column:
    """A ``CASE`` over those cases that are present; none if there is only one."""
    made = [(name, make()) for name, make in cases.items() if name in present]
    if not made:
        return F.lit(None).cast("string") if otherwise is None else otherwise
    if len(made) == 1 and otherwise is None:
        return made[0][1]
    out = None
    for name, value in made:
        out = F.when(selector == name, value) if out is None else out.when(selector == name, value)
    return out if otherwise is None else out.otherwise(otherwise)


def _number_shows(data: Column, at: Column, width: Column, value: Column) -> dict[str, Callable[[], Column]]:
    shift = (F.lit(8) - width) * 8

    def signed() -> Column:
        return F.call_function("shiftright", F.call_function("shiftleft", value, shift), shift).cast("string")

    return {
        "unsigned": lambda: bits.unsigned_text(value),
        "signed": signed,
        "hex": lambda: bits.hex_text(value),
        "truth": lambda: _truth(value),
        "port": lambda: bits.be_uint(data, at, 2).cast("string"),
        "ipv4": lambda: text.ipv4_text(data, at),
        "time": lambda: text.filetime_text(value),
        "float": lambda: bits.ieee_float(value).cast("string"),
        "double": lambda: bits.ieee_double(value).cast("string"),
    }


def show_row(data: Column, at: Column, size: Column, prop, label, kinds: Kinds) -> Column:
    """The text of one field whose place and size are known."""
    numbers = set(_number_shows(data, at, size, size))

    def number() -> Column:
        def show(value: Column) -> Column:
            plain = _one_of(prop.form, kinds.forms & numbers, _number_shows(data, at, size, value))
            return F.coalesce(label(value), plain) if kinds.labelled else plain

        return bits.let(bits.le_uint(data, at, size), show)

    def shown_text() -> Column:
        def show(digits: Column) -> Column:
            if len(kinds.units) == 1:
                return _show_text(digits, 2 in kinds.units)
            return _row_text(digits, prop.unit)

        return bits.let(F.hex(bits.slice_bytes(data, at, size)), show)

    source = Source(data, at, size, size, F.lit(8))
    digits = F.hex(bits.slice_bytes(data, at, size))
    fixed = {"guid": lambda: guid_text(data, at), "clock": lambda: text.systemtime_text(data, at)}
    binary = {"ipv6": lambda: text.ipv6_text(data, at), "socket": lambda: _socket(source), "hex": lambda: digits}
    cases = {
        "number": number,
        "text": shown_text,
        "fixed": lambda: _one_of(prop.form, kinds.forms, fixed),
        "sid": lambda: text.sid_text(data, at),
        "binary": lambda: _one_of(prop.form, kinds.forms, binary),
        "hexdump": lambda: digits,
    }
    present = {"text" if r in _TEXT_READERS else r for r in kinds.readers}
    reader = F.when(prop.reader.isin(*_TEXT_READERS), "text").otherwise(prop.reader) if "text" in present else prop.reader
    if len(present) < 2:
        return _one_of(reader, present, cases)
    return bits.let(reader, lambda r: _one_of(r, present, cases))


def convert_shown(shown: Column, conversion: Column, kinds: Kinds) -> Column:
    """The declared conversion of a text that it does not fail on."""
    if not kinds.conversions:
        return shown
    outs = {"int": C.OUT_INT, "float": C.OUT_FLOAT, "truth": C.OUT_BOOLEAN}
    return bits.let(
        shown,
        lambda s: _one_of(conversion, kinds.conversions, {n: lambda o=o: convert(s, o)[0] for n, o in outs.items()}, otherwise=s),
    )


def _row_number(data: Column, at: Column, width: Column, value: Column, prop, label) -> Column:
    shows = _number_shows(data, at, width, value)
    return F.coalesce(label(value), _one_of(prop.form, shows, shows))


def read_row(src: Source, prop, label) -> Column:
    """One field as ``READ_TYPE`` by its property row; NULL when its bytes are missing."""
    data, at, left, unit = src.data, src.offset, src.left, prop.unit

    def number() -> Column:
        width = F.coalesce(prop.width, src.pointer)

        def show(value: Column) -> Column:
            return _reading(width, _row_number(data, at, width, value, prop, label), value)

        return F.when(left >= width, bits.let(bits.le_uint(data, at, width), show))

    def string() -> Column:
        """Sized, NUL-terminated and single characters."""
        size = F.when(prop.reader == "char", F.lit(1)).otherwise(src.length) * unit
        rest = F.hex(bits.slice_bytes(data, at, left))
        digits = F.when(size > 0, F.hex(bits.slice_bytes(data, at, size))).otherwise(
            F.when(unit == 2, F.regexp_extract(rest, text.WIDE_UNTIL_NUL, 0)).otherwise(
                F.regexp_extract(rest, text.NARROW_UNTIL_NUL, 0)
            )
        )

        def use(d: Column) -> Column:
            taken = F.floor(F.length(d) / 2).cast("int")
            end = taken + F.when((size == 0) & (taken + unit <= left), unit).otherwise(0)
            return _reading(end, _row_text(d, unit))

        return F.when((size >= 0) & (left >= size), bits.let(digits, use))

    def counted() -> Column:
        count = F.when(prop.reader == "counted", bits.le_uint(data, at, 2)).otherwise(
            bits.be_uint(data, at, 2)
        )

        def use(n: Column) -> Column:
            digits = F.hex(bits.slice_bytes(data, at + 2, n - n % unit))
            return F.when(
                left >= n + 2, _reading(n + 2, bits.let(digits, lambda d: _row_text(d, unit)))
            )

        return F.when(left >= 2, bits.let(count.cast("int"), use))

    def rest() -> Column:
        digits = F.hex(bits.slice_bytes(data, at, left - left % unit))
        return _reading(left, bits.let(digits, lambda d: _row_text(d, unit)))

    def fixed() -> Column:
        shown = F.when(prop.form == "guid", guid_text(data, at)).otherwise(
            text.systemtime_text(data, at)
        )
        return F.when(left >= prop.width, _reading(prop.width, shown))

    def binary() -> Column:
        shown = (
            F.when(prop.form == "hex", F.hex(bits.slice_bytes(data, at, src.length)))
            .when(prop.form == "ipv6", _ipv6(src))
            .otherwise(_socket(src))
        )
        return F.when((src.length >= 0) & (left >= src.length), _reading(src.length, shown))

    def sid() -> Column:
        before = F.when(prop.form == "prefixed", src.pointer * 2).otherwise(0)

        def use(skip: Column) -> Column:
            size = skip + text.sid_size(data, at + skip)
            fits = (left >= skip + 8) & (left >= size)
            return F.when(fits, _reading(size, text.sid_text(data, at + skip)))

        return bits.let(before, use)

    def hexdump() -> Column:
        value = _hexdump(src)
        return F.when(value.fits, value.read())

    return (
        F.when(prop.reader == "number", number())
        .when(prop.reader.isin("string", "char"), string())
        .when(prop.reader == "fixed", fixed())
        .when(prop.reader == "binary", binary())
        .when(prop.reader.isin("counted", "reversed"), counted())
        .when(prop.reader == "sid", sid())
        .when(prop.reader == "rest", rest())
        .when(prop.reader == "hexdump", hexdump())
    )


def convert_row(shown: Column, conversion: Column) -> tuple[Column, Column]:
    """:func:`convert` for a conversion given as data."""
    as_int, bad_int = convert(shown, C.OUT_INT)
    as_float, bad_float = convert(shown, C.OUT_FLOAT)
    truth = convert(shown, C.OUT_BOOLEAN)[0]
    converted = (
        F.when(conversion.isNull(), shown)
        .when(conversion == "int", as_int)
        .when(conversion == "float", as_float)
        .otherwise(truth)
    )
    failed = (
        F.when(conversion.isNull(), F.lit(False))
        .when(conversion == "int", bad_int)
        .when(conversion == "float", bad_float)
        .otherwise(F.lit(False))
    )
    return converted, failed


# --------------------------------------------------------------------------------------
# declared conversions
# --------------------------------------------------------------------------------------


def known(in_type: int) -> bool:
    return in_type == C.IN_NULL or reading_of(in_type, 0, False)["reader"] is not None


def may_not_convert(in_type: int, out: int, mapped: bool) -> bool:
    """Whether the text of such a field can fail its declared conversion."""
    if out in C.OUT_TO_INT:
        whole = C.IN_INT8 <= in_type <= C.IN_UINT64 or in_type in (
            C.IN_BOOLEAN, C.IN_POINTER, C.IN_SIZET, C.IN_HEXINT32, C.IN_HEXINT64, C.IN_FILETIME,
        )
        return mapped or not whole
    if out in C.OUT_TO_FLOAT:
        return mapped or in_type not in (C.IN_FLOAT, C.IN_DOUBLE)
    return False


def convert(shown: Column, out) -> tuple[Column, Column]:
    """Text after the declared conversion, and whether the conversion failed.

    Integers and floats are brought to their plain form, truth values to true/false;
    every other out-type keeps its text.
    """
    never = F.lit(False)
    if out not in C.OUT_TO_INT and out not in C.OUT_TO_FLOAT and out != C.OUT_BOOLEAN:
        return shown, never
    whole = F.translate(F.trim(shown), "_+", "")
    as_int = bits.let(
        whole, lambda w: F.coalesce(w.try_cast("decimal(38,0)").cast("string"), w)
    )
    as_float = F.trim(shown).try_cast("double").cast("string")
    truth = F.when(text.to_bool(shown), F.lit("true")).otherwise(F.lit("false"))
    converted = choose(
        out,
        [
            (C.OUT_TO_INT, lambda: as_int),
            (C.OUT_TO_FLOAT, lambda: as_float),
            ((C.OUT_BOOLEAN,), lambda: F.when(shown.isNotNull(), truth)),
        ],
        lambda: shown,
    )
    failed = choose(
        out,
        [
            (C.OUT_TO_INT, lambda: ~text.is_int_text(shown)),
            (C.OUT_TO_FLOAT, lambda: as_float.isNull()),
        ],
        lambda: never,
    )
    return converted, F.coalesce(shown.isNotNull() & failed, never)
