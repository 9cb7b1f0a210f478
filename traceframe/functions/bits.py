"""Little-endian numbers in BINARY columns, read and written with built-in functions.

Spark has no byte-order aware cast, so a field is read as ``hex(substring(...))``. The
hex text is reversed, which puts the bytes in big-endian order but swaps the two digits
of each byte; one shift-and-mask on the parsed BIGINT puts the digits back. That is one
``conv`` per field, the dearest step, and no Python.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_DIGITS = 0x0F0F0F0F0F0F0F0F
TWO_64 = Decimal(2**64)

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Spark does not share sub-expressions across the branches of a ``CASE``; a one-element
    ``transform`` does. What is inside runs as an expression tree rather than generated
    code, so a wide ``CASE`` cannot grow a method past what the JVM will compile.
    """
    return F.get(F.transform(F.array(value), body), 0)


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def slice_bytes(data: Column, offset, width) -> Column:
    """``width`` bytes of ``data`` starting at the 0-based ``offset``."""
    start = offset + 1
    if isinstance(start, Column) or isinstance(width, Column):
        return F.substring(data, as_col(start).cast("int"), as_col(width).cast("int"))
    return F.substring(data, start, width)


def le_uint(data: Column, offset, width) -> Column:
    """Unsigned little-endian integer of up to 8 bytes, as a BIGINT bit pattern."""
    digits = F.conv(F.reverse(F.hex(slice_bytes(data, offset, width))), 16, -10)
    if not isinstance(width, Column) and width == 1:
        return be_uint(data, offset, 1)
    mask = F.lit(LOW_DIGITS)
    return let(
        digits.cast("bigint"),
        lambda swapped: F.shiftleft(swapped.bitwiseAND(mask), 4).bitwiseOR(
            F.shiftrightunsigned(swapped, 4).bitwiseAND(mask)
        ),
    )


def le_digits(data: Column, offset, width: int) -> Column:
    """Big-endian hex digits of a little-endian number.

    Dearer than :func:`le_uint` to write down but mentioned once, so it suits generated
    code, where ``conv`` turns the digits straight into text.
    """
    return F.concat(*[F.hex(slice_bytes(data, offset + i, 1)) for i in reversed(range(width))])


def be_uint(data: Column, offset, width) -> Column:
    return F.conv(F.hex(slice_bytes(data, offset, width)), 16, -10).cast("bigint")


def sign_extend(value: Column, width: int) -> Column:
    """Read the low ``width`` bytes of a BIGINT as a signed number."""
    if width == 8:
        return value
    shift = 64 - 8 * width
    return F.shiftright(F.shiftleft(value, shift), shift)


def unsigned_decimal(value: Column) -> Column:
    """BIGINT bit pattern to an unsigned DECIMAL(20,0)."""
    plain = value.cast("decimal(20,0)")
    return F.when(value >= 0, plain).otherwise(
        (plain + F.lit(TWO_64)).cast("decimal(20,0)")
    )


def unsigned_text(value: Column) -> Column:
    """BIGINT bit pattern to unsigned decimal text."""
    return F.when(value >= 0, value.cast("string")).otherwise(
        unsigned_decimal(value).cast("string")
    )


def hex_text(value: Column) -> Column:
    """``0x`` followed by upper-case digits without leading zeros."""
    return F.concat(F.lit("0x"), F.hex(value))


def le_bytes(value: Column, width: int) -> Column:
    """Encode the low ``width`` bytes of an integer, least significant byte first.

    The reverse of :func:`le_uint`: the digits of each byte change places, then all digits are reversed.
    """
    v, mask = value.cast("bigint"), F.lit(LOW_DIGITS)
    swapped = F.shiftleft(v.bitwiseAND(mask), 4).bitwiseOR(F.shiftrightunsigned(v, 4).bitwiseAND(mask))
    return F.unhex(F.substring(F.reverse(F.lpad(F.hex(swapped), 16, "0")), 1, 2 * width))


def ieee_double(bits: Column) -> Column:
    """64-bit pattern to DOUBLE. Every step is exact: powers of two and one product."""
    exponent = F.shiftrightunsigned(bits, 52).bitwiseAND(F.lit(0x7FF))
    fraction = bits.bitwiseAND(F.lit(0xFFFFFFFFFFFFF))
    return _ieee(bits < 0, exponent, fraction, 52, 1075, 0x7FF)


def ieee_float(bits: Column) -> Column:
    """32-bit pattern to FLOAT."""
    exponent = F.shiftrightunsigned(bits, 23).bitwiseAND(F.lit(0xFF))
    fraction = bits.bitwiseAND(F.lit(0x7FFFFF))
    negative = F.shiftrightunsigned(bits, 31).bitwiseAND(F.lit(1)) == 1
    return _ieee(negative, exponent, fraction, 23, 150, 0xFF).cast("float")


def _ieee(negative, exponent, fraction, fraction_bits, bias, top) -> Column:
    sign = F.when(negative, F.lit(-1.0)).otherwise(F.lit(1.0))
    special = F.when(
        fraction == 0, sign * F.lit(float("inf"))
    ).otherwise(F.lit(float("nan")))
    subnormal = sign * fraction.cast("double") * F.pow(F.lit(2.0), F.lit(float(1 - bias)))
    normal = (
        sign
        * (fraction + F.lit(1 << fraction_bits)).cast("double")
        * F.pow(F.lit(2.0), (exponent - F.lit(bias)).cast("double"))
    )
    return F.when(exponent == top, special).when(exponent == 0, subnormal).otherwise(normal)
