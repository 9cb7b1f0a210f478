"""Column functions against plain Python."""

import ipaddress
import math
import os
import random
import struct
import uuid

import pytest
from pyspark.sql import functions as F

from traceframe.functions import (
    guid_bytes, guid_norm, guid_text, hex_text, ieee_double, ieee_float, ipv4_text, ipv6_text,
    le_bytes, le_uint, sid_text, sign_extend, systemtime_text, to_bool, unsigned_decimal,
    unsigned_text,
)
from traceframe.functions.text import filetime_text, wide_text

B = F.col("b")


def run(spark, data, column):
    rows = [(i, bytearray(d)) for i, d in enumerate(data)]
    df = spark.createDataFrame(rows, "i int, b binary")
    return [r[1] for r in sorted(df.select("i", column.alias("x")).collect())]


def test_unsigned_numbers(spark):
    numbers = [0, 1, 255, 256, 0x12345678, 2**63 - 1, 2**63, 2**64 - 1]
    data = [struct.pack("<Q", n) for n in numbers]
    assert run(spark, data, unsigned_text(le_uint(B, 0, 8))) == [str(n) for n in numbers]
    assert [int(x) for x in run(spark, data, unsigned_decimal(le_uint(B, 0, 8)))] == numbers
    assert run(spark, data, hex_text(le_uint(B, 0, 8))) == [f"0x{n:X}" for n in numbers]
    assert run(spark, data, F.hex(le_bytes(le_uint(B, 0, 8), 8))) == [d.hex().upper() for d in data]


def test_signed_numbers(spark):
    for code, width in (("b", 1), ("h", 2), ("i", 4), ("q", 8)):
        top = 1 << (8 * width - 1)
        numbers = [0, 1, -1, top - 1, -top]
        data = [struct.pack(f"<{code}", n) for n in numbers]
        assert run(spark, data, sign_extend(le_uint(B, 0, width), width)) == numbers


def test_floats(spark):
    numbers = [0.0, 1.5, -3.14159, 1e308, 5e-324, 2.2e-308, math.inf, -math.inf, 1 / 3]
    data = [struct.pack("<d", n) for n in numbers]
    assert run(spark, data, ieee_double(le_uint(B, 0, 8))) == numbers
    assert math.isnan(run(spark, [struct.pack("<d", math.nan)], ieee_double(le_uint(B, 0, 8)))[0])
    small = [1.5, -0.1, 1e-45, 3e38, math.inf]
    data = [struct.pack("<f", n) for n in small]
    want = [struct.unpack("<f", d)[0] for d in data]
    assert run(spark, data, ieee_float(le_uint(B, 0, 4))) == want


def test_ids(spark):
    ids = [uuid.uuid4() for _ in range(5)]
    data = [g.bytes_le for g in ids]
    text = ["{" + str(g).upper() + "}" for g in ids]
    assert run(spark, data, guid_text(B)) == text
    assert run(spark, data, F.hex(guid_bytes(guid_text(B)))) == [d.hex().upper() for d in data]
    loose = F.concat(F.lit(" "), F.lower(F.translate(guid_text(B), "{}", "")))
    assert run(spark, data, guid_norm(loose)) == text
    assert run(spark, [b"short"], guid_text(B)) == [None]


def shortest(data):
    groups = [f"{int.from_bytes(data[i : i + 2], 'big'):x}" for i in range(0, 16, 2)]
    best, i = (0, 0), 0
    while i < 8:
        j = i
        while j < 8 and groups[j] == "0":
            j += 1
        best = max(best, (j - i, -i))
        i = max(j, i + 1)
    length, at = best[0], -best[1]
    if length < 2:
        return ":".join(groups)
    return ":".join(groups[:at]) + "::" + ":".join(groups[at + length :])


def test_addresses(spark):
    random.seed(7)
    data = [bytes(16), bytes(15) + b"\1", b"\1" + bytes(15)]
    for _ in range(300):
        data.append(b"".join(random.choice([b"\0\0", os.urandom(2)]) for _ in range(8)))
    shown = run(spark, data, ipv6_text(B, 0))
    assert shown == [shortest(d) for d in data]
    assert all(ipaddress.IPv6Address(s).packed == d for s, d in zip(shown, data))
    assert run(spark, [bytes([1, 2, 255, 0])], ipv4_text(B, 0)) == ["1.2.255.0"]


def test_sids(spark):
    long = bytes([1, 5]) + (5).to_bytes(6, "big") + struct.pack("<5I", 21, 1, 2**32 - 1, 3, 500)
    bare = bytes([1, 0]) + (1).to_bytes(6, "big")
    assert run(spark, [long, bare], sid_text(B, 0)) == ["S-1-5-21-1-4294967295-3-500", "S-1-1"]


def test_times_do_not_depend_on_the_zone(spark):
    ticks = [131311311314234567, 2**64 - 1]
    data = [struct.pack("<Q", t) for t in ticks]
    assert run(spark, data, filetime_text(le_uint(B, 0, 8))) == ["2017-02-09T16:25:31.4234567Z", None]
    # 02:30 on this day does not exist in New York.
    clock = [struct.pack("<8H", 2024, m, 0, 10, 2, 30, 15, 7) for m in (3, 13)]
    assert run(spark, clock, systemtime_text(B, 0)) == ["2024-03-10T02:30:15.007Z", None]


def test_wide_text(spark):
    texts = ["héllo Øß", "emoji \U0001f600 x", "a" * 5000 + "\U0001f600", ""]
    data = [t.encode("utf-16-le") for t in texts]
    assert run(spark, data, wide_text(F.hex(B))) == texts
    lone = b"a\0" + b"\x3d\xd8" + b"b\0"
    assert run(spark, [lone, b"a\0\0\0b\0"], wide_text(F.hex(B))) == ["a?b", "a"]


@pytest.mark.parametrize(
    "text, truth",
    [("1", True), ("true", True), ("TRUE", True), ("0", False), ("false", False), ("yes", False)],
)
def test_truth_text(spark, text, truth):
    assert spark.range(1).select(to_bool(F.lit(text))).first()[0] is truth
