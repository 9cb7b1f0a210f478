"""The Arrow cursor against the fold and against hand-made layouts."""

import json
import random
import struct
import time

import pytest
from pyspark.sql import functions as F

from tests.helpers import PROVIDER, layout, prop, records
from traceframe import constants as C
from traceframe.operators import cursor
from traceframe.operators.decode import _property_rows, decode_payload
from traceframe.operators.manifest import Manifest

IN_TYPES = [
    C.IN_NULL, C.IN_UNICODESTRING, C.IN_ANSISTRING, C.IN_INT8, C.IN_UINT8, C.IN_INT16, C.IN_UINT16, C.IN_INT32, C.IN_UINT32,
    C.IN_INT64, C.IN_UINT64, C.IN_FLOAT, C.IN_DOUBLE, C.IN_BOOLEAN, C.IN_BINARY, C.IN_GUID, C.IN_POINTER, C.IN_FILETIME,
    C.IN_SYSTEMTIME, C.IN_SID, C.IN_HEXINT32, C.IN_HEXINT64, C.IN_COUNTEDSTRING, C.IN_COUNTEDANSISTRING,
    C.IN_REVERSEDCOUNTEDSTRING, C.IN_REVERSEDCOUNTEDANSISTRING, C.IN_NONNULLTERMINATEDSTRING, C.IN_UNICODECHAR, C.IN_ANSICHAR,
    C.IN_SIZET, C.IN_HEXDUMP, C.IN_WBEMSID,
]
COMMON = [C.IN_UNICODESTRING, C.IN_ANSISTRING, C.IN_UINT8, C.IN_UINT16, C.IN_UINT32, C.IN_POINTER, C.IN_COUNTEDSTRING]
OUT_TYPES = [
    0, C.OUT_STRING, C.OUT_DATETIME, C.OUT_INT, C.OUT_UNSIGNEDINT, C.OUT_HEXINT32, C.OUT_BOOLEAN, C.OUT_PORT, C.OUT_IPV4, C.OUT_IPV6,
    C.OUT_SOCKETADDRESS, C.OUT_NOPRINT, C.OUT_DOUBLE, C.OUT_UNSIGNEDLONG, C.OUT_PID,
]


def random_layout(rng):
    """Fields of any type, arrays and structs, lengths and counts taken from earlier fields or carried."""
    props = []

    def leaf(name, **more):
        in_type = rng.choice(COMMON if rng.random() < 0.5 else IN_TYPES)
        out = rng.choice(OUT_TYPES) if rng.random() < 0.4 else 0
        length = rng.choice([0, 0, 1, 2, 4, 8, 16, 24, -3])
        if props and rng.random() < 0.15:
            more |= {"flags": more.get("flags", 0) | C.PROP_PARAM_LENGTH, "length_index": rng.randrange(len(props))}
        if rng.random() < 0.15:
            more["map_name"] = rng.choice(["M", "B"])
        return prop(name, in_type, out, length=length, **more)

    for i in range(rng.randrange(1, 9)):
        name = rng.choice([f"F{i}", f"F{i}", f"N{i}Length", f"N{i}Length", "Same"])
        kind = rng.random()
        counted = {}
        if kind < 0.4:
            numbers = [j for j, p in enumerate(props) if p["in_type"] in (C.IN_UINT8, C.IN_INT8, C.IN_UINT16)]
            if numbers and rng.random() < 0.7:
                counted = {"flags": C.PROP_PARAM_COUNT, "count_index": rng.choice(numbers)}
            else:
                counted = {"count": rng.choice([2, 3, 5])}
        if kind < 0.2:
            members = rng.randrange(1, 4)
            flags = counted.pop("flags", 0) | C.PROP_STRUCT
            props.append(prop(name, flags=flags, struct_start=len(props) + 1, struct_members=members, **counted))
            names = [rng.choice(["A", "B", "CLength"]) for _ in range(members)]
            props += [leaf(n, top_level=False) for n in names]
        else:
            props.append(leaf(name, **counted))
    return props


def random_payload(rng):
    parts = []
    for _ in range(rng.randrange(12)):
        parts.append(
            rng.choice(
                [
                    lambda: bytes([rng.randrange(6)]),
                    lambda: struct.pack("<H", rng.randrange(8)),
                    lambda: struct.pack("<I", rng.randrange(1 << 32)),
                    lambda: struct.pack("<q", rng.choice([-1, 0, 7, 132_000_000_000_000_000, 2**63 - 1])),
                    lambda: ("".join(rng.choices("ab1 語é", k=rng.randrange(6))) + "\0").encode("utf-16-le"),
                    lambda: b"".join(rng.choices([b"1", b"x", b" ", b"+", b"_"], k=rng.randrange(5))) + b"\0",
                    lambda: bytes(rng.randrange(256) for _ in range(rng.randrange(10))),
                    lambda: struct.pack("<8H", 2024, 1 + rng.randrange(13), 0, 1 + rng.randrange(31), 1, 2, rng.randrange(62), 5),
                    lambda: struct.pack("<HHI8x", rng.choice([2, 23, 9]), 80, 5),
                    lambda: bytes([1, rng.randrange(4), 0, 0, 0, 0, 0, 5]) + bytes(8),
                ]
            )()
        )
    return b"".join(parts)


def many(spark, layouts, maps=()):
    rows = []
    for kind, props in enumerate(layouts):
        for i, p in enumerate(props):
            rows.append((
                PROVIDER, kind, 0, i, p["name"], p.get("flags", 0), p["in_type"], p["out_type"], p.get("map_name"), p.get("count", 1),
                p.get("count_index"), p.get("length", 0), p.get("length_index"), p.get("struct_start"), p.get("struct_members"),
                p.get("top_level", True),
            ))
    events = [(PROVIDER, kind, 0, "Provider", f"T{kind}", None, 0) for kind in range(len(layouts))]
    return Manifest.of(spark, events, rows, maps)


MAPS = [(PROVIDER, "M", False, 1, "one"), (PROVIDER, "M", False, 3, "three"), (PROVIDER, "M", False, -1, "minus"),
        (PROVIDER, "B", True, 1, "a"), (PROVIDER, "B", True, 4, "c")]


def decoded(df, manifest, way):
    out = df.transform(decode_payload(manifest, table_driven=way)).orderBy("record_id")
    rows = out.select(F.to_json("payload", {"ignoreNullFields": "false"}).alias("payload"), "record_parse_error", "field_parse_error")
    return [tuple(r) for r in rows.collect()]


@pytest.mark.parametrize("seed", range(3))
def test_any_layout_as_by_the_fold(spark, seed):
    rng = random.Random(seed)
    layouts = [random_layout(rng) for _ in range(60)]
    manifest = many(spark, layouts, MAPS)
    payloads = [random_payload(rng) for _ in range(60 * 12)]
    df = records(spark, payloads).withColumn("Id", F.col("record_id").cast("int") % 60)
    df = df.withColumn("Flags", F.when(F.col("record_id") % 5 == 0, C.FLAG_32_BIT_HEADER).otherwise(F.col("Flags")))
    placed = [cursor.placeable(_property_rows(x)) for x in manifest.layouts]
    assert sum(placed) > 25
    fold, places = decoded(df, manifest, "fold"), decoded(df, manifest, True)
    wrong = [(layouts[i % 60], payloads[i], a, b) for i, (a, b) in enumerate(zip(fold, places)) if a != b]
    assert not wrong, (len(wrong), wrong[0])
    assert sum(json.loads(p[0]) != {} for p in places) > 300


def test_seventy_three_layouts_in_one_plan(spark):
    """More layouts than are compiled: the plan holds the cursor, not the fold."""
    layouts = [[prop("Id", C.IN_UINT32, length=4), *[prop(f"S{j}", C.IN_UNICODESTRING, 1) for j in range(i % 7)]] for i in range(73)]
    manifest = many(spark, layouts)
    payloads = [
        struct.pack("<I", n) + b"".join((f"{n}-{j}\0").encode("utf-16-le") for j in range(n % 73 % 7)) for n in range(730)
    ]
    df = records(spark, payloads).withColumn("Id", F.col("record_id").cast("int") % 73)
    out = df.transform(decode_payload(manifest)).orderBy("record_id")
    for n, r in enumerate(out.collect()):
        assert r.payload == {"Id": str(n), **{f"S{j}": f"{n}-{j}" for j in range(n % 73 % 7)}}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "_folded" not in plan


def big(n, width):
    """A counted array of numbers, one of strings, and a struct array."""
    numbers = struct.pack("<I", n) + b"".join(struct.pack("<I", i) for i in range(n))
    words = b"".join(f"s{i}\0".encode() for i in range(n))
    parts = b"".join(struct.pack("<IQ", i, i) for i in range(n))
    return numbers + words + parts + width * b"\1"


BIG = [
    prop("N", C.IN_UINT32, length=4),
    prop("Numbers", C.IN_UINT32, length=4, flags=C.PROP_PARAM_COUNT, count_index=0),
    prop("Words", C.IN_ANSISTRING, flags=C.PROP_PARAM_COUNT, count_index=0),
    prop("Parts", flags=C.PROP_STRUCT | C.PROP_PARAM_COUNT, count_index=0, struct_start=4, struct_members=2),
    prop("I", C.IN_UINT32, length=4, top_level=False),
    prop("Base", C.IN_POINTER, length=8, top_level=False),
    prop("Tail", C.IN_UINT8, length=1),
]


def test_ten_thousand_elements_in_linear_time(spark):
    manifest = layout(spark, BIG)
    took = {}
    for n in (50, 1_250, 10_000):
        df = records(spark, [big(n, 1)] * 2)
        best = []
        for _ in range(2):
            start = time.perf_counter()
            row = df.transform(decode_payload(manifest)).first()
            best.append(time.perf_counter() - start)
        took[n] = min(best)
        assert json.loads(row.payload["Numbers"]) == [str(i) for i in range(n)]
        assert json.loads(row.payload["Words"]) == [f"s{i}" for i in range(n)]
        assert json.loads(row.payload["Parts"]) == [{"I": str(i), "Base": f"0x{i:X}"} for i in range(n)]
        assert row.payload["Tail"] == "1" and not row.field_parse_error
    # Eight times the elements, less what a run costs in any case.
    assert took[10_000] - took[50] < 16 * max(took[1_250] - took[50], 0.1), took


def test_a_thousand_strings_in_linear_time(spark):
    took = {}
    for n in (25, 250, 1_000):
        manifest = layout(spark, [prop(f"S{i}", C.IN_UNICODESTRING, 1) for i in range(n)])
        data = b"".join(f"value {i} {'x' * 40}\0".encode("utf-16-le") for i in range(n))
        df = records(spark, [data] * 40).repartition(1)
        best = []
        for _ in range(2):
            start = time.perf_counter()
            rows = df.transform(decode_payload(manifest, table_driven=True)).collect()
            best.append(time.perf_counter() - start)
        took[n] = min(best)
        assert all(r.payload == {f"S{i}": f"value {i} {'x' * 40}" for i in range(n)} for r in rows)
    assert took[1_000] - took[25] < 8 * max(took[250] - took[25], 0.2), took


def test_slices_of_a_batch_change_nothing(monkeypatch):
    """Places of a batch in slices of a few bytes, of a sliced array with empty and missing payloads."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(9)
    prop_row = {"hidden": False, "reader": "string", "form": None, "width": None, "unit": 2, "conversion": None, "kind": "plain", "length": 0,
                "length_ref": None, "count": 1, "count_ref": None, "fixed_count": False, "carries": False, "is_bitmap": False, "entries": [],
                "struct_start": None, "struct_members": None, "top_level": True}
    rows = [{**prop_row, "ordinal": i, "name": f"S{i}"} for i in range(3)]
    payloads = [random_payload(rng) for _ in range(200)] + [None, b""]
    array = pa.array([b"skip", *payloads], pa.binary()).slice(1)
    ids, pointer = np.zeros(len(array), np.int64), np.full(len(array), 8)
    whole = cursor._find({0: rows}, array, ids, pointer)
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(cursor, "SLICE", size)
        cuts = cursor._slices(array)
        assert cuts[0][0] == 0 and cuts[-1][1] == len(array) and (size > 1 or len(cuts) > 100)
        parts = [cursor._find({0: rows}, array.slice(a, b - a), ids[a:b], pointer[a:b]) for a, b in cuts]
        assert pa.concat_arrays(parts).to_pylist() == whole.to_pylist()
    assert cursor._slices(array.slice(0, 0)) == [(0, 0)]


def test_header_filters_still_reach_the_scan(spark, manifest, raw):
    out = raw.transform(decode_payload(manifest, table_driven=True)).where("Level <= 3 AND ProcessId = 4")
    plan = out._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("\n", 1)[0]
    assert "Level" in pushed and "ProcessId" in pushed and "ArrowEvalPython" in plan
    assert "Exchange hashpartitioning" not in plan


def test_rules_of_texts():
    assert [bool(cursor._WHOLE.match(t)) for t in ("12", " +1_0 ", "1__0", "", "x", "1\n", "1 x", "-")] == [
        True, True, False, False, False, True, False, False,
    ]
    assert [cursor._length(t) for t in ("5", " -2 ", "1_0", "99999999999999999999", "x", "")] == [
        5, -2, cursor.LENGTH_LIMIT + 1, cursor.LENGTH_LIMIT + 1, None, None,
    ]
