"""Payload decode on hand-made and random layouts; both ways must agree."""

import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from tests.helpers import PROVIDER, decode, layout, prop, records
from traceframe import constants as C
from traceframe.operators.decode import decode_payload, event_view
from traceframe.operators.manifest import Manifest, keyword_mask_value


def u16(text):
    return text.encode("utf-16-le")


WAYS = (None, True, "fold")
BOTH = pytest.mark.parametrize("by_table", WAYS)


@BOTH
def test_carry_is_sticky_and_zero_ends_it(spark, by_table):
    props = [
        prop("ALength", C.IN_UINT16, length=2), prop("A", C.IN_UNICODESTRING),
        prop("B", C.IN_UNICODESTRING), prop("CLength", C.IN_UINT16, length=2),
        prop("C", C.IN_UNICODESTRING), prop("D", C.IN_UNICODESTRING),
    ]
    data = struct.pack("<H", 2) + u16("ab") + u16("cd") + struct.pack("<H", 0) + u16("end\0")
    row = decode(spark, props, data, by_table)
    # B reuses A's length; C has none; after that D runs to its terminator.
    assert row.payload == {
        "ALength": "2", "A": "ab", "B": "cd", "CLength": "0", "C": None, "D": "end",
    }
    assert row.field_parse_error and not row.record_parse_error


@BOTH
def test_hex_length_does_not_carry(spark, by_table):
    props = [
        prop("NLength", C.IN_HEXINT32, length=4), prop("S", C.IN_ANSISTRING),
        prop("T", C.IN_UINT8, length=1),
    ]
    row = decode(spark, props, struct.pack("<I", 2) + b"abc\0\x09", by_table)
    assert row.payload == {"NLength": "0x2", "S": "abc", "T": "9"}


@BOTH
def test_exhausted_payload_gives_null_fields(spark, by_table):
    props = [prop("A", C.IN_UINT32, length=4), prop("B", C.IN_UINT32, length=4), prop("C", C.IN_UNICODESTRING)]
    row = decode(spark, props, struct.pack("<I", 7) + b"\1\2", by_table)
    assert row.payload == {"A": "7", "B": None, "C": None}
    assert row.field_parse_error and not row.record_parse_error
    empty = decode(spark, props, b"", by_table)
    assert empty.payload == {} and not empty.field_parse_error


@BOTH
def test_undecodable_field_moves_by_its_declared_length(spark, by_table):
    # A time needs 16 bytes but only 12 are left: the next field starts after 8.
    props = [prop("T", C.IN_SYSTEMTIME, length=8), prop("N", C.IN_UINT32, length=4)]
    row = decode(spark, props, bytes(8) + struct.pack("<I", 5), by_table)
    assert row.payload == {"T": None, "N": "5"}


@BOTH
def test_repeated_name_keeps_last_value(spark, by_table):
    props = [prop("X", C.IN_UINT8, length=1), prop("X", C.IN_UINT8, length=1)]
    assert decode(spark, props, b"\1\2", by_table).payload == {"X": "2"}


@BOTH
def test_hidden_field_is_read_but_not_shown(spark, by_table):
    props = [prop("H", C.IN_UINT8, C.OUT_NOPRINT, length=1), prop("X", C.IN_UINT8, length=1)]
    assert decode(spark, props, b"\1\2", by_table).payload == {"X": "2"}


@BOTH
def test_length_from_missing_field_is_a_record_error(spark, by_table):
    props = [
        prop("S", C.IN_ANSISTRING), prop("B", C.IN_BINARY, flags=C.PROP_PARAM_LENGTH, length_index=0),
        prop("N", C.IN_UINT8, length=1),
    ]
    row = decode(spark, props, b"ab\0xyz", by_table)
    assert row.record_parse_error and row.payload == {"S": "ab"}


@BOTH
def test_map_label_that_is_no_number_fails_a_number_type(spark, by_table):
    props = [prop("A", C.IN_UINT8, length=1), prop("M", C.IN_UINT8, C.OUT_UNSIGNEDINT, length=1, map_name="m")]
    maps = [(PROVIDER, "m", False, 1, "One")]
    row = decode(spark, props, b"\7\1", by_table, maps)
    assert row.record_parse_error and row.payload == {"A": "7"}
    row = decode(spark, props, b"\7\2", by_table, maps)
    assert not row.record_parse_error and row.payload == {"A": "7", "M": "2"}


@BOTH
def test_huge_lengths_do_not_fail_the_job(spark, by_table):
    props = [prop("NLength", C.IN_UINT64, length=8), prop("S", C.IN_UNICODESTRING), prop("Z", C.IN_UINT8, length=1)]
    for n in (2**64 - 1, 2**40, 2**31):
        row = decode(spark, props, struct.pack("<Q", n) + b"abcd", by_table)
        assert row.payload["S"] is None and row.field_parse_error


def test_empty_struct_array_is_a_field_error(spark):
    props = [
        prop("N", C.IN_UINT16, length=2),
        prop("S", flags=C.PROP_STRUCT | C.PROP_PARAM_COUNT, count_index=0, struct_start=2, struct_members=1),
        prop("M", C.IN_UINT8, length=1, top_level=False),
    ]
    row = decode(spark, props, struct.pack("<H", 0) + b"\1")
    assert row.payload == {"N": "0"} and row.field_parse_error and not row.record_parse_error
    row = decode(spark, props, struct.pack("<H", 3) + b"\1\2")
    assert json.loads(row.payload["S"]) == [{"M": "1"}, {"M": "2"}, {"M": None}]
    assert row.field_parse_error


def test_unknown_event_kind_is_kept_and_flagged(spark):
    manifest = layout(spark, [prop("A", C.IN_UINT8, length=1)])
    df = records(spark, [b"\1"]).withColumn("Id", F.lit(99))
    row = df.transform(decode_payload(manifest)).first()
    assert row.record_parse_error and row.payload == {} and not row.field_parse_error


def test_event_view_tolerates_words_in_number_fields(spark):
    df = spark.createDataFrame([(1, "T", {"N": "Chunk"}), (2, "T", {"N": "7"})], "record_id int, task_name string, payload map<string,string>")
    rows = df.transform(event_view("T", {"N": "bigint"})).orderBy("record_id").collect()
    assert [r.N for r in rows] == [None, 7]


def test_manifest_rejects_two_rows_for_one_kind(spark):
    event = (PROVIDER, 1, 0, "P", "T", None, 0)
    with pytest.raises(ValueError):
        Manifest.of(spark, [event, event], [])


def test_keyword_masks(manifest):
    mask = lambda p, names: keyword_mask_value(manifest, p, names)
    assert mask(C.PROCESS_PROVIDER, ["WINEVENT_KEYWORD_PROCESS"]) == 0x10
    assert mask(C.PROCESS_PROVIDER.lower(), ["WINEVENT_KEYWORD_PROCESS", "WINEVENT_KEYWORD_THREAD"]) == 0x30
    assert mask(C.WEB_CLIENT_PROVIDER, ["WININET_KEYWORD_HTTP", "nothing"]) == 0x2
    assert mask(C.KERNEL_PROVIDER, ["process"]) == 0x1
    assert mask(C.KERNEL_PROVIDER, []) == 0


KINDS = [
    (C.IN_UINT8, 0, 1, lambda r: (lambda v: (struct.pack("<B", v), str(v)))(r.randrange(256))),
    (C.IN_INT16, 0, 2, lambda r: (lambda v: (struct.pack("<h", v), str(v)))(r.randrange(-(2**15), 2**15))),
    (C.IN_UINT32, C.OUT_HEXINT32, 4, lambda r: (lambda v: (struct.pack("<I", v), f"0x{v:X}"))(r.randrange(2**32))),
    (C.IN_UINT64, 0, 8, lambda r: (lambda v: (struct.pack("<Q", v), str(v)))(r.randrange(2**64))),
    (C.IN_POINTER, 0, 8, lambda r: (lambda v: (struct.pack("<Q", v), f"0x{v:X}"))(r.randrange(2**64))),
    (C.IN_BOOLEAN, C.OUT_BOOLEAN, 4, lambda r: (lambda v: (struct.pack("<I", v), str(v != 0).lower()))(r.randrange(2))),
    (C.IN_UNICODESTRING, 1, 0, lambda r: (lambda s: (u16(s + "\0"), s))("".join(r.choices("abcØ語", k=r.randrange(6))))),
    (C.IN_ANSISTRING, 1, 0, lambda r: (lambda s: (s.encode("latin-1") + b"\0", s))("".join(r.choices("xyzä", k=r.randrange(6))))),
    (C.IN_COUNTEDSTRING, 1, 0, lambda r: (lambda s: (struct.pack("<H", 2 * len(s)) + u16(s), s))("".join(r.choices("abc", k=r.randrange(4))))),
]


@pytest.mark.parametrize("seed", range(3))
def test_random_layouts_round_trip_both_ways(spark, seed):
    rng = random.Random(seed)
    kinds = [rng.choice(KINDS) for _ in range(rng.randrange(3, 9))]
    props = [prop(f"F{i}", k[0], k[1], length=k[2]) for i, k in enumerate(kinds)]
    payloads, wanted = [], []
    for _ in range(30):
        parts = [k[3](rng) for k in kinds]
        payloads.append(b"".join(p[0] for p in parts))
        wanted.append({f"F{i}": p[1] for i, p in enumerate(parts)})
    # The same payloads cut short somewhere must not differ between the two ways either.
    cut = [p[: rng.randrange(len(p) + 1)] for p in payloads]
    manifest = layout(spark, props)
    got = {}
    for by_table in WAYS:
        df = records(spark, payloads + cut).transform(decode_payload(manifest, table_driven=by_table))
        rows = df.orderBy("record_id").select("payload", "record_parse_error", "field_parse_error").collect()
        got[by_table] = [tuple(r) for r in rows]
    assert [g[0] for g in got[None][:30]] == wanted
    assert got[None] == got[True] == got["fold"]


def test_maps_give_one_result_by_both_ways(spark):
    """A value with two labels, and a map on a field that is no whole number."""
    maps = [(PROVIDER, "M", False, 1, "one"), (PROVIDER, "M", False, 1, "uno"), (PROVIDER, "M", False, 0, "none")]
    props = [
        prop("N", C.IN_UINT32, 0, length=4, map_name="M"),
        prop("When", C.IN_FILETIME, C.OUT_DATETIME, length=8, map_name="M"),
    ]
    data = struct.pack("<IQ", 1, 0)
    code, table, fold = (decode(spark, props, data, by_table=way, maps=maps) for way in WAYS)
    assert code.payload == table.payload == fold.payload and code.payload["N"] == "one" and code.payload["When"].startswith("1601")


def test_tasks_keep_whole_rows(spark, raw, manifest):
    out = raw.transform(decode_payload(manifest, tasks=frozenset(["PROCESSSTART"])))
    lost = out.where("size(payload) = 0 AND NOT record_parse_error AND NOT field_parse_error AND length(UserData) > 0")
    assert lost.count() == 0 and 0 < out.count() < raw.count()
