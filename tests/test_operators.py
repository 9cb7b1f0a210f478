"""Filters, descriptors, modes, extended items, sinks, lookups, plans."""

import struct

import pytest
from pyspark.sql import functions as F

from tests.helpers import records
from traceframe import constants as C
from traceframe.operators import descriptors, filters, lookup, modes, sinks
from traceframe.operators.extended import decode_extended
from traceframe.operators.manifest import bounded_rows
from traceframe.plans.trace import Trace, preset
from traceframe.sources.records import read_events_by_date, write_events


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_header_filters_reach_the_scan(raw):
    kept = (
        raw.transform(filters.event_id_filter([1, 2]))
        .transform(filters.pid_filter(allow=[1, 2]))
        .transform(filters.level_filter(4))
    )
    text = plan(kept.select("record_id"))
    assert "In(ProcessId, [1,2])" in text and "LessThanOrEqual(Level,4)" in text
    assert "UserData" not in text.split("ReadSchema")[1].split("\n")[0]


def test_decode_needs_no_shuffle(raw, manifest):
    text = plan(raw.transform(Trace(manifest, mode=2)))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert "ArrowEvalPython" not in text and "MapInArrow" not in text


def test_raw_mode_has_no_join(raw, manifest):
    assert "Join" not in plan(raw.transform(Trace(manifest, mode=1)))


def test_allow_list_switches_deny_list_off(raw):
    both = raw.transform(filters.pid_filter(allow=[1, 2], deny=[1]))
    assert {r.ProcessId for r in both.select("ProcessId").distinct().collect()} == {1, 2}
    assert raw.transform(filters.pid_filter(allow=[], deny=[])).count() == raw.count()


def test_long_lists_are_joined(spark, raw):
    long = list(range(5, 3000))
    kept = raw.transform(filters.pid_filter(allow=long))
    assert "BroadcastHashJoin" in plan(kept)
    table = spark.range(5, 3000).toDF("pid")
    want = sorted(r.record_id for r in raw.where("ProcessId >= 5").select("record_id").collect())
    for keep in (True, False):
        got = filters.member_join(raw, F.col("ProcessId"), table, keep)
        ids = sorted(r.record_id for r in got.select("record_id").collect())
        assert ids == want if keep else not set(ids) & set(want)
        assert got.columns == raw.columns


def test_null_process_is_in_no_list(spark):
    df = records(spark, [b"", b""]).withColumn("ProcessId", F.when(F.col("record_id") == 0, F.lit(7).cast("bigint")))
    table = spark.range(8, 2000).toDF("pid")
    for some in ([8], list(range(8, 2000)), table):
        assert df.transform(filters.pid_filter(deny=some)).count() == 2
        assert df.transform(filters.pid_filter(allow=some)).count() == 0
    assert df.transform(filters.pid_filter(deny=table.limit(0))).count() == 2


def test_level_names_and_mask_signs():
    assert filters.level_number("verbose") == 5
    assert filters.signed_mask(1 << 63) == -(2**63)
    with pytest.raises(KeyError):
        filters.level_number("chatty")


def test_event_id_descriptor_limit():
    descriptors.event_id_descriptor(True, range(64))
    with pytest.raises(ValueError):
        descriptors.event_id_descriptor(True, range(65))


def test_enabled_properties_of_one_provider(spark):
    item = (C.EXT_TS_ID, 4, bytearray(4))
    df = records(spark, [b"", b""], items=[item])
    df = df.withColumn("ProviderId", F.when(F.col("record_id") == 0, C.PROCESS_PROVIDER).otherwise(F.col("ProviderId")))
    out = df.transform(descriptors.provider_params(C.PROCESS_PROVIDER, [], C.PROPERTY_SID))
    sizes = {r.record_id: len(r.ExtendedData) for r in out.collect()}
    assert sizes == {0: 0, 1: 1}


@pytest.mark.parametrize("mode", [0, 1, 2, 4, 8])
def test_good_modes(mode):
    assert modes.check_mode(mode) == mode


@pytest.mark.parametrize("mode", [3, 5, 6, 7, 9, 16, 1234, -1, "1", None, True])
def test_bad_modes(mode, manifest):
    with pytest.raises(ValueError):
        Trace(manifest, mode=mode)


def test_mode_table(raw, manifest):
    """Every mode against every kind of error."""
    provider = F.col("EventHeader.ProviderId")
    for mode in (0, 2, 4):
        df = raw.transform(Trace(manifest, mode=mode))
        rows = df.select(
            "record_parse_error", "field_parse_error", F.col("UserData").isNotNull().alias("raw"),
            F.col("payload").isNotNull().alias("decoded"), (F.col("task_name") == provider).alias("by_id"),
            F.col("description").isNotNull().alias("described"),
        ).distinct().collect()
        kinds = {(r.record_parse_error, r.field_parse_error) for r in rows}
        assert kinds == {(False, False), (True, False), (False, True)}
        for r in rows:
            merged = mode != 4 or not r.field_parse_error
            assert r.decoded == merged
            assert r.raw == (mode != 0 and (r.record_parse_error or r.field_parse_error))
            assert r.by_id == (r.record_parse_error or not merged)
            assert r.described == (merged and not r.record_parse_error)
    whole = raw.transform(Trace(manifest, mode=8, event_ids=(99,), pid_deny=(1,)))
    assert whole.count() == raw.count() and whole.columns[1:] == raw.columns


def test_bad_extended_items_leave_others_alone(spark):
    def item(kind, data, size=None):
        return (kind, len(data) if size is None else size, bytearray(data))

    items = [
        item(C.EXT_TS_ID, struct.pack("<I", 7)), item(C.EXT_TS_ID, b"\1"),
        item(C.EXT_SID, bytes([1, 9, 0, 0, 0, 0, 0, 5])), item(C.EXT_PEBS_INDEX, b""),
        item(C.EXT_EVENT_KEY, struct.pack("<Q", 2**64 - 1)), item(C.EXT_STACK_TRACE32, struct.pack("<QI", 3, 9) + b"\1"),
        item(C.EXT_PMC_COUNTERS, b""), item(0x55, b"x"),
    ]
    df = records(spark, [b""], items=items, Flags=0x41).transform(decode_extended)
    x = df.first().EventExtendedData
    assert x.TSID == 7 and x.SID is None and x.PebsIndex is None
    assert int(x.EventKey) == 2**64 - 1
    assert x.StackTrace32.Address == [9] and x.PMCCounters == []
    off = records(spark, [b""], items=items, Flags=0x40).transform(decode_extended)
    assert off.first().EventExtendedData is None


def test_presets(raw, manifest):
    with pytest.raises(ValueError):
        preset("process", manifest, task_names=["X"])
    own = raw.transform(preset("process", manifest, ["PROCESSSTOP"], use_default_tasks=False))
    assert [r[0] for r in own.select("task_name").distinct().collect()] == ["PROCESSSTOP"]


def test_lookups(raw, manifest):
    events = raw.transform(Trace(manifest))
    first = events.transform(lookup.first_event("PROCESSSTART")).collect()
    times = [r.t for r in events.transform(lookup.all_events("PROCESSSTART")).select(F.col("EventHeader.TimeStamp").alias("t")).collect()]
    assert len(first) == 1 and first[0].EventHeader.TimeStamp == min(times)
    assert events.transform(lookup.first_event("NOTHING")).count() == 0
    ordered = [r.TimeStamp for r in lookup.chronological(raw).select("TimeStamp").collect()]
    assert ordered == sorted(ordered)


def test_lookups_filter_below_the_decode(raw, manifest):
    trace = Trace(manifest)
    lean = plan(raw.transform(lookup.all_events("PROCESSSTART", trace)))
    assert len(lean) < len(plan(raw.transform(trace).transform(lookup.all_events("PROCESSSTART")))) / 2
    first = raw.transform(lookup.first_event("PROCESSSTART", trace)).collect()
    assert first == raw.transform(trace).transform(lookup.first_event("PROCESSSTART")).collect()
    other = Trace(manifest, task_names=("PROCESSSTOP",))
    assert raw.transform(lookup.all_events("PROCESSSTART", other)).count() == 0


def test_day_and_provider_prune_folders(raw, spark, tmp_path):
    low = raw.withColumn("ProviderId", F.lower("ProviderId"))
    write_events(low, str(tmp_path / "log"), by_date=True)
    log = read_events_by_date(spark, str(tmp_path / "log"))
    assert {r[0] for r in log.select("ProviderId").distinct().collect()} == {r[0] for r in raw.select("ProviderId").distinct().collect()}
    day = log.agg(F.min("event_date")).first()[0]
    kept = log.where((F.col("event_date") == F.lit(day)) & (F.col("ProviderId") == C.PROCESS_PROVIDER))
    filtered = plan(kept).split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "event_date" in filtered and "ProviderId" in filtered
    ticks = F.col("TimeStamp") - C.UNIX_EPOCH_TICKS
    same = raw.where(F.date_from_unix_date(F.floor(ticks / 864_000_000_000).cast("int")) == F.lit(day))
    assert log.where(F.col("event_date") == F.lit(day)).count() == same.count() > 0


def test_console_prints_every_event(raw, manifest, capsys):
    sinks.to_console(raw.transform(Trace(manifest)).limit(57))
    assert sum(line[:1].isdigit() and line.endswith(")") for line in capsys.readouterr().out.splitlines()) == 57


def test_event_line_has_each_key_once(spark, raw, manifest):
    df = raw.transform(Trace(manifest)).limit(1)
    df = df.withColumn("payload", F.create_map(F.lit("Description"), F.lit("payload"), F.lit("Other"), F.lit("x")))
    line = sinks.format_event(df).first().line
    assert line.count('"Description"') == 1 and '"Other":"x"' in line


def test_log_appends(raw, manifest, tmp_path, spark):
    events = raw.transform(Trace(manifest, mode=2))
    for times in (1, 2):
        sinks.to_log(events, str(tmp_path / "log"))
        heads = spark.read.text(str(tmp_path / "log")).where(F.col("value").rlike(r"^\d+ \(")).count()
        assert heads == times * raw.count()


def test_quarantine(raw, manifest, spark, tmp_path):
    events = raw.transform(Trace(manifest, mode=2))
    good, bad = modes.quarantine(events)
    modes.write_quarantine(events, str(tmp_path / "q"))
    stored = modes.read_quarantine(spark, str(tmp_path / "q"))
    assert stored.where("quarantined").count() == bad.count() > 0
    assert stored.where("not quarantined").count() == good.count() > 0


def test_metadata_must_be_small(spark):
    assert len(bounded_rows(spark.range(5), 5, "t")) == 5
    with pytest.raises(ValueError):
        bounded_rows(spark.range(6), 5, "t")


def test_lives_of_processes(spark, raw, monkeypatch):
    """Touching, overlapping and repeated lives are one; ends are not part of a life; NULLs are open."""
    rows = [
        (1, "a.exe", None, 10), (1, "a.exe", 10, 20), (1, "a.exe", 15, 18), (1, "a.exe", 15, 18), (1, "b.exe", 20, 30), (1, "a.exe", 40, None),
        (2, "a.exe", 5, 5), (None, "a.exe", None, None), (3, "a.exe", 7, 9), (3, "a.exe", 11, 12),
    ]
    processes = spark.createDataFrame(rows, "pid bigint, image_name string, start_time bigint, end_time bigint")
    found = sorted(tuple(r) for r in descriptors.lives(processes.where("image_name = 'a.exe'")).collect())
    assert found == [(1, -(1 << 63), 20), (1, 40, (1 << 63) - 1), (3, 7, 9), (3, 11, 12)]
    df = raw.limit(1).drop("ProcessId", "TimeStamp", "record_id")
    stamps = [(0, 1, 0), (1, 1, 19), (2, 1, 20), (3, 1, 40), (4, 2, 5), (5, 3, 10), (6, 3, 11), (7, None, 8), (8, 1, None), (9, 9, 8)]
    times = spark.createDataFrame(stamps, "record_id bigint, ProcessId bigint, TimeStamp bigint")
    made = times.join(df, F.lit(True)).select(raw.columns)
    one = descriptors.exe_descriptor(["a.exe"], processes)
    none = lambda d: sorted(r.record_id for r in d.collect())
    assert none(one(made)) == [0, 1, 3, 6]
    provider = made.first().ProviderId
    assert none(made.transform(descriptors.provider_params(provider, [one]))) == [0, 1, 3, 6]
    assert none(made.transform(descriptors.provider_params(C.NULL_GUID, [one]))) == list(range(10))
    assert "BroadcastHashJoin" in plan(made.transform(descriptors.provider_params(provider, [one])))
    # More lives than may be broadcast: those that occur are, or else all records are shuffled; same result.
    for most in (3, 1):
        monkeypatch.setattr(descriptors, "MAX_LIVES", most)
        assert none(one(made)) == [0, 1, 3, 6]


def test_events_in_memory_are_held(spark, raw, manifest):
    from traceframe.operators.sinks import to_memory

    table = to_memory(raw.transform(Trace(manifest)), "held_events")
    assert spark.catalog.isCached("held_events") and table.count() == raw.count()
    spark.catalog.uncacheTable("held_events")
