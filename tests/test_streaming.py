"""Streams give what batches give, and sessions behave."""

import time
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from traceframe.plans.trace import Trace
from traceframe.sources.records import read_events_stream
from traceframe.streaming import capture as live
from traceframe.streaming.rules import PidRules, live_rules


@pytest.fixture(scope="module")
def dropped(raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("drop") / "events")
    raw.repartition(3).write.parquet(path)
    return path


def keys(df):
    columns = ["record_id", "task_name", "record_parse_error", "field_parse_error", F.to_json("payload")]
    return sorted(map(tuple, df.select(*columns).collect()))


def test_replay_equals_batch(spark, raw, manifest, dropped, tmp_path):
    trace = Trace(manifest, mode=2)
    records = read_events_stream(spark, dropped, max_files_per_trigger=1)
    done = live.replay(records, trace, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert keys(done) == keys(raw.transform(trace))


def test_session_is_reused_and_only_its_owner_stops_it(spark, manifest, dropped, tmp_path):
    seen = []

    def count(batch, batch_id):
        seen.append(batch.count())

    def session(**more):
        records = read_events_stream(spark, dropped)
        return live.Capture(records, Trace(manifest), count, name="shared", checkpoint=str(tmp_path / "c"), **more)

    with session() as first:
        second = session()
        assert second.start().id == first.query.id
        second.stop()
        assert first.query.isActive
        with pytest.raises(RuntimeError):
            session(reuse=False).start()
    assert not first.query.isActive and sum(seen) == 1000


def test_failing_batches_are_kept(spark, manifest, dropped, tmp_path):
    calls = []

    def fail(batch, batch_id):
        calls.append(batch_id)
        raise ValueError("not today")

    records = read_events_stream(spark, dropped, max_files_per_trigger=1)
    letters = str(tmp_path / "letters")
    session = live.Capture(records, Trace(manifest), fail, trigger={"availableNow": True}, dead_letters=letters)
    session.start()
    session.wait()
    assert len(calls) == 3 and session.query.exception() is None
    assert spark.read.parquet(letters).count() == 1000


def test_a_failure_ends_the_capture_and_loses_nothing(spark, manifest, dropped, tmp_path):
    got, broken = [], [True]

    def sometimes(batch, batch_id):
        if batch_id == 1 and broken[0]:
            raise ValueError("not today")
        got.append(batch.count())

    def session():
        records = read_events_stream(spark, dropped, max_files_per_trigger=1)
        return live.Capture(
            records, Trace(manifest), sometimes, trigger={"availableNow": True}, checkpoint=str(tmp_path / "c")
        )

    first = session()
    first.start()
    with pytest.raises(StreamingQueryException):
        first.wait()
    broken[0] = False
    again = session()
    again.start()
    again.wait()
    assert sum(got) == 1000


def test_named_session_goes_on(spark, manifest, dropped):
    got, name = [], f"named-{uuid.uuid4()}"
    for _ in range(2):
        records = read_events_stream(spark, dropped)
        session = live.Capture(
            records, Trace(manifest), lambda b, _: got.append(b.count()), name=name,
            trigger={"availableNow": True},
        )
        session.start()
        session.wait()
    assert sum(got) == 1000


def test_stop_does_not_wait_for_ever(spark, manifest, dropped):
    records = read_events_stream(spark, dropped, max_files_per_trigger=1)
    session = live.Capture(records, lambda r: r, lambda b, _: time.sleep(5), trigger={"processingTime": "0 seconds"})
    session.start()
    start = time.monotonic()
    session.stop(seconds=1)
    assert time.monotonic() - start < 30 and not session.query.isActive


def test_counters_of_more_batches_than_spark_keeps(spark, manifest, dropped):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        records = read_events_stream(spark, dropped, max_files_per_trigger=1)
        trace = Trace(manifest, event_ids=(1,))
        session = live.Capture(
            records, lambda raw: live.observed(trace(raw)), lambda b, _: b.count(), trigger={"availableNow": True}
        )
        session.start()
        session.wait()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(session.query.recentProgress) < 3
    total = session.counters().agg(F.sum("input_rows"), F.sum("events"), F.sum("dropped"), F.count("*")).first()
    assert total[0] == 1000 and total[1] + total[2] == 1000 and total[2] > 0 and total[3] == 3


def test_no_rules_yet(spark, tmp_path, raw):
    rules = PidRules(spark, str(tmp_path / "none"))
    assert rules.current().count() == 0 and live_rules(rules.path)(raw).count() == raw.count()
    rules.add("deny", 1, 2)
    rules.remove("deny", 2)
    rules.compact()
    assert [tuple(r) for r in rules.current().collect()] == [("deny", 1)]


def test_console_stream(spark, manifest, dropped, tmp_path, capsys):
    events = Trace(manifest)(read_events_stream(spark, dropped, max_files_per_trigger=1))
    live.to_console_stream(events, str(tmp_path / "c"), {"availableNow": True}).awaitTermination()
    lines = capsys.readouterr().out.splitlines()
    assert sum(x[:1].isdigit() and x.endswith(")") for x in lines) == 1000


def test_rules_change_between_batches(spark, manifest, dropped, tmp_path):
    rules = PidRules(spark, str(tmp_path / "rules"))
    rules.add("deny", 1)
    pids = []

    def note(batch, batch_id):
        found = batch.select("ProcessId").distinct().collect()
        pids.append({r.ProcessId for r in found})
        rules.reset("deny")
        rules.add("allow", 3)

    records = read_events_stream(spark, dropped, max_files_per_trigger=1)
    session = live.Capture(
        records, lambda raw: raw, note, trigger={"availableNow": True},
        batch_filter=live_rules(rules.path),
    )
    session.start()
    session.wait()
    assert 1 not in pids[0] and len(pids[0]) > 5
    assert pids[1:] == [{3}, {3}]


def test_rule_log(spark, tmp_path):
    rules = PidRules(spark, str(tmp_path / "rules"))
    rules.add("allow", 1, 2, 3)
    rules.remove("allow", 2)
    rules.add("deny", 9)
    assert {tuple(r) for r in rules.current().collect()} == {("allow", 1), ("allow", 3), ("deny", 9)}
    rules.reset("allow")
    rules.add("allow", 2)
    assert {tuple(r) for r in rules.current().collect()} == {("allow", 2), ("deny", 9)}
    with pytest.raises(ValueError):
        rules.add("maybe", 1)


def test_memory_and_log_sinks(spark, manifest, dropped, tmp_path):
    events = Trace(manifest)(read_events_stream(spark, dropped))
    once = {"availableNow": True}
    live.to_memory_stream(events, "captured", once).awaitTermination()
    assert spark.table("captured").count() == 1000
    live.to_log_stream(events, str(tmp_path / "log"), str(tmp_path / "c1"), once).awaitTermination()
    assert spark.read.text(str(tmp_path / "log")).where(F.col("value").rlike(r"^\d+ \(")).count() == 1000
    got = []
    live.to_callback(events, lambda b, _: got.append(b.count()), str(tmp_path / "c2"), once).awaitTermination()
    assert sum(got) == 1000


def test_throttle_drops_nothing(spark, manifest, dropped):
    options, trigger = live.throttle(1, "1 second")
    assert trigger == {"processingTime": "1 second"}
    sizes = []
    records = read_events_stream(spark, dropped, options["maxFilesPerTrigger"])
    start = time.time()
    with live.Capture(records, lambda r: r, lambda b, _: sizes.append(b.count()), trigger=trigger):
        pass
    assert len(sizes) == 3 and sum(sizes) == 1000 and time.time() - start > 1
