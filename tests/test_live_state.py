"""Streams whose state outlives a restart: delivery by event, losses, order, record offsets, rule versions."""

import json
import os
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from traceframe.plans.trace import Trace
from traceframe.sources import record_log
from traceframe.sources.records import read_events_stream
from traceframe.streaming import capture as live
from traceframe.streaming import files, losses
from traceframe.streaming.callback import Delivery, Handler, outcomes
from traceframe.streaming.losses import LossLog
from traceframe.streaming.order import Reorder
from traceframe.streaming.rules import LiveRules, PidRules


@pytest.fixture(scope="module")
def events(raw, manifest):
    return raw.transform(Trace(manifest))


# --- one event at a time --------------------------------------------------------------


def test_one_failing_event_costs_that_event(spark, events, raw, tmp_path):
    bad = raw.agg(F.max("record_id")).first()[0]
    stamp = raw.where(F.col("record_id") == bad).first().TimeStamp
    assert raw.where(F.col("TimeStamp") == stamp).count() == 1

    def handle(event_id, event):
        if event["EventHeader"]["TimeStamp"] == stamp:
            raise KeyError("no")
        return event["Task Name"]

    delivery = Delivery(str(tmp_path / "out"), handle)
    delivery(events, 0)
    done = delivery.outcomes(spark)
    counts = {r.status: r["count"] for r in done.groupBy("status").count().collect()}
    assert counts == {"handled": 999, "failed": 1}
    letter = delivery.dead_letters(spark).first()
    assert letter.record_id == bad and letter.error == "KeyError: 'no'"
    assert json.loads(letter.event)["EventHeader"]["TimeStamp"] == stamp
    names = done.where("status = 'handled'").select("record_id", "result").join(events, "record_id")
    assert names.where("result <> task_name").count() == 0
    # The epoch comes again after a restart: it is whole, so nothing is delivered.
    Delivery(str(tmp_path / "out"), lambda i, e: 1 / 0)(events, 0)
    assert delivery.outcomes(spark).where("status = 'handled'").count() == 999
    delivery(events.limit(3), 1)
    assert delivery.outcomes(spark).groupBy("epoch").count().count() == 2


def test_an_epoch_that_was_not_finished_is_delivered_again(spark, events, tmp_path):
    path = str(tmp_path / "out")
    events.limit(1).select("record_id").write.parquet(f"{path}/epoch=0")
    files.remove(spark, f"{path}/epoch=0/_SUCCESS")
    delivery = Delivery(path, lambda i, e: None)
    assert delivery.outcomes(spark).count() == 0
    delivery(events.limit(5), 0)
    assert delivery.outcomes(spark).count() == 5


class _Picky(Handler):
    """Takes no partition but the first; notes that it was closed."""

    def __init__(self, folder):
        self.folder = folder

    def open(self, partition_id, epoch_id):
        self.at = f"{partition_id}-{epoch_id}"
        return partition_id == 0

    def process(self, event_id, event):
        return self.at

    def close(self, error):
        open(os.path.join(self.folder, self.at), "w").write(repr(error))


def test_open_and_close(events, tmp_path):
    rows = outcomes(events.repartition(3), _Picky(str(tmp_path)), epoch=7).collect()
    assert {r.status for r in rows} == {"handled", "skipped"}
    assert {r.result for r in rows} == {"0-7", None} and len(rows) == 1000
    assert sorted(os.listdir(tmp_path)) == ["0-7", "1-7", "2-7"]
    assert (tmp_path / "1-7").read_text() == "None"
    assert outcomes(events.limit(0), _Picky(str(tmp_path))).count() == 0


# --- losses ---------------------------------------------------------------------------


def numbers(spark, values, session="a"):
    return spark.createDataFrame([(session, v) for v in values], "who string, record_id bigint")


def test_losses_across_batches(spark, tmp_path):
    log = LossLog(str(tmp_path / "log"), F.col("who"))
    assert log.report(spark).count() == 0
    log(numbers(spark, [5, 6, 9, 9, None, -4]), 0)
    log(numbers(spark, [40_000, 100_000], "b"), 1)
    log(numbers(spark, [7, 70_000, 6]), 2)
    log(numbers(spark, [7, 70_000, 6]), 2)  # the batch comes again
    rows = {r.session: r for r in log.report(spark).collect()}
    a, b = rows["a"], rows["b"]
    assert (a["first"], a["last"], a.received, a.repeated, a.lost) == (5, 70_000, 5, 2, 69_991)
    assert (b["first"], b["last"], b.received, b.repeated, b.lost) == (40_000, 100_000, 2, 0, 59_999)
    assert {r.session: r.lost for r in log.report(spark, since=0).collect()} == {"a": 69_996, "b": 99_999}
    found = log.lost_numbers(spark).where("session = 'a' AND record_id < 32768").agg(F.min("record_id"), F.count("*")).first()
    assert tuple(found) == (8, 32_768 - 9)
    # Late records fill their gap.
    log(numbers(spark, range(10, 70_000)), 3)
    assert log.report(spark).where("session = 'a'").first().lost == 1
    assert [r.record_id for r in log.lost_numbers(spark).where("session = 'a'").collect()] == [8]


def lost_of(held):
    return sorted((r.session or "", r.record_id) for r in losses.lost_numbers(held).collect())


def test_lost_numbers_of_buckets_of_which_nothing_came(spark, tmp_path):
    n = losses.BITS
    log = LossLog(str(tmp_path / "log"), F.col("who"))
    assert log.lost_numbers(spark).count() == 0
    log(numbers(spark, [5, 3 * n + 1]), 0)
    log(numbers(spark, [n - 1, n, 5 * n], "b"), 1)
    log(numbers(spark, [2 * n, 4 * n], None), 2)
    log(numbers(spark, [7 * n + 7], "one"), 3)
    want = {"a": range(6, 3 * n + 1), "b": range(n + 1, 5 * n), "": range(2 * n + 1, 4 * n)}
    assert lost_of(log.held(spark)) == sorted((who, i) for who, ids in want.items() for i in ids)
    # As many as the report says, with what comes late too.
    log(numbers(spark, range(n, 3 * n)), 4)
    counts = {r.session: r["count"] for r in log.lost_numbers(spark).groupBy("session").count().collect()}
    assert counts == {r.session: r.lost for r in log.report(spark).collect() if r.lost}
    assert counts["a"] == n - 5


def test_buckets_between_numbers_far_apart(spark):
    n, top = losses.BITS, 2**63 - 1
    ends = spark.createDataFrame([("far", 3, 3 + n**2), ("high", top - n, top), (None, 7, 7)], "session string, first bigint, last bigint")
    found = losses.between(ends)
    assert found.where("session = 'far'").agg(F.count("*"), F.min("first"), F.max("last"), F.sum(F.expr("last - first + 1"))).first() == (
        n + 1, 3, 3 + n**2, n**2 + 1
    )
    rest = found.where("session = 'high' OR session IS NULL").select("session", "bucket", "first", "last").collect()
    assert sorted((r[0] or "", *r[1:]) for r in rest) == [
        ("", 0, 7, 7), ("high", top // n - 1, top - n, top - n), ("high", top // n, top - n + 1, top)
    ]
    assert found.dtypes == losses.bitmaps(spark.range(1), number="id").dtypes


def test_losses_are_spread_over_tasks(spark):
    held = losses.bitmaps(spark.range(200_000).withColumnRenamed("id", "record_id"))
    assert held.count() == 7 and held.agg(F.max(F.length("bits"))).first()[0] == 4096
    assert losses.report(held).first().lost == 0


# --- order ----------------------------------------------------------------------------


def times(spark, *stamps):
    return spark.createDataFrame(list(stamps), "TimeStamp bigint, record_id bigint").repartition(3)


def test_order_within_a_bound(spark, tmp_path):
    given = {}

    def take(frame, batch_id):
        given[batch_id] = [tuple(r) for r in frame.select("TimeStamp", "record_id").collect()]

    order = Reorder(take, str(tmp_path / "state"), delay=10)
    batches = [
        times(spark, (5, 1), (30, 2), (12, 3), (30, 0)), times(spark, (25, 4), (19, 5), (50, 6), (None, 7)),
        times(spark, (41, 8), (45, 9)).limit(0), times(spark, (40, 8), (45, 9), (61, 10)),
    ]
    for i, batch in enumerate(batches):
        order(batch, i)
        if i == 1:
            before = dict(given)
            order(batch, i)  # it comes again
            assert given == before
    order.flush(spark)
    assert given == {
        0: [(5, 1), (12, 3)], 1: [(25, 4), (30, 0), (30, 2)], 2: [], 3: [(45, 9), (50, 6)], 4: [(61, 10)],
    }
    counts = {r.batch: (r.given, r.late, r.held) for r in order.counts(spark).collect()}
    assert counts == {0: (2, 0, 2), 1: (3, 2, 1), 2: (0, 0, 1), 3: (2, 1, 1), 4: (1, 0, 0)}
    assert sorted(r.record_id for r in order.late(spark).collect()) == [5, 7, 8]
    # Only the last state is kept.
    assert files.names(spark, str(tmp_path / "state" / "marks")) == ["3.json", "4.json"]


# --- record log -----------------------------------------------------------------------


def test_log_entries_and_slices(spark, raw, tmp_path):
    path = str(tmp_path / "log")
    first = record_log.append(raw.limit(40).repartition(2), path)
    empty = record_log.append(raw.limit(0), path)
    more = record_log.append(raw.limit(25).coalesce(1), path)
    log = record_log.Log(path)
    assert (first.first, empty.first, more.first, log.end) == (0, 40, 40, 65) and len(log.entries) == 3
    found = list(log.slices(35, 50))
    assert sum(stop - begin for _, begin, stop, _ in found) == 15 and [x[3] for x in found][0] == 35
    assert list(log.slices(7, 7)) == [] and sum(s - b for _, b, s, _ in log.slices(0, 65)) == 65
    # An entry's number that is taken is not taken again.
    assert not files.put_new(spark, f"{path}/{record_log.entry_name(1)}", {})


def test_stream_of_records_is_paced_and_goes_on(spark, raw, tmp_path):
    path, seen = str(tmp_path / "log"), []
    record_log.append(raw.repartition(2), path)

    def run(fail_at=None):
        def take(batch, batch_id):
            rows = batch.select("record_id", F.size("ExtendedData")).collect()
            seen.append((batch_id, sorted(r.record_id for r in rows)))
            if batch_id == fail_at:
                raise InterruptedError("not now")

        stream = record_log.read_log_stream(spark, path, progress=str(tmp_path / "progress"), records_per_batch=300, records_per_task=70)
        assert stream.schema == raw.schema
        query = stream.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        except StreamingQueryException:
            assert fail_at is not None
        finally:
            query.stop()

    run(fail_at=1)
    run()
    record_log.append(raw.limit(10), path)
    run()
    assert [(i, len(rows)) for i, rows in seen] == [(0, 300), (1, 300), (1, 300), (2, 300), (3, 100), (4, 10)]
    assert seen[1] == seen[2]
    got = sorted(x for i, rows in {i: rows for i, rows in seen[:5]}.items() for x in rows)
    assert got == sorted(r.record_id for r in raw.select("record_id").collect())


def test_record_log_options(spark, tmp_path):
    record_log.register(spark)
    with pytest.raises(ValueError):
        record_log.RecordLog({"path": "x"}).streamReader(None)


# --- rules and counters ---------------------------------------------------------------


def test_rule_versions_and_snapshots(spark, tmp_path):
    rules = PidRules(spark, str(tmp_path / "rules"))
    lists = lambda version=None: sorted(map(tuple, rules.current(version).collect()))
    assert rules.version() == 0 and lists() == []
    rules.add("allow", 1, 2)
    one = rules.version()
    rules.remove("allow", 1)
    rules.add("deny", 7)
    two = rules.version()
    rules.compact()
    rules.compact()  # nothing has changed
    assert rules.version() == two and lists() == [("allow", 2), ("deny", 7)]
    rules.reset("deny")
    assert lists() == [("allow", 2)] and lists(one) == [("allow", 1), ("allow", 2)] and lists(two) == [("allow", 2), ("deny", 7)]
    rules.reset("allow")
    rules.compact()
    assert lists() == [] and rules.version() > two
    rules.add("deny", 8)
    assert lists() == [("deny", 8)] and lists(two) == [("allow", 2), ("deny", 7)]
    assert [n for n in files.names(spark, f"{rules.path}/snapshots") if n.endswith(".json")] == ["1.json", "2.json"]


def test_a_snapshot_counts_only_when_whole(spark, tmp_path):
    rules = PidRules(spark, str(tmp_path / "rules"))
    rules.add("allow", 1)
    # A compaction that died before its control file was written.
    spark.createDataFrame([(5, "allow", "add", 99)], "seq bigint, kind string, action string, pid bigint").write.parquet(f"{rules.path}/snapshots/1")
    assert [tuple(r) for r in rules.current().collect()] == [("allow", 1)]
    rules.compact()
    assert [tuple(r) for r in rules.current().collect()] == [("allow", 1)]


def test_batches_are_pinned_by_capture(spark, raw, tmp_path):
    live_ = LiveRules(str(tmp_path / "rules"))
    rules = PidRules(spark, live_.path)
    all_ = raw.count()
    assert live_.for_batch(raw, 0, "one").count() == all_
    rules.add("allow", 3)
    mine = raw.where("ProcessId = 3").count()
    assert live_.for_batch(raw, 0, "one").count() == all_ and live_.for_batch(raw, 1, "one").count() == mine
    assert live_.for_batch(raw, 0, "two").count() == mine


def test_counters_outlive_a_restart(spark, raw, manifest, tmp_path):
    path = str(tmp_path / "drop")
    raw.repartition(4).write.parquet(path)
    name, broken = f"counted-{uuid.uuid4()}", [True]

    def once(batch, batch_id):
        batch.count()
        if batch_id == 2 and broken:
            broken.pop()
            raise InterruptedError("not now")

    for _ in range(2):
        trace = Trace(manifest)
        session = live.Capture(
            read_events_stream(spark, path, 1), lambda r: live.observed(trace(r)), once, name=name, trigger={"availableNow": True}
        )
        session.start()
        try:
            session.wait()
        except StreamingQueryException:
            session._close()
    rows = session.counters().orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == [0, 1, 2, 3] and sum(r.input_rows for r in rows) == 1000
    assert sum(r.events for r in rows) == 1000 and not session.progress.waiting
