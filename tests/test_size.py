"""Work goes to tasks by rows, whatever the source's bytes on disk are."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from traceframe import checks
from traceframe.functions import le_bytes
from traceframe.sources import sample
from traceframe.sources.records import read_events, read_events_stream
from traceframe.streaming import files, losses


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(sample, "ROWS", 60)


def parts(df):
    """Rows by task."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_source_and_its_records_are_many_tasks(spark, small):
    n = sample.read_source(spark, SF_DIR, 1).count()
    assert n > 600
    for df in (checks._raw(spark, SF_DIR), checks.event_lines(spark, SF_DIR).select("record_id")):
        assert len(parts(df)) >= n // 120
    assert max(parts(checks._raw(spark, SF_DIR))) < 150
    assert checks._raw(spark, SF_DIR).select("record_id").distinct().count() == n


def test_stream_of_the_source_is_many_tasks(spark, small):
    seen = []
    stream = checks._stream(spark, SF_DIR)
    query = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.rdd.getNumPartitions())).trigger(availableNow=True)
    query.start().awaitTermination()
    assert max(seen) > 10


def batches(spark, path, n, folder):
    """Ids of each batch."""
    found = {}

    def save(batch, batch_id):
        found[batch_id] = sorted(r.record_id for r in batch.collect())

    stream = read_events_stream(spark, path, n).writeStream.foreachBatch(save)
    stream.option("checkpointLocation", str(folder)).trigger(availableNow=True).start().awaitTermination()
    return found


@pytest.mark.parametrize("skewed", [False, True])
def test_arrivals_are_batches_of_several_files(spark, small, tmp_path, skewed):
    """Also one of few records, and one of none."""
    part = F.when(F.col("record_id") < 3, 1).when(F.col("record_id") % 2 == 0, 2).otherwise(0) if skewed else F.col("record_id") % 4
    path, n = checks._arrivals(spark, SF_DIR, part, 4)
    assert n > 2
    found = batches(spark, path, n, tmp_path / "checkpoint")
    want = {i: [] for i in range(4)}
    for r in checks._raw(spark, SF_DIR).select("record_id", part.alias("part")).collect():
        want[r.part].append(r.record_id)
    assert found == {i: sorted(ids) for i, ids in want.items()}
    assert sum(name.endswith(".parquet") for name in files.names(spark, path)) == 4 * n


def test_dropped_files_are_four_batches(spark, small, tmp_path):
    path, n = checks._dropped(spark, SF_DIR)
    assert n > 2 and sum(name.endswith(".parquet") for name in files.names(spark, path)) == 4 * n
    found = batches(spark, path, n, tmp_path / "checkpoint")
    assert len(found) == 4
    ids = sorted(i for mine in found.values() for i in mine)
    assert ids == sorted(r.record_id for r in read_events(spark, path).select("record_id").collect())
    assert ids == sorted(r.record_id for r in checks._raw(spark, SF_DIR).select("record_id").collect())


@pytest.mark.parametrize("name", ["log_of_batches", "lost_events", "paced_by_records", "pinned_rules"])
def test_results_do_not_depend_on_the_number_of_files(spark, monkeypatch, name):
    one = rows(checks.QUERIES[name](spark, SF_DIR))
    monkeypatch.setattr(sample, "ROWS", 60)
    assert rows(checks.QUERIES[name](spark, SF_DIR)) == one


def test_record_log_has_more_files_with_more_rows(spark, small, monkeypatch):
    seen = []
    append = checks.record_log.append
    monkeypatch.setattr(checks.record_log, "append", lambda df, path: seen.append(append(df, path)) or seen[-1])
    checks.QUERIES["paced_by_records"](spark, SF_DIR)
    assert all(len(e.files) > 10 and max(n for _, n in e.files) < 150 for e in seen)


def test_lost_numbers_are_made_in_many_tasks(spark):
    numbers = spark.range(0, 40 * losses.BITS, 3).withColumnRenamed("id", "record_id")
    lost = losses.lost_numbers(losses.bitmaps(numbers))
    assert len(parts(lost)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = (40 * losses.BITS - 1) // 3 * 3
    assert lost.count() == last + 1 - (last // 3 + 1)


def test_le_bytes_of_any_width(spark):
    values = [0, 1, 255, 256, 0x0123456789ABCDEF, -1, -2, 2**63 - 1, -(2**63), None]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for width in range(1, 9):
        got = [r[0] for r in df.select(le_bytes(F.col("v"), width)).collect()]
        want = [None if v is None else (v % 2**64).to_bytes(8, "little")[:width] for v in values]
        assert [None if g is None else bytes(g) for g in got] == want
