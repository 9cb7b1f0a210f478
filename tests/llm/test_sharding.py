import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import documents
from traceframe.llm import queries, sharding

SF = "/root/testdata/sf0.01"


def test_all_rows_once_and_slots_without_gaps(spark):
    rows = queries.op7_shards(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(1000))
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    assert set(by) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert any(r["grown_shard"] == 24 for r in rows)
    again = queries.op7_shards(spark, SF).collect()
    assert sorted(rows) == sorted(again)


def test_growing_by_one_shard_is_what_was_said(spark):
    docs = documents(spark).withColumn("size", F.lit(1))
    deal = lambda n: sharding.external_shuffle(docs, id_col="doc_id", size=F.col("size"), shards=n)
    now, more = deal(3).collect(), deal(4).collect()
    assert {r["doc_id"]: r["grown_shard"] for r in now} == {r["doc_id"]: r["shard"] for r in more}


def test_many_buckets_and_odd_rows(spark):
    docs = documents(spark, [(7, "same")] * 500 + [(i, None) for i in range(50)] + [(None, "")])
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 8
    made = sharding.external_shuffle(docs, id_col="doc_id", size=size, shards=2, bucket_bytes=300)
    rows = made.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    for shard in {r["shard"] for r in rows}:
        slots = [r["slot"] for r in rows if r["shard"] == shard]
        assert sorted(slots) == list(range(len(slots)))
    assert all(r["score"] == "own score" and r["row"] == "own row" for r in rows)
    assert sharding.external_shuffle(docs.limit(0), id_col="doc_id", size=size, shards=2).count() == 0


def test_the_law_in_plain_python(spark):
    """Spark's xxhash64 of a text and two numbers, by the xxhash library; the largest wins."""
    rows = queries.op7_shards(spark, SF).collect()

    def weight(key, shard):
        h = 42
        data = key.encode()
        h = xxhash.xxh64_intdigest(data, h)
        for n in (sharding.SEED, shard):
            h = xxhash.xxh64_intdigest(n.to_bytes(4, "little", signed=True), h)
        return h - (1 << 64) if h >= 1 << 63 else h

    for r in rows:
        best = max((weight(str(r["doc_id"]), s), s) for s in range(24))[1]
        grown = max((weight(str(r["doc_id"]), s), s) for s in range(25))[1]
        assert (r["shard"], r["grown_shard"]) == (best, grown) and r["law"] == "key"


def test_files_and_their_order_make_no_difference(spark):
    docs = documents(spark, [(i, f"text {i % 50}") for i in range(3000)], extra=False)
    deal = lambda d: sorted(map(tuple, sharding.external_shuffle(
        d, id_col="doc_id", size=F.octet_length("text"), shards=3, bucket_bytes=400).collect()))
    one = deal(docs.coalesce(1))
    assert one == deal(docs.orderBy(F.desc("doc_id")).repartition(5)) == deal(docs.repartition(3, "text"))


def test_a_bucket_is_a_task(spark):
    docs = documents(spark, [(i, "x" * 92) for i in range(4000)] + [(9, "same" * 23)] * 2000, extra=False)
    made, total = sharding.scatter(docs, id_col="doc_id", size=F.octet_length("text") + 8, shards=4, seed=1, bucket_bytes=10_000)
    assert 60 <= total <= 70
    sizes = [r["count"] for r in made.groupBy("__bucket").count().collect()]
    assert len(sizes) == total and max(sizes) < 200  # also where a third of all records are equal
    out = sharding.external_shuffle(docs, id_col="doc_id", size=F.octet_length("text") + 8, shards=4, bucket_bytes=10_000)
    per_task = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == total and max(r["count"] for r in per_task) < 200
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") <= 4


def test_order_is_shuffled(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"))
    rows = sharding.external_shuffle(docs, id_col="doc_id", size=F.lit(1), shards=1).collect()
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["slot"])]
    rising = sum(a < b for a, b in zip(order, order[1:], strict=False))
    assert 430 < rising < 570 and sum(i == x for i, x in enumerate(order)) < 15


def test_no_python_in_the_plan(spark):
    plan = queries.op7_shards(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_whole_records_are_dealt(spark, monkeypatch):
    seen = []
    deal = sharding.external_shuffle
    monkeypatch.setattr(sharding, "external_shuffle", lambda df, **k: seen.append(deal(df, **k)) or seen[-1])
    rows = queries.op7_shards(spark, SF).select("doc_id", "size", "text_crc32").collect()
    assert "text" in seen[0].columns
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r["size"] == len(docs[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]]) for r in rows)
    plan = queries.op7_shards(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("crc32") < plan.index("collect_list")


def test_written_shards(spark, tmp_path):
    docs = documents(spark)
    sharding.write(sharding.external_shuffle(docs, id_col="doc_id", size=F.lit(1), shards=3), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()
