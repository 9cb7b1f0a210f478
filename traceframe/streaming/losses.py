"""Lost events: record numbers that never came, by session, across batches and restarts.

A session numbers its records. What has come is kept as bitmaps of 32,768 numbers, four kilobytes
each, made before the shuffle; a batch adds its bitmaps as one folder of a table,
which a repeated batch overwrites. So nothing depends on the order of records, records that come late
fill their gap, records that come twice count once, and a session with all the rows is spread
over as many tasks as it has bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe.streaming import files

#: Numbers in one bitmap.
BITS = 32_768
HELD = "session STRING, bucket BIGINT, bits BINARY, first BIGINT, last BIGINT, rows BIGINT"


def bitmaps(records: DataFrame, session: Column | None = None, number: str = "record_id") -> DataFrame:
    """``HELD``: the numbers that came, by session and bucket. Rows without a number are left out."""
    who = F.lit("") if session is None else session.cast("string")
    rows = records.select(who.alias("session"), F.col(number).cast("bigint").alias("n")).where("n >= 0")
    return rows.groupBy("session", F.expr(f"n div {BITS}").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(n % {BITS})").alias("bits"), F.min("n").alias("first"), F.max("n").alias("last"),
        F.count(F.lit(1)).alias("rows"),
    )


def together(held: DataFrame) -> DataFrame:
    """Bitmaps of several batches as one for each session and bucket."""
    return held.groupBy("session", "bucket").agg(
        F.expr("bitmap_or_agg(bits)").alias("bits"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum("rows").alias("rows"),
    )


def report(held: DataFrame, since: int | None = None) -> DataFrame:
    """Per session the first and last number, how many came, came again, and were lost between.

    ``since`` is the first number a session gives, if that is known; else the first that came counts.
    """
    counted = together(held).select("session", "first", "last", "rows", F.expr("bitmap_count(bits)").alias("came"))
    out = counted.groupBy("session").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("came").alias("received"),
        (F.sum("rows") - F.sum("came")).alias("repeated"),
    )
    begin = F.col("first") if since is None else F.least("first", F.lit(since).cast("bigint"))
    return out.withColumn("lost", F.col("last") - begin + 1 - F.col("received"))


def between(ends: DataFrame) -> DataFrame:
    """``HELD`` with no bits: each bucket from ``first`` to ``last`` of a session, and its first and last number of these.

    In three steps, so that no row makes a long list, however far the two are apart.
    """
    for size in (BITS**3, BITS**2, BITS):
        piece = F.explode(F.expr(f"sequence(first div {size}, last div {size})")).alias("bucket")
        low = F.greatest("first", F.col("bucket") * size).alias("first")
        high = F.least("last", F.col("bucket") * size + (size - 1)).alias("last")
        ends = ends.select("session", piece, "first", "last").select("session", "bucket", low, high)
    bits, rows = F.lit(None).cast("binary").alias("bits"), F.lit(0).cast("bigint").alias("rows")
    return ends.select("session", "bucket", bits, "first", "last", rows)


def lost_numbers(held: DataFrame) -> DataFrame:
    """``session`` and ``record_id`` of all lost numbers between the first and last of each session.

    Also those of buckets of which nothing came, which have no bitmap.
    """
    ends = held.groupBy("session").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    every = between(ends)
    # A bitmap is small and gives many rows: by their size all of them would be one task. A number of tasks given
    # after the last grouping would not count, as that has the same keys.
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = together(held).select(every.columns).union(every).repartition(parts, "session", "bucket")
    some = together(pieces).where(F.expr("bitmap_count(bits)") < BITS)
    number = F.explode(F.sequence("first", "last"))
    numbers = some.select("session", "bits", number.alias("record_id"))
    place = (F.col("record_id") % BITS).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.call_function("shiftright", byte, place % 8).bitwiseAND(F.lit(1)) == 1
    return numbers.where(~there).select("session", "record_id")


class LossLog:
    """A table of bitmaps at ``path``; call it with each batch of records."""

    def __init__(self, path: str, session: Column | None = None, number: str = "record_id"):
        self.path, self.session, self.number = path, session, number

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        held = bitmaps(batch, self.session, self.number)
        held.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def held(self, spark: SparkSession) -> DataFrame:
        if not files.exists(spark, self.path):
            return spark.createDataFrame([], HELD)
        return spark.read.schema(HELD).parquet(self.path)

    def report(self, spark: SparkSession, since: int | None = None) -> DataFrame:
        return report(self.held(spark), since)

    def lost_numbers(self, spark: SparkSession) -> DataFrame:
        return lost_numbers(self.held(spark))
