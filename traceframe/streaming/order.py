"""Time order in a stream, within a bound.

Each batch gives, in order, the records that are older than the newest time seen less ``delay``;
younger ones are held for the next batch. A record that comes after later ones have been given is late: it is
kept apart and counted, and never given out of order. All state is tables by batch: what a batch
holds back, and a control file with the time up to which records have been given. A repeated
batch reads the state of the one before it and gives the same again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe.operators.lookup import chronological
from traceframe.streaming import files

LATE = "batch BIGINT, given BIGINT, late BIGINT, held BIGINT"


def event_time(df: DataFrame) -> Column:
    """The time of raw records or of decoded events."""
    return F.col("TimeStamp") if "TimeStamp" in df.columns else F.col("EventHeader.TimeStamp")


class Reorder:
    """A batch function that gives ``fn`` batches in time order.

    ``fn(frame, batch_id)`` gets a frame sorted by (time, ``record_id``): a range sort, no
    single task. ``delay`` is in units of the time stamp (100 ns). Rows without a time are late.
    Call :meth:`flush` after the last batch to give what is still held.
    """

    def __init__(self, fn: Callable[[DataFrame, int], None], path: str, delay: int):
        self.fn, self.path, self.delay = fn, path, delay

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._step(batch, batch_id, flush=False)

    def flush(self, spark: SparkSession) -> None:
        """Give what is held. Records that come after this are late if older than what was given."""
        last = max(self._marks(spark), default=None)
        if last is not None:
            none = self._held(spark, last).limit(0).drop("__at")
            self._step(none, last + 1, flush=True)

    def _marks(self, spark: SparkSession) -> list[int]:
        """Batches whose state is kept: the last ones."""
        return [int(n.removesuffix(".json")) for n in files.names(spark, f"{self.path}/marks") if n.endswith(".json")]

    def _held(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/held/{batch_id}")

    def _step(self, batch: DataFrame, batch_id: int, flush: bool) -> None:
        spark = batch.sparkSession
        before = max((n for n in self._marks(spark) if n < batch_id), default=None)
        mark = {"given_to": None, "newest": None}
        if before is not None:
            mark = files.get(spark, f"{self.path}/marks/{before}.json")
        given_to = mark["given_to"]
        # One pass over the batch: its rows come from a source or a decode.
        rows = batch.withColumn("__at", event_time(batch).cast("bigint"))
        on_time = F.col("__at").isNotNull()
        if given_to is not None:
            on_time = on_time & (F.col("__at") > F.lit(given_to))
        rows = rows.withColumn("__late", ~on_time)
        if before is not None:
            rows = rows.unionByName(self._held(spark, before).withColumn("__late", F.lit(False)))
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/{batch_id}")
        rows = spark.read.schema(rows.schema).parquet(f"{self.path}/rows/{batch_id}")

        fresh = rows.where("NOT __late").agg(F.max("__at")).first()[0]
        newest = max((x for x in (fresh, mark["newest"]) if x is not None), default=None)
        until = newest if flush or newest is None else newest - self.delay
        up_to = max((x for x in (given_to, until) if x is not None), default=None)
        ready = F.lit(False) if up_to is None else F.col("__at") <= F.lit(up_to)
        due, waits = F.expr("NOT __late") & ready, F.expr("NOT __late") & ~ready
        rows.where(waits).drop("__late").write.mode("overwrite").parquet(f"{self.path}/held/{batch_id}")
        self.fn(chronological(rows.where(due).drop("__at", "__late")), batch_id)
        rows.where("__late").drop("__at", "__late").write.mode("overwrite").parquet(f"{self.path}/late/{batch_id}")
        counts = rows.agg(
            F.lit(batch_id).cast("bigint").alias("batch"), F.count_if(due).alias("given"), F.count_if("__late").alias("late"),
            F.count_if(waits).alias("held"),
        )
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/{batch_id}")
        files.put_new(spark, f"{self.path}/marks/{batch_id}.json", {"given_to": up_to, "newest": newest})
        # A batch can be run again only until the next one begins.
        for old in self._marks(spark):
            if old < batch_id - 1:
                for folder in (f"rows/{old}", f"held/{old}", f"marks/{old}.json"):
                    files.remove(spark, f"{self.path}/{folder}")

    def counts(self, spark: SparkSession) -> DataFrame:
        """Per batch how many rows were given, came too late, and were held back."""
        return spark.read.schema(LATE).option("recursiveFileLookup", True).parquet(f"{self.path}/counts")

    def late(self, spark: SparkSession) -> DataFrame:
        """All rows that came too late."""
        return spark.read.option("recursiveFileLookup", True).parquet(f"{self.path}/late")
