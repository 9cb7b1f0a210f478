"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters records by seeded hashes: the id and the number of shards decide the shard
(rendezvous hashing, so that one more shard takes records only into itself), and a hash of the whole
record the bucket inside it. A shard has as many buckets as its bytes need for ``bucket_bytes``
each. Pass two gives each bucket a task of its own, which puts it into the order of its hashes and applies
``shuffle``, Spark's Fisher-Yates permutation of an array, seeded. Buckets follow each other in their
shard, so ``slot`` counts from 0 without gaps. Files and their order make no difference. Scattered
records are stored in ``spark.checkpoint.dir`` between the passes.

Records that occur more than ``ALIKE`` times, the same in all columns, are spread over the buckets by
their place in the stored table, so that they do not pile up in one.

Defined cases: NULL ids hash like an empty text and NULL text has no bytes; records of one id share a shard and are spread over
its buckets; equal records are told apart by nothing but their slots; an empty table gives an empty result; a very
long text makes its bucket larger than ``bucket_bytes``. Input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traceframe.llm.common import column, stored, without

SEED = 11
BUCKET_BYTES = 32 << 20
#: Equal records up to this many stay together; a list of more common ones may be broadcast up to its size.
ALIKE = 64
BROADCAST_ALIKE = 1_000_000
OUTPUTS = ("shard", "slot", "grown_shard")


def weight(key: Column, shard: int, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed), F.lit(shard))


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose hash with the key is the largest; ties to the larger number."""
    found, *more = [F.struct(weight(key, s, seed).alias("w"), F.lit(s).alias("s")) for s in range(shards)]
    return (F.greatest(found, *more) if more else found)["s"]


def scatter(df: DataFrame, *, id_col: str, size: Column, shards: int, seed: int, bucket_bytes: int) -> tuple[DataFrame, int]:
    """Pass one: ``df`` with ``__shard``, ``__grown``, ``__bucket`` (numbered over all shards), stored; and the number of buckets."""
    key = F.coalesce(column(df, id_col).cast("string"), F.lit(""))
    whole = [column(df, f.name) for f in df.schema if "map<" not in f.dataType.simpleString()]
    made = df.select(
        "*", key.alias("__key"), size.alias("__size"), F.xxhash64(F.lit(seed), key, *whole).alias("__hash"),
        F.monotonically_increasing_id().alias("__place"),
    )
    k = F.col("__key")
    made = stored(made.withColumns({"__shard": shard_of(k, shards, seed), "__grown": shard_of(k, shards + 1, seed)}))
    loads = made.groupBy("__shard").agg(F.sum("__size").alias("bytes")).collect()  # one row a shard
    count, first, total = [], [], 0
    for r in sorted(loads, key=lambda r: r["__shard"]):
        n = max(1, -(-r["bytes"] // bucket_bytes))
        count += [F.lit(r["__shard"]), F.lit(n)]
        first += [F.lit(r["__shard"]), F.lit(total)]
        total += n
    if not total:
        return made.withColumn("__bucket", F.lit(0)), 1
    many = stored(made.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > ALIKE).select("__hash"))
    spread = F.lit(0).cast("bigint")
    if not many.isEmpty():
        many = many.withColumn("__many", F.lit(True))
        made = made.join(F.broadcast(many) if many.offset(BROADCAST_ALIKE).isEmpty() else many, "__hash", "left")
        spread = F.when(F.col("__many"), F.col("__place")).otherwise(spread)
    share = F.pmod(F.xxhash64(F.lit(seed), "__hash", spread), F.lit(1 << 30)) / float(1 << 30)
    shard = F.col("__shard")
    bucket = F.create_map(*first)[shard] + F.floor(share * F.create_map(*count)[shard]).cast("int")
    return made.withColumn("__bucket", bucket.cast("int")), total


def external_shuffle(
    df: DataFrame,
    *,
    id_col: str,
    size: Column,
    shards: int,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``df`` with ``shard``, ``slot`` in it, and ``grown_shard`` for one more shard."""
    base = without(df, OUTPUTS)
    kept = base.columns
    made, total = scatter(base, id_col=id_col, size=size, shards=shards, seed=seed, bucket_bytes=bucket_bytes)
    counts = made.groupBy("__shard", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    # One row for each bucket.
    starts = F.broadcast(counts.select("__bucket", (F.sum("__n").over(before) - F.col("__n")).alias("__start")))
    record = F.struct(
        F.xxhash64("__hash", F.lit(seed)).alias("__order"), "__key", "__shard", "__grown",
        F.struct(*[column(made, c) for c in kept]).alias("row"),
    )
    gathered = (
        made.select("__bucket", record.alias("__record")).repartitionById(total, F.col("__bucket"))
        .groupBy("__bucket").agg(F.collect_list("__record").alias("__rows"))
    )
    placed = gathered.withColumn("__rows", F.shuffle(F.array_sort("__rows", _by_order), seed))
    return (
        placed.join(starts, "__bucket")
        .select("__start", F.posexplode("__rows").alias("__pos", "__r"))
        .select(
            *[F.col("__r.row").getField(c).alias(c) for c in kept],
            F.col("__r.__shard").alias("shard"), (F.col("__start") + F.col("__pos")).alias("slot"),
            F.col("__r.__grown").alias("grown_shard"),
        )
    )


def _by_order(a: Column, b: Column) -> Column:
    x, y = F.struct(a["__order"], a["__key"]), F.struct(b["__order"], b["__key"])
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def write(df: DataFrame, path: str) -> None:
    """One folder a shard, its files in slot order, no file larger than a task's share."""
    ranged = df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").mode("overwrite").parquet(path)
