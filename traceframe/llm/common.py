"""What the operators share: reading tables, folders that all executors see, hashes, words."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z and a-z in the same order, for ASCII-only lower case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    visible(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def visible(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Unset on a local master (tests): a temporary one."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if sc.getCheckpointDir():
            return sc.getCheckpointDir()
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder now, without its lineage; what only that needed goes."""
    shared_folder(df.sparkSession)
    made = df.checkpoint(eager=True)
    let_go(df.sparkSession)
    return made


def let_go(spark: SparkSession) -> None:
    """Collect the driver's garbage: plans, broadcasts and shuffles of steps that are done.

    Spark removes these when the driver's heap is collected, which else is when it is full; by then an operator
    of many steps has filled it to its limit, and what it once took it keeps.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, from which each reader takes only the columns it needs."""
    return placed(df)[0]


def placed(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as :func:`written`, and where it lies, for :func:`removed`."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder of this run, by the file system that Spark uses."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Return what this Python worker has freed to the system: workers live on, beside those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def lean(tasks: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of a task's batches, which gives memory back at the end."""

    @wraps(tasks)
    def run(batches):
        try:
            yield from tasks(batches)
        finally:
            give_back()

    return run


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; NULL counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns that an operator's own output columns replace, in any case."""
    taken = {x.lower() for x in names}
    return df.select(*[column(df, c) for c in df.columns if c.lower() not in taken])


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, also where the name holds dots or back-ticks."""
    return df["`" + name.replace("`", "``") + "`"]


def merged_spans(spans: Column, kind: str = "bigint") -> Column:
    """Structs (start, end) in order, those that overlap or share an end as one."""
    empty = F.array().cast(f"array<struct<start:{kind},end:{kind}>>")

    def add(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        rest = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(
            (F.size(done) > 0) & (s["start"] <= last["end"]), F.concat(rest, F.array(joined))
        ).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, add)
