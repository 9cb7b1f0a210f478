"""A corpus through five operators, each stage written as Parquet and read again by the next.

Repeated ids, NULLs, empty and very long texts: a stage judges rows, and whole texts, as its operator defines.
An empty table stays empty. Columns named like an operator's outputs keep their own values. Ties in quality stay
(the bound belongs to the kept). Documents with NULL id are never duplicates. Near duplicates are judged by id and text, so of the rows of one id
those stay whose texts are like no other; of equal rows one stays.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traceframe.llm import bpe, decontaminate, jaccard, line_dedup, quality
from traceframe.llm.common import column, crc_mod, read, removed, shared_folder

#: Documents with a lower probability of label 1 are rejected.
QUALITY = 0.3
#: Share of the encoder's usual tables that a task of the last stage holds beside what earlier stages left.
REMEMBERED = 0.3
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000
#: Texts, by id and hash, that may be broadcast, 32 MB; more are joined by shuffle.
TEXTS = 2_000_000


def small_batches(stage):
    """The stage with at most ``BATCH_ROWS`` rows in an Arrow batch, for its session from then on.

    Whole texts travel in such batches, several at a time in each task and on both sides, beside all
    that earlier stages have left in the workers. A smaller setting of the session stays.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = int(spark.conf.get(ARROW_ROWS, "10000"))
        if rows <= 0 or rows > BATCH_ROWS:
            spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality").where(crc_mod("doc_id", 5) != 0)
    scored = quality.score(_aside(docs, quality.OUTPUTS), quality.fit(docs.select("doc_id", "text"), labels))
    return _back(scored.where(F.col("score") >= QUALITY), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks that earlier ones hold; those of which nothing is left go."""
    cut = line_dedup.dedup(_aside(docs, [line_dedup.OUT]))
    changed = F.size(line_dedup.OUT) > 0
    cut = cut.where(~changed | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return _back(cut, docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of the smallest id of each group of near duplicates, and all rows without words or id."""
    found = jaccard.near_duplicates(docs.select("doc_id", "text")).where("n > 0 AND id IS NOT NULL")
    first = (F.col("component") == F.col("id")) & (F.col("component_th") == F.col("th"))
    rows = found.groupBy(F.col("id").alias("__id"), F.col("th").alias("__th")).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(first).alias("__first")
    )
    rows = rows.where("__rows > 1 OR NOT __first")
    if rows.count() <= TEXTS:
        rows = F.broadcast(rows)
    text = F.xxhash64(column(docs, "text").cast("string"))
    joined = docs.join(rows, (docs["doc_id"] == F.col("__id")) & (text == F.col("__th")), "left")
    one = joined.where(F.col("__id").isNull())
    again = joined.where("__first").dropDuplicates(["__id", "__th"])
    return _back(one, docs).unionByName(_back(again, docs))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any word of a benchmark window."""
    found = decontaminate.mark(_aside(docs, decontaminate.OUTPUTS), read(spark, sf_dir, "benchmark"))
    return _back(found.where("n_hit = 0"), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, and whether they decode to it."""
    made = bpe.encode_checked(docs.select("doc_id", "text"), keep=["doc_id"], share=REMEMBERED)
    return made.select("doc_id", F.size("token_ids").alias("n_tokens"), "token_ids", "lossless")


def _aside(docs: DataFrame, names) -> DataFrame:
    """``docs`` with columns that an operator would replace under another name."""
    taken = {n.lower() for n in names}
    return docs.select(*[column(docs, c).alias(_other(c) if c.lower() in taken else c) for c in docs.columns])


def _back(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, under their names."""
    return df.select(*[column(df, _other(c) if _other(c) in df.columns else c).alias(c) for c in docs.columns])


def _other(name: str) -> str:
    return f"__own_{name}"


STAGES = [
    ("quality", small_batches(good)),
    ("line_dedup", small_batches(lines)),
    ("near_duplicates", small_batches(distinct)),
    ("decontaminate", small_batches(clean)),
    ("tokens", small_batches(tokens)),
]
#: Neither the classifier nor the tokenizer can be put in SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written under ``spark.checkpoint.dir``; the last one's rows.

    A stage's table is removed when the next one's is whole.
    """
    docs = read(spark, sf_dir, "documents")
    folder, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            removed(spark, before)
        before = path
    return docs
