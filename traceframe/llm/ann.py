"""Approximate nearest neighbours by an adaptive dimension scan of probed lists.

Index: k-means centroids fitted on a bounded sample give lists of about ``LIST_ROWS`` vectors;
every vector is rotated by one random orthogonal matrix and put into its nearest list, in blocks of
at most about ``BLOCK_ROWS`` rows, so that a list of any size is many tasks. Rows of equal id and
vector are one before that, and a block returns ids, each at its nearest row. Search: a query visits
the blocks of its nearest lists, as many as hold ``target`` of the nearest rows of queries tried
on the sample. In a block its first rows give a first bound; the others
are scanned in blocks of columns, and a row is given up once its partial distance shows, by a
hypothesis test on the rotated coordinates, that it lies beyond the bound (chance of a wrong
rejection falls as exp(-c * EPSILON^2)). The best of all blocks are ranked by the exact distance on
original vectors.

Defined cases: NULL, empty and zero vectors, those with NULL or non-finite components, and rows
without id take no part; vectors of one length are near to none of another; equal distances go to the smaller id; a
query gets all candidates if there are fewer than ``k``; repeated ids count once, at their
smallest distance; a query excludes its own id; an empty table gives an empty result; only ids come along, other
columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import column, stored, visible

SAMPLE_ROWS = 20_000
LIST_ROWS = 512
MAX_LISTS = 4096
BLOCK_ROWS = 2048
QUERY_ROWS = 16_384
CHUNK = 1024
#: Share of the sample's own nearest rows that the probed lists must hold.
TARGET = 0.97
TRIALS = 256
COLUMNS = 16
EPSILON = 2.1
SEED = 5
ROUNDS = 8


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that take part."""
    v = column(df, vector_col).cast("array<double>")
    rows = df.select(column(df, id_col).cast("bigint").alias("id"), v.alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & good & F.exists("v", lambda x: x != 0))


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def kmeans(sample: np.ndarray, lists: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        chunks = range(0, len(sample), CHUNK)
        near = np.concatenate([squares(sample[i : i + CHUNK], centres).argmin(1) for i in chunks])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def probes_for(sample: np.ndarray, centres: np.ndarray, k: int, target: float) -> int:
    """Lists to probe so that they hold ``target`` of the nearest sampled rows of sampled queries.

    In all the data the nearest rows are nearer than in the sample, so this errs on the safe side.
    """
    trial = sample[:: max(1, len(sample) // TRIALS)]
    ranks = []
    for at in range(0, len(trial), 64):
        some = trial[at : at + 64]
        n = min(k + 1, len(sample))  # a trial row is its own nearest
        near = np.argpartition(squares(some, sample), n - 1, axis=1)[:, :n]
        order = squares(some, centres).argsort(1).argsort(1)
        for row, places in zip(order, near, strict=True):
            ranks.append(row[squares(sample[places], centres).argmin(1)])
    found = np.sort(np.concatenate(ranks)) if ranks else np.zeros(1)
    return int(found[min(len(found) - 1, math.ceil(target * len(found)))]) + 1


def scan(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """For each query the places of its ``k`` nearest ids, each at its nearest row, without its own id.

    All vectors are rotated. ``rows`` are visited in column blocks; ``bound`` is the ``k``-th best of
    the first rows of the first ids.
    """
    n, dim = rows.shape
    lead = np.sort(np.unique(ids, return_index=True)[1])
    repeated = len(lead) < n
    lead = lead[: 4 * k]
    others = np.delete(np.arange(n), lead)
    found = []
    for q, me in zip(queries, own, strict=True):
        first = lead[ids[lead] != me]
        near = ((rows[first] - q) ** 2).sum(1)
        rest = others[ids[others] != me]
        if len(near) >= k and len(rest):
            bound = np.partition(near, k - 1)[k - 1]
            part = np.zeros(len(rest))
            for at in range(0, dim, COLUMNS):
                upto = min(dim, at + COLUMNS)
                part += ((rows[rest, at:upto] - q[at:upto]) ** 2).sum(1)
                # Expected share of the whole distance, and how far beyond it a near row may be.
                limit = bound if upto == dim else bound * (upto / dim) * (1 + EPSILON / math.sqrt(upto)) ** 2
                keep = part <= limit * (1 + 1e-9)
                rest, part = rest[keep], part[keep]
                if not len(rest):
                    break
        else:
            part = ((rows[rest] - q) ** 2).sum(1)
        places, all_ = np.concatenate((first, rest)), np.concatenate((near, part))
        if repeated:
            order = np.lexsort((all_, ids[places]))
            places, all_ = places[order], all_[order]
            nearest = np.append(True, ids[places][1:] != ids[places][:-1])[: len(places)]
            places, all_ = places[nearest], all_[nearest]
        if len(places) > k:  # ties at the edge stay: the exact ranking decides
            places = places[all_ <= np.partition(all_, k - 1)[k - 1] * (1 + 1e-9) + 1e-12]
            if len(places) > k:
                places = _smallest(places, rows, q, ids, k)
        found.append(places)
    return found


def _smallest(places: np.ndarray, rows: np.ndarray, q: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of them that are nearest; rotated distances equal but for rounding tie by id."""
    near = np.round(((rows[places] - q) ** 2).sum(1), 9)
    return places[np.lexsort((ids[places], near))[:k]]


def search(
    vectors: DataFrame,
    is_query,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    target: float = TARGET,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``id``, ``distance`` of the ``k`` nearest rows found for each query.

    ``is_query``: a column over ``id``. Vectors of each length are searched among themselves.
    """
    spark = vectors.sparkSession
    visible(spark)
    rows = usable(vectors, id_col, vector_col)
    # One row for each length that queries have.
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count_if(is_query).alias("n")).where("n > 0").orderBy("dim").collect()
    found = None
    for r in lengths:
        own = stored(rows.where(F.size("v") == r["dim"]).dropDuplicates(["id", "v"]))
        part = _search(own, is_query, r["dim"], k, target, sample_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, distance double")
    # An id may have vectors of several lengths: its nearest ids over all of them.
    return _ranked(found.groupBy("query_id", "id").agg(F.min("distance").alias("distance")), k) if len(lengths) > 1 else found


def _search(rows: DataFrame, is_query, dim: int, k: int, target: float, sample_rows: int) -> DataFrame:
    """The search among stored rows of one length."""
    spark = rows.sparkSession
    total = rows.count()
    draw = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < min(1.0, sample_rows / total)).toPandas()
    sample = sample.iloc[sorted(range(len(sample)), key=lambda i: (sample["id"][i], tuple(sample["v"][i])))]
    turn = rotation(dim)
    start = np.array(sample["v"].tolist(), float).reshape(-1, dim) @ turn
    centres = kmeans(start, min(MAX_LISTS, max(1, total // LIST_ROWS))) if len(start) else np.zeros((1, dim))
    probes = probes_for(start, centres, k, target)
    sent = spark.sparkContext.broadcast((turn, centres))  # MAX_LISTS x dim numbers at most

    def lists_of(count: int):
        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turn, centres = sent.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                flat = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                turned = flat @ turn
                for at in range(0, len(turned), CHUNK):
                    some = turned[at : at + CHUNK]
                    dist = squares(some, centres)
                    n = min(count, len(centres))
                    near = np.argpartition(dist, n - 1, axis=1)[:, :n] if n < len(centres) else np.tile(np.arange(n), (len(some), 1))
                    rid = np.repeat(batch["id"].to_numpy()[at : at + CHUNK], n)
                    raw = [x.tobytes() for x in some]
                    yield pa.RecordBatch.from_pydict(
                        {"id": rid, "list": near.ravel().astype(np.int32), "r": [x for x in raw for _ in range(n)]}
                    )

        return assign

    shape = "id bigint, list int, r binary"
    placed = stored(rows.mapInArrow(lists_of(1), shape))
    asked = rows.where(is_query).mapInArrow(lists_of(probes), shape)
    # One small row a list: broadcast. Blocks of rows meet blocks of the queries that probe the list.
    blocks = placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    halls = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("halls"))
    loads = F.broadcast(blocks.join(halls, "list"))
    part = lambda n: F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(loads, "list").withColumn("block", part("blocks")).withColumn("hall", every("halls"))
    right = asked.join(loads, "list").withColumn("hall", part("halls")).withColumn("block", every("blocks"))
    key = ["list", "block", "hall"]
    groups = left.select(*key, "id", "r").groupBy(key).cogroup(right.select(*key, "id", "r").groupBy(key))

    def visit(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "id": []}
        if len(rows) and len(queries):
            matrix = np.frombuffer(b"".join(rows["r"]), np.float64).reshape(-1, dim)
            ids = rows["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            matrix, ids = matrix[order], ids[order]
            asked = np.frombuffer(b"".join(queries["r"]), np.float64).reshape(-1, dim)
            own = queries["id"].to_numpy()
            for me, places in zip(own, scan(asked, matrix, ids, own, k), strict=True):
                out["query_id"] += [me] * len(places)
                out["id"] += ids[places].tolist()
        return pd.DataFrame(out, dtype="int64")

    pairs = groups.applyInPandas(visit, "query_id bigint, id bigint")
    # Exact distances on original vectors decide the ranks.
    return exact(pairs, rows, k)


def exact(pairs: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    q = rows.select(F.col("id").alias("query_id"), F.col("v").alias("qv"))
    near = pairs.distinct().join(rows, "id").join(q, "query_id")
    parts = F.zip_with("v", "qv", lambda a, b: (a - b) * (a - b))
    distance = F.sqrt(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x))
    return _ranked(near.groupBy("query_id", "id").agg(F.min(distance).alias("distance")), k)


def _ranked(best: DataFrame, k: int) -> DataFrame:
    top = F.slice(F.array_sort(F.collect_list(F.struct("distance", "id"))), 1, k)
    ranked = best.groupBy("query_id").agg(top.alias("top"))
    return ranked.select("query_id", F.posexplode("top").alias("p", "t")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("t.id").alias("id"), F.col("t.distance").alias("distance")
    )
