"""Centroid clustering of integer vectors, with Orchard's search for the nearest centroid.

Each centroid has a list of all others, nearest first. A vector starts at one centroid and walks
its list; whenever a centroid is closer (or as close, with a smaller number) it jumps to that one's list
and begins anew. Centroids already measured are marked and passed over. The walk
ends when the list's next entry lies strictly beyond twice the current distance, as no
later one can be as close (triangle inequality). All vectors of a batch walk at once in numpy.

Everything is exact: components are whole numbers, distances are compared squared, and sums are
kept in limbs of 50 bits, added by Spark as decimals, so that neither rows nor magnitudes
overflow. Each round is one pass: tasks send a sum for each centroid and component they have met,
added up before and after the shuffle. The driver sees ``k`` centroids and nothing that grows with
the table. Vectors whose numbers exceed ``SMALL`` take the same steps with Python integers.

Defined cases: vectors that are NULL, of another length, or hold NULL or non-finite components take no
part; NULL ids may take part (they hash as the empty id); equal hashes begin with the smaller
vector, so repeated rows of one id may be several centroids; equal distances go to the smaller
number; fewer vectors than centroids: each is one; an empty table gives no rows; distances and
inertias beyond a BIGINT are NULL; only the id column comes along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import column, visible, written

DIMENSIONS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Components up to this size are 64-bit numbers throughout: four times the sum of ``WIDE`` squared differences fits.
SMALL = 1 << 24
WIDE = 1 << 10
LIMB = 50
#: Vectors that walk at once.
BLOCK = 8192
LONG = (1 << 63) - 1


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles, exactly: 64-bit numbers if all are small, else Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    if not scaled.size or (values.shape[-1] <= WIDE and np.abs(scaled).max() <= SMALL):
        return scaled.astype(np.int64)
    # Beyond 2 ** 53 a double is a whole number, so that it can be multiplied as one.
    exact = [int(x) * scale if abs(x) >= 2**53 else int(s) for x, s in zip(values.ravel(), scaled.ravel(), strict=True)]
    return np.array(exact, dtype=object).reshape(values.shape)


class Centroids:
    """Centroids with their lists of neighbours."""

    def __init__(self, rows: list[list[int]]):
        self.exact = rows
        small = all(len(row) <= WIDE and abs(x) <= SMALL for row in rows for x in row)
        self.rows = np.array(rows, dtype=np.int64 if small else object).reshape(len(rows), len(rows[0]) if rows else 0)
        k = len(rows)
        self.between = np.array([[_squared(a, b) for b in rows] for a in rows], dtype=object).reshape(k, k)
        if not k or max(x for row in self.between for x in row) <= LONG // 4:
            self.between = self.between.astype(np.int64)
        #: ``list[c]``: the other centroids, nearest to ``c`` first, ties by number.
        self.list = np.array([sorted((j for j in range(k) if j != c), key=lambda j: (self.between[c, j], j)) for c in range(k)], dtype=np.int64)
        self.list = self.list.reshape(k, max(k - 1, 0))

    def nearest(self, vectors: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of and squared distance to the nearest centroid of each vector; distances computed."""
        n, k = len(vectors), len(self.exact)
        kind = object if object in (vectors.dtype, self.rows.dtype, self.between.dtype) else np.int64
        vectors, rows, between = vectors.astype(kind), self.rows.astype(kind), self.between.astype(kind)

        def measure(which: np.ndarray, to: np.ndarray) -> np.ndarray:
            away = vectors[which] - rows[to]
            return (away * away).sum(axis=1) if kind is object else np.einsum("ij,ij->i", away, away)

        here = np.full(n, start)
        best = measure(np.arange(n), here)
        marked = np.zeros((n, k), dtype=bool)
        marked[:, start] = True
        place, walking, measured = np.zeros(n, dtype=np.int64), np.arange(n), n
        while len(walking):
            walking = walking[place[walking] < k - 1]
            to = self.list[here[walking], place[walking]]
            within = np.asarray(between[here[walking], to] <= 4 * best[walking], dtype=bool)
            walking, to = walking[within], to[within]
            place[walking] += 1
            fresh = ~marked[walking, to]
            some, to = walking[fresh], to[fresh]
            marked[some, to] = True
            away = measure(some, to)
            measured += len(some)
            jump = np.asarray((away < best[some]) | ((away == best[some]) & (to < here[some])), dtype=bool)
            some = some[jump]
            here[some], best[some], place[some] = to[jump], away[jump], 0
        return here, best, measured


def _squared(a: list[int], b: list[int]) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def usable(df: DataFrame, id_col: str, vector_col: str, dimensions: int) -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that take part."""
    v = column(df, vector_col).cast("array<double>")
    rows = df.select(column(df, id_col).alias("id"), v.alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("v") == dimensions) & good)


def _first(rows: DataFrame, k: int, seed: int, scale: int) -> list[list[int]]:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    found = rows.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return [[int(x) for x in whole(np.array([r["v"]]), scale)[0]] for r in found]


def _blocks(batch: pa.RecordBatch, name: str, dimensions: int, scale: int) -> Iterator[tuple[slice, np.ndarray]]:
    values = batch.column(name).flatten().to_numpy().reshape(-1, dimensions)
    for i in range(0, len(values), BLOCK):
        yield slice(i, i + BLOCK), whole(values[i : i + BLOCK], scale)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(position, limb) with the sign of the value; nothing for 0."""
    sign, value, at = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield at, sign * (value & ((1 << LIMB) - 1))
        value >>= LIMB
        at += 1


def _round(rows: DataFrame, centroids: Centroids, dimensions: int, scale: int) -> list[list[int]]:
    """The centroids after all vectors have been assigned once."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids.exact)
        total = [[0] * dimensions for _ in range(k)]
        count = [0] * k
        for batch in batches:
            for _, vectors in _blocks(batch, "v", dimensions, scale):
                near, _, _ = centroids.nearest(vectors)
                for c in np.unique(near):
                    some = vectors[near == c].sum(axis=0)
                    total[c] = [a + int(b) for a, b in zip(total[c], some, strict=True)]
                    count[c] += int((near == c).sum())
        out = [(c, -1, 0, count[c]) for c in range(k) if count[c]]
        out += [(c, d, at, limb) for c in range(k) for d in range(dimensions) for at, limb in _limbs(total[c][d])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0)))],
            ["c", "d", "at", "part"],
        )

    parts = rows.select("v").mapInArrow(sums, "c int, d int, at int, part decimal(38,0)")
    total = [[0] * dimensions for _ in centroids.exact]
    count = [0] * len(centroids.exact)
    for r in parts.groupBy("c", "d", "at").agg(F.sum("part").alias("part")).collect():
        if r["d"] < 0:
            count[r["c"]] = int(r["part"])
        else:
            total[r["c"]][r["d"]] += int(r["part"]) << (LIMB * r["at"])
    return [
        [x // n for x in sums_] if n else old for sums_, n, old in zip(total, count, centroids.exact, strict=True)
    ]


def cluster(
    df: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """Id, ``cluster`` and squared ``distance`` of each vector, and the final centroids."""
    visible(df.sparkSession)
    rows = usable(df, id_col, vector_col, dimensions)
    centroids = Centroids(_first(rows, k, seed, scale))
    for _ in range(rounds if centroids.exact else 0):
        moved = _round(rows, centroids, dimensions, scale)
        if moved == centroids.exact:  # further rounds would change nothing
            break
        centroids = Centroids(moved)
    kind = rows.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in _blocks(batch, "v", dimensions, scale):
                near, distance, _ = centroids.nearest(vectors)
                far = [x if x <= LONG else None for x in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id")[at], pa.array(near, pa.int32()), pa.array(far, pa.int64())], ["id", "cluster", "distance"]
                )

    found = rows.mapInArrow(assign, f"id {kind}, cluster int, distance bigint")
    return found.withColumnRenamed("id", id_col), centroids.exact


def with_inertia(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``found`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of each vector's cluster."""
    found = written(found)
    whole_sum = lambda: F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(whole_sum().alias("sum"), F.count(F.when(F.col("distance").isNull(), 1)).alias("far")).collect()
    inertia = {r["cluster"]: None if r["far"] else int(r["sum"]) for r in sums}
    every = None if None in inertia.values() else sum(inertia.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def by_cluster(value: Callable, kind: str) -> Column:
        # One value for each of the k centroids.
        return F.get(F.array(*[F.lit(value(c)).cast(kind) for c in range(len(centroids))]).cast(f"array<{kind}>"), F.col("cluster"))

    def long(value: int | None) -> int | None:
        return value if value is not None and value <= LONG else None

    return found.withColumns(
        {
            "cluster_inertia": by_cluster(lambda c: long(inertia.get(c)), "bigint"),
            "inertia": F.lit(long(every)).cast("bigint"),
            "centroid_sha256": by_cluster(lambda c: digests[c], "string"),
        }
    )
