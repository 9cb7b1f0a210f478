"""Quality classifier of supervised subword embeddings.

A word is its own hashed feature and that of its character n-grams; a word that equals the one
before it adds the word-bigram feature of a repetition. A document is the average of its
features' learned vectors; a softmax layer gives the probability of label 1. Vectors and layer
are trained together by numpy stochastic gradient descent.

Training takes about ``rows`` labelled documents at most, picked by a hash of the id, in one task;
scoring covers whole texts. As averaging is linear, scoring looks up each feature's vector
already multiplied by the layer, ``Model.margin``: one number a feature, of fixed size.

Defined cases: NULL and blank texts have no features and get the layer's bias as score; NULL
labels and labels other than 0 and 1 teach nothing; several labels of one document all count;
without any label every score is 0.5; texts are read in runs of ``RUN`` characters, cut at white
space, or inside a longer word; repeated documents are each scored, and teach as often as they are drawn with a label; equal
scores mean nothing more; an empty table gives no rows. Input columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import column, lean, visible, without

BITS = 18
BUCKETS = 1 << BITS
DIM = 16
GRAMS = (3, 4)
ROWS = 6000
EPOCHS = 5
RATE = 2.0
SEED = 7
RUN = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
#: The feature of a word that equals the one before it.
REPEAT = 1
OUTPUTS = ("score",)


def runs(text: str | None) -> Iterator[str]:
    """The text in runs of about ``RUN`` characters, cut at white space where there is any."""
    text, begin = text or "", 0
    while len(text) - begin > RUN:
        cut = begin + RUN
        space = next((i for i in range(cut, max(begin, cut - 4096), -1) if text[i].isspace()), cut)
        yield text[begin:space]
        begin = space
    yield text[begin:]


def buckets(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(29))) * ODD >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """Buckets of all words, their character n-grams and repetitions, as often as they occur.

    Words lie between single blanks here; an n-gram may begin or end with one, which marks the edge
    of its word, but has none inside.
    """
    found: list[np.ndarray] = []
    for run in runs(text):
        words = run.split()
        if not words:
            continue
        raw = f" {' '.join(words)} ".encode("utf-32-le", "replace")
        code = np.frombuffer(raw, np.uint32).astype(np.uint64)
        blank = code == 32
        start = np.flatnonzero(blank)[:-1] + 1
        inside = np.where(blank, np.uint64(0), code)
        length = np.diff(np.append(start, len(code)))
        place = np.arange(len(code) - 1) - np.repeat(start - 1, length)
        whole = np.add.reduceat(inside[1:] * powers(int(length.max()) + 1)[place], start - 1)
        found.append(buckets(whole))
        again = np.count_nonzero(whole[1:] == whole[:-1])
        found.append(np.full(again, REPEAT))
        for n in GRAMS:
            m = len(code) - n + 1
            if m < 1:
                continue
            gram, fits = np.full(m, n, np.uint64), np.ones(m, bool)
            for i in range(n):
                gram = gram * ODD + code[i : i + m]
                if 0 < i < n - 1:
                    fits &= ~blank[i : i + m]
            found.append(buckets(gram[fits]))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


@lru_cache(maxsize=4)
def _powers(bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.full(1 << bits, ODD, np.uint64))


def powers(n: int) -> np.ndarray:
    return _powers(max(10, n.bit_length()))


@dataclass
class Model:
    """``vectors``: by bucket; ``layer``: 2 x DIM; ``bias``: 2."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    @property
    def margin(self) -> np.ndarray:
        return (self.vectors @ (self.layer[1] - self.layer[0])).astype(np.float32)

    @property
    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], *, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, epochs * len(bags)), 0
    seen = np.zeros(BUCKETS, bool)
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            at, counts = bags[i]
            step = rate * (1 - done / steps)
            done += 1
            weight = (counts / max(1, counts.sum())).astype(np.float32)
            mean = weight @ vectors[at] if len(at) else np.zeros(DIM, np.float32)
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ layer
            layer -= step * np.outer(p, mean)
            bias -= 0.1 * step * p
            vectors[at] -= step * np.outer(weight, back)
            seen[at] = True
    vectors[~seen] = 0  # buckets without evidence say nothing
    return Model(vectors, layer, bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = ROWS,
) -> Model:
    """Train on documents joined to their labels by id."""
    visible(docs.sparkSession)
    marked = labels.select(
        column(labels, id_col).alias("i"), column(labels, label_col).cast("int").alias("y")
    ).where("i IS NOT NULL AND y IN (0, 1)")
    total = marked.count()
    share = min(1.0, rows / total) if total else 0.0
    draw = F.pmod(F.xxhash64(F.col("i"), F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    picked = marked.where(draw < share)  # about ``rows`` small rows, so they may be broadcast
    texts = docs.select(column(docs, id_col).alias("i"), column(docs, text_col).cast("string").alias("t"))
    sample = texts.join(F.broadcast(picked), "i").select("i", "t", "y")

    @lean
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for i, t, y in zip(*(batch[c].to_pylist() for c in ("i", "t", "y")), strict=True):
                at, counts = np.unique(features(t), return_counts=True)
                found.append((str(i), y, (at.astype(np.int32), counts.astype(np.int32))))
        found.sort(key=lambda x: (x[0], x[1], x[2][0].tobytes()))  # the order in which rows came is chance
        model = train([x[2] for x in found], [x[1] for x in found])
        yield pa.RecordBatch.from_pydict(
            {"vectors": [model.vectors.tobytes()], "layer": [model.layer.tobytes()], "bias": [model.bias.tobytes()]}
        )

    made = sample.repartition(1).mapInArrow(learn, "vectors binary, layer binary, bias binary").first()
    if made is None:
        return train([], [])
    return Model(
        np.frombuffer(made["vectors"], np.float32).reshape(BUCKETS, DIM),
        np.frombuffer(made["layer"], np.float32).reshape(2, DIM),
        np.frombuffer(made["bias"], np.float32),
    )


def probability(text: str | None, margin: np.ndarray, offset: float) -> float:
    at = features(text)
    z = offset + (float(margin[at].mean(dtype=np.float64)) if len(at) else 0.0)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def score(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1."""
    spark = docs.sparkSession
    visible(spark)
    sent = spark.sparkContext.broadcast((model.margin, model.offset))

    @F.arrow_udf("double")
    @lean
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        margin, offset = sent.value
        for texts in batches:
            yield pa.array([probability(t.as_py(), margin, offset) for t in texts], pa.float64())

    base = without(docs, OUTPUTS)
    return base.withColumn("score", scored.asNondeterministic()(column(docs, text_col).cast("string")))
