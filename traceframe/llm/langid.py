"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, seeded by its code point. A trigram binds its three
letters, each permuted by its place, by multiplication; a document bundles its trigrams by
addition, counting every one of them; a language's prototype bundles its documents, each scaled
to length one. A document gets the language whose prototype has the largest cosine.

Text is lower-cased; runs of anything but letters are one blank, which has a vector like a letter.
Prototypes are fitted on ``rows_per_lang`` documents of a language, those whose texts have the smallest
hashes; on all where there are fewer. A prototype is two kilobytes and passes through the driver.

Defined cases: NULL text and text without letters is ``und`` with score 0, as is everything if no
labelled document has a letter; rows with NULL language or text teach nothing; equal cosines go to
the language that sorts first; a negative cosine scores 0. Repeated rows teach as often as they
occur, within the number of rows of their language. Very long texts are bundled whole, in runs; an empty
table teaches nothing and gives no rows. Input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from traceframe.llm.common import column, visible, without

DIM = 512
SEED = 20011
ROWS_PER_LANG = 2000
#: Languages whose bounds may be broadcast, 100 MB; more are joined by shuffle.
BROADCAST_LANGS = 1_000_000
MAX_TRIGRAMS = 40_000
#: Texts are cut into runs of so many characters to bound memory; trigrams across cuts count.
RUN = 1 << 20
OUTPUTS = ("lang_pred", "score")


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=20_000)
def letter_vector(code: int) -> np.ndarray:
    rng = np.random.default_rng((SEED, code))
    return (rng.integers(0, 2, DIM, dtype=np.int8) * 2 - 1).astype(np.float32)


class Space:
    """Trigram vectors, made when first met; all dropped when there are too many."""

    def __init__(self) -> None:
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((4096, DIM), np.float32)

    def make(self, keys: list[int]) -> None:
        for key in keys:
            if key not in self.rows:
                n = len(self.rows)
                if n == len(self.vectors):
                    grown = np.empty((2 * n, DIM), np.float32)
                    grown[:n] = self.vectors
                    self.vectors = grown
                a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
                self.vectors[n] = (
                    np.roll(letter_vector(a), 2) * np.roll(letter_vector(b), 1) * letter_vector(c)
                )
                self.rows[key] = n

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The document's vector; None without letters."""
        total, before, any_letter = None, np.zeros(1, np.int64), False
        for begin in range(0, len(text or ""), RUN):
            raw = text[begin : begin + RUN].lower().encode("utf-32-le", "replace")
            codes = np.frombuffer(raw, np.uint32).astype(np.int64)
            symbols = np.where(letters()[codes], codes, 0)
            any_letter = any_letter or bool(symbols.any())
            symbols = np.concatenate((before, symbols, [0] if begin + RUN >= len(text) else []))
            symbols = symbols.astype(np.int64)
            symbols = symbols[np.concatenate(([True], (symbols[1:] != 0) | (symbols[:-1] != 0)))]
            before = symbols[-2:]
            part = self.sum(symbols)
            if part is not None:
                total = part if total is None else total + part
        return total if any_letter else None

    def sum(self, symbols: np.ndarray) -> np.ndarray | None:
        if len(symbols) < 3:
            return None
        keys, counts = np.unique(symbols[:-2] << 42 | symbols[1:-1] << 21 | symbols[2:], return_counts=True)
        total = np.zeros(DIM, np.float32)
        for i in range(0, len(keys), 8192):
            some = keys[i : i + 8192].tolist()
            rows = list(map(self.rows.get, some))
            if None in rows:
                if len(self.rows) > MAX_TRIGRAMS:
                    self.rows.clear()
                self.make(some)
                rows = list(map(self.rows.get, some))
            total += counts[i : i + 8192].astype(np.float32) @ self.vectors[rows]
        return total


@lru_cache(maxsize=1)
def space() -> Space:
    return Space()


def fit(
    labelled: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_lang: int = ROWS_PER_LANG,
) -> dict[str, list[float]]:
    """A prototype of length one for each language of the labelled rows."""
    visible(labelled.sparkSession)
    rows = labelled.select(
        column(labelled, lang_col).cast("string").alias("lang"),
        column(labelled, text_col).cast("string").alias("text"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    sample = _sample(rows, rows_per_lang)

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text, weight in zip(*(batch[c].to_pylist() for c in ("lang", "text", "weight")), strict=True):
                v = space().bundle(text)
                if v is not None and (size := float(np.linalg.norm(v))):
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64) * (weight / size)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * DIM, "dim": np.arange(DIM), "value": v})

    parts = sample.mapInArrow(bundles, "lang string, dim bigint, value double")
    made: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect():
        made.setdefault(r["lang"], np.zeros(DIM))[r["dim"]] = r["value"]
    return {k: np.round(v / (np.linalg.norm(v) or 1), 6).tolist() for k, v in sorted(made.items())}


def _sample(rows: DataFrame, rows_per_lang: int) -> DataFrame:
    """``lang``, ``text`` and ``weight``: texts with the smallest hashes, standing for ``rows_per_lang`` rows of a language.

    Each text once, with the number of its rows as weight, less what goes beyond. Languages with
    fewer rows have all of them.
    """
    drawn = rows.withColumn("h", F.pmod(F.xxhash64("text", F.lit(SEED)), F.lit(1 << 62)))
    # By powers of two: the largest power that rows enough lie below is found from one pass.
    power = F.when(F.col("h") > 0, F.floor(F.log2("h")) + 1).otherwise(0).cast("int")
    counts = drawn.groupBy("lang", power.alias("power")).count()
    below = Window.partitionBy("lang").orderBy("power")
    reached = counts.withColumn("rows", F.sum("count").over(below)).groupBy("lang").agg(
        F.coalesce(F.min(F.when(F.col("rows") >= rows_per_lang, F.col("power"))), F.max("power")).alias("most")
    )
    if reached.offset(BROADCAST_LANGS).isEmpty():
        reached = F.broadcast(reached)
    few = drawn.join(reached, "lang").where(power <= F.col("most"))
    texts = few.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, -1))
    weight = F.least(F.col("n"), F.lit(rows_per_lang) - F.coalesce(before, F.lit(0)))
    return texts.withColumn("weight", weight).where("weight > 0").select("lang", "text", "weight")


def predict(docs: DataFrame, prototypes: dict[str, list[float]], *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine."""
    visible(docs.sparkSession)
    names = list(prototypes)
    matrix = np.array([prototypes[k] for k in names], np.float32).reshape(len(names), DIM)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            langs, scores = [], []
            for text in texts:
                v = space().bundle(text.as_py()) if names else None
                size = 0.0 if v is None else float(np.linalg.norm(v))
                near = matrix @ v / size if size else None
                best = -1 if near is None else int(near.argmax())
                langs.append("und" if best < 0 else names[best])
                scores.append(0.0 if best < 0 else float(min(1, max(0, near[best]))))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    base = without(docs, OUTPUTS)
    made = base.withColumn("__lang", predicted.asNondeterministic()(column(docs, text_col).cast("string")))
    return made.select(*[column(made, c) for c in base.columns], *[F.col(f"__lang.{c}") for c in OUTPUTS])
