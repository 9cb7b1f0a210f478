"""A small table of documents with every odd case, and plain-Python versions of the operators."""

import random
import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Names that operators use for outputs or inside.
CLASHES = ["score", "n_words", "id", "n", "c", "shard", "row", "rule", "value", "token_ids", "lang_pred", "k"]


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def odd_documents():
    """(doc_id, text): NULLs, empty, blank, very long, repeated and near texts."""
    rng = random.Random(3)
    base = words(rng, 120)
    near = [*base[:60], "changed", *base[61:]]
    passage = "\n".join(" ".join(words(rng, 12)) for _ in range(6))
    long_ = " ".join(words(rng, 60_000, 5000))
    texts = [
        None, "", "  \n\t ", "one two", "One TWO", " ".join(base), " ".join(base), " ".join(near), long_,
        "x" * 70_000, f"first\n{passage}\nlast", f"other start\n{passage}", passage, "Ünï çødé 文字 x y",
        "a\x00b\x1fc", "the the the the the the the",
    ]
    rows = list(enumerate(texts))
    return [*rows, rows[5], rows[10], (None, "one two"), (None, None), (3, "one two but other")]


def documents(spark, rows=None, extra=True):
    """The rows with columns that clash with those of operators."""
    names = CLASHES if extra else []
    fields = [StructField("doc_id", LongType()), StructField("text", StringType())]
    schema = StructType(fields + [StructField(n, StringType()) for n in names])
    rows = odd_documents() if rows is None else rows
    return spark.createDataFrame([(*r, *(f"own {n}" for n in names)) for r in rows], schema)


def shingles(text, n=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return set()
    return {tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1))}


def smallest_linked(rows):
    """By row: the smallest id reached by links of similar shingle sets; NULL ids link nothing."""
    sets = [shingles(t) for _, t in rows]
    label = {i: i for i, (d, _) in enumerate(rows) if d is not None}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in label:
        for j in label:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[root(j)] = root(i)
    low = {}
    for i in label:
        low[root(i)] = min(low.get(root(i), rows[i][0]), rows[i][0])
    return [low[root(i)] if i in label else None for i in range(len(rows))]
