"""Benchmark decontamination: one Aho-Corasick automaton over the items' normalised text.

Words are runs of digits, letters and non-ASCII characters, with A-Z lower-cased. A window is
``window`` consecutive words of an item, or the whole item where it has fewer, but at least one.
Each text is scanned once; matches are mapped back to the original's words and characters.

Defined cases: NULL or wordless text has no words and no hits; NULL or wordless items have no
windows; equal items all count; an empty ``items`` table hits nothing; repeated documents are
each scanned; very long texts are scanned whole; an empty table gives no rows. Input columns named like an output are replaced. Items are sent to the tasks in
blocks of about ``block_bytes`` of text, each block one more pass over the text, whose hits are stored in
``spark.checkpoint.dir`` and put together by row at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import column, lean, merged_spans, visible, without, written

#: Bytes to words: A-Z lower-cased, ASCII other than digits and letters to a space.
FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
    for b in range(256)
)
WINDOW = 10
BLOCK_BYTES = 8 << 20
OUTPUTS = ("n_words", "n_hit", "item_ids", "spans")
RESULT = "struct<n_words:bigint,n_hit:bigint,item_ids:array<string>,spans:array<struct<start:bigint,end:bigint>>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def windows(found: list[bytes], window: int) -> list[list[bytes]]:
    if not found:
        return []
    return [found[i : i + window] for i in range(max(1, len(found) - window + 1))]


@lru_cache(maxsize=1)
def automaton(items: tuple[tuple[str, str], ...], window: int):
    """Patterns are windows between spaces; each carries its word count and its items."""
    patterns: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        for w in windows(words(text), window):
            key = (b" " + b" ".join(w) + b" ").decode("latin-1")
            patterns.setdefault(key, (len(w), set()))[1].add(item)
    if not patterns:
        return None
    machine = ahocorasick.Automaton()
    for key, (n, ids) in patterns.items():
        machine.add_word(key, (n, len(key), frozenset(ids)))
    machine.make_automaton()
    return machine


def scan(text: str | None, machine) -> tuple[int, np.ndarray, set[str]]:
    """Words of a text, which of them are hit, and the items with a window in it."""
    found = words(text)
    items: set[str] = set()
    if machine is None or not found:
        return len(found), np.zeros(0, bool), items
    joined = b" " + b" ".join(found) + b" "
    hits = list(machine.iter(joined.decode("latin-1")))
    if not hits:
        return len(found), np.zeros(0, bool), items
    starts = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)  # the space before each word
    step = np.zeros(len(found) + 1, np.int64)
    for end, (n, length, ids) in hits:
        first = int(np.searchsorted(starts, end - length + 1))
        step[first] += 1
        step[first + n] -= 1
        items |= ids
    return len(found), np.cumsum(step)[:-1] > 0, items


def spans_of(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as character offsets [start, end) in the original text."""
    if not hit.any():
        return []
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    inside = np.concatenate(([False], np.frombuffer(bytes(FOLD), np.uint8)[raw] != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # characters before a byte
    turns = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [
        {"start": int(chars[begins[a]]), "end": int(chars[ends[b - 1]])}
        for a, b in zip(turns[::2], turns[1::2], strict=True)
    ]


def _scanner(items: tuple[tuple[str, str], ...], window: int, spans: bool):
    @F.arrow_udf(RESULT)
    @lean
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = automaton(items, window)
        for texts in batches:
            rows = []
            for text in texts.to_pylist():
                n, hit, found = scan(text, machine)
                rows.append(
                    {
                        "n_words": n, "n_hit": int(hit.sum()), "item_ids": sorted(found),
                        "spans": spans_of(text, hit) if spans and found else [],
                    }
                )
            yield pa.array(rows, SCHEMA)

    return scanned.asNondeterministic()


SCHEMA = pa.struct(
    [
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


class Blocks:
    """The items in blocks of about ``block_bytes`` of text; the driver holds one at a time."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str, block_bytes: int):
        rows = items.select(
            column(items, id_col).cast("string").alias("i"), column(items, text_col).cast("string").alias("t")
        ).where("i IS NOT NULL AND t IS NOT NULL")
        size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        self.number = max(1, -(-size // block_bytes))
        if self.number > 1:  # read again for each block
            rows = written(rows.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(self.number)).cast("int")))
        self.rows = rows

    def block(self, k: int) -> tuple[tuple[str, str], ...]:
        rows = self.rows if self.number == 1 else self.rows.where(F.col("block") == k)
        return tuple((r.i, r.t) for r in rows.select("i", "t").collect())


def mark(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``item_ids`` and ``spans`` (characters that are hit)."""
    visible(docs.sparkSession)
    base = without(docs, OUTPUTS)
    kept = base.columns
    blocks = Blocks(items, item_id_col, item_text_col, block_bytes)
    if blocks.number == 1:
        out = base.withColumn("__hit", _scanner(blocks.block(0), window, True)(column(docs, text_col).cast("string")))
        return out.select(*[column(out, c) for c in kept], *[F.col(f"__hit.{c}") for c in OUTPUTS])
    # One block after the other: its hits are stored before the next is read.
    names = {c: f"__c{i}" for i, c in enumerate(kept)}
    rows = written(
        docs.select(
            *[column(docs, c).alias(n) for c, n in names.items()], column(docs, text_col).cast("string").alias("__text"),
            F.monotonically_increasing_id().alias("__row"),
        )
    )
    hits = None
    for k in range(blocks.number):
        found = rows.select("__row", _scanner(blocks.block(k), window, True)("__text").alias("h"))
        stored = written(found.where("h.n_hit > 0").select("__row", "h.item_ids", "h.spans"))
        hits = stored if hits is None else hits.unionByName(stored)
    each = hits.groupBy("__row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        merged_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    joined = rows.join(each.withColumnRenamed("__row", "__of"), F.col("__row") == F.col("__of"), "left").withColumn(
        "spans", F.coalesce("spans", F.expr("filter(array(named_struct('start', 0L, 'end', 0L)), x -> false)"))
    )
    counted = joined.withColumn("__n", _counts(F.col("__text"), F.col("spans")))
    return counted.select(
        *[F.col(n).alias(c) for c, n in names.items()], F.col("__n.n_words").alias("n_words"), F.col("__n.n_hit").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "spans",
    )


def _counts(text: Column, spans: Column) -> Column:
    """Words of a text, and of its spans."""

    @F.arrow_udf("struct<n_words:bigint,n_hit:bigint>")
    def count(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = [
            {"n_words": len(words(t)), "n_hit": sum(len(words(t[s["start"] : s["end"]])) for s in own)}
            for t, own in zip(texts.to_pylist(), spans.to_pylist(), strict=True)
        ]
        return pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64())]))

    return count(text, spans)


def digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ",").cast("binary"), 256)


def item_digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
