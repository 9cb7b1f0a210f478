"""Line dedup by pairwise alignment.

A line alone is often frequent; with its neighbours it is rare. So each line gets two rare line
hashes: of the shortest runs of lines that begin and that end with it and have ``min_words`` words.
Documents overlap where they share such a hash, and each is paired with the first holder of each
of its hashes: pairs grow with the lines, and no group makes all its pairs. Any common block of two
documents is covered by such runs, so the pairs with first holders find all its lines.

Each pair is aligned with patience diff over the lines of shared runs; a run of lines that are next to each
other in both, of at least ``min_words`` words, is a common block and is deleted from the later
document. Blocks that one alignment cannot hold, being in another order or there more than once, are
then taken from what it left, until the pair has no shared run left. So every line goes that lies
in a common block with any earlier document. Earlier and later go by id; the first holder of a block
keeps it. Ranges of deleted lines do not overlap.

Lines are compared trimmed, by a 64-bit hash; blank lines separate nothing and go with the block
around them.

Defined cases: NULL and empty text stays as it is; rows with NULL id are left alone; rows of the
same id and text are one document, so nothing is deleted between them; rows of the same id but
other texts are documents in the order of a hash of their text; a document whose lines all go
keeps an empty text; very long texts are compared whole; an empty table stays empty. Input columns named like an output are replaced.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from traceframe.llm.common import column, lean, merged_spans, stored, visible, without

MIN_WORDS = 50
#: Line ranges, at most as many documents, that may be broadcast; beyond, texts are shuffled to them.
BROADCAST_RANGES = 400_000
OUT = "deleted"
RANGES = "array<struct<first:int,last:int>>"


def lines_of(text: str) -> Iterator[tuple[int, str]]:
    """Number and trimmed text of the lines that are not blank."""
    for i, line in enumerate(text.split("\n")):
        if line := line.strip():
            yield i, line


def longest_rising(values: list[int]) -> list[int]:
    """Places of a longest rising subsequence."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
        before.append(at[k - 1] if k else -1)
    found = []
    i = at[-1] if at else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal lines in an alignment of ``a`` and ``b``.

    Equal ends match first. What lies between is cut at the lines that are there once in either,
    in the longest order they have in common, and each part is aligned in the same way.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            found.append((i2, j2))
        if i == i2 or j == j2:
            continue
        once_a = {x for x, n in Counter(a[i:i2]).items() if n == 1}
        once_b = {x for x, n in Counter(b[j:j2]).items() if n == 1}
        place = {b[y]: y for y in range(j, j2) if b[y] in once_a and b[y] in once_b}
        anchors = [(x, place[a[x]]) for x in range(i, i2) if a[x] in place]
        anchors = [anchors[k] for k in longest_rising([y for _, y in anchors])]
        if not anchors:
            continue
        for (x, y), (x2, y2) in zip([(i - 1, j - 1), *anchors], [*anchors, (i2, j2)], strict=True):
            todo.append((x + 1, x2, y + 1, y2))
        found += anchors
    return sorted(found)


def blocks(later: list[dict], earlier: list[dict], min_words: int) -> list[tuple[int, int]]:
    """First and last line number, in ``later``, of the common blocks; of each line: seq, at, h, w."""
    pairs = patience([x["h"] for x in later], [x["h"] for x in earlier])
    found, run = [], []
    for p in [*pairs, None]:
        if run and (
            p is None
            or later[p[0]]["seq"] != later[run[-1][0]]["seq"] + 1
            or earlier[p[1]]["seq"] != earlier[run[-1][1]]["seq"] + 1
        ):
            if sum(later[i]["w"] for i, _ in run) >= min_words:
                found.append((run[0][0], run[-1][0]))
            run = []
        if p is not None:
            run.append(p)
    found += unaligned(later, earlier, min_words, found)
    return [(later[a]["at"], later[b]["at"]) for a, b in found]


def unaligned(later: list[dict], earlier: list[dict], min_words: int, done: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Common blocks, as places in ``later``, that one alignment leaves: in other order, or repeated.

    Shared runs with a line outside ``done`` are looked up in ``earlier`` and grown to both sides,
    until no shared run is left.
    """
    gone = {i for a, b in done for i in range(a, b + 1)}
    held = {x["h"] for x in earlier}
    if all(i in gone or x["h"] not in held for i, x in enumerate(later)):
        return []
    known: dict[tuple[int, ...], int] = {}
    for a, b in sorted(shared_runs(earlier, min_words)):
        known.setdefault(tuple(x["h"] for x in earlier[a : b + 1]), a)
    found = []
    for a, b in sorted(shared_runs(later, min_words)):
        if all(i in gone for i in range(a, b + 1)):
            continue
        at = known.get(tuple(x["h"] for x in later[a : b + 1]))
        if at is None:
            continue
        end = at + b - a
        while a and at and follows(later, a) and follows(earlier, at) and later[a - 1]["h"] == earlier[at - 1]["h"]:
            a, at = a - 1, at - 1
        while (
            b + 1 < len(later) and end + 1 < len(earlier)
            and follows(later, b + 1) and follows(earlier, end + 1) and later[b + 1]["h"] == earlier[end + 1]["h"]
        ):
            b, end = b + 1, end + 1
        gone.update(range(a, b + 1))
        found.append((a, b))
    return found


def follows(lines: list[dict], i: int) -> bool:
    """Whether line ``i`` is next to the one before it in its document."""
    return lines[i]["seq"] == lines[i - 1]["seq"] + 1


def shared_runs(lines: list[dict], min_words: int) -> Iterator[tuple[int, int]]:
    """``runs`` of each part of ``lines`` whose lines are next to each other."""
    starts = [i for i in range(len(lines)) if not i or not follows(lines, i)]
    for start, end in zip(starts, [*starts[1:], len(lines)], strict=True):
        for a, b in runs([x["w"] for x in lines[start:end]], min_words):
            yield start + a, start + b


def cut(text: str, ranges: list[dict]) -> str:
    """The text without the lines of the ranges."""
    lines = text.split("\n")
    gone = set()
    for r in ranges:
        gone.update(range(r["first"], r["last"] + 1))
    return "\n".join(x for i, x in enumerate(lines) if i not in gone)


def runs(count: list[int], min_words: int) -> set[tuple[int, int]]:
    """The shortest runs of lines with ``min_words`` words, from each line on and up to each line."""
    found = set()
    words, a = 0, 0
    for b, n in enumerate(count):
        words += n
        while words - count[a] >= min_words:
            words -= count[a]
            a += 1
        if words >= min_words:
            found.add((a, b))
    words, b = 0, len(count) - 1
    for a in range(len(count) - 1, -1, -1):
        words += count[a]
        while words - count[b] >= min_words:
            words -= count[b]
            b -= 1
        if words >= min_words:
            found.add((a, b))
    return found


def hashed(text: str) -> tuple[list[int], list[int], list[int]]:
    """Number, hash and word count of each line that is not blank."""
    at, h, w = [], [], []
    for i, line in lines_of(text):
        at.append(i)
        h.append(xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace")) - (1 << 63))
        w.append(len(line.split()))
    return at, h, w


def _runs(docs: DataFrame, min_words: int) -> DataFrame:
    """One row a run: document ``k``, hash ``h``, first and last line ``a`` and ``b``."""

    @lean
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h, a, b = [], [], [], []
            for i, text in enumerate(batch["text"]):
                _, lines, count = hashed(text.as_py())
                raw = np.array(lines, np.int64)
                for first, last in runs(count, min_words):
                    n.append(i)
                    h.append(xxhash.xxh3_64_intdigest(raw[first : last + 1].tobytes()) - (1 << 63))
                    a.append(first)
                    b.append(last)
                if len(n) > 100_000:
                    yield made(batch, n, h, a, b)
                    n, h, a, b = [], [], [], []
            yield made(batch, n, h, a, b)

    def made(batch: pa.RecordBatch, n: list[int], h: list[int], a: list[int], b: list[int]) -> pa.RecordBatch:
        at = pa.array(n, pa.int64())
        ends = [pa.array(a, pa.int32()), pa.array(b, pa.int32())]
        columns = [batch["id"].take(at), batch["th"].take(at), pa.array(h, pa.int64()), *ends]
        return pa.RecordBatch.from_arrays(columns, ["id", "th", "h", "a", "b"])

    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.mapInArrow(split, f"id {kind}, th bigint, h bigint, a int, b int")
    return rows.select(F.struct("id", "th").alias("k"), "h", "a", "b")


LINES = "array<struct<seq:int,at:int,h:bigint,w:int>>"
LINES_ARROW = pa.list_(pa.struct([("seq", pa.int32()), ("at", pa.int32()), ("h", pa.int64()), ("w", pa.int32())]))


def _sketches(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``k``, ``lines``: the lines of each document that lie in shared runs."""
    named = marks.select(F.col("k.id").alias("__id"), F.col("k.th").alias("__th"), "ranges")
    found = docs.join(named, (docs["id"] == F.col("__id")) & (docs["th"] == F.col("__th")))

    @F.arrow_udf(LINES)
    def sketch(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        rows = []
        for text, own in zip(texts, ranges, strict=True):
            at, h, w = hashed(text.as_py())
            inside = sorted({i for r in own.as_py() for i in range(r["start"], r["end"] + 1)})
            rows.append([{"seq": i, "at": at[i], "h": h[i], "w": w[i]} for i in inside])
        return pa.array(rows, LINES_ARROW)

    lines = sketch.asNondeterministic()("text", "ranges")
    return found.select(F.struct("id", "th").alias("k"), lines.alias("lines")).dropDuplicates(["k"])


def deletions(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """``id``, ``th``, ``deleted`` (line ranges) of the documents (``id``, ``th``, ``text``) that lose lines."""
    found = _runs(docs, min_words)
    held = found.groupBy("h").agg(F.min("k").alias("first"), F.max("k").alias("last"))
    shared = found.join(held.where("first < last").select("h", "first"), "h")
    marks = shared.groupBy("k").agg(
        F.collect_set(F.struct(F.col("a").alias("start"), F.col("b").alias("end"))).alias("ranges"),
        F.collect_set("first").alias("firsts"),
    )
    marks = stored(marks.select("k", merged_spans(F.col("ranges"), "int").alias("ranges"), "firsts"))
    small = _small(marks, "ranges")
    sketches = stored(_sketches(docs, F.broadcast(marks.drop("firsts")) if small else marks.drop("firsts")))
    pairs = marks.select("k", F.explode("firsts").alias("k2")).where("k2 < k")
    both = pairs.join(sketches, "k").join(sketches.select(F.col("k").alias("k2"), F.col("lines").alias("lines2")), "k2")

    @lean
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, cuts = [], []
            for n in range(batch.num_rows):
                ranges = blocks(batch["lines"][n].as_py(), batch["lines2"][n].as_py(), min_words)
                keep += [n] * len(ranges)
                cuts += [{"first": a, "last": b} for a, b in ranges]
            n = pa.array(keep, pa.int64())
            kind = pa.struct([("first", pa.int32()), ("last", pa.int32())])
            yield pa.RecordBatch.from_arrays([batch["id"].take(n), batch["th"].take(n), pa.array(cuts, kind)], ["id", "th", "r"])

    kind = docs.schema["id"].dataType.simpleString()
    rows = both.select("k.id", "k.th", "lines", "lines2").mapInArrow(align, f"id {kind}, th bigint, r struct<first:int,last:int>")
    spans = merged_spans(F.collect_set(F.struct(F.col("r.first").alias("start"), F.col("r.last").alias("end"))), "int")
    ranges = F.transform("spans", lambda r: F.struct(r["start"].alias("first"), r["end"].alias("last")))
    return rows.groupBy("id", "th").agg(spans.alias("spans")).select("id", "th", ranges.alias(OUT))


def _small(df: DataFrame, ranges: str) -> bool:
    return (df.agg(F.sum(F.size(ranges))).first()[0] or 0) <= BROADCAST_RANGES


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with common blocks cut out of ``text_col``, and ``deleted``: the line ranges cut."""
    visible(docs.sparkSession)
    base = without(docs, [OUT])
    kept = base.columns
    text, id_ = column(base, text_col).cast("string"), column(base, id_col)
    key = F.xxhash64(text)
    narrow = base.select(id_.alias("id"), key.alias("th"), text.alias("text"))
    narrow = narrow.where("id IS NOT NULL AND text IS NOT NULL AND text <> ''")
    gone = stored(deletions(narrow, min_words=min_words))
    gone = gone.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col(OUT).alias("__deleted"))
    if _small(gone, "__deleted"):
        gone = F.broadcast(gone)
    joined = base.join(gone, (id_ == F.col("__id")) & (key == F.col("__th")), "left")

    @F.arrow_udf(StringType())
    def without_lines(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        rows = zip(texts, ranges, strict=True)
        return pa.array([cut(t.as_py(), r.as_py()) if r.as_py() else t.as_py() for t, r in rows], pa.string())

    new = without_lines(column(joined, text_col).cast("string"), F.col("__deleted"))
    none = F.array().cast(RANGES)
    return joined.select(
        *[new.alias(c) if c == text_col else column(joined, c) for c in kept],
        F.coalesce("__deleted", none).alias(OUT),
    )
