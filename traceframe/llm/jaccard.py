"""Self-join of word n-gram sets by Jaccard similarity, with vertical partitioning.

The global order of n-grams is that of their 64-bit hashes. It is cut into fragments; each
fragment counts on its own, and the counts are summed by document or by pair:

1. Documents of equal sets are one class.
2. Classes that cannot link go. A partner must hold at least the ``threshold`` share of a class's
   n-grams, so a class with more n-grams than the rest that no other class holds has none.
   ``alone`` counts those over the first ``SHARE`` of the order, fragment by fragment.
3. Of the few classes left, those with an equal minimum under one of ``HUBS`` hash functions are
   compared with one of them, their hub: pairs grow with the classes, not with a group's square.
   Exact bounds (``may_link``) drop nearly all pairs that are not similar enough. Of the others partial overlaps are counted by fragment and summed per pair (``overlaps``). Linked classes make
   components.
4. What is still missing are links between components. Step 2 is repeated with components in the
   place of classes. Classes that remain are joined exactly, by the prefix filter, rarest n-grams
   first, and only across components.

So no link between different components is lost, and no pairs inside one are made needlessly.

Defined cases: NULL and wordless text has an empty set and links with nothing; a document of fewer
words than ``words`` has them as its one n-gram; documents with NULL id link nothing but
get the component of an equal document; repeated rows are members of one class; very long
texts count whole; an empty table gives no rows; only the id comes along, other columns may have any names. Two n-grams count as equal if their 64-bit
hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import column, lean, stored, visible
from traceframe.llm.components import components

WORDS = 5
PERCENT = 80
#: Share of the n-gram order that step 2 looks at; more than 1 - threshold.
SHARE = 0.4
#: N-grams in one fragment of step 2, about.
FRAGMENT = 1 << 21
#: N-grams of the owners in one bucket, about, when their counts are summed.
GRAMS_PER_BUCKET = 1 << 23
#: Fragments in which overlaps of pairs are counted.
FRAGMENTS = 4
HUBS = 3
#: Words of 64 bits of a class's bitmap.
BITMAP = tuple(f"w{i}" for i in range(16))
IDS = 4_000_000  # 32 MB of ids may be broadcast
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
TOP = 1 << 64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def ngrams(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-grams. Words end at blanks and at 09-0D; A-Z count as a-z."""
    found = (text or "").encode("utf-8", "replace").translate(FOLD).split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, found)), np.uint64)
    n = min(words, len(h))
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total = total * ODD + h[i : len(h) - n + 1 + i]
    return np.unique(mix(total))


def signed(x: int) -> int:
    return x - TOP if x >= TOP // 2 else x


def profile(text: Column, words: int) -> Column:
    """struct(n, c): size and hash of the set."""

    @F.arrow_udf("struct<n:bigint,c:bigint>")
    @lean
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, c = [], []
            for t in texts:
                grams = ngrams(t.as_py(), words)
                n.append(len(grams))
                c.append(signed(xxhash.xxh3_64_intdigest(grams.tobytes())))
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(c, pa.int64())], ["n", "c"])

    return made.asNondeterministic()(text)


def _gather(rows: Iterator[tuple[int, int, np.ndarray]], fragments: int, share: float) -> Iterator[dict]:
    """One row for each fragment: n-grams, and owner and group of each run of them.

    N-grams that two groups here hold are already known to be shared: one entry, without owner.
    """
    owner, group, grams = [], [], []
    for o, g, x in rows:
        x = x[x < np.uint64(min(TOP - 1, int(share * TOP)))]
        if len(x):
            owner.append(np.full(len(x), o, np.int64))
            group.append(np.full(len(x), g, np.int64))
            grams.append(x)
    if not grams:
        return
    x, o, g = np.concatenate(grams), np.concatenate(owner), np.concatenate(group)
    order = np.lexsort((o, g, x))
    x, o, g = x[order], o[order], g[order]
    first = np.concatenate(([True], x[1:] != x[:-1]))
    start = np.flatnonzero(first)
    run = np.cumsum(first) - 1
    shared = np.maximum.reduceat(g, start) != np.minimum.reduceat(g, start)
    known = x[start[shared]]
    keep = ~shared[run]
    keep[1:] &= ~((x[1:] == x[:-1]) & (o[1:] == o[:-1]))
    x, o, g = x[keep], o[keep], g[keep]
    width = share * TOP / fragments
    part = lambda y: np.minimum((y / width).astype(np.int64), fragments - 1)
    low = lambda y, f: (y - np.uint64(int(f * width))).astype(np.uint32)
    at, known_at = part(x), part(known)
    by = np.lexsort((o, at))
    x, o, g, at = x[by], o[by], g[by], at[by]
    for f in np.union1d(at, known_at).tolist():
        i, j = np.searchsorted(at, [f, f + 1])
        own = o[i:j]
        turn = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))) if j > i else np.zeros(0, np.int64)
        yield {
            "fragment": f, "grams": low(x[i:j], f).tobytes(), "owners": own[turn].tobytes(),
            "groups": g[i:j][turn].tobytes(),
            "runs": np.diff(np.concatenate((turn, [j - i]))).astype(np.uint32).tobytes(),
            "shared": low(known[known_at == f], f).tobytes(),
        }


GATHERED = "fragment bigint, grams binary, owners binary, groups binary, runs binary, shared binary"


def _count_alone(found: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of one fragment: the owners, and how many of their n-grams only their group holds.

    N-grams are compared by 32 bits here, which can only make them look shared.
    """
    whole = lambda c, kind: np.concatenate([np.frombuffer(b, kind) for b in found[c]])
    x, runs = whole("grams", np.uint32), whole("runs", np.uint32)
    o, g = np.repeat(whole("owners", np.int64), runs), np.repeat(whole("groups", np.int64), runs)
    keep = ~np.isin(x, whole("shared", np.uint32))
    x, o, g = x[keep], o[keep], g[keep]
    if not len(x):
        return o, o
    order = np.lexsort((o, x))
    x, o, g = x[order], o[order], g[order]
    keep = np.concatenate(([True], (x[1:] != x[:-1]) | (o[1:] != o[:-1])))  # copies of a class
    x, o, g = x[keep], o[keep], g[keep]
    start = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    one = np.maximum.reduceat(g, start) == np.minimum.reduceat(g, start)
    mine = o[np.repeat(one, np.diff(np.concatenate((start, [len(x)]))))]
    return np.unique(mine, return_counts=True)


def alone(rows: DataFrame, read, grams: int, share: float = SHARE) -> DataFrame:
    """``owner``, ``alone``: n-grams in the first ``share`` of the order that no other group holds.

    ``read(batch)``: (owner, group, n-grams) of a batch's rows; ``grams``: their number in all.
    """
    fragments = max(1, round(grams * share / FRAGMENT))

    @lean
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                for row in _gather(read(batch.slice(at, 4096)), fragments, share):
                    yield pa.RecordBatch.from_pylist([row], SCHEMA)

    # Counts travel in one row for each fragment and bucket of owners, not in one for each owner.
    buckets = np.uint64(max(1, -(-grams // GRAMS_PER_BUCKET)))

    def count(found: pd.DataFrame) -> pd.DataFrame:
        owners, counts = _count_alone(found)
        bucket = (owners.view(np.uint64) % buckets).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        owners, counts, bucket = owners[order], counts[order], bucket[order]
        names, start = np.unique(bucket, return_index=True)
        ends = [*start[1:], len(bucket)]
        return pd.DataFrame(
            {
                "bucket": names,
                "owners": [owners[i:j].tobytes() for i, j in zip(start, ends, strict=True)],
                "counts": [counts[i:j].astype(np.uint32).tobytes() for i, j in zip(start, ends, strict=True)],
            }
        )

    def total(found: pd.DataFrame) -> pd.DataFrame:
        owners, place = np.unique(np.frombuffer(b"".join(found["owners"]), np.int64), return_inverse=True)
        counts = np.bincount(place, np.frombuffer(b"".join(found["counts"]), np.uint32), len(owners))
        return pd.DataFrame({"owner": owners, "alone": counts.astype(np.int64)})

    packed = rows.mapInArrow(gather, GATHERED)
    counted = packed.groupBy("fragment").applyInPandas(count, "bucket bigint, owners binary, counts binary")
    return counted.groupBy("bucket").applyInPandas(total, "owner bigint, alone bigint")


SCHEMA = pa.schema([("fragment", pa.int64())] + [(c, pa.binary()) for c in ("grams", "owners", "groups", "runs", "shared")])


def hopeful(classes: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """Classes (``c``, ``n``) that may have a partner, and ``most``, the largest overlap it may have."""
    joined = classes.join(counts, classes.c == counts.owner, "left")
    most = F.col("n") - F.coalesce("alone", F.lit(0))  # that it may have in common
    kept = joined.where(most * 100 >= F.col("n") * percent)
    return kept.select(*[c for c in classes.columns if c != "most"], most.alias("most"))


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b``, ``same``: overlap of each pair, counted by fragment and summed."""
    low, width = -(1 << 63), TOP // FRAGMENTS
    part = lambda f: F.filter("grams", lambda x: x.between(low + f * width, low + (f + 1) * width - 1))
    pieces = F.array(*[F.struct(F.lit(f).alias("f"), part(f).alias("x")) for f in range(FRAGMENTS)])
    cut = sets.select("c", F.explode(pieces).alias("p")).select("c", "p.f", "p.x")
    spread = pairs.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("f"))
    x = cut.select(F.col("c").alias("a"), "f", F.col("x").alias("xa"))
    y = cut.select(F.col("c").alias("b"), "f", F.col("x").alias("xb"))
    partial = spread.join(y, ["b", "f"]).join(x, ["a", "f"])
    partial = partial.select("a", "b", F.size(F.array_intersect("xa", "xb")).alias("same"))
    return partial.groupBy("a", "b").agg(F.sum("same").alias("same"))


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``na``, ``b``, ``nb``) that are similar enough, as ``a``, ``b``."""
    near = stored(pairs.where(may_link(percent)).select("a", "na", "b", "nb").distinct())
    union = F.col("na") + F.col("nb") - F.col("same")
    both = near.join(overlaps(near, sets), ["a", "b"])
    return both.where(F.col("same") * 100 >= union * percent).select("a", "b")


def may_link(percent: int) -> Column:
    """Whether ``a`` and ``b`` may be similar enough; exact bounds only.

    By the overlap that each may have at most (``oa``, ``ob``), and by their bitmaps: each n-gram
    that only one of them has turns at most one bit.
    """
    both = F.col("na") + F.col("nb")
    turned = sum(F.bit_count(F.col(f"wa.{w}").bitwiseXOR(F.col(f"wb.{w}"))) for w in BITMAP)
    return (F.least("oa", "ob") * (100 + percent) >= both * percent) & (turned * (100 + percent) <= both * (100 - percent))


def hub_pairs(sets: DataFrame) -> DataFrame:
    """Each class with the hub among those of an equal minimum, for each hash function.

    The hub is the class with the fewest n-grams of its own: in a group of near copies the one
    that is nearest to the text that they were made from.
    """
    keys = sets.select("c", "n", "most", "bits", F.posexplode("lows").alias("i", "low"))
    own = F.struct((F.col("n") - F.col("most")).alias("own"), "c", "n", "most", "bits")
    hubs = keys.groupBy("i", "low").agg(F.min(own).alias("h"), F.count(F.lit(1)).alias("m"))
    met = keys.join(hubs.where("m > 1"), ["i", "low"]).where("c <> h.c")
    return met.select(
        F.col("h.c").alias("a"), F.col("h.n").alias("na"), F.col("h.most").alias("oa"), F.col("h.bits").alias("wa"),
        F.col("c").alias("b"), F.col("n").alias("nb"), F.col("most").alias("ob"), F.col("bits").alias("wb"),
    )


def cross_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes in different groups (``g``) that share an n-gram of both prefixes."""
    grams = sets.select("c", "n", "g", F.explode("grams").alias("t"))
    common = grams.groupBy("t").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count(F.lit(1)).alias("df"))
    held = grams.join(common.where("lo < hi").select("t", "df"), "t")
    # N-grams of one group alone come first in the order; they take places of the prefix.
    ordered = held.groupBy("c", "n", "g").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("ts"))
    spare = F.floor(F.col("n") * (100 - percent) / 100) + 1 - (F.col("n") - F.size("ts"))
    prefix = ordered.where(spare > 0).select(
        "c", "n", "g", F.size("ts").alias("m"), F.posexplode(F.slice("ts", 1, spare.cast("int"))).alias("p", "x")
    )
    # If this is the first n-gram that a pair has in common, only those after it can follow.
    prefix = prefix.select("c", "n", "g", (F.col("m") - F.col("p")).alias("o"), F.col("x.t").alias("t"))
    prefix = prefix.join(sets.select("c", F.col("bits").alias("w")), "c")
    a, b = [prefix.select(*[F.col(x).alias(x + side) for x in "cngow"], "t") for side in "ab"]
    named = a.join(b, "t").where("ga < gb").select(
        F.col("ca").alias("a"), "na", "oa", "wa", F.col("cb").alias("b"), "nb", "ob", "wb"
    )
    return named.where(may_link(percent))


def _lead(id_: str, th: str) -> Column:
    """The smallest id with the smallest text hash of its rows."""
    return F.min(F.when(F.col(id_).isNotNull(), F.struct(id_, th))).alias("lead")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: ``id``, ``th`` (hash of its text), ``n`` (set size), ``component``: the smallest id linked to it.

    ``component_th``: of the rows of that id linked to it, the smallest hash of a text.
    """
    visible(docs.sparkSession)
    base = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).cast("string").alias("text"))
    known = base.select("id", F.xxhash64("text").alias("th"), profile(F.col("text"), words).alias("p"))
    known = known.select("id", "th", "p.n", "p.c")
    known = stored(known)
    classes = known.where("n > 0").groupBy("n", "c").agg(F.min("id").alias("first"), _lead("id", "th"))

    def of_text(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        for text in batch["text"]:
            x = ngrams(text.as_py(), words)
            if len(x):
                c = signed(xxhash.xxh3_64_intdigest(x.tobytes()))
                yield c, c, x

    size = known.agg(F.sum("n")).first()[0] or 0
    left = stored(hopeful(classes, alone(base.select("text"), of_text, size), percent))
    sets = stored(_sets(base, left, words))
    found = stored(links(hub_pairs(sets), sets, percent))
    groups = components(found)
    grouped = stored(_grouped(sets, groups))

    def of_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        for c, g, x in zip(batch["c"].to_pylist(), batch["g"].to_pylist(), batch["grams"], strict=True):
            yield c, g, np.sort(x.values.to_numpy().view(np.uint64))

    size = grouped.agg(F.sum("n")).first()[0] or 0
    open_ = hopeful(grouped, alone(grouped, of_sets, size), percent)
    open_ = stored(open_)
    if not open_.isEmpty():
        more = stored(links(cross_pairs(open_, percent), open_, percent))
        if not more.isEmpty():
            groups = components(found.unionByName(more))
    labels = classes.join(groups, classes.c == groups.node, "left")
    labels = labels.select("n", "c", "first", "lead", F.coalesce("label", "c").alias("g"))
    labels = stored(labels)
    smallest = labels.groupBy("g").agg(F.min("first").alias("component"), F.min("lead").alias("best"))
    named = labels.join(smallest, "g").select("n", "c", "component", F.col("best.th").alias("component_th"))
    return known.join(named, ["n", "c"], "left").select(
        "id", "th", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"), "component_th"
    )


def _sets(base: DataFrame, left: DataFrame, words: int) -> DataFrame:
    """``c``, ``n``, ``grams``, ``lows`` (minima under the hub hash functions) of the classes in ``left``."""
    ids = left.where("first IS NOT NULL").select(F.col("first").alias("id")).distinct()
    if ids.count() <= IDS:
        ids = F.broadcast(ids)
    texts = base.join(ids, "id", "left_semi").select("text")

    @lean
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(1)
        odd = rng.integers(0, 1 << 62, HUBS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                x = ngrams(text.as_py(), words)
                c = signed(xxhash.xxh3_64_intdigest(x.tobytes()))
                lows = [int(mix(x * a).min().view(np.int64)) for a in odd] if len(x) else []
                rows.append({"c": c, "grams": x.view(np.int64), "lows": lows, "bits": bitmap(x)})
                if len(rows) == 256:
                    yield pa.RecordBatch.from_pylist(rows, SETS)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, SETS)

    bits = ",".join(f"{w}:bigint" for w in BITMAP)
    found = texts.mapInArrow(made, f"c bigint, grams array<bigint>, lows array<bigint>, bits struct<{bits}>")
    found = found.dropDuplicates(["c"])
    return found.join(left.select("c", "n", "most"), "c")


def bitmap(grams: np.ndarray) -> dict[str, int]:
    """Of ``64 * len(BITMAP)`` places the parity of the n-grams that fall on each."""
    places = 64 * len(BITMAP)
    odd = np.bincount((grams % np.uint64(places)).astype(np.int64), minlength=places) & 1
    return dict(zip(BITMAP, np.packbits(odd.astype(np.uint8)).view(np.int64).tolist(), strict=True))


SETS = pa.schema(
    [
        ("c", pa.int64()), ("grams", pa.list_(pa.int64())), ("lows", pa.list_(pa.int64())),
        ("bits", pa.struct([(w, pa.int64()) for w in BITMAP])),
    ]
)


def _grouped(sets: DataFrame, groups: DataFrame) -> DataFrame:
    joined = sets.join(groups, sets.c == groups.node, "left")
    return joined.select("c", "n", "most", "grams", "bits", F.coalesce("label", "c").alias("g"))
