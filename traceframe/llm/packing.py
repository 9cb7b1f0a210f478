"""Best-fit packing of tokenised documents into sequences of a fixed length.

Each task packs the documents of its partition as they come: bounded-space online best fit. A
fixed number of bins is open; a bitset holds the amounts of free space that open bins have, so the
bin with the least sufficient space is the lowest set bit from a piece's length on. When one bin
too many is open, the fullest closes. A closed bin is a sequence. Bins still open at the end
of a task are packed once more, as whole items, longest first, by the same rule in groups of about
``GROUP`` bins. Nothing is shuffled but those bins and their pieces.

Tasks hold the pieces of their open bins (at most ``open_bins * capacity`` tokens), one batch of
documents, and ids of frequent pieces of text up to a bound. What a task packed is written to the shared folder before it is read again, so a
lost executor cannot give two different packings.

Defined cases: NULL and empty texts are the end id alone, one piece of length 1; a text of any
length is cut only into pieces of ``capacity`` and a last one of at most that; only the id column
comes along, other columns may have any names; rows of one id and NULL ids are documents of their
own; equal free space: the bin used last; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import column, visible, written
from traceframe.llm.units import Units, parts

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
OPEN = 256
END = 0
#: Bins that one task packs when bins are packed again.
GROUP = 65_536
#: Tokens in one output batch.
BATCH = 1 << 20

_WORDS = re.compile(r"[^ \n\t\r]+").findall
# Texts of plain characters alone are cut into the library's own pieces here, which repeat more often
# than words: lower case and normal forms of them are the same everywhere. Other characters, and the
# beginnings of special tokens, show in the pieces.
_OTHER = re.compile(r"[^!-~ß-öø-ÿ‘’“”–—…]|<\|").search
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \n\t\ra-zß-öø-ÿ0-9]+").findall


@lru_cache(maxsize=1)
def _tokenizers(path: str):
    """The tokenizer as it is, and one that takes text in normal form."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole, bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
    bare.normalizer = None
    return whole, bare


#: Pieces whose ids a worker remembers for as long as it lives, some 100 MB.
REMEMBERED = 1_000_000
#: Pieces encoded as one text. Fewer cost more a piece, and so do very many.
TOGETHER = 50


class Encoder:
    """The library's ids of whole texts, by words or smaller: white space is in no token of this vocabulary."""

    def __init__(self, path: str):
        self.whole, self.bare = _tokenizers(path)
        names = self.whole.get_vocab()
        self.kind = np.uint16 if max(names.values()) < 1 << 16 else np.uint32
        self.last = np.zeros(max(names.values()) + 1, bool)
        self.last[[i for t, i in names.items() if t.endswith("</w>")]] = True
        self.words, self.pieces = Units(self._encode, REMEMBERED // 4), Units(self._encode_pieces, REMEMBERED)
        self.odd = b"\xff" * 3  # no piece is encoded as this: it is no whole number of ids

    def _encode(self, some: list[str]) -> list[bytes]:
        found = self.whole.encode_batch(some, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in found]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Many pieces as one text; a piece ends with the token that ends a word. ``odd`` for others than plain ones."""
        plain = [p for p in pieces if not _OTHER(p)]
        if len(plain) < len(pieces):
            made = dict(zip(plain, self._encode_pieces(plain), strict=True)) if plain else {}
            return [made.get(p, self.odd) for p in pieces]
        texts = [" ".join(pieces[i : i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        found = self.bare.encode_batch(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, self.kind) for x in found])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):
            return self._encode(pieces)
        data, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def ids(self, text: str, end: int | None = END) -> np.ndarray:
        found = []
        for part in parts(text):
            made = self.pieces(_PIECES(part.lower()))
            found += self.words(_WORDS(part)) if self.odd in made else made
        if end is not None:
            found.append(np.array([end], self.kind).tobytes())
        return np.frombuffer(b"".join(found), self.kind).astype(np.int32)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Bins:
    """Open bins, found by their free space."""

    def __init__(self, capacity: int, limit: int, first: int = 0):
        self.capacity, self.limit, self.next = capacity, limit, first
        self.bits = 0
        self.by_free: dict[int, list[list]] = {}
        self.open = 0

    def place(self, size: int, item) -> list[list]:
        """Put ``item`` into the best bin; the bins [number, used, [(offset, item)]] that close by it."""
        above = self.bits >> size
        if above:
            bin_ = self._take(size + (above & -above).bit_length() - 1)
        else:
            bin_ = [self.next, 0, []]
            self.next += 1
        bin_[2].append((bin_[1], item))
        bin_[1] += size
        free = self.capacity - bin_[1]
        if not free:
            return [bin_]
        self.by_free.setdefault(free, []).append(bin_)
        self.bits |= 1 << free
        self.open += 1
        if self.open <= self.limit:
            return []
        return [self._take((self.bits & -self.bits).bit_length() - 1)]

    def _take(self, free: int) -> list:
        same = self.by_free[free]
        bin_ = same.pop()
        if not same:
            del self.by_free[free]
            self.bits &= ~(1 << free)
        self.open -= 1
        return bin_

    def rest(self) -> list[list]:
        return [bin_ for same in self.by_free.values() for bin_ in same]


def _first(round_: int) -> int:
    """The first bin number of the running task: no two tasks or rounds share one."""
    return round_ << 57 | TaskContext.get().partitionId() << 32


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    open_bins: int = OPEN,
    end: int | None = END,
) -> DataFrame:
    """The pieces of all documents: id, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``.

    ``ids_crc32`` is the checksum of a piece's ids as little-endian 32-bit numbers.
    """
    visible(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    given = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder(path).ids, Bins(capacity, open_bins, _first(0))
        out, tokens = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py() or "", end)
                for n, start in enumerate(range(0, len(ids), capacity)):
                    some = ids[start : start + capacity]
                    some = some if len(some) == len(ids) else some.copy()
                    for bin_ in bins.place(len(some), (key, n, start, some)):
                        out.append((bin_, False))
                        tokens += bin_[1]
                if tokens >= BATCH:
                    yield _pieces(out, batch.schema.field(0).type)
                    out, tokens = [], 0
        out += [(bin_, True) for bin_ in bins.rest()]
        if out:
            yield _pieces(out, out[0][0][2][0][1][0].type)

    schema = f"id {kind}, piece int, start bigint, length bigint, ids array<int>, ids_crc32 bigint, bin bigint, offset bigint, open boolean"
    packed = written(given.mapInArrow(tasks, schema))
    left = packed.where("open").groupBy("bin").agg(F.max(F.col("offset") + F.col("length")).alias("used"))
    moved = _pack_bins(left, capacity)
    names = ["piece", "start", "length", "ids", "ids_crc32"]
    alone = packed.where("NOT open").select("id", *names, F.col("bin").alias("sequence_id"), "offset")
    joined = packed.where("open").join(moved, "bin").select(
        "id", *names, "sequence_id", (F.col("offset") + F.col("base")).alias("offset")
    )
    return alone.unionByName(joined).withColumnRenamed("id", id_col)


def _pieces(bins: list, kind: pa.DataType) -> pa.RecordBatch:
    rows = [(bin_[0], offset, open_, *item) for bin_, open_ in bins for offset, item in bin_[2]]
    number, offset, open_, key, piece, start, ids = zip(*rows, strict=True)
    sizes = np.array([len(x) for x in ids])
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k.as_py() for k in key], kind), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
            pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids), pa.int32())),
            pa.array([zlib.crc32(np.ascontiguousarray(x, "<i4")) for x in ids], pa.int64()),
            pa.array(number, pa.int64()), pa.array(offset, pa.int64()), pa.array(open_, pa.bool_()),
        ],
        ["id", "piece", "start", "length", "ids", "ids_crc32", "bin", "offset", "open"],
    )


def _pack_bins(bins: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """``bin``, ``sequence_id`` and ``base``: where each of the bins (``bin``, ``used``) ends up."""
    bins = written(bins)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Longest first, a bin must stay open until the short ones come: all of a group may be open.
        open_, done = Bins(capacity, 2 * group, _first(1)), []
        for batch in batches:
            for number, used in zip(*batch.to_pydict().values(), strict=True):
                done += open_.place(used, number)
        moves = [(was, bin_[0], at) for bin_ in done + open_.rest() for at, was in bin_[2]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[i] for m in moves], pa.int64()) for i in range(3)], ["bin", "sequence_id", "base"]
        )

    groups = -(-bins.count() // group)
    dealt = bins.repartition(groups, "bin") if groups > 1 else bins.repartition(1)
    dealt = dealt.sortWithinPartitions(F.desc("used"), "bin")
    return written(dealt.mapInArrow(tasks, "bin bigint, sequence_id bigint, base bigint"))


def sequences(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``sequence_id``, its ``ids`` in order and its ``documents`` (id, offset, length); at most ``capacity`` each."""
    part = F.struct("offset", "length", column(pieces, id_col).alias("id"), "ids")
    rows = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return rows.select(
        "sequence_id", F.flatten("parts.ids").alias("ids"),
        F.transform("parts", lambda p: F.struct(p["id"].alias("id"), p["offset"].alias("offset"), p["length"].alias("length"))).alias("documents"),
    )
