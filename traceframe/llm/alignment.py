"""Alignment of the tokens that two tokenizers make of the same texts.

Both token sequences cover the same bytes. Per batch, ``pandas.merge_asof`` keyed by document
finds for each token's start the other side's token that covers it. The union of both directions holds every
overlapping pair: of two tokens that overlap, the one that starts later starts inside the other.
Ends that both sides have cut a document into groups.

How many documents of the corpus hold a pair of ids is counted from partial counts: documents
come in chunks of a bounded number of links, a chunk's distinct pairs are counted in its
task, and only those rows meet by id pair. The totals go back to their chunk, once for each distinct
pair, so a pair that every document holds is one row a chunk, not one a document.

Texts are encoded by the two libraries in units between single blanks, where both begin anew: the
byte-level vocabulary puts a blank before a word, and no piece of the other one has a blank
inside. Units are remembered while a task runs, up to a bound.

Defined cases: texts that are NULL, empty, or whose tokens do not give the text back with a blank before
it (say, with U+2581 in it) have no tokens: zeros and an empty digest; a text without any blank is one unit of
any length; rows of one id and NULL ids are documents of their own; pairs with equal counts are
all best; an empty table gives no rows; only the id column comes along.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import column, lean, visible, written
from traceframe.llm.units import Units, parts

BYTES = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Links in one chunk of documents, give or take one document.
CHUNK = 1 << 20
#: Units encoded as one text, and in one run of such texts.
TOGETHER = 50
RUN = 2000
#: Characters of text that are aligned at a time, give or take one document.
BATCH = 1 << 20

#: Room for a pair of ids; the documents of a batch are numbered above it.
PAIR_BITS = 40

#: A blank between two characters that are no white space to either side's rules.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"


def _byte_letters() -> dict[str, int]:
    """The usual letter of each byte in byte-level vocabularies: itself if visible, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Side:
    """One tokenizer: the bytes of each id, and the ids of strings."""

    def __init__(self, token: list[bytes]):
        self.token = token
        self.length = np.array([len(t) for t in token], np.int64)


class ByteSide(Side):
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = _byte_letters()
        size = self.library.get_vocab_size(with_added_tokens=True)
        names = [self.library.id_to_token(i) or "" for i in range(size)]
        super().__init__([bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names])

    def encode(self, units: list[str]) -> list[list[int]]:
        found = self.library.encode_batch([f" {u}" for u in units], add_special_tokens=False)
        return [x.ids for x in found]


class PieceSide(Side):
    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        if any(_SPACE in n.lstrip(_SPACE) for n in names):
            raise ValueError(f"{path} has pieces with a blank inside, so texts cannot be cut at blanks")
        super().__init__(
            [bytes([int(n[3:5], 16)]) if lib.is_byte(i) else n.replace(_SPACE, " ").encode() for i, n in enumerate(names)]
        )

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.library.encode(units, num_threads=1)


@lru_cache(maxsize=1)
def _sides(byte_path: str, piece_path: str) -> tuple[Side, Side]:
    return ByteSide(byte_path), PieceSide(piece_path)


class Aligned:
    """Alignment of a batch: token ids of both sides, their document, group and links (as positions)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray, side_a: Side, side_b: Side):
        self.a, self.b, self.doc_a, self.doc_b = a, b, doc_a, doc_b
        # Documents follow one another, so positions rise over the whole batch.
        end_a, end_b = np.cumsum(side_a.length[a]), np.cumsum(side_b.length[b])
        self.start_a, self.start_b = end_a - side_a.length[a], end_b - side_b.length[b]
        left = pd.DataFrame({"doc": doc_a, "at": self.start_a, "i": np.arange(len(a))})
        right = pd.DataFrame({"doc": doc_b, "at": self.start_b, "j": np.arange(len(b))})
        over_a = pd.merge_asof(left, right, on="at", by="doc")
        over_b = pd.merge_asof(right, left, on="at", by="doc")
        # Tokens that start together find each other in both directions: kept from the first only.
        later = ~np.isin(self.start_b, self.start_a, assume_unique=True)
        self.link_a = np.concatenate([over_a["i"].to_numpy(), over_b["i"].to_numpy()[later]])
        self.link_b = np.concatenate([over_a["j"].to_numpy(), over_b["j"].to_numpy()[later]])
        # A token's group is the number of common ends before it.
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        self.group_a = np.searchsorted(both, end_a)
        self.group_b = np.searchsorted(both, end_b)
        self.last_a = np.isin(end_a, both, assume_unique=True)
        self.last_b = np.isin(end_b, both, assume_unique=True)


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        self.side_a, self.side_b = _sides(byte_path, piece_path)
        most = max(len(self.side_a.token), len(self.side_b.token))
        self.kind = np.uint16 if most <= 1 << 16 else np.uint32
        self.units = Units(self._encode)
        #: An id pair is ``a << shift | b``.
        self.shift = (len(self.side_b.token) - 1).bit_length()
        a, b = self.side_a.token, self.side_b.token
        # Ids as text with what follows them: inside a group, or at the end of its side.
        self.text = np.array(
            [f"{i},".encode() for i in range(len(a))] + [f"{i}|".encode() for i in range(len(a))]
            + [f"{i},".encode() for i in range(len(b))] + [f"{i};".encode() for i in range(len(b))],
            dtype=object,
        )

    def _encode(self, units: list[str]) -> list[tuple[bytes, bytes] | bool]:
        """Ids of both sides; False where they do not give the unit back."""
        out: dict[str, tuple[bytes, bytes] | bool] = {}
        # White space at a unit's edge would run together with the blank beside it.
        bare = [u for u in units if u and not u[0].isspace() and not u[-1].isspace()]
        for i in range(0, len(bare), RUN):
            some = bare[i : i + RUN]
            found = self._encode_run(some)
            if found:
                out.update(zip(some, found, strict=True))
        rest = [u for u in units if u not in out]
        a_token, b_token = self.side_a.token.__getitem__, self.side_b.token.__getitem__
        for unit, a, b in zip(rest, self.side_a.encode(rest), self.side_b.encode(rest), strict=True):
            data = b" " + unit.encode()
            same = b"".join(map(a_token, a)) == data == b"".join(map(b_token, b))
            out[unit] = (np.array(a, self.kind).tobytes(), np.array(b, self.kind).tobytes()) if same else False
        return [out[u] for u in units]

    def _encode_run(self, units: list[str]) -> list[tuple[bytes, bytes]] | None:
        """The same of many units, joined by blanks in texts of a few; None if one of them does not fit."""
        texts = [" ".join(units[i : i + TOGETHER]) for i in range(0, len(units), TOGETHER)]
        data = [u.encode() for u in units]
        whole = b" " + b" ".join(data)
        ends = np.cumsum([len(d) + 1 for d in data])
        cut = []
        for side in (self.side_a, self.side_b):
            ids = np.concatenate([np.array(x, self.kind) for x in side.encode(texts)])
            if b"".join(map(side.token.__getitem__, ids.tolist())) != whole:
                return None
            at = np.cumsum(side.length[ids])
            last = np.searchsorted(at, ends)
            if not (at[last] == ends).all():
                return None
            ids, last = ids.tobytes(), ((last + 1) * self.kind().itemsize).tolist()
            cut.append([ids[x:y] for x, y in zip([0, *last], last, strict=False)])
        return list(zip(*cut, strict=True))

    def ids(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides of each text; none where they do not give the text back."""
        cut = [[_CUT.split(part) for part in parts(t, _CUT)] if t else [] for t in texts]
        # Short texts together, long ones part by part.
        short = list(chain.from_iterable(c[0] for c in cut if len(c) == 1))
        found, at, out = self.units(short), 0, []
        for c in cut:
            if len(c) == 1:
                own, at = found[at : at + len(c[0])], at + len(c[0])
            else:
                own = list(chain.from_iterable(map(self.units, c)))
            out.append(self._joined(own))
        return out

    def _joined(self, units: list) -> tuple[np.ndarray, np.ndarray]:
        if not units or False in units:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = zip(*units, strict=True)
        return tuple(np.frombuffer(b"".join(x), self.kind).astype(np.int64) for x in (a, b))

    def align(self, texts: list[str | None]) -> Aligned:
        made = self.ids(texts)
        doc = np.arange(len(made))
        both = []
        for side in (0, 1):
            ids = [m[side] for m in made]
            both.append((np.concatenate(ids), np.repeat(doc, [len(x) for x in ids])))
        (a, doc_a), (b, doc_b) = both
        return Aligned(a, b, doc_a, doc_b, self.side_a, self.side_b)

    def digests(self, x: Aligned, docs: int) -> list[str]:
        """sha256 of each document's groups as text; empty without tokens."""
        n_a, n_b = len(self.side_a.token), len(self.side_b.token)
        # Groups in a row, a group's side A before its side B.
        text = np.empty(len(x.a) + len(x.b), dtype=object)
        before_a = np.searchsorted(x.group_b, x.group_a, "left")
        before_b = np.searchsorted(x.group_a, x.group_b, "right")
        text[np.arange(len(x.a)) + before_a] = self.text[x.a + n_a * x.last_a]
        text[np.arange(len(x.b)) + before_b] = self.text[2 * n_a + x.b + n_b * x.last_b]
        ends = np.searchsorted(x.doc_a, np.arange(docs), "right") + np.searchsorted(x.doc_b, np.arange(docs), "right")
        out, begin = [], 0
        for end in ends.tolist():
            # The last group is followed by nothing.
            out.append(hashlib.sha256(b"".join(text[begin:end])[:-1]).hexdigest() if end > begin else "")
            begin = end
        return out


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts in runs of about ``BATCH`` characters."""
    for batch in batches:
        keys, texts, begin, size = batch.column(0), [], 0, 0
        for i, text in enumerate(batch.column(1)):
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size >= BATCH or i == len(batch) - 1:
                yield keys.slice(begin, len(texts)), texts
                begin, texts, size = i + 1, [], 0


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.ListArray:
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(flat, kind))


def alignments(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_path: str | None = None,
    piece_path: str | None = None,
) -> DataFrame:
    """Per document the ids of both sides, the group of each token, and the links.

    ``a_ids`` and ``b_ids`` are ids in order, ``a_groups`` and ``b_groups`` their groups from 0,
    ``links`` structs (a, b) of places in those lists.
    """
    given, byte_path, piece_path, kind = _given(docs, id_col, text_col, byte_path, piece_path)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for keys, texts in _batches(batches):
            x, n = aligner.align(texts), len(texts)
            count_a, count_b = np.bincount(x.doc_a, minlength=n), np.bincount(x.doc_b, minlength=n)
            first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
            order = np.lexsort((x.link_b, x.link_a))
            at, to = x.link_a[order], x.link_b[order]
            doc = x.doc_a[at]
            # The first group of each document: groups rise, so that of its first token.
            group = np.zeros(n, np.int64)
            some = count_a > 0
            group[some] = x.group_a[first_a[some]]
            pairs = pa.StructArray.from_arrays(
                [pa.array(at - first_a[doc], pa.int32()), pa.array(to - first_b[doc], pa.int32())], ["a", "b"]
            )
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    keys, _lists(x.a, count_a, pa.int32()), _lists(x.b, count_b, pa.int32()),
                    _lists(x.group_a - group[x.doc_a], count_a, pa.int32()), _lists(x.group_b - group[x.doc_b], count_b, pa.int32()),
                    pa.ListArray.from_arrays(ends, pairs),
                ],
                ["id", "a_ids", "b_ids", "a_groups", "b_groups", "links"],
            )

    found = given.mapInArrow(
        tasks,
        f"id {kind}, a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>, links array<struct<a:int,b:int>>",
    )
    return found.withColumnRenamed("id", id_col)


def _given(docs: DataFrame, id_col: str, text_col: str, byte_path: str | None, piece_path: str | None):
    visible(docs.sparkSession)
    given = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return given, byte_path or public_tokenizers.path(BYTES), piece_path or public_tokenizers.path(PIECES), kind


_COUNTED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def statistics(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_path: str | None = None,
    piece_path: str | None = None,
    chunk_links: int = CHUNK,
) -> DataFrame:
    """Per document the numbers of tokens, groups and links, a digest of the groups, and what the
    corpus says of its links: ``n_best`` have the highest count of their A id, ``count_sum`` adds counts."""
    given, byte_path, piece_path, kind = _given(docs, id_col, text_col, byte_path, piece_path)

    @lean
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        chunk, links = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []  # distinct pairs and documents that hold them
        for keys, texts in _batches(batches):
            x, n = aligner.align(texts), len(texts)
            per = lambda which, n=n: np.bincount(which, minlength=n)
            # Distinct pairs of each document, and how often it has them.
            doc = x.doc_a[x.link_a]
            key = np.sort(doc << PAIR_BITS | x.a[x.link_a] << aligner.shift | x.b[x.link_b])
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
            times = np.diff(np.append(first, len(key)))
            pair, counts = key[first] & ((1 << PAIR_BITS) - 1), per(key[first] >> PAIR_BITS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, chunk), pa.int64()), pa.array(np.ones(n, bool)), keys,
                    pa.array(per(x.doc_a), pa.int64()), pa.array(per(x.doc_b), pa.int64()),
                    pa.array(per(x.doc_a[x.last_a]), pa.int64()), pa.array(per(doc), pa.int64()),
                    pa.array(aligner.digests(x, n), pa.string()), _lists(pair, counts), _lists(times, counts),
                ],
                _STORED_NAMES,
            )
            held.append(np.unique(pair, return_counts=True))
            links += len(doc)
            if links >= chunk_links:
                yield _chunk(chunk, held, keys.type)
                chunk, links, held = chunk + 1, 0, []
        if held:
            yield _chunk(chunk, held, keys.type)

    schema = f"chunk bigint, is_doc boolean, id {kind}, {_COUNTED}, pairs array<bigint>, times array<bigint>"
    stored = written(given.mapInArrow(tasks, schema))
    shift = (len(_sides(byte_path, piece_path)[1].token) - 1).bit_length()
    counted = _counts(shift, stored.where("NOT is_doc").select(F.col("chunk").alias("of"), F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "of", F.col("p.pairs").alias("pair"), F.col("p.times").alias("docs")
    ))

    def add(rows: pa.Table, counts: pa.Table) -> pa.Table:
        pair, total, best = (counts.column(c).to_numpy() for c in ("pair", "total", "best"))
        order = np.argsort(pair)
        pair, total, best = pair[order], total[order], best[order]
        pairs, times = (rows.column(c).combine_chunks() for c in ("pairs", "times"))
        at, times = np.searchsorted(pair, pairs.flatten().to_numpy()), times.flatten().to_numpy()
        ends = pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
        out = rows.select(["id", *_COUNTED_NAMES])
        for name, values in (("n_best", times * best[at]), ("count_sum", times * total[at])):
            sums = np.concatenate([[0], np.cumsum(values)])
            out = out.append_column(name, pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64()))
        return out

    rows = stored.where("is_doc").drop("is_doc")
    found = rows.groupBy("chunk").cogroup(counted.groupBy("of")).applyInArrow(
        add, f"id {kind}, {_COUNTED}, n_best bigint, count_sum bigint"
    )
    return found.withColumnRenamed("id", id_col)


_COUNTED_NAMES = [x.split()[0] for x in _COUNTED.split(", ")]
_STORED_NAMES = ["chunk", "is_doc", "id", *_COUNTED_NAMES, "pairs", "times"]


def _chunk(chunk: int, held: list, kind: pa.DataType) -> pa.RecordBatch:
    """The row of a chunk: its distinct pairs and how many of its documents hold them."""
    pair, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
    docs = np.bincount(at, weights=np.concatenate([n for _, n in held]), minlength=len(pair)).astype(np.int64)
    none = [pa.nulls(1, pa.int64()) for _ in range(4)]
    size = np.array([len(pair)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([chunk], pa.int64()), pa.array([False]), pa.nulls(1, kind), *none, pa.nulls(1, pa.string()),
            _lists(pair, size), _lists(docs, size),
        ],
        _STORED_NAMES,
    )


def _counts(shift: int, held: DataFrame) -> DataFrame:
    """``of`` (a chunk), ``pair``, ``total`` and ``best`` from the documents that hold a pair by chunk."""
    totals = held.groupBy("pair").agg(F.sum("docs").alias("total"))
    tops = totals.groupBy(F.shiftright("pair", shift).alias("a")).agg(F.max("total").alias("top"))
    best = totals.join(tops, F.shiftright("pair", shift) == F.col("a")).select("pair", "total", (F.col("total") == F.col("top")).alias("best"))
    return held.select("of", "pair").join(best, "pair")
