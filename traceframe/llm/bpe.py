"""Byte-level BPE as a finite-state transducer, determinised as it is used.

A sequence of tokens is what the merges give for its bytes exactly when every two neighbours are
(``Vocabulary.stable``), and each prefix of a text has one such sequence. That makes encoding a
transducer: its hypotheses are a last complete token and a trie node inside the next one. Reading
a byte moves all hypotheses; output that all of them share is emitted at once. States are sets of
hypotheses, made when first met (``Transducer.expand``) and dropped together when there are more
than ``MAX_STATES``. How far output can lag is bounded by the longest token.

Decoding joins the tokens' bytes and runs them through an incremental UTF-8 decoder, so a text can
be decoded token by token although tokens may end inside a character.

Defined cases: NULL text counts as empty and has no tokens; a lone surrogate cannot occur in a
Spark string; unknown ids on decoding raise ``KeyError``; very long texts, also
without any blank, are encoded whole within the same bounds; repeated rows are each encoded; an empty
table gives no rows. Input columns named like an output are
replaced.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import column, lean, visible, without

RANKS = "byte_bpe_50k.tiktoken"
#: Bounds of what a worker remembers: about 60 MB of states, 90 MB of pieces, 50 MB of pairs.
MAX_STATES = 120_000
MAX_PIECES = 600_000
MAX_PAIRS = 500_000
#: Token ids in one output batch, give or take one text.
BATCH = 1 << 20
#: Texts are cut for splitting into parts of about so many characters, where no piece is cut.
PART = 1 << 20
ROOT = 0


class Vocabulary:
    """Token bytes and ids, and a trie of the tokens."""

    def __init__(self, path: str, share: float = 1):
        self.most = int(MAX_PAIRS * share)
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.token = {i: t for t, i in self.rank.items()}
        self.edge: dict[int, int] = {}  # node * 256 + byte -> node
        self.at: list[int] = [-1]  # token that ends at a node
        for t, i in self.rank.items():
            node = ROOT
            for b in t:
                key = node << 8 | b
                if key not in self.edge:
                    self.edge[key] = len(self.at)
                    self.at.append(-1)
                node = self.edge[key]
            self.at[node] = i
        self.pairs: dict[int, bool] = {}

    def merge(self, parts: list[bytes], cut: int = -1) -> list[bytes] | None:
        """Merge neighbours, lowest rank first; None as soon as a merge spans byte ``cut``."""
        rank = self.rank.get
        ranks = [rank(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, where = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, where = r, i
            if best is None:
                return parts
            if cut >= 0:
                start = sum(map(len, parts[:where]))
                if start < cut < start + len(parts[where]) + len(parts[where + 1]):
                    return None
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
            del ranks[where]
            if where:
                ranks[where - 1] = rank(parts[where - 1] + parts[where])
            if where < len(ranks):
                ranks[where] = rank(parts[where] + parts[where + 1])

    def stable(self, a: int, b: int) -> bool:
        """Whether the merges leave the bytes of ``a`` and ``b`` as these two tokens."""
        if a < 0:
            return True
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            x, y = self.token[a], self.token[b]
            parts = [bytes([c]) for c in x + y]
            known = self.pairs[key] = self.merge(parts, len(x)) == [x, y]
        return known


class State(dict):
    """byte -> (next state, tokens emitted). ``final``: tokens still to come if the text ends."""

    __slots__ = ("final", "hypotheses")


class Transducer:
    def __init__(self, vocabulary: Vocabulary, share: float = 1):
        self.v, self.most = vocabulary, int(MAX_STATES * share)
        self.clear()

    def clear(self) -> None:
        for state in getattr(self, "states", {}).values():
            state.clear()  # edges may form cycles
        self.states: dict[tuple, State] = {}
        self.start = self.state(((-1, (), ROOT),))

    def state(self, hypotheses: tuple) -> State:
        known = self.states.get(hypotheses)
        if known is None:
            known = self.states[hypotheses] = State()
            known.hypotheses = hypotheses
            known.final = next((pend for _, pend, node in hypotheses if node == ROOT), None)
        return known

    def expand(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        if len(self.states) >= self.most:  # also inside a long piece; the state at hand goes on alone
            self.clear()
        edge, at, moved, complete = self.v.edge, self.v.at, [], None
        for last, pend, node in state.hypotheses:
            child = edge.get(node << 8 | byte)
            if child is None:
                continue
            moved.append((last, pend, child))
            token = at[child]
            if token >= 0 and complete is None and self.v.stable(last, token):
                complete = (token, (*pend, token), ROOT)
                moved.append(complete)
        out = moved[0][1]
        for _, pend, _ in moved:  # what all hypotheses share
            if pend[: len(out)] != out:
                n = min(len(pend), len(out))
                while pend[:n] != out[:n]:
                    n -= 1
                out = out[:n]
        if out:
            n = len(out)
            moved = [(last, pend[n:], node) for last, pend, node in moved]
        found = state[byte] = (self.state(tuple(moved)), out)
        return found

    def run(self, data: bytes) -> list[int]:
        state, out = self.start, []
        for b in data:
            edge = state.get(b) or self.expand(state, b)
            state = edge[0]
            if edge[1]:
                out += edge[1]
        out += state.final
        return out


class Codec:
    """Encodes and decodes whole texts, remembering the pieces it has met, up to a bound.

    ``share`` scales all bounds.
    """

    def __init__(self, path: str, pattern: str, share: float = 1):
        self.v = Vocabulary(path, share)
        self.transducer = Transducer(self.v, share)
        self.most = max(2, int(MAX_PIECES * share))
        self.split = regex.compile(pattern).findall
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        # Vocabularies whose merges cannot make one of their own tokens: such a piece is that token.
        self.whole = {
            t: i for t, i in self.v.rank.items() if self.v.merge([bytes([c]) for c in t]) != [t]
        }

    def piece(self, piece: str) -> tuple[int, ...]:
        """The ids of a piece that is not among the newer half of those remembered."""
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode("utf-8", "replace")
            token = self.whole.get(data) if self.whole else None
            ids = tuple(self.transducer.run(data)) if token is None else (token,)
        if len(piece) <= 64:
            if len(self.pieces) >= self.most // 2:
                self.older, self.pieces = self.pieces, {}
            self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in parts(text):
            pieces = self.split(part)
            found = list(map(self.pieces.get, pieces))
            if None in found:
                known, piece = self.pieces.get, self.piece
                found = [ids or known(p) or piece(p) for p, ids in zip(pieces, found, strict=True)]
            out.extend(chain.from_iterable(found))
        return out

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.v.token.__getitem__, ids))

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as soon as its characters are complete; bytes that are no UTF-8 become U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        token = self.v.token
        for i in ids:
            if text := machine.decode(token[i]):
                yield text
        if text := machine.decode(b"", True):
            yield text

    def decode(self, ids: list[int], step: int = 4096) -> str:
        """The same over runs of tokens."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        runs = (machine.decode(self.decode_bytes(ids[i : i + step])) for i in range(0, len(ids), step))
        return "".join(runs) + machine.decode(b"", True)


def parts(text: str) -> Iterator[str]:
    """The text cut before single blanks between non-blanks, where every piece begins anew."""
    begin = 0
    while len(text) - begin > PART:
        cut = begin + PART
        while cut < len(text) - 1 and not (
            text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1].isspace()
        ):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def default_path() -> str:
    return public_tokenizers.path(RANKS)


def encode(
    docs: DataFrame,
    *,
    text_col: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    out: str = "token_ids",
) -> DataFrame:
    """``docs`` with the token ids of each whole text as an array."""
    path = path or default_path()

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path, pattern)
        for texts in batches:
            yield pa.array([c.encode(t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))

    return _with(docs, out, ids.asNondeterministic(), text_col)


def decode(
    docs: DataFrame,
    *,
    ids_col: str = "token_ids",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    out: str = "decoded",
) -> DataFrame:
    """``docs`` with the text of each array of token ids; NULL ids give empty text."""
    path = path or default_path()

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path, pattern)
        for ids in batches:
            yield pa.array([c.decode(x or []) for x in ids.to_pylist()], pa.string())

    return _with(docs, out, texts.asNondeterministic(), ids_col)


CHECKED = ("token_ids", "lossless")


def encode_checked(
    docs: DataFrame,
    *,
    text_col: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    keep: Iterable[str] | None = None,
    share: float = 1,
) -> DataFrame:
    """``docs`` with ``token_ids``, and ``lossless``: whether they decode to the text.

    One pass: the ids need not go back to a task to be decoded. Ids leave the task in batches of about
    ``BATCH``, whatever the number of rows. ``keep`` names the columns that come along; all by default.
    ``share`` scales what a task remembers; it is given back when the task ends.
    """
    path = path or default_path()
    visible(docs.sparkSession)
    base = without(docs, CHECKED)
    kept = base.columns if keep is None else [c for c in base.columns if c in set(keep)]
    names = [f"c{i}" for i in range(len(kept))]
    given = docs.select(*[column(docs, c).alias(n) for c, n in zip(kept, names, strict=True)], column(docs, text_col).cast("string").alias("t"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields if f.name != "t")

    @lean
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Codec(path, pattern, share)
        for batch in batches:
            texts, begin, parts, sizes, same = batch.column("t"), 0, [], [0], []
            for i, t in enumerate(texts):
                text = t.as_py() or ""
                ids = c.encode(text)
                same.append(c.decode(ids) == text)
                sizes.append(sizes[-1] + len(ids))
                parts.append(np.array(ids, np.int32))
                if sizes[-1] >= BATCH or i == len(texts) - 1:
                    lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(parts)))
                    own = [batch.column(n).slice(begin, len(parts)) for n in names]
                    yield pa.RecordBatch.from_arrays([*own, lists, pa.array(same, pa.bool_())], [*names, *CHECKED])
                    begin, parts, sizes, same = i + 1, [], [0], []
            gc.freeze()  # what is remembered is not worth scanning again
        gc.unfreeze()
        c.transducer.clear()

    made = given.mapInArrow(tasks, ", ".join(x for x in (kinds, "token_ids array<int>", "lossless boolean") if x))
    return made.select(*[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], *CHECKED)


ROUND_TRIP = ("n_tokens", "ids_sha256", "decoded_sha256")


def round_trip(
    docs: DataFrame,
    *,
    text_col: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``docs`` with the number of tokens and digests of the ids and of the bytes decoded from them.

    Encodes and decodes in one pass, so that neither ids nor decoded text leave the task.
    """
    path = path or default_path()
    schema = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path, pattern)
        names = {i: str(i) for i in c.v.token}.__getitem__
        for texts in batches:
            rows = []
            for t in texts:
                ids = c.encode(t.as_py() or "")
                rows.append(
                    {
                        "n_tokens": len(ids),
                        "ids_sha256": hashlib.sha256(" ".join(map(names, ids)).encode()).hexdigest(),
                        "decoded_sha256": hashlib.sha256(c.decode(ids).encode()).hexdigest(),
                    }
                )
            yield pa.array(rows, schema)
            gc.freeze()  # the tables live as long as the worker: not worth scanning again

    visible(docs.sparkSession)
    base = without(docs, ROUND_TRIP)
    made = base.withColumn("__trip", trip.asNondeterministic()(column(docs, text_col).cast("string")))
    return made.select(*[column(made, c) for c in base.columns], *[F.col(f"__trip.{c}") for c in ROUND_TRIP])


def _with(docs: DataFrame, out: str, udf, source: str) -> DataFrame:
    visible(docs.sparkSession)
    base = without(docs, [out])
    value = column(docs, source)
    return base.withColumn(out, udf(value))
