import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import documents, odd_documents
from traceframe.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe.default_path(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.v.rank, special_tokens={})


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_encodes_as_by_the_library(codec, library, text):
    text = text.encode("utf-8", "replace").decode()
    ids = codec.encode(text)
    assert ids == library.encode_ordinary(text)
    assert codec.decode(ids) == text == "".join(codec.decode_stream(ids))


def test_long_pieces_and_parts(codec, library, monkeypatch):
    rng = random.Random(1)
    piece = "".join(rng.choice("abcdefgh") for _ in range(3000))
    assert codec.encode(piece) == library.encode_ordinary(piece)
    monkeypatch.setattr(bpe, "PART", 50)
    text = "  ".join("".join(rng.choice("ab 1'.s\n") for _ in range(40)) for _ in range(50))
    assert "".join(bpe.parts(text)) == text and codec.encode(text) == library.encode_ordinary(text)


def test_bounded_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 20)
    monkeypatch.setattr(bpe, "MAX_PIECES", 6)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 10)
    small = bpe.Codec(bpe.default_path(), public_tokenizers.PATTERN)
    for _, text in odd_documents()[:15]:
        text = (text or "")[:5000]
        assert small.encode(text) == library.encode_ordinary(text)


def test_tokens_may_end_inside_a_character(codec):
    ids = [i for b in "文é".encode() for i in [codec.v.rank[bytes([b])]]]
    assert list(codec.decode_stream(ids)) == ["文", "é"]
    assert "".join(codec.decode_stream(ids[:2])) == "�"


def test_odd_rows(spark, library):
    docs = documents(spark)
    rows = bpe.round_trip(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = r["text"] or ""
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["score"] == "own score"
    both = bpe.decode(bpe.encode(docs)).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in both)
    checked = bpe.encode_checked(docs).collect()
    assert sorted(map(repr, (r["token_ids"] for r in checked))) == sorted(map(repr, (r["token_ids"] for r in both)))
    assert all(r["lossless"] and r["token_ids"] == library.encode_ordinary(r["text"] or "") for r in checked)
    assert all(r["score"] == "own score" for r in checked) and bpe.encode_checked(docs.limit(0)).count() == 0
    assert bpe.encode_checked(docs, keep=["doc_id"]).columns == ["doc_id", "token_ids", "lossless"]
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_batches_by_ids_change_nothing(spark, library, monkeypatch):
    docs = documents(spark)
    monkeypatch.setattr(bpe, "BATCH", 40)
    got = bpe.encode_checked(docs, keep=["doc_id", "text"], share=0.001).collect()
    assert len(got) == docs.count()
    assert all(r["lossless"] and r["token_ids"] == library.encode_ordinary(r["text"] or "") for r in got)


def test_a_text_without_blanks_keeps_its_bounds(library, monkeypatch):
    """States are dropped inside a piece too: their number never passes the bound."""
    monkeypatch.setattr(bpe, "MAX_STATES", 2000)
    small = bpe.Codec(bpe.default_path(), public_tokenizers.PATTERN)
    most, expand = [0], small.transducer.expand

    def watched(state, byte):
        found = expand(state, byte)
        most[0] = max(most[0], len(small.transducer.states))
        return found

    small.transducer.expand = watched
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000))
    ids = small.encode(text)
    assert ids == library.encode_ordinary(text) and most[0] <= 2001
    assert not small.pieces and not small.older
