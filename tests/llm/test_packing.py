import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import documents, odd_documents
from traceframe.llm import packing, units


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@pytest.fixture(scope="module")
def own():
    return packing.Encoder(public_tokenizers.path(packing.VOCABULARY))


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text_encodes_as_by_the_library(own, library, text):
    text = text.encode("utf-8", "replace").decode()
    assert own.ids(text, end=None).tolist() == library.encode(text, add_special_tokens=False).ids


@given(st.lists(st.sampled_from(["a", "B!", "'s", "é", "é", "́", " ", "\n", "\x0b", "\x1c", "\x85", "　", "İ", "Σ", "É", "ß", "×", "ª", "²", "’", "'LL", "'", "\xa0", "文字", "<|endoftext|>", "12"])))
@settings(max_examples=300, deadline=None)
def test_odd_characters(own, library, some):
    text = "".join(some)
    assert own.ids(text, end=None).tolist() == library.encode(text, add_special_tokens=False).ids


def test_parts_and_forgotten_units_change_nothing(library, monkeypatch):
    monkeypatch.setattr(units, "BLOCK", 50)
    small = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    small.words.most = small.pieces.most = 5
    monkeypatch.setattr(packing, "TOGETHER", 2)
    for _, text in odd_documents()[:16]:
        assert small.ids(text or "", end=None).tolist() == library.encode(text or "", add_special_tokens=False).ids


def brute(sizes, capacity, limit):
    """Bins, by looking at all open ones: least sufficient space, of those the one used last."""
    bins, open_, clock = [], [], 0
    for size in sizes:
        clock += 1
        fit = [b for b in open_ if capacity - b["used"] >= size]
        if fit:
            best = max(fit, key=lambda b: (b["used"], b["at"]))
        else:
            best = {"used": 0, "items": []}
            bins.append(best)
            open_.append(best)
        best["used"] += size
        best["at"] = clock
        best["items"].append(size)
        if best["used"] == capacity:
            open_.remove(best)
        elif len(open_) > limit:
            open_.remove(max(open_, key=lambda b: (b["used"], b["at"])))
    return sorted(tuple(b["items"]) for b in bins)


@given(st.lists(st.integers(1, 40), max_size=200), st.integers(1, 8))
@settings(max_examples=200, deadline=None)
def test_bins_are_those_of_a_plain_search(sizes, limit):
    bins, done = packing.Bins(40, limit), []
    for n, size in enumerate(sizes):
        done += bins.place(size, (n, size))
        assert bins.open == sum(map(len, bins.by_free.values())) <= limit
    done += bins.rest()
    assert sorted(tuple(size for _, (_, size) in b[2]) for b in done) == brute(sizes, 40, limit)
    for _, used, items in done:
        assert [at for at, _ in items] == np.cumsum([0, *(s for _, (_, s) in items)])[:-1].tolist()
        assert used == sum(s for _, (_, s) in items) <= 40


def check(rows, texts, library, capacity):
    """Every document's ids are there once and in order, every sequence is gapless; the number of sequences."""
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == r["length"] and r["start"] == r["piece"] * capacity
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    pieces = Counter((r["doc_id"], r["piece"], tuple(r["ids"])) for r in rows)
    want = Counter()
    for doc, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), capacity)):
            want[doc, n, tuple(ids[start : start + capacity])] += 1
    assert pieces == want
    return len(by_seq)


def test_odd_rows(spark, library):
    docs = documents(spark)
    rows = packing.pack(docs, capacity=64).collect()
    assert check(rows, odd_documents(), library, 64) <= sum(r["length"] for r in rows) / 64 + 4
    assert sum(r["length"] == 1 and r["ids"] == [0] for r in rows) >= 3
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.sequences(packing.pack(docs.limit(0))).count() == 0


def test_many_tasks_leave_few_sequences_open(spark, library):
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(["tree", "house", "of", "x1"]) for _ in range(int(rng.paretovariate(0.7)) % 90))) for i in range(3000)]
    docs = documents(spark, texts, extra=False).repartition(40)
    pieces = packing.pack(docs, capacity=64, open_bins=16)
    rows = pieces.collect()
    least = -(-sum(r["length"] for r in rows) // 64)
    assert check(rows, texts, library, 64) <= 1.04 * least
    for r in packing.sequences(pieces).collect():
        assert len(r["ids"]) == sum(d["length"] for d in r["documents"]) <= 64
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)


def test_open_bins_are_packed_in_groups(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(1, 100)) for i in range(2000)]
    bins = spark.createDataFrame(rows, "bin long, used long")
    for group in (150, 10_000):
        placed = packing._pack_bins(bins, 100, group).collect()
        used = dict(rows)
        assert sorted(r["bin"] for r in placed) == sorted(used)
        by_seq = defaultdict(list)
        for r in placed:
            by_seq[r["sequence_id"]].append((r["base"], used[r["bin"]]))
        for parts in by_seq.values():
            assert np.cumsum([0, *(u for _, u in sorted(parts))])[:-1].tolist() == sorted(b for b, _ in parts)
            assert sum(u for _, u in parts) <= 100
        assert len(by_seq) <= 1.06 * sum(used.values()) / 100
