import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import documents, odd_documents
from traceframe.llm import alignment, units


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(alignment.BYTES))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(public_tokenizers.path(alignment.BYTES), public_tokenizers.path(alignment.PIECES))


def tokens(text, libraries, aligner):
    """Ids and byte ranges of whole texts, as the libraries give them."""
    a, b = libraries
    none = ([], [], [], [])
    if not text:
        return none
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spell_a = [aligner.side_a.token[i] for i in ids_a]
    spell_b = [bytes([i - 3]) if 3 <= i < 259 else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    data = (" " + text).encode()
    if b"".join(spell_a) != data or b"".join(spell_b) != data:
        return none
    ranges = []
    for spell in (spell_a, spell_b):
        at, out = 0, []
        for t in spell:
            out.append((at, at + len(t)))
            at += len(t)
        ranges.append(out)
    return ids_a, ids_b, *ranges


def brute(text, libraries, aligner):
    """(ids, ids, links by place, groups as text): every pair of ranges compared."""
    ids_a, ids_b, at_a, at_b = tokens(text, libraries, aligner)
    links, j = [], 0
    for i, (x, y) in enumerate(at_a):
        while j and at_b[j - 1][1] > x:
            j -= 1
        while j < len(at_b) and at_b[j][0] < y:
            if at_b[j][1] > x:
                links.append((i, j))
            j += 1
    common = sorted({y for _, y in at_a} & {y for _, y in at_b})
    groups, before = [], 0
    for end in common:
        own = [",".join(str(t) for t, (_, y) in zip(ids, at) if before < y <= end) for ids, at in ((ids_a, at_a), (ids_b, at_b))]
        groups.append("|".join(own))
        before = end
    return ids_a, ids_b, links, groups


def same(text, libraries, aligner):
    x = aligner.align(["start here", text, None, "the end"])
    ids_a, ids_b, links, groups = brute(text, libraries, aligner)
    assert x.a[x.doc_a == 1].tolist() == ids_a and x.b[x.doc_b == 1].tolist() == ids_b
    first_a, first_b = (x.doc_a < 1).sum(), (x.doc_b < 1).sum()
    own = x.doc_a[x.link_a] == 1
    assert sorted(zip((x.link_a[own] - first_a).tolist(), (x.link_b[own] - first_b).tolist())) == links
    want = hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else ""
    digests = aligner.digests(x, 4)
    assert digests[1] == want and digests[2] == "" and digests[0] and digests[3]


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_any_text(libraries, aligner, text):
    same(text.encode("utf-8", "replace").decode(), libraries, aligner)


_ODD = ["a", "Word", "'s", "é", "́", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "▁", "文字", "<s>", "<|endoftext|>", "<0x41>", "12", "</s>", "\x00"]


@given(st.lists(st.sampled_from(_ODD)))
@settings(max_examples=300, deadline=None)
def test_odd_characters(libraries, aligner, some):
    same("".join(some), libraries, aligner)


def test_parts_and_forgotten_units_change_nothing(libraries, monkeypatch):
    monkeypatch.setattr(units, "BLOCK", 40)
    small = alignment.Aligner(public_tokenizers.path(alignment.BYTES), public_tokenizers.path(alignment.PIECES))
    small.units.most = 3
    for _, text in odd_documents()[:16]:
        same((text or "")[:3000], libraries, small)


@pytest.mark.parametrize("chunk", [1, 500, 1 << 21])
def test_corpus_counts(spark, libraries, aligner, chunk):
    rows = [(d, (t or "")[:4000]) for d, t in odd_documents()] + [(30, "the the of▁"), (31, None)]
    found = [(d, *brute(t, libraries, aligner)) for d, t in rows]
    holds, tops = Counter(), defaultdict(int)
    for _, a, b, links, _ in found:
        holds.update({(a[i], b[j]) for i, j in links})
    for (a, _), n in holds.items():
        tops[a] = max(tops[a], n)
    want = []
    for d, a, b, links, groups in found:
        counts = [(a[i], holds[a[i], b[j]]) for i, j in links]
        want.append((d, len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
                     sum(n == tops[x] for x, n in counts), sum(n for _, n in counts)))
    got = alignment.statistics(documents(spark, rows).repartition(3), chunk_links=chunk).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))


def test_real_outputs_and_empty_table(spark, libraries, aligner):
    rows = [(i, t) for i, t in enumerate([None, "", "Some words, antidisestablishmentarianism!", "x  y", "▁"])]
    for r in alignment.alignments(documents(spark, rows)).collect():
        a, b, links, groups = brute(rows[r["doc_id"]][1], libraries, aligner)
        assert (r["a_ids"], r["b_ids"]) == (a, b) and [(x["a"], x["b"]) for x in r["links"]] == links
        made = [
            "|".join(",".join(str(t) for t, g in zip(ids, at) if g == n) for ids, at in ((r["a_ids"], r["a_groups"]), (r["b_ids"], r["b_groups"])))
            for n in range(len(groups))
        ]
        assert made == groups
    assert alignment.statistics(documents(spark).limit(0)).count() == 0
    assert alignment.alignments(documents(spark).limit(0)).count() == 0
