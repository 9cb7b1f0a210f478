import re

from tests.llm.helpers import LOWER, documents
from traceframe.llm import decontaminate as D


def found(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, items, n=10):
    words, hit, ids = found(text), set(), set()
    for item, t in items:
        w = found(t)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            window = w[i : i + n]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids)


ITEMS = [
    (1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (20, "Short  item!"), (3, None), (4, "..."), (5, "Short item"),
    (6, "ünï ÇØ"), (None, "no id"), (7, "w3 w4 w5 w6 w7 w8 w9 w10 w11 end"),
]
TEXTS = [
    "start w1 w2, w3 W4 w5 w6 w7 w8 w9 w10 w11 stop", "a short ITEM and a short item, shortitem", "x ünï ÇØ y Ünï",
    "w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 end", "w1 w2 w3 w4 w5", "no id", None, "",
]


def run(spark, docs, **more):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return D.mark(docs, items, **more).collect()


def test_agrees_with_brute_force(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    rows = run(spark, docs)
    items = [x for x in ITEMS if x[0] is not None]
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == brute(r["text"], items)
        assert sum(len(found(r["text"][s["start"] : s["end"]])) for s in r["spans"]) == r["n_hit"]
    assert sum(r["n_hit"] > 0 for r in rows) == 4


def test_spans_are_characters_of_the_original(spark):
    rows = {r["doc_id"]: r for r in run(spark, documents(spark, list(enumerate(TEXTS))))}
    assert [TEXTS[2][s["start"] : s["end"]] for s in rows[2]["spans"]] == ["ünï ÇØ"]
    assert [TEXTS[1][s["start"] : s["end"]] for s in rows[1]["spans"]] == ["short ITEM", "short item"]


def test_blocks_of_items_change_nothing(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    def key(rows):
        return sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"], r["spans"]) for r in rows)
    assert key(run(spark, docs)) == key(run(spark, docs, block_bytes=30))


def test_many_blocks_one_at_a_time(spark, monkeypatch):
    """Forty blocks: the driver asks for one after the other, and every row comes out once with its columns."""
    items = spark.createDataFrame([(i, f"item{i} word{i} end") for i in range(120)], "item_id long, text string")
    texts = [(i, f"see item{i} word{i} end, and item{i + 1} word{i + 1} end") for i in range(60)] + [(7, None), (8, ""), (None, "nothing")]
    asked, block = [], D.Blocks.block
    monkeypatch.setattr(D.Blocks, "block", lambda self, k: asked.append(k) or block(self, k))
    rows = D.mark(documents(spark, texts), items, block_bytes=50).collect()
    assert len(asked) > 30 and asked == sorted(set(asked))
    assert len(rows) == len(texts) and all(r["score"] == "own score" for r in rows)
    plain = [(i, f"item{i} word{i} end") for i in range(120)]
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == brute(r["text"], plain)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = run(spark, docs)
    assert len(rows) == docs.count() and all(r["score"] == "own score" for r in rows)
    assert all((r["n_words"], r["n_hit"]) == brute(r["text"], ITEMS[:-1])[:2] for r in rows if len(r["text"] or "") < 10_000)
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["n_hit"] == 0 and r["item_ids"] == [] for r in D.mark(docs, none).collect())
    assert run(spark, docs.limit(0)) == []
