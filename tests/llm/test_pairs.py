"""Nearest neighbours, line dedup and the Jaccard join against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_documents, smallest_linked, words
from traceframe.llm import ann, components, jaccard, line_dedup, queries

SF = "/root/testdata"


def brute_nearest(ids, m, q, k=10):
    d = np.sqrt(((m - m[q]) ** 2).sum(1))
    d[ids == ids[q]] = np.inf
    order = np.lexsort((ids, d))
    return [(int(ids[i]), float(d[i])) for i in order[:k] if np.isfinite(d[i])]


def test_recall(spark):
    rows = queries.op5_nearest(spark, f"{SF}/sf0.1").collect()
    table = spark.read.parquet(f"{SF}/sf0.1/embeddings.parquet").toPandas()
    ids, m = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), float)
    hit = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        best = brute_nearest(ids, m, q)
        mine = sorted((r for r in rows if r["query_id"] == ids[q]), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [r["score"] for r in mine] == sorted(r["score"] for r in mine)
        exact = {i: np.sqrt(((m[ids == i][0] - m[q]) ** 2).sum()) for i in (r["vec_id"] for r in mine)}
        assert all(abs(r["score"] - exact[r["vec_id"]]) < 1e-12 for r in mine)
        hit += len({i for i, _ in best} & set(exact))
        total += 10
    assert hit >= 0.9 * total


def test_vectors_that_take_no_part_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300)] + [(i, [float(i), 1.0, 0.0]) for i in range(300, 330)]
    bad = [(400, None), (401, []), (402, [0.0, 0.0, 0.0]), (403, [nan, 1.0, 1.0]), (404, [inf, 1.0, 1.0]),
           (405, [None, 1.0, 1.0]), (406, [1.0, 1.0]), (None, [1.0, 2.0, 3.0]), (0, [1.0, 2.0, 3.0])]
    schema = "vec_id long, embedding array<float>, id string, r int"
    table = spark.createDataFrame([(*x, "own", 1) for x in good + bad], schema)
    rows = ann.search(table, F.col("id") % 100 == 0).collect()
    assert {r["query_id"] for r in rows} == {0, 100, 200, 300}
    mine = {q: [r["id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 100, 300)}
    assert mine[0] == list(range(1, 11)) and mine[100] == list(range(10)) and mine[300] == list(range(301, 311))
    few = ann.search(table.where("vec_id IN (100, 7)"), F.col("id") == 100).collect()
    assert [(r["rank"], r["id"]) for r in few] == [(1, 7)]
    assert ann.search(table.limit(0), F.col("id") == 1).count() == 0


def test_early_abandoning_keeps_the_near_ones():
    rng = np.random.default_rng(0)
    rows = rng.standard_normal((3000, 64))
    queries_ = rng.standard_normal((20, 64))
    own = np.full(20, -1)
    got = ann.scan(queries_, rows, np.arange(3000), own, 10)
    best = [np.argsort(((rows - q) ** 2).sum(1))[:10] for q in queries_]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(got, best, strict=True)]) > 0.95


@pytest.mark.parametrize("step", [0.0, 1e-4], ids=["equal", "other"])
def test_many_rows_of_one_near_id(spark, step):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(200)]
    rows += [(500, [x + 0.001 + step * n for x in rows[0][1]]) for n in range(60)]
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    best = {}
    for i, x in sorted(brute_nearest(ids, m, 0, len(rows)), key=lambda r: r[1]):
        best.setdefault(i, x)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(ann.search(table, F.col("id") == 0).collect(), key=lambda r: r["rank"])
    assert [r["id"] for r in got] == list(best)[:10]
    assert [r["distance"] for r in got] == pytest.approx(list(best.values())[:10])


def test_vectors_of_each_length_are_searched(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(2).tolist()) for i in range(30)] + [(100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 4.0]), (200, [5.0])]
    rows += [(0, [1.0, 2.0, 3.5])]  # an id with vectors of two lengths
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(table, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["distance"]))
    assert got[100] == [(0, 0.5), (101, 1.0)] and 200 not in got
    plain = [(i, v) for i, v in rows if len(v) == 2 and i]
    near = [(float(np.linalg.norm(np.array(v) - rows[0][1])), i) for i, v in plain] + [(0.5, 100), (0.5, 101)]
    assert [i for i, _ in got[0]] == [i for _, i in sorted(near)[:10]]


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(60)]
    edges = chain + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 230), rng.randrange(200, 230)) for _ in range(25)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(50))
    assert all(got[a] == got[b] for a, b in edges if a != b)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(n=150):
    """Groups of copies whose members differ by some words, with passages that many share."""
    rng = random.Random(9)
    passage = words(rng, 40)
    rows = []
    for i in range(n):
        kind = i % 5
        if kind == 0 or not rows:
            text = words(rng, rng.randrange(1, 160))
        else:
            text = rows[rng.randrange(len(rows))].split() if kind < 4 else [*passage, *words(rng, rng.randrange(4, 30))]
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
        rows.append(" ".join(text))
    return list(enumerate(rows))


@pytest.mark.parametrize("rows", [near_texts(), odd_documents()], ids=["near", "odd"])
def test_jaccard_components(spark, rows):
    docs = documents(spark, rows)
    got = sorted((r["id"], r["n"], r["component"]) for r in jaccard.near_duplicates(docs).collect() if r["id"] is not None)
    from tests.llm.helpers import shingles

    expected = smallest_linked(rows)
    assert got == sorted((d, len(shingles(t)), c) for (d, t), c in zip(rows, expected, strict=True) if d is not None)
    assert jaccard.near_duplicates(docs).count() == len(rows)


def test_jaccard_without_hubs(spark, monkeypatch):
    """The exact join across components finds what hubs do not."""
    found = jaccard.hub_pairs
    monkeypatch.setattr(jaccard, "hub_pairs", lambda sets: found(sets).limit(0))
    rows = near_texts(90)
    got = {r["id"]: r["component"] for r in jaccard.near_duplicates(documents(spark, rows)).collect()}
    assert [got[d] for d, _ in rows] == smallest_linked(rows)


def test_jaccard_in_many_fragments(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FRAGMENT", 100)
    rows = near_texts(120)
    got = {r["id"]: r["component"] for r in jaccard.near_duplicates(documents(spark, rows)).collect()}
    assert [got[d] for d, _ in rows] == smallest_linked(rows)


def test_jaccard_of_nothing(spark):
    empty = documents(spark, [(1, None), (2, ""), (2, "")])
    assert sorted((r["id"], r["n"], r["component"]) for r in jaccard.near_duplicates(empty).collect()) == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]
    assert jaccard.near_duplicates(empty.limit(0)).count() == 0


def brute_cuts(rows, min_words):
    """Each text less its common blocks with every earlier text."""
    lines = []
    for _, t in rows:
        lines.append([{"seq": n, "at": a, "h": x, "w": len(x.split())} for n, (a, x) in enumerate(line_dedup.lines_of(t or ""))])
    out = []
    for i, (_, t) in enumerate(rows):
        found = {r for j in range(i) for r in line_dedup.blocks(lines[i], lines[j], min_words)}
        out.append(line_dedup.cut(t, [{"first": a, "last": b} for a, b in found]) if found else t)
    return out


def test_line_dedup_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/sf0.001/documents.parquet").orderBy("doc_id").collect()
    rows = [(r["doc_id"], r["text"]) for r in table]
    got = {r["doc_id"]: r["text"] for r in queries.op6_line_dedup(spark, f"{SF}/sf0.001").collect()}
    assert [got[d] for d, _ in rows] == brute_cuts(rows, line_dedup.MIN_WORDS)


def test_line_dedup_of_passages(spark):
    rng = random.Random(6)
    passages = [[" ".join(words(rng, rng.randrange(3, 20), 90)) for _ in range(rng.randrange(1, 6))] for _ in range(5)]
    rows = []
    for i in range(60):
        lines = [" ".join(words(rng, 6)) for _ in range(3)] + passages[rng.randrange(5)] + ["", "common line"]
        lines += passages[rng.randrange(5)] if i % 3 else [" ".join(words(rng, 9))]
        rows.append((i, "\n".join(lines)))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(documents(spark, rows), min_words=12).collect()}
    assert [got[d] for d, _ in rows] == brute_cuts(rows, 12)


def brute_runs(rows, min_words):
    """Each text less the lines of any run that an earlier text has too; without alignment or hashes."""
    out = []
    for i, (_, t) in enumerate(rows):
        mine, gone = t.split("\n"), set()
        for _, other in rows[:i]:
            theirs = other.split("\n")
            for a in range(len(mine)):
                for x in range(len(theirs)):
                    n = 0
                    while a + n < len(mine) and x + n < len(theirs) and mine[a + n] == theirs[x + n]:
                        n += 1
                    if sum(len(y.split()) for y in mine[a : a + n]) >= min_words:
                        gone.update(range(a, a + n))
        out.append("\n".join(y for k, y in enumerate(mine) if k not in gone))
    return out


def test_line_dedup_of_crossed_and_repeated_blocks(spark):
    rng = random.Random(8)
    x, y, p, q, t = (" ".join(words(rng, 14)) for _ in range(5))
    rows = [(0, f"{x}\n{y}"), (1, f"{y}\n{x}\nown"), (2, f"{p}\n{p}"), (3, q), (4, t), (5, f"{q}\n{p}\n{t}\nown")]
    assert brute_runs(rows, 12)[1::4] == ["own", "own"]
    lines = [" ".join(words(rng, rng.randrange(3, 15))) for _ in range(12)]
    rows += [(i, "\n".join([*rng.choices(lines, k=rng.randrange(2, 12)), f"own {i}"])) for i in range(6, 70)]
    found = line_dedup.dedup(documents(spark, rows), min_words=12).collect()
    got = {r["doc_id"]: r["text"] for r in found}
    assert [got[d] for d, _ in rows] == brute_runs(rows, 12)
    for r in found:
        spans = [(s["first"], s["last"]) for s in r["deleted"]]
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_line_dedup_of_odd_rows(spark):
    docs = documents(spark)
    rows = line_dedup.dedup(docs).collect()
    assert len(rows) == docs.count() and all(r["k"] == "own k" for r in rows)
    was = {(r["doc_id"], r["text"]) for r in docs.collect()}
    cut = [r for r in rows if (r["doc_id"], r["text"]) not in was]
    assert {r["doc_id"] for r in cut} == {6, 11, 12}
    assert {r["doc_id"]: r["text"] for r in cut} == {6: "", 11: "other start", 12: ""}
    assert line_dedup.dedup(docs.limit(0)).count() == 0


def test_patience():
    assert line_dedup.patience([1, 2, 3, 9, 4], [7, 2, 3, 8, 4]) == [(1, 1), (2, 2), (4, 4)]
    assert line_dedup.patience([], [1]) == [] and line_dedup.patience([5, 5], [5, 5]) == [(0, 0), (1, 1)]
    assert line_dedup.longest_rising([3, 1, 2, 5, 4]) == [1, 2, 4]
