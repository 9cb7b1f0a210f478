import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from tests.llm.helpers import documents, shingles
from tests.llm.test_decontaminate import brute
from tests.llm.test_pairs import brute_cuts
from traceframe.llm import bpe, line_dedup, quality
from traceframe.llm.common import crc_mod

SF = "/root/testdata/sf0.001"


def test_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(crc_mod("doc_id", 5) != 0)
    model = quality.fit(docs.select("doc_id", "text"), labels)
    margin, offset = model.margin, model.offset
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [(d, t) for d, t in rows if quality.probability(t, margin, offset) >= P.QUALITY]
    cut = brute_cuts(rows, line_dedup.MIN_WORDS)
    rows = [(d, new) for (d, t), new in zip(rows, cut, strict=True) if new == t or new.strip()]
    sets = [shingles(t) for _, t in rows]
    link = {i: [j for j in range(len(rows)) if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])] for i in range(len(rows))}
    seen, kept = set(), []
    for i in range(len(rows)):
        if i not in seen:
            kept.append(rows[i])
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += link[x]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [(d, t) for d, t in kept if not brute(t, items)[1]]
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Vocabulary(bpe.default_path()).rank, special_tokens={}
    )
    expected = [(d, library.encode_ordinary(t)) for d, t in kept]
    got = sorted((r["doc_id"], r["token_ids"]) for r in P.run(spark, SF).collect())
    assert len(got) < docs.count()
    digest = lambda x: hashlib.sha256(repr(x).encode()).hexdigest()
    assert [d for d, _ in got] == [d for d, _ in expected] and digest(got) == digest(expected)


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = documents(spark)
    assert [name for name, _ in P.STAGES][2] == "near_duplicates"
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert all(r["score"] == "own score" and r["n_words"] == "own n_words" for r in rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert all(r["lossless"] for r in P.STAGES[-1][1](spark, docs, SF).collect())


def test_one_of_each_group_stays(spark):
    rows = [(r["doc_id"], r["text"]) for r in P.distinct(spark, documents(spark), SF).collect()]
    ids = [d for d, _ in rows]
    assert 6 not in ids and 7 not in ids and 4 not in ids and ids.count(5) == 1 and ids.count(None) == 2
    assert {0, 1, 2, 3, 8, 9} <= set(ids)


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    text = [" ".join(f"{x}{i}" for i in range(30)) for x in "abcdef"]
    rows = [(1, text[0]), (1, text[1]), (1, text[1]), (1, ""), (1, None), (2, text[1]), (2, text[2]), (2, ""), (2, ""),
            (3, text[3]), (3, text[3] + " more"), (4, text[4]), (4, text[4]), (5, text[4]), (None, text[0]), (None, None)]
    got = sorted(((r["doc_id"], r["text"]) for r in P.distinct(spark, documents(spark, rows), SF).collect()), key=repr)
    near = [r for r in got if r[0] == 3]
    assert len(near) == 1 and near[0] in rows
    assert [r for r in got if r[0] != 3] == sorted(
        [(1, text[0]), (1, text[1]), (1, ""), (1, None), (2, text[2]), (2, ""), (2, ""), (4, text[4]), (None, text[0]), (None, None)],
        key=repr,
    )
    texts = [(r["doc_id"], r["text"]) for r in P.distinct(spark, documents(spark), SF).collect()]
    assert (3, "one two") in texts and (3, "one two but other") in texts
