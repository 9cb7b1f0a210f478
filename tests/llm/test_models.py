"""The two classifiers: held-out accuracy, and odd rows."""

import random

from pyspark.sql import functions as F

from tests.llm.helpers import documents
from traceframe.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = queries.op3_quality(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)


def labelled(n):
    rng = random.Random(2)
    good = lambda: " ".join("".join(rng.choices("aeinrst", k=5)) for _ in range(60))
    bad = lambda: " ".join(["spam!!"] * 20 + ["".join(rng.choices("XYZ#$", k=5)) for _ in range(20)])
    return [(i, good() if i % 2 else bad()) for i in range(n)]


def test_quality_of_odd_rows(spark):
    rows = labelled(80)
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(1, 1), (2, None), (None, 1), (3, 7)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    mine = quality.score(docs, model).collect()
    assert all((r["score"] > 0.5) == (r["doc_id"] % 2 == 1) for r in mine)
    odd = quality.score(documents(spark), model).collect()
    assert len(odd) == documents(spark).count() and all(0 <= r["score"] <= 1 for r in odd)
    empty = {r["score"] for r in odd if not (r["text"] or "").strip()}
    assert len(empty) == 1
    assert quality.score(docs.limit(0), model).count() == 0
    none = quality.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}


def test_quality_features_cover_whole_texts(monkeypatch):
    text = " ".join(f"word{i % 97}" for i in range(3000))
    whole = quality.features(text)
    monkeypatch.setattr(quality, "RUN", 500)
    assert sorted(quality.features(text)) == sorted(whole)
    assert (quality.features("ha ha ha") == quality.REPEAT).sum() == 2


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op8_language(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 250
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)


def test_language_of_odd_rows(spark):
    rng = random.Random(4)
    make = lambda letters: " ".join("".join(rng.choices(letters, k=6)) for _ in range(40))
    rows = [("ab", make("abcd")), ("xy", make("wxyz"))] * 10 + [(None, make("mn")), ("zz", None), ("zz", "123")]
    learned = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert list(learned) == ["ab", "xy"]
    got = {r["text"]: r for r in langid.predict(documents(spark, [(1, make("abcd")), (2, make("wxyz"))]), learned).collect()}
    assert [r["lang_pred"] for r in sorted(got.values(), key=lambda r: r["doc_id"])] == ["ab", "xy"]
    odd = langid.predict(documents(spark), learned).collect()
    assert len(odd) == documents(spark).count()
    for r in odd:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] != "und" or r["score"] == 0)
    assert {r["lang_pred"] for r in langid.predict(documents(spark), {}).collect()} == {"und"}
    assert langid.fit(spark.createDataFrame([], "lang string, text string")) == {}


def test_a_language_of_one_repeated_text_is_learned(spark):
    for text in ("ein haus am see", "une maison", "la casa", "a tree by the lake"):
        rows = [("aa", text)] * 600 + [("bb", f"{i} bla bleh {i % 7} blum") for i in range(30)]
        df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
        sample = langid._sample(df, 200).groupBy("lang").agg(F.sum("weight").alias("n"), F.count("*").alias("texts"))
        assert {r["lang"]: (r["n"], r["texts"]) for r in sample.collect()} == {"aa": (200, 1), "bb": (30, 30)}
        assert list(langid.fit(df, rows_per_lang=200)) == ["aa", "bb"]


def test_sample_is_that_of_the_smallest_hashes(spark):
    rng = random.Random(8)
    rows = [(rng.choice("xyz"), f"text {int(rng.paretovariate(0.5)) % 400}") for _ in range(3000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    hashed = df.distinct().withColumn("h", F.pmod(F.xxhash64("text", F.lit(langid.SEED)), F.lit(1 << 62))).collect()
    for limit in (1, 50, 700, 10_000):
        want = {}
        for lang in "xyz":
            left = limit
            for h, text in sorted((r["h"], r["text"]) for r in hashed if r["lang"] == lang):
                n = min(left, rows.count((lang, text)))
                left -= n
                if n:
                    want[lang, text] = n
        got = {(r["lang"], r["text"]): r["weight"] for r in langid._sample(df.repartition(3), limit).collect()}
        assert got == want


def test_prototypes_against_plain_python(spark):
    """Letter by letter with Python lists: vectors, binding, bundling, cosine."""
    texts = [("ab", "Abba, bab ab"), ("ab", "baab-ab"), ("xy", "xyy yx!"), ("xy", "xxy  yyx")]

    def bundle(text):
        symbols = [0]
        for c in text.lower():
            code = ord(c) if c.isalpha() else 0
            if code or symbols[-1]:
                symbols.append(code)
        if symbols[-1]:
            symbols.append(0)
        total = [0.0] * langid.DIM
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            va, vb, vc = (langid.letter_vector(x).tolist() for x in (a, b, c))
            for i in range(langid.DIM):
                total[i] += va[i - 2] * vb[i - 1] * vc[i]
        return total

    def unit(v):
        size = sum(x * x for x in v) ** 0.5
        return [x / size for x in v]

    want = {}
    for lang in ("ab", "xy"):
        parts = [unit(bundle(t)) for name, t in texts if name == lang]
        want[lang] = unit([sum(p) for p in zip(*parts)])
    learned = langid.fit(spark.createDataFrame(texts, "lang string, text string"))
    for lang, v in want.items():
        assert max(abs(a - b) for a, b in zip(v, learned[lang])) < 1e-5
    row = langid.predict(documents(spark, [(1, "Abab xa")]), learned).first()
    cosines = {lang: sum(a * b for a, b in zip(unit(bundle("Abab xa")), v)) for lang, v in want.items()}
    best = max(cosines, key=cosines.get)
    assert row["lang_pred"] == best and abs(row["score"] - max(0, cosines[best])) < 1e-4


def test_language_vectors_do_not_depend_on_runs(monkeypatch):
    text = "Some words, and: more wörds. " * 40
    whole = langid.Space().bundle(text)
    monkeypatch.setattr(langid, "RUN", 64)
    assert abs(langid.Space().bundle(text) - whole).max() < 1e-2
    monkeypatch.setattr(langid, "MAX_TRIGRAMS", 5)
    assert abs(langid.Space().bundle(text) - whole).max() < 1e-2


def test_folds(spark):
    folds = queries.op3_quality(spark, SF).groupBy("held_out").agg(F.count("*").alias("n")).collect()
    assert {r["held_out"] for r in folds} == {True, False}
