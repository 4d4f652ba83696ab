"""Language ID: held-out accuracy, odd rows, SVM against its optimality conditions."""

import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from zonepulse.llm import langid as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    said = L.op6_language_id(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    both = said.merge(docs, on="doc_id")
    assert len(both) == len(docs)
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(said.doc_id, said.held_out))
    test = both[both.held_out]
    assert len(test) > 150 and (test.lang_pred == test.lang).mean() > 0.98
    assert said.score.between(0, 1).all()


def test_counts_are_whole_text():
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcé1 .ÄЖ") for _ in range(5000))
    none = np.zeros(0x110000, bool)
    assert (L.letter_grams(text, none) == L.letter_grams(text, none, piece=37)).all()
    assert L.letter_grams("12 !", none)[L.DIM] == 0


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)).astype(np.float32)
    y = np.where(x[:, 0] - 0.5 * x[:, 1] > 0, 1.0, -1.0)
    w = L.fit_svm(x, y, c=10.0, rounds=50)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_prediction_ignores_labels_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = L.fit(docs)
    odd = spark.createDataFrame(
        [(1, None, "en", "s", 1), (2, "", "en", "s", 1), (3, "12 34!", "fr", "s", 1), (None, "the and of that", None, None, None),
         (5, "the and of that", "zz", "q", 9), (5, "the and of that", "zz", "q", 9), (6, "你好世界", "en", "s", 1)],
        "doc_id bigint, text string, lang string, source string, _tag int")
    got = [(r.doc_id, r._lang, r._score) for r in L.predict(odd, model).collect()]
    by = {g[0]: g[1:] for g in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[5] == by[None] and by[5][0] == "en" and len(got) == 7 and by[6][1] < 0.1
    kept = L.predict(odd, model).where("_lang <> 'und' and _score >= 0.45")
    assert kept.count() == 3
    assert L.fit(odd.where("lang is null")) is None
    assert [r._lang for r in L.predict(odd, None).collect()] == ["und"] * 7
    assert L.keep_identified(docs).columns == docs.columns
    assert L.keep_identified(docs.limit(0)).count() == 0


def test_every_language_has_its_own_sample(spark, monkeypatch):
    docs = spark.range(24_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word number "), F.col("id")).alias("text"),
        F.expr("CASE WHEN id % 400 = 0 THEN 'it' WHEN id % 50 = 1 THEN 'pt' WHEN id % 10 = 2 THEN 'fr' ELSE 'en' END").alias("lang"))
    nulls = spark.range(24_000, 26_000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit("pt").alias("lang"))
    monkeypatch.setattr(L, "LanguageModel", lambda x, langs, alphabet: Counter(langs))
    learned = {r["lang"]: r["count"] for r in docs.where(~L.held_out(F.col("doc_id"))).groupBy("lang").count().collect()}
    assert learned["it"] < 100 < 150 < learned["pt"]
    # three vectors a document: 100 documents of each language, all of one with fewer
    assert L.fit(docs.union(nulls)) == {lang: 3 * min(100, n) for lang, n in learned.items()}


def test_no_language_is_left_out(spark):
    rnd = random.Random(2)
    words = {f"x{k:02d}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(8)] for k in range(70)}
    rows = [(70 * i + k, " ".join(rnd.choices(words[lang], k=12)), lang) for k, lang in enumerate(words) for i in range(8 if k < 60 else 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = L.fit(docs)
    assert [f for f in words if f not in model.families.classes] == []
    said = [model.predict(" ".join(w))[0] for w in words.values()]
    assert sum(a == b for a, b in zip(said, words)) >= 68 and said[60:] == list(words)[60:]
