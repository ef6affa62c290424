"""The least score that a document needs comes from all documents that may be learned from."""

import random

import numpy as np
from pyspark.sql import functions as F

from kiln.llm import labelled, language


def test_least_score_counts_all_learned_documents(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 5)
    monkeypatch.setattr(language, "CLEAN", 0.9)
    rng = random.Random(11)
    own = {"aa": "abcde ", "zz": "vwxyz "}
    rows = [(i, "".join(rng.choice(own[lang] + rng.choice(["", "mn", "mnopq"])) for _ in range(60)), lang)
            for i in range(400) for lang in ("aa" if i % 2 else "zz",)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.learn(docs)
    scored = language.predict_languages(docs, model).join(docs, "doc_id").where("not held_out and lang_pred = lang")
    right = sorted(r["score"] for r in scored.collect())
    assert len(right) > 10 * language.SAMPLE_DOCS
    want = right[int((1 - language.CLEAN) * (len(right) - 1))]
    assert want / 2 - 1 / language.SCORE_STEPS <= model.least <= want / 2
    sample = {r["doc_id"] for r in labelled.least_hashed(docs.where(~labelled.held_out(F.col("doc_id"), 4, 2)), "lang", 5).collect()}
    few = [r["score"] for r in scored.where(F.col("doc_id").isin(sorted(sample))).collect()]
    assert abs(np.quantile(few, 1 - language.CLEAN) / 2 - model.least) > 2 / language.SCORE_STEPS


def test_model_without_a_least_score(spark):
    docs = spark.createDataFrame([(i, "abc" if i % 2 else "xyz", "aa" if i % 2 else "zz") for i in range(20)],
                                 "doc_id long, text string, lang string")
    assert language.learn(docs, with_least=False).least == 0 < language.learn(docs).least
