"""Quality and language classifiers: held-out accuracy, what they never see, defined cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.llm import labelled, language, quality
from kiln.llm.registry import op3_quality_classifier, op4_language_id
from llm_fixtures import none, odd  # noqa: F401

SF = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_quality_on_held_out_rows(spark):
    rows = op3_quality_classifier(spark, SF).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (fold(r["doc_id"], 3) == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [p for p, y in held if y == 1]
    assert sum(good) / len(good) > 0.95                       # clean documents stay
    assert sum(p == y for p, y in held) / len(held) > 0.93


def test_quality_defined_cases(spark, odd, none):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = quality.quality_scores(odd, quality.learn(odd, labels)).collect()
    assert len(rows) == odd.count() and {r["score"] for r in rows} == {1.0}
    rows = quality.quality_scores(odd, quality.learn(odd, labels.limit(0))).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)}
    assert quality.quality_scores(none, quality.learn(none, labels)).collect() == []
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [True]


def test_quality_scores_null_and_empty_texts(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert model.weights
    scores = {r["doc_id"]: r["score"] for r in quality.quality_scores(odd, model).collect()}
    assert scores[2] == scores[3] == pytest.approx(model.prior) and all(0 <= s <= 1 for s in scores.values())


def test_logistic_fit_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] - 2 * x[:, 1] > 0.3).astype(float)
    w = quality.fit_logistic(x, y)
    assert ((quality.sigmoid(w[0] + x @ w[1:]) > 0.5) == (y > 0)).mean() > 0.97


def brute_difference(text, good, bad):
    """(bad - good) / (bad + good) by one compressor a block, written out."""
    import zstandard as z
    sizes = []
    for d in (good, bad):
        total = 0
        for k in range(0, max(1, len(text)), 1024):
            data = z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT)
            total += len(z.ZstdCompressor(level=quality.LEVEL, dict_data=data, write_content_size=False, write_dict_id=False).compress(
                text[k:k + 1024]))
        sizes.append(total)
    return (sizes[1] - sizes[0]) / (sizes[1] + sizes[0])


def test_scores_are_the_curve_over_the_normalised_difference(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert len(model.weights) == 4
    some = docs.orderBy("doc_id").limit(60).unionByName(docs.orderBy(F.desc(F.length("text"))).limit(3))
    for r in quality.quality_scores(some, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        d = brute_difference((r["text"] or "").encode(), model.good, model.bad)
        want = 1 / (1 + np.exp(-(model.weights[0] + sum(w * d**k for k, w in enumerate(model.weights[1:], 1)))))
        assert r["score"] == pytest.approx(want if r["text"] else model.prior, abs=1e-9)


def test_sample_is_by_class_bounded_and_whole(spark):
    rows = [(i, f"c{i % 3}", f"{i} " * (i + 1)) for i in range(60)] + [(5, "c2", "other text of 5"), (None, "c0", "x"),
                                                                       (7, None, "y"), (8, "c2", None)]
    docs = spark.createDataFrame(rows, "doc_id long, label string, text string").unionByName(
        spark.createDataFrame(rows[:10], "doc_id long, label string, text string"))
    chosen = labelled.least_hashed(docs, "label", 4)
    got = labelled.fetch_sample(docs, chosen, ["doc_id", "label"], 10**6)
    assert {r["label"] for r in got} == {"c0", "c1", "c2"} and max(r["rank"] for r in got) <= 4
    assert len({(r["doc_id"], r["label"]) for r in got}) == len(got)
    assert all((r["doc_id"], r["label"], r["text"]) in rows for r in got)
    few = labelled.fetch_sample(docs, chosen, ["doc_id", "label"], 1)
    assert sorted(r["label"] for r in few) == sorted({r["label"] for r in got if r["rank"] == 1})
    assert labelled.fetch_sample(docs.limit(0), labelled.least_hashed(docs.limit(0), "label", 4), ["doc_id", "label"], 9) == []


def ngrams(text):
    b = text.encode().lower()
    return {b[k:k + n] for n in (1, 2, 3) for k in range(len(b) - n + 1)}


def test_kernel_and_ridge_equal_brute_force():
    """The model's outputs against presence kernels of n-gram sets and a dense weighted kernel ridge regression."""
    rng = random.Random(5)
    make = lambda signs, n: ["".join(rng.choice(signs) for _ in range(rng.randint(20, 60))) for _ in range(n)]
    texts, langs = make("abcd ", 9) + make("cdef ", 7) + make("efgh ", 5), ["aa"] * 9 + ["bb"] * 7 + ["cc"] * 5
    model = language.fit(texts, langs, 3)
    marks = [t for k in ("aa", "bb", "cc") for t in [x for x, lang in zip(texts, langs) if lang == k][:3]]
    kernel = lambda a, b: len(ngrams(a) & ngrams(b)) / np.sqrt(len(ngrams(a)) * len(ngrams(b)))
    new = make("abcdefgh ", 12)
    (_, rows), = language.presence(pa.array(new, pa.large_string()))
    want = np.array([[kernel(t, m) for m in marks] for t in new])
    assert np.allclose(model.kernel(rows), want, atol=1e-5)
    own = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(own)
    root = vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()])
    x = np.array([[kernel(t, m) for m in marks] for t in texts]) @ root
    weight = np.array([1 / langs.count(k) for k in langs])
    weight *= len(langs) / weight.sum()
    y = np.array([[1.0 if lang == k else -1.0 for k in ("aa", "bb", "cc")] for lang in langs])
    mx, my = (weight[:, None] * x).sum(0) / weight.sum(), (weight[:, None] * y).sum(0) / weight.sum()
    a = ((x - mx) * weight[:, None]).T @ (x - mx) + language.RIDGE * len(x) / x.shape[1] * np.eye(x.shape[1])
    w = np.linalg.solve(a, ((x - mx) * weight[:, None]).T @ (y - my))
    assert np.allclose(model.outputs(rows), (want @ root - mx) @ w + my, atol=2e-3)


def test_every_label_is_learned(spark):
    """More labels than any fixed cap: each of 260 languages can be predicted."""
    rng = random.Random(3)
    rows = []
    for k in range(260):
        signs = rng.sample("abcdefghijklmnopqrstuvwxyzäöüßéèñ", 4)
        rows += [(k * 10 + j, "".join(rng.choice(signs) for _ in range(80)), f"l{k:03d}") for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert len(model.languages) == 260
    got = [(r["lang_pred"], r["lang"]) for r in language.predict_languages(docs, model).join(docs, "doc_id").collect()]
    assert len({p for p, _ in got}) > 240 and sum(p == t for p, t in got) / len(got) > 0.8


def test_texts_of_no_learned_language_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn(docs)
    assert model.least > 0
    odd_texts = spark.createDataFrame([(10**9 + k, "漢字仮名交じり文 " * 30 if k else "жзиклмно прст уфхц " * 20) for k in range(2)],
                                      "doc_id long, text string")
    scored = language.predict_languages(docs, model)
    clean = scored.where("held_out and lang_pred <> 'und'")
    lost = clean.where(F.col("score") < model.least).count()
    assert lost <= 0.01 * clean.count()
    assert language.keep_languages(odd_texts.withColumn("lang", F.lit(None).cast("string")), model).count() <= 2


def test_language_on_held_out_rows(spark):
    rows = op4_language_id(spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_presence_is_the_set_of_ngrams():
    texts = ["Abba", "", "äb", "x", "xy" * 200]
    (first, rows), = language.presence(pa.array(texts, pa.large_string()))
    assert first == 0
    for t, row in zip(texts, rows):
        b = t.encode().lower()
        cells = set(b) | {256 + b[k] * 256 + b[k + 1] for k in range(len(b) - 1)}
        assert set(np.flatnonzero(row[:256 + 65536]).tolist()) == cells
        assert row[256 + 65536:].sum() <= len({b[k:k + 3] for k in range(len(b) - 2)})


def test_language_small_model_and_ties():
    rng = random.Random(2)
    make = lambda signs: ["".join(rng.choice(signs) for _ in range(40)) for _ in range(12)]
    texts, langs = make("abc ") + make("xyz "), ["aa"] * 12 + ["zz"] * 12
    model = language.fit(texts, langs)
    lang, score = language.predict(model, pa.array(["abcab", "zyxx", "", None], pa.large_string()).fill_null(""),
                                   np.array([True, True, False, False]))
    assert lang.tolist() == ["aa", "zz", "und", "und"] and score[2] == 0
    one = language.fit(texts[:12], langs[:12])
    assert language.predict(one, pa.array(["q"], pa.large_string()), np.array([True]))[0].tolist() == ["aa"]


def test_language_defined_cases(spark, odd, none):
    rows = {r["doc_id"]: r for r in language.predict_languages(odd, language.learn(odd)).collect()}
    for k in (2, 3, 4, 5):
        assert (rows[k]["lang_pred"], rows[k]["score"]) == ("und", 0.0)
    assert rows[1]["lang_pred"] in ("en", "de", "fr")
    assert language.learn(none) is None
    assert {r["lang_pred"] for r in language.predict_languages(odd, None).collect()} == {"und"}
    assert language.predict_languages(none, None).collect() == []
    kept = language.keep_languages(odd, language.learn(odd))
    assert kept.columns == odd.columns
    got = {r["doc_id"]: r["lang"] for r in kept.collect()}
    assert set(got) == {1, 6, 7, 8, 9, None, 10, 11, 12, 13} and got[10] is not None and got[6] == "fr"


def test_without_learned_languages_texts_with_letters_stay(spark, odd):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    model = language.learn(unlabelled)
    assert model is None
    kept = language.keep_languages(unlabelled, model)
    want = [d["text"] for d in odd.collect() if any(map(str.isalpha, d["text"] or ""))]
    assert sorted(r["text"] for r in kept.collect()) == sorted(want) and want
