"""One document of over a megabyte beside small ones: whole results, no crash."""

import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
import tokenizers
from pyspark.sql import functions as F

from kiln.llm import bpe, decontaminate, fingerprint, jaccard, language, pii, quality, repeats, token_file, unigram
from kiln.llm.registry import PATTERN, RANKS

PASSAGE = "the quick brown fox jumps over the lazy dog near the old river bank today"


def long_text():
    rng = random.Random(17)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
    body = " ".join(rng.choice(words) for _ in range(200_000))
    return f"{body}\nmail a.b@c.org, {PASSAGE}. {body[:50_000]}"


@pytest.fixture(scope="module")
def docs(spark):
    text = long_text()
    assert len(text) > 1_000_000
    rows = [(1, text, "en"), (2, text + "#end", "en"), (3, "short text", "en"), (4, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2).cache()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_near_copies_and_repeats(spark, docs):
    got = by_id(jaccard.jaccard_join(spark, docs))
    assert (got[2]["class_id"], got[1]["n_links"], got[3]["n_links"]) == (1, 1, 0)
    cut = by_id(repeats.remove_repeats(spark, docs))
    size = len(long_text().encode())
    assert cut[2]["n_removed"] == size and cut[2]["n_spans"] == 1 and cut[1]["n_removed"] == 0
    assert cut[2]["kept_sha256"] == hashlib.sha256(b"#end").hexdigest()


def test_tokens(spark, docs, tmp_path):
    text = long_text()
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    ids = encoding.encode_ordinary(text)
    got = by_id(bpe.bpe_encode(docs, RANKS, PATTERN))
    assert (got[1]["n_tokens"], got[1]["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert got[1]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    words = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    files = by_id(token_file.token_binary(spark, docs, public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "shards")))
    assert files[1]["n_tokens"] == len(words.encode(text, add_special_tokens=False).ids) + 1
    assert by_id(unigram.token_counts(docs, RANKS, PATTERN))[1]["n_words"] == len(regex.findall(PATTERN, text))


def test_scores_and_spans(spark, docs):
    fine = by_id(fingerprint.edited_fingerprints(docs))
    assert fine[1]["n_chars"] == len(long_text()) and fine[1]["near_next"] > 0.95 and fine[2]["near_next"] < 0.2
    bench = spark.createDataFrame([(7, PASSAGE)], "item_id long, text string")
    assert by_id(decontaminate.contamination(docs, bench))[1]["n_hit"] == 15
    spans = by_id(pii.personal_data(docs, None))
    assert spans[1]["n_email"] == 1 and spans[1]["spans"].startswith("email:")
    model = language.fit([PASSAGE, "der schnelle braune fuchs springt über den faulen hund"], ["en", "de"])
    assert by_id(language.predict_languages(docs, model))[1]["lang_pred"] in ("en", "de")
    labels = spark.createDataFrame([(k, k % 2) for k in range(100, 140)], "doc_id long, quality int")
    more = spark.range(100, 140).select(F.col("id").alias("doc_id"), F.concat(F.when(F.col("id") % 2 == 0, "junk $$$ ").otherwise(
        PASSAGE), F.col("id").cast("string")).alias("text"))
    scored = by_id(quality.quality_scores(docs, quality.learn(more, labels)))
    assert 0 <= scored[1]["score"] <= 1
