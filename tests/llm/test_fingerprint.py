"""Consistent weighted sampling: collision rates, edited texts, neighbours over shards."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from kiln.llm import fingerprint
from kiln.llm.registry import op8_fingerprints
from llm_fixtures import documents, none, odd, texts  # noqa: F401


def generalised_jaccard(a, b):
    count = lambda t: {w: t.split().count(w) for w in set(t.split())}
    x, y = count(a), count(b)
    keys = set(x) | set(y)
    return sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(3)
    errors = []
    for trial in range(120):
        words = [f"w{trial}x{k}" for k in range(30)]      # other words, so other draws, in each trial
        a = " ".join(rng.choice(words[:22]) for _ in range(80))
        b = " ".join(rng.choice(words[rng.randint(0, 8):]) for _ in range(60)) + " " + a[:rng.randint(0, len(a))]
        s = fingerprint.signatures(pa.array([a, b], pa.large_string()))
        errors.append(fingerprint.likeness(s[:1], s[1:])[0] - generalised_jaccard(a, b))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.06   # unbiased; one has sd sqrt(J (1 - J) / 128)


def test_equal_and_wordless_texts():
    s = fingerprint.signatures(pa.array(["a b", "A, b!", "", "", "!!", "??", "a b"], pa.large_string()))
    like = lambda i, j: fingerprint.likeness(s[i:i + 1], s[j:j + 1])[0]
    assert like(0, 6) == like(0, 1) == like(2, 3) == 1 and like(4, 5) < 0.1 and like(2, 4) < 0.1


def expected(docs):
    """(doc_id, n_chars, edited_sha256) for documents in (doc_id, text) order."""
    out = []
    for k, (i, t) in enumerate(docs):
        q = len(t) // 4
        e = t[:len(t) - q] + docs[(k + 1) % len(docs)][1][:q]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shards", [1, 4, 9])
def test_edited_texts_across_shards(spark, texts, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        rows = op8_fingerprints(spark, SF_SMALL).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r)[:3] for r in rows), key=str) == expected(sorted(texts.items()))
    by_text = {}
    for r in rows:
        assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert np.mean([r["near_edited"] for r in rows]) > 0.5 > 0.25 > np.mean([r["near_next"] for r in rows])


def test_odd_documents(spark, odd, none):
    rows = fingerprint.edited_fingerprints(odd).collect()
    docs = sorted(((d["doc_id"] if d["doc_id"] is not None else -1, d["text"] or "") for d in odd.collect()))
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["n_chars"], r["edited_sha256"]) for r in rows),
                  key=str) == expected(docs)
    assert fingerprint.edited_fingerprints(none).collect() == []
    single = spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")
    (row,) = fingerprint.edited_fingerprints(single).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and row["near_next"] == 1
    own = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(odd).collect()}
    assert all(own[r["doc_id"]] == r["fingerprint"] for r in rows)
