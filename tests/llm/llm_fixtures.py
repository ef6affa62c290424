"""Fixtures of the operator tests: a table of odd documents, an empty one, and the small generated one."""

import hashlib

import pytest

from conftest import SF_SMALL

#: documents with nulls, empty and odd texts, repeated rows, and columns named like the operators' own
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en"),
    (2, None, None), (3, "", "en"), (4, "   \n\t ", "de"), (5, "!!! ???", None), (6, "été à la plage, naïve café", "fr"),
    (7, "The quick brown fox jumps over the lazy dog near the old river bank today", "en"),
    (8, "one two", "en"), (9, "one two", "en"), (9, "one two", "en"), (None, "no id at all", "en"),
    (10, "字漢 かな 😀 mixed é text\x00with nul", None), (11, "a" * 6000, "en"), (12, "ab " * 3000, "en"),
    (13, "9" * 5000 + " 4111111111111111 x@y.z " + "a." * 2000, None),
]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def odd_documents(spark):
    rows = [(i, t, lang, f"src{k % 3}", len(t) if t else 0, k, "x", "y", "z") for k, (i, t, lang) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "row long, words string, `key` string, rep string")


def no_documents(spark):
    return odd_documents(spark).limit(0)


@pytest.fixture(scope="session")
def odd(spark):
    return odd_documents(spark)


@pytest.fixture(scope="session")
def none(spark):
    return no_documents(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}
