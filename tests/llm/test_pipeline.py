"""The pipeline's stages one after the other, and the registry."""

import hashlib
import re

import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from kiln.llm import bpe, jaccard, registry
from kiln.llm.common import Workspace
from llm_fixtures import documents, none, odd, texts  # noqa: F401
from test_decontaminate import words
from test_jaccard import brute


def test_registry():
    names = entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "n-gram Jaccard join",
                                                      "benchmark decontamination", "PII", "byte-level BPE"]


def test_stages_take_effect(spark, documents, texts):
    work, docs = Workspace(spark, "test"), documents
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, work.stage(stage(spark, docs, SF_SMALL), "x")
        seen[name] = docs
        if name != "byte-level BPE":
            assert docs.columns == documents.columns
    rows = {n: {r["doc_id"]: r for r in d.collect()} for n, d in seen.items()}
    known = {i for i, t in texts.items() if any(map(str.isalpha, t or ""))}
    assert set(rows["language ID"]) == known
    groups = brute([(i, texts[i]) for i in sorted(known)])
    assert set(rows["n-gram Jaccard join"]) == {i for i, label, _, _ in groups if i == label}
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[k:k + 10]) for w in items for k in range(max(1, len(w) - 9))}
    for i, r in rows["benchmark decontamination"].items():
        w = words(texts[i])
        dirty = any(tuple(w[k:k + 10]) in windows for k in range(len(w)))
        assert (r["text"] != texts[i]) == dirty and r["n_chars"] == len(r["text"])
    for i, r in rows["PII"].items():
        assert "@mail" not in r["text"] and r["n_chars"] == len(r["text"])
    encoding = tiktoken.Encoding("own", pat_str=registry.PATTERN, mergeable_ranks=bpe.read_ranks(registry.RANKS),
                                 special_tokens={})
    for i, r in rows["byte-level BPE"].items():
        ids = encoding.encode_ordinary(rows["PII"][i]["text"])
        assert (r["n_tokens"], r["ids_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_stages_on_odd_and_no_documents(spark, odd, none):
    for docs in (odd, none):
        work = Workspace(spark, "test")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = work.stage(stage(spark, docs, SF_SMALL), "x")
            assert docs.columns == columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()


def test_one_of_each_is_what_the_pipeline_keeps(spark, documents):
    kept = jaccard.one_of_each(spark, documents)
    groups = jaccard.jaccard_join(spark, documents).where("doc_id = class_id")
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in groups.collect()}
