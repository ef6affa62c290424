"""N-gram Jaccard join against brute force, and its parts."""

import hashlib
import random
import re
from math import comb

import numpy as np
import pytest

from conftest import SF_SMALL
from kiln.llm import jaccard
from kiln.llm.common import Workspace
from kiln.llm.components import components
from kiln.llm.registry import ORACLE, op1_ngram_jaccard_join
from kiln.testing.compare import compare, duck
from llm_fixtures import documents, none, odd, texts  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(docs):
    """(doc_id, class_id, copy_of, n_links) of rows with distinct ids."""
    sets = [(i, shingles(t), t or "") for i, t in docs]
    linked = {i: set() for i, _ in docs}
    copies = {i: i for i, _ in docs}
    for i, a, s in sets:
        for j, b, t in sets:
            if i != j and ((a == b and (a or s == t)) or 5 * len(a & b) >= 4 * len(a | b) > 0):
                linked[i].add(j)
            if (a == b and (a or s == t)):
                copies[i] = min(copies[i], j)
    label = {i: i for i, _ in docs}
    changed = True
    while changed:
        changed = False
        for i in linked:
            m = min([label[i], *(label[j] for j in linked[i])])
            changed, label[i] = changed or m != label[i], m
    return sorted((i, label[i], copies[i], len(linked[i])) for i, _ in docs)


def planted():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("etaoin") for _ in range(rng.randint(2, 6)))
    base = [word() for _ in range(120)]
    docs = []
    for k in range(70):                        # one large group of near copies, some beyond the threshold
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        docs.append(" ".join(w))
    docs += [docs[0]] * 15 + [docs[1].upper().replace(" ", ", ")] * 3          # copies, also in other clothes
    docs += [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(60)]
    docs += ["one two three", "One  two three!", "one two", "", None, "", "?!", "?!", "!?"]
    return list(enumerate(docs))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bucket_chunk,component_chunk", [(512, 256), (7, 5)])
def test_matches_brute_force(spark, monkeypatch, bucket_chunk, component_chunk):
    monkeypatch.setattr(jaccard, "BUCKET_CHUNK", bucket_chunk)
    monkeypatch.setattr(jaccard, "COMPONENT_CHUNK", component_chunk)
    docs = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows_of(jaccard.jaccard_join(spark, df)) == brute(docs)


def test_odd_documents(spark, odd, none):
    rows = jaccard.jaccard_join(spark, odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert (by[7]["class_id"], by[7]["copy_of"], by[7]["n_links"]) == (1, 1, 1)
    assert by[2]["class_id"] == by[3]["class_id"] == 2              # null and empty texts are copies
    assert by[4]["n_links"] == by[5]["n_links"] == 0                # different texts without words
    assert by[9]["class_id"] == 8 and by[8]["n_links"] == 2
    assert by[None]["class_id"] is None
    assert jaccard.jaccard_join(spark, none).collect() == []


def test_one_of_each(spark, odd, none):
    kept = jaccard.one_of_each(spark, odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 4, 5, 6, 8, 10, 11, 12, 13]
    assert jaccard.one_of_each(spark, none).collect() == []


def test_rows_that_share_a_doc_id_are_documents_of_their_own(spark):
    """No unrelated text is lost, and each text under the id has its own links."""
    word = lambda k: " ".join(f"{k}w{j}" for j in range(40))
    near = word("a").replace("aw39", "other")
    rows = [(1, word("a")), (1, word("b")), (2, near), (3, word("b")), (3, word("c")), (4, word("c")), (4, word("c")), (5, word("d"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    links = {(r["doc_id"], r["tid"]): r["n_links"] for r in jaccard.grouped(spark, df).collect()}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert links == {(1, md5(word("a"))): 1, (1, md5(word("b"))): 1, (2, md5(near)): 1, (3, md5(word("b"))): 1,
                     (3, md5(word("c"))): 2, (4, md5(word("c"))): 2, (5, md5(word("d"))): 0}
    kept = sorted(tuple(r) for r in jaccard.one_of_each(spark, df).collect())
    assert kept == [(1, word("a")), (1, word("b")), (3, word("c")), (5, word("d"))]


def test_query_matches_sql(spark):
    r = compare(op1_ngram_jaccard_join(spark, SF_SMALL), duck(SF_SMALL), ORACLE["op1_ngram_jaccard_join"])
    assert r["match"], r


def test_least_matches_is_the_posterior_bound():
    least = jaccard.least_matches(0.8, 1e-6)
    for n in (10, 50, 150):
        tail = lambda m: sum(comb(n + 1, k) * .8**k * .2**(n + 1 - k) for k in range(m + 1))  # noqa: B023, E731
        assert tail(int(least[n])) >= 1e-6
        assert least[n] == 0 or tail(int(least[n]) - 1) < 1e-6


def test_pruning_keeps_pairs_at_the_threshold_and_drops_others():
    rng = np.random.default_rng(7)
    kept = {}
    for s in (0.3, 0.8):
        n, shared = 400, int(round(400 * 2 * s / (1 + s)))
        doc, value = [], []
        for k in range(0, 200, 2):
            a = rng.integers(0, 1 << 48, n, dtype=np.uint64)
            b = np.concatenate([a[:shared], rng.integers(0, 1 << 48, n - shared, dtype=np.uint64)])
            doc += [np.full(n, k), np.full(n, k + 1)]
            value += [np.sort(a), np.sort(b)]
        sig = jaccard.signatures(np.concatenate(doc), np.concatenate(value), 200)
        a = np.arange(0, 200, 2)
        kept[s] = len(jaccard.surviving(sig, a, a + 1, jaccard.least_matches())[0])
        close = (sig[a] == sig[a + 1]).mean()
        assert abs(close - s) < 0.02                                 # MinHash estimates the similarity
    assert kept == {0.3: 0, 0.8: 100}


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + k, 401 + k) for k in range(60)]
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components(Workspace(spark, "test"), spark.createDataFrame(edges, "a long, b long"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(label.items())
    empty = components(Workspace(spark, "test"), spark.createDataFrame([], "a long, b long"))
    assert empty.collect() == []
