"""FM-index decontamination against brute force and SQL."""

import hashlib
import random
import re

import numpy as np
import pytest

from conftest import SF_SMALL
from kiln.llm import decontaminate, fm_index
from kiln.llm.registry import ORACLE, op9_decontamination
from kiln.testing.compare import compare, duck
from llm_fixtures import documents, none, odd, texts  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        w, found = words(text), set()
        hit = [False] * len(w)
        for item_id, t in items:
            iw = words(t)
            for k in range(max(1, len(iw) - size + 1) if iw else 0):
                win = iw[k:k + size]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        found |= {str(item_id)} - {"None"}
                        hit[p:p + len(win)] = [True] * len(win)
        out.append((doc_id, len(w), sum(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    return sorted(out, key=str)


def planted():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 3)))
    items = [(k, " ".join(word() for _ in range(rng.randint(0, 30)))) for k in range(12)]
    items += [(3, "kurz und gut"), (None, "la la la kurz und gut"), (None, None), (50, None), (51, "?!"), (52, "Ä Ö"), (53, "la la la la la la la la la la la la")]
    docs = []
    for k in range(40):
        t = " ".join(word() for _ in range(rng.randint(0, 40)))
        passage = rng.choice(items)[1] or ""
        docs.append((k, f"{t}. {passage.upper() if k % 2 else passage}, {t}"))
    docs += [(60, "LA " * 40), (61, "kurz, und\ngut"), (62, None), (63, ""), (64, "kurz und"), (64, "gut")]
    return docs, items


def test_query_matches_sql(spark):
    r = compare(op9_decontamination(spark, SF_SMALL), duck(SF_SMALL), ORACLE["op9_decontamination"])
    assert r["match"], r


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_matches_brute_force_with_any_number_of_blocks(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    docs, items = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert (len(decontaminate._blocks(bench)) > 1) == (block_bytes == 300)
    got = sorted((tuple(r) for r in decontaminate.contamination(df, bench).collect()), key=str)
    assert got == brute(docs, items)


def test_odd_documents_and_empty_tables(spark, odd, none):
    items = [(1, "quick brown fox jumps over the lazy dog near the old river"), (None, "one two"), (2, "NAÏVE café")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.contamination(odd, bench).collect()), key=str)
    # the capital I with diaeresis is no ASCII letter, so item 2 does not occur
    assert got == brute([(d["doc_id"], d["text"]) for d in odd.collect()], items)
    assert {r[2] for r in got if r[0] in (8, 9)} == {2}            # an item without an id hits words ...
    assert {r[3] for r in got if r[0] in (8, 9)} == {0}            # ... and is not listed
    assert decontaminate.contamination(none, bench).collect() == []
    clean = decontaminate.contamination(odd, bench.limit(0)).collect()
    assert len(clean) == odd.count() and not any(r["contaminated"] for r in clean)


def test_removal_keeps_columns_and_cuts_spans(spark, odd):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the old river"), (2, "café")],
                                  "item_id long, text string")
    out = decontaminate.remove_contamination(odd, bench)
    assert out.columns == odd.columns
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[1]["text"] == "The  bank today" and by[6]["text"] == "été à la plage, naïve "
    assert by[2]["text"] is None and by[8]["text"] == "one two" and by[1]["words"] == "x"


def test_removal_does_not_depend_on_the_number_of_blocks(spark, monkeypatch):
    w = [f"w{k}" for k in range(1, 31)]
    docs, items = planted()
    docs += [(70, f"start {' '.join(w[:14])} end"), (71, " ".join([*w[:5], *w[20:30], *w[5:15]]))]
    # overlapping items, and one whose cut would join the sides of document 71 into another item's window
    items += [(100 + k, " ".join(w[k:k + 10])) for k in range(5)] + [(120, " ".join(w[20:30]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")

    def kept():
        return sorted((tuple(r) for r in decontaminate.remove_contamination(df, bench).collect()), key=str)

    whole = kept()
    assert {(70, "start  end"), (71, f"{' '.join(w[:5])}  {' '.join(w[5:15])}")} <= set(whole)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    assert len(decontaminate._blocks(bench)) > 1
    assert kept() == whole


def naive_suffixes(seq):
    """Order with each separator a sign of its own, below every code."""
    def key(p):
        out = []
        for q in range(p, len(seq)):
            out.append((0, q) if seq[q] == 0 else (1, seq[q]))
            if seq[q] == 0:
                break
        return out
    return sorted(range(len(seq)), key=key)


def test_index_searches_and_locates():
    rng = random.Random(10)
    for _ in range(60):
        n_codes = rng.randint(1, 5)
        codes = np.array([rng.randint(0, n_codes) for _ in range(rng.randint(1, 60))] + [0])
        seq = [0, *codes.tolist()]
        assert fm_index.suffix_array(np.array(seq)).tolist() == naive_suffixes(seq)
        index = fm_index.FMIndex(codes, n_codes)
        phrases = np.array([[rng.randint(1, n_codes) for _ in range(4)] for _ in range(10)])
        lengths = np.array([rng.randint(1, 4) for _ in range(10)])
        low, high = index.search(phrases, lengths)
        for p, n, a, z in zip(phrases, lengths, low, high):
            want = [k for k in range(len(codes) - n + 1) if codes[k:k + n].tolist() == p[:n].tolist()]
            assert sorted(index.locate(np.arange(a, max(a, z))).tolist()) == want
