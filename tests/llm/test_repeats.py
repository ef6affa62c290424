"""Suffix-array dedup and its interval scan against brute force."""

import hashlib
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from llm_fixtures import documents, none, odd, texts  # noqa: F401
from kiln.llm import lcp_intervals, repeats
from kiln.llm.registry import ORACLE, op2_suffix_array_dedup
from kiln.testing.compare import compare, duck


def brute_repeats(segments, least):
    """Maximal groups of equal strings of at least ``least`` bytes over all suffixes."""
    groups = {}
    for s, t in enumerate(segments):
        for o in range(len(t)):
            for e in range(o + least, len(t) + 1):
                groups.setdefault(t[o:e], []).append((s, o))
    out = set()
    for t, places in groups.items():
        if len(places) < 2:
            continue
        before = {segments[s][o - 1:o] if o else (s, o) for s, o in places}
        after = {segments[s][o + len(t):o + len(t) + 1] or (s, o) for s, o in places}
        if len(after) > 1 and (len(before) > 1 or any(isinstance(b, tuple) for b in before)):
            out.add((len(t), tuple(sorted(places))))
    return out


def test_maximal_repeats_are_complete():
    rng = random.Random(4)
    for _ in range(150):
        segments = ["".join(rng.choice("ab\0") for _ in range(rng.randint(1, 14))).encode()
                    for _ in range(rng.randint(1, 5))]
        segments = list(dict.fromkeys(segments))
        least = rng.randint(1, 4)
        text = np.frombuffer(b"".join(segments), np.uint8)
        length = np.array([len(s) for s in segments])
        start = np.cumsum(length) - length
        got = {(d, tuple(sorted(zip(s.tolist(), o.tolist()))))
               for d, s, o in lcp_intervals.maximal_repeats(text, start, length, least)}
        assert got == brute_repeats(segments, least), (segments, least)


def brute_removed(docs, size=repeats.MATCH):
    first = {}
    low = float("-inf")
    for i, t in docs:
        for p in range(len(t) - size + 1):
            w = t[p:p + size]
            first[w] = min(first.get(w, float("inf")), low if i is None else i)
    out = []
    for i, t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - size + 1):
            if first[t[p:p + size]] < (low if i is None else i):
                gone[p:p + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_removal_on_planted_repeats(spark):
    rng = random.Random(5)
    prose = lambda n: "".join(rng.choice("abcdefgh éß\n") for _ in range(n))
    passage, line = prose(140), prose(49)
    docs = [(k, prose(rng.randint(0, 200)) + rng.choice([passage, passage[30:], line, ""]) + prose(rng.randint(0, 90)))
            for k in range(60)]
    docs += [(100 + k, docs[3][1]) for k in range(20)]                        # exact copies
    docs += [(200 + k, docs[5][1][:60] + "X" + docs[5][1][60:]) for k in range(3)]
    docs += [(300, "ab" * 700), (301, "ab" * 300 + "c" + "ab" * 200), (302, "a" * 500), (303, "a" * 49)]
    docs += [(7, docs[9][1]), (7, docs[9][1]), (None, passage)]               # shared ids, no id
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows_of(repeats.remove_repeats(spark, df)) == brute_removed([(i, t.encode()) for i, t in docs])


def line_in_changing_text(rng):
    """A line below MATCH bytes in many documents, in other text each time, and a passage in most of them."""
    prose = lambda n: "".join(rng.choice("abcdefgh éß\n") for _ in range(n))
    line, passage = prose(40), prose(120)
    return [(k, prose(60) + line + prose(60) + (passage if k % 3 else "") + prose(20)) for k in range(150)]


@pytest.mark.parametrize("hot_runs", [3, 40])
def test_removal_under_hot_names(spark, monkeypatch, hot_runs):
    monkeypatch.setattr(repeats, "HOT_RUNS", hot_runs)
    docs = line_in_changing_text(random.Random(6))
    docs += [(200 + k, docs[k][1][:80 + k]) for k in range(20)] + [(300, "a" * 500), (301, "a" * 700), (None, docs[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows_of(repeats.remove_repeats(spark, df)) == brute_removed([(i, t.encode()) for i, t in docs])


def test_a_group_sends_a_common_segment_once(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_RUNS", 20, raising=False)
    docs, most, real = line_in_changing_text(random.Random(6)), [], repeats.removal_spans
    docs += [(500 + k, docs[4][1]) for k in range(200)]

    def counted(segments):
        names = [x for r in segments.collect() for x in np.frombuffer(r["names"], np.uint64).tolist()]
        most.append(max(names.count(x) for x in set(names)))
        return real(segments)

    monkeypatch.setattr(repeats, "removal_spans", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows_of(repeats.remove_repeats(spark, df)) == brute_removed([(i, t.encode()) for i, t in docs])
    # four groups: a name has a segment of each, or a few more below HOT_RUNS; not one for each of 350 documents
    assert most[0] <= 20


def test_removal_on_odd_documents(spark, odd, none):
    rows = rows_of(repeats.remove_repeats(spark, odd))
    assert rows == brute_removed([(d["doc_id"], (d["text"] or "").encode()) for d in odd.collect()])
    assert repeats.remove_repeats(spark, none).collect() == []


def test_removal_returns_the_kept_bytes(spark, odd):
    for r in repeats.remove_repeats(spark, odd, keep_text=True).collect():
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"]


def test_query_matches_sql(spark):
    r = compare(op2_suffix_array_dedup(spark, SF_SMALL), duck(SF_SMALL), ORACLE["op2_suffix_array_dedup"])
    assert r["match"], r


@pytest.mark.parametrize("size", [1, 2, 20, 33])
def test_gram_hashes_follow_the_bytes(size):
    data = np.frombuffer(b"abcabcabcabcabcabcabcabcabcabcabcabcabcabcabcX", np.uint8)
    h = repeats.gram_hashes(data, size)
    assert len(h) == len(data) - size + 1
    strings = [data[k:k + size].tobytes() for k in range(len(h))]
    assert len(set(h.tolist())) == len(set(strings))
    assert all((h[i] == h[0]) == (strings[i] == strings[0]) for i in range(len(h)))
