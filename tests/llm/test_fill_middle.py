"""Fill-in-middle: cuts against a plain loop, forms, restored texts, odd documents."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kiln.llm import fill_middle
from kiln.llm.registry import op12_fill_in_middle
from llm_fixtures import EMPTY_SHA, documents, none, odd, texts  # noqa: F401


def brute(doc_id, text):
    """The transformation by a loop over lines."""
    lines, rest = [], text
    while rest:
        k = rest.find("\n") + 1 or len(rest)
        lines.append(rest[:k])
        rest = rest[k:]
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:z]), "".join(lines[z:])
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_cuts_like_a_loop_over_lines():
    rng = random.Random(5)
    cutter = fill_middle.Cutter()
    for i in range(3000):
        text = "".join(rng.choice(["a", "é", "\n", "\r\n", "😀 b", "<", "<P", ">", "\x85", "\u2028"])
                       for _ in range(rng.randint(0, 30)))
        assert cutter.cut(i, text) == brute(i, text)


def test_query_equals_brute_force(spark, texts):
    for r in op12_fill_in_middle(spark, SF_SMALL).collect():
        text = texts[r["doc_id"]] or ""
        n, form, p, m, out = brute(r["doc_id"], text)
        assert tuple(r) == (r["doc_id"], n, form, p, m, sha(out), sha(text))


def test_odd_documents(odd, none):
    got = sorted(map(tuple, fill_middle.fill_in_middle_digests(odd).collect()), key=str)
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    want = [(i, *(b := brute(i, t))[:4], sha(b[4]), sha(t)) for i, t in rows]
    assert got == sorted(want, key=str)
    assert [r[5] for r in got if r[0] in (2, 3)] == [EMPTY_SHA, EMPTY_SHA]
    assert fill_middle.fill_in_middle_digests(none).collect() == []


def test_marks_stay_plain_and_borders_of_marks_do_not_confuse(spark):
    rows = [(1, "a\n<M>b\n"), (2, "x <\nP>\n<"), (3, "<\n<\n<\n<"), (4, "S>a\nM>\n<P")]
    docs = spark.createDataFrame(rows * 40, "doc_id long, text string").withColumn(
        "doc_id", F.monotonically_increasing_id())
    texts_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = fill_middle.fill_in_middle(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    forms = set()
    for r in out.collect():
        assert r["back"] == texts_of[r["doc_id"]]
        assert (r["form"] == "plain") == ("<M>" in r["back"])
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}


def test_very_long_texts(spark):
    long = ["x" * 3_000_000, "line of text\n" * 200_000, "\n" * 500_000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    for r in fill_middle.fill_in_middle_digests(docs).collect():
        want = brute(r["doc_id"], long[r["doc_id"]]) if r["doc_id"] == 0 else None
        assert r["restored_sha256"] == sha(long[r["doc_id"]]) and r["n"] == (1, 200_000, 500_000)[r["doc_id"]]
        assert want is None or r["output_sha256"] == sha(want[4])


@pytest.mark.parametrize("percent, spm", [(0, 50), (100, 0), (100, 100)])
def test_rates(documents, percent, spm):
    forms = {r[0] for r in fill_middle.fill_in_middle(documents, percent=percent, spm_percent=spm)
             .where("n > 0").select("form").distinct().collect()}
    assert forms <= {"plain", "spm" if spm else "psm"} and (percent or forms == {"plain"})


def test_units_that_do_not_cover_a_text():
    cutter = fill_middle.Cutter(unit=r"[a-z]+ ?")
    assert cutter.cut(1, "ab cd")[0] == 2
    assert cutter.cut(1, "ab 1 cd") == (0, "plain", None, None, "ab 1 cd")
