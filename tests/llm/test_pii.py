"""Personal data: base spans against Python's patterns, the trees, redaction; no Python on executors."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kiln.llm import pii
from kiln.llm.registry import op6_pii
from llm_fixtures import EMPTY_SHA, none, odd  # noqa: F401

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    out = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return [f"{k}:{a}:{z}" for a, _, k, z in sorted(out)]


def check(rows, texts):
    for r in rows:
        want = base(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (r, want)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(want) <= set(spans) and len(spans) == len(want) + r["n_added"]


@pytest.fixture(scope="module")
def model(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_query_has_the_base_spans(spark):
    rows = op6_pii(spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    check(rows, texts)


def test_base_spans_of_random_signs(spark):
    rng = random.Random(11)
    signs = ["a", "b.c", "@", ".", "-", "+", "1", "42", "255", "256", "4111111111111111", " ", "(", ")", "é", "😀",
             "\n", "a@b.c", "_", "%", "1.2.3.4", "+1 (555) 555-1234", "00", "$1", "\\"]
    texts = {k: "".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for k in range(1500)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pii.personal_data(df, None).collect(), texts)


def test_long_runs_stay_linear_and_shallow(spark):
    n = 40_000
    texts = dict(enumerate(["9" * n, "1 " * n, "a" * n, "a." * n, "a@" * n, "a@b" + ".c" * n, "+1" + " " * n,
                            "1." * n, "+1 (" * n, "é" * n + "a@b.cd", "12-" * n, "[at]" * n, "a-_/+" * n]))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = pii.personal_data(df, None).collect()
    fast = {k: t for k, t in texts.items() if k not in (2, 3, 4, 12)}    # quadratic in Python's re
    check([r for r in rows if r["doc_id"] in fast], fast)
    assert [r["n_email"] for r in sorted(rows, key=lambda r: r["doc_id"])][2:4] == [0, 0]


def test_many_matches_take_seconds(spark, model):
    """Work is linear in the matches of one document: numeric tables do not stop a job."""
    n = 32_000
    texts = {1: "".join(f"{k % 9}.{k % 255}.1.2, " for k in range(n)), 2: " ".join(["a@b.cd"] * n), 3: "+1 555 555 1234\n" * n}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    start = time.time()
    rows = pii.personal_data(df, None).collect()
    assert time.time() - start < 60
    check(rows, texts)
    assert [r[f"n_{k}"] for r, k in zip(sorted(rows, key=lambda r: r["doc_id"]), ("ip", "email", "phone"))] == [n] * 3


def test_spans_around_the_run_length(spark):
    texts = {n: "x 1.2.3.4 é" * n for n in (0, 1, pii.RUN - 1, pii.RUN, pii.RUN + 1, 2 * pii.RUN, 2 * pii.RUN + 1)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pii.personal_data(df, None).collect(), texts)


def test_the_sample_does_not_shrink_with_the_corpus(spark):
    hashes = spark.range(1_000_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    for share in (1.0, 0.02, 1e-4):
        n = hashes.where(pii.in_sample(share)).count()
        assert abs(n - share * 10**6) <= 6 * (share * 10**6) ** 0.5
    border = lambda share: int(re.search(r"-?\d{6,}", str(pii.in_sample(share)))[0])
    assert border(20_000 / 5e10) > -(1 << 63) + 10**12       # some 10**12 of 2**64 hashes: the share asked for


def test_model_adds_what_base_patterns_lose(spark, model):
    assert model.thresholds
    key = "token = \"" + "0a1b2c3d" * 5 + "\""
    texts = {1: "call +1 (269) 555-3296 4524132264652876 now", 2: key, 3: "plain prose, 12 apples in 1999, v2.0.1",
             4: "mail a.b@c.org and 10.0.0.1"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.personal_data(df, model).collect()}
    check(rows.values(), texts)
    assert rows[1]["spans"] == "phone:5:22,card:23:39" and rows[1]["n_added"] == 2
    assert rows[2]["spans"] == "secret:9:49"
    assert rows[3]["spans"] == "" and rows[4]["n_added"] == 0


def test_tree_columns_score_like_the_fitted_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    rng = random.Random(12)
    rows = []
    for _ in range(400):
        x = [float(rng.randint(0, 6)) for _ in pii.FEATURES]
        rows.append((*x, float(x[1] + x[3] > x[2] + 3)))
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in pii.FEATURES) + ", label double")
    v = VectorAssembler(inputCols=pii.FEATURES, outputCol="x").transform(df)
    fitted = GBTClassifier(featuresCol="x", maxIter=4, maxDepth=3, seed=1).fit(v)
    trees = tuple(pii._parse(t.toDebugString.strip().splitlines()[1:]) for t in fitted.trees)
    own = pii.Model(trees, tuple(fitted.treeWeights), {}).score(F.struct(*pii.FEATURES))
    for r in fitted.transform(v).select("probability", own.alias("own")).collect():
        assert r["own"] == pytest.approx(r["probability"][1], abs=1e-9)


def test_main_path_has_no_python(spark, model):
    df = pii.personal_data(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), model)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan


def test_odd_documents(spark, odd, none, model):
    rows = pii.personal_data(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert (by[2]["spans"], by[2]["base_sha256"]) == ("", EMPTY_SHA)
    assert (by[13]["n_card"], by[13]["n_email"]) == (0, 1)           # the long digits swallow the card
    assert pii.personal_data(none, model).collect() == [] and pii.learn(none) is None


def test_redaction_keeps_columns(spark, odd, none, model):
    out = pii.redact(odd, model)
    assert out.columns == odd.columns
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[2]["text"] is None and by[1]["text"] == "The quick brown fox jumps over the lazy dog near the old river bank today"
    assert "<EMAIL>" in by[13]["text"] and "x@y.z" not in by[13]["text"] and by[13]["words"] == "x"
    one = spark.createDataFrame([("x@y.zz, 1.2.3.4 é", 1)], "text string, base int")
    assert pii.redact(one, None).collect()[0]["text"] == "<EMAIL>, <IP> é"
    assert pii.redact(none, model).collect() == []
