"""Dense numbers: order, ties, hot keys, nulls, empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from kiln.operators.numbering import number_rows
from kiln.plans.dag import shared_folder


@pytest.fixture
def stage(spark):
    import uuid
    base = f"{shared_folder(spark)}/numbering-{uuid.uuid4().hex[:8]}"

    def write(df, name):
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")
    return write


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbers_follow_the_order(spark, stage, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.randint(0, 200), k) for k in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, t int").repartition(5)
    got = number_rows(df, ["k", F.desc("v")], stage, ties=["t"], first=1, parts=parts).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got) == list(range(1, 2001))


def test_empty_table(spark, stage):
    assert number_rows(spark.createDataFrame([], "k string"), ["k"], stage).collect() == []
