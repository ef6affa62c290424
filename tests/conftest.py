import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kiln.session import build_session
    scratch = tempfile.mkdtemp(prefix="kiln-tests-")
    s = build_session("local[4]", shuffle_partitions=4, app_name="kiln-tests",
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_layer(spark):
    from kiln.plans.dag import GoldLayer
    from kiln.sources.testdata import raw_from_testdata
    from kiln.testing.oracle import AS_OF
    return GoldLayer(raw_from_testdata(spark, SF_SMALL), as_of=AS_OF)


def one_col(spark, values, expr_fn, dtype="string"):
    """Apply a Column function to a single-column frame; returns values in input order."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("x"))).collect()]
