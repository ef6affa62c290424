"""Raw readers keep text as text; catalog sinks round-trip."""

import os
import tempfile

from kiln.sources import raw as rawmod
from kiln.sources.sinks import catalog_listing, write_tables


def test_csv_raw_is_read_as_text(spark):
    d = tempfile.mkdtemp(prefix="kiln-csv-")
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("customer_id,customer_name,tier,extra\n007,  Zed ,tier-1,ignored\n,,,\n")
    for name in rawmod.RAW_TABLES:
        os.makedirs(os.path.join(d, name), exist_ok=True)
    os.replace(os.path.join(d, "x.csv"), os.path.join(d, "customers_raw", "part-0.csv"))
    got = rawmod.read_raw(spark, d, fmt="csv", options={"header": "true"})["customers_raw"]
    assert got.columns == rawmod.RAW_COLUMNS["customers_raw"]
    assert set(t for _, t in got.dtypes) == {"string"}
    first = got.collect()[0]
    assert first.customer_id == "007" and first.country is None


def test_write_tables_and_listing(spark, small_layer):
    spark.conf.set("spark.sql.legacy.allowNonEmptyLocationInCTAS", "true")
    names = write_tables({"dim_carrier": small_layer["dim_carrier"], "dim_warehouse": small_layer["dim_warehouse"]},
                         "kiln_test_gold")
    assert names == ["kiln_test_gold.dim_carrier", "kiln_test_gold.dim_warehouse"]
    assert [r.tableName for r in catalog_listing(spark, "kiln_test_gold").collect()] == ["dim_carrier",
                                                                                         "dim_warehouse"]
    assert spark.table("kiln_test_gold.dim_carrier").count() == small_layer["dim_carrier"].count()


def test_json_raw_is_read_as_text(spark):
    d = tempfile.mkdtemp(prefix="kiln-json-")
    os.makedirs(os.path.join(d, "suppliers_raw"))
    with open(os.path.join(d, "suppliers_raw", "part-0.json"), "w") as f:
        f.write('{"supplier_id": "SUP-1", "lead_time_days": 12, "preferred_flag": "y"}\n')
        f.write('{"supplier_id": " SUP-2 ", "lead_time_days": "12days"}\n')
    rows = rawmod.read_raw(spark, d, fmt="json", tables=["suppliers_raw"])["suppliers_raw"].collect()
    assert [(x.supplier_id, x.lead_time_days) for x in rows] == [("SUP-1", "12"), (" SUP-2 ", "12days")]


def test_oracle_sql_builds_without_spark():
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, %r)\n"
            "import __spark_entry__ as E\n"
            "from pyspark import SparkContext\n"
            "s = E.library_oracle_sql(); q = E.library_queries()\n"
            "assert SparkContext._active_spark_context is None and set(s) == set(q) <= set(E.queries())\n"
            "print(len(s))\n") % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.strip()) >= 53
