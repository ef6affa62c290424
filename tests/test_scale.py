"""Steps that grow with the input are taken once and move no more than they need."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kiln.operators.keys import orphans, with_known_flag
from kiln.operators.sizing import SizeBook
from kiln.plans import dated, monitoring
from kiln.plans.dag import read_by_one_fact

REPORT = "source_model string, issue_type string, record_id string"


class Layer(dict):
    """Tables by name with a folder for written steps."""

    def __init__(self, spark, folder, tables):
        super().__init__(tables)
        self.spark, self.run_folder, self.steps = spark, str(folder), []

    def stage(self, df, name):
        self.steps.append(name)
        path = f"{self.run_folder}/steps/{len(self.steps)}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def test_runs_record_counts_of_one_pass_over_the_reports(spark, tmp_path, monkeypatch):
    rows = [("fct_shipments", "late_delivery", f"SH-{i}") for i in range(9)] + [("fct_shipments", "late_delivery", None)]
    tables = {n: spark.createDataFrame(rows if n == "dq_date_violations" else [], REPORT)
              for n in ("dq_orphan_records", "dq_date_violations", "dq_value_violations")}
    tables.update({m: spark.range(40).toDF("x") for models in monitoring.DOMAINS.values() for m in models})
    read, record = [], monitoring.FindingCounts.record

    def recorded(self, run, counts, rows):
        read.extend(counts.inputFiles())
        record(self, run, counts, rows)
    monkeypatch.setattr(monitoring.FindingCounts, "record", recorded)
    layer = Layer(spark, tmp_path, tables)
    got = dated.finding_thresholds(layer, None).collect()
    assert read and all("-finding-counts/" in f for f in read)
    early = sum(r[0] for r in spark.createDataFrame(rows, REPORT).select(
        (F.substring(F.md5(F.coalesce("record_id", F.lit("")).cast("binary")), 1, 1) < "8").cast("int")).collect())
    (row,) = got
    assert 0 < early < 10 and (row.n_findings, row.n_rows, row.share, row.previous_share) == (10, 40, 0.25, early / 40)


def test_a_side_is_judged_by_the_columns_that_are_joined(spark):
    dim = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit("x" * 1000).alias("text"))
    fact = spark.range(30).select((F.col("id") % 15).cast("string").alias("k"))
    side = SizeBook(50, 5_000).side("dim", dim)
    assert not side.broadcast and side.pick(["k"]).broadcast and not side.pick(["k", "text"]).broadcast
    for df, carried in ((with_known_flag(fact, "k", side, "k", "known"), False), (orphans(fact, "k", side, "k", True), False),
                        (with_known_flag(fact.withColumnRenamed("k", "f"), "f", side, "k", "known", carry=["text"]), True)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) is not carried
    assert with_known_flag(fact, "k", side, "k", "known").agg(F.sum("known")).first()[0] == 20


@pytest.mark.parametrize("names, once", [
    (["fct_sales_orders"], {"sales_orders_raw"}),
    (["fct_shipments"], {"sales_orders_raw", "shipments_raw"}),
    (["fct_sales_orders", "stg_sales_orders"], set()),
    (["fct_sales_orders", "sales_orders_raw"], set()),
    (["stg_retail_pos"], set()),
    (["dim_carrier"], set())])
def test_extracts_of_one_fact_are_not_landed(names, once):
    assert read_by_one_fact(names) == once


def test_profiles_read_each_extract_once_and_land_none(spark, small_layer):
    from kiln.plans import focused
    from kiln.plans.dag import GoldLayer
    layer = GoldLayer(small_layer.raw, as_of=small_layer.as_of).ensure(*focused.QUERIES["cast_strict_real"][1])
    assert not layer._landed and focused.QUERIES["cast_alpha_reject_real"][1] == []
    plan = focused.parse_profile(layer, F.trim, focused.PARSE_SOURCES["cast_strict_int"][1])._jdf.queryExecution() \
        .optimizedPlan().toString()
    sources = focused.PARSE_SOURCES["cast_strict_int"][1]
    assert plan.count("Generate inline") == len({t for t, _ in sources}) < len(sources)


def test_checks_drop_rows_without_facts_in_generated_code(spark):
    from kiln.operators.expectations import AcceptedValues, NotNull, Suite, run
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (None, "c")], "k int, v string")
    got = run({"t": rows}, Suite([NotNull("t", "k"), AcceptedValues("t", "v", ("a",))]))
    assert {(r.test_name, r.failures) for r in got.collect()} == {("not_null", 2), ("accepted_values", 2)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(array" not in plan and "lambda" not in plan


@pytest.mark.parametrize("name, raw", [("stg_retail_pos", "retail_pos_raw"), ("stg_sales_orders", "sales_orders_raw"),
                                       ("stg_shipment_events", "shipment_events_raw")])
def test_queries_of_staging_views_land_no_extract(spark, small_layer, tmp_path, name, raw):
    import __spark_entry__
    (tmp_path / "tables").symlink_to(SF_SMALL)         # a folder that no query has landed extracts of
    found = __spark_entry__.queries()[name](spark, str(tmp_path / "tables"))
    layer = __spark_entry__._LAYERS[spark.sparkContext.applicationId, str(tmp_path / "tables")]
    assert raw not in layer._landed
    assert found.count() == small_layer.raw[raw].count() and found.exceptAll(small_layer[name]).isEmpty()


def test_a_large_dimension_is_replaced_by_the_few_keys_that_it_lacks(spark, tmp_path):
    from kiln.operators.keys import AbsentKeys, by_absence
    layer = Layer(spark, tmp_path, {})
    dim = spark.createDataFrame([(f"k{i}",) for i in range(200)] + [(None,)], "k string")
    fact = spark.createDataFrame([(i, f"k{i % 203}") for i in range(900)] + [(900, None), (901, None)], "i int, f string")
    orders = spark.createDataFrame([(f"k{i % 201}",) for i in range(500)], "o string")
    for rows, few in ((10, True), (1, False)):
        side = SizeBook(rows, 5_000, stage=layer.stage).side("dim", dim)
        d, known = by_absence(fact.withColumn("o", F.col("f")), {"f": (side, "k")}, {"o": (orders, "o")})
        assert isinstance(known["f"], AbsentKeys) is isinstance(known["o"], AbsentKeys) is few
        got = with_known_flag(with_known_flag(d, "f", known["f"], "k", "known"), "o", known["o"], "o", "ordered", distinct=True)
        assert ("SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()) is not few
        assert sorted(got.select("i", "known", "ordered").collect()) == sorted(
            (i, int(i < 900 and i % 203 < 200), int(i < 900 and i % 203 < 201)) for i in range(902))
    small = SizeBook(1000, stage=layer.stage).side("dim", dim)
    assert by_absence(fact, {"f": (small, "k")}) == (fact, {"f": small})


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning")


def test_readings_and_movements_move_once(spark):
    from kiln.operators.position import reconciled
    read = spark.createDataFrame([("a", "2024-01-01", 5), ("a", "2024-01-03", 9), ("a", "2024-01-03", 8)], "k string, d string, v int")
    moved = spark.createDataFrame([("a", "2024-01-02", 3), ("a", "2024-01-02", None), ("b", "2024-01-02", 1)],
                                  "k string, day string, quantity long")
    got = reconciled(read.withColumn("d", F.to_date("d")), moved.withColumn("day", F.to_date("day")), ["k"], "d", "v")
    assert [(r.reading, r.previous, r.moved, r.difference) for r in got.orderBy("day").collect()] == [
        (5, None, None, None), (9, 5, 3, 1)]
    assert exchanges(got) == 2              # once by key and day, once by key


def test_a_merge_moves_the_rows_of_a_batch_once(spark, tmp_path, monkeypatch):
    from kiln.operators.dedup import By
    from kiln.sources import upsert
    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", None), (None, "n", 3), (None, "m", 3)],
                                 "k string, t string, n int")
    table = upsert.UpsertTable(spark, str(tmp_path / "t"), rows.schema, ["k"], [By("n", desc=True)], F.lit("p"))
    plans, keep_best = [], upsert.keep_best
    monkeypatch.setattr(upsert, "keep_best", lambda *a: plans.append(keep_best(*a)) or plans[-1])
    for batch, n in ((rows, 3), (rows, 0), (rows.where("t = 'x'"), 0)):
        assert table.merge(batch).rows == n
    assert sorted(map(tuple, table.read().collect()), key=str) == [("a", "y", 2), ("b", "z", None), (None, "m", 3)]
    assert [exchanges(p) for p in plans] == [1, 1, 1]


def test_product_revenue_moves_the_lines_once(spark, small_layer):
    from kiln.plans.dag import GoldLayer
    from kiln.sources.testdata import load_driver_tables
    lines = [("s", 10.0, "usd", "1996-01-05"), ("s", 4.0, "cad", "1996-01-05"), ("s", 4.0, "cad", "1990-01-05"),
             ("s", None, "zz", None), (None, 2.5, "usd", None)]
    sales = spark.createDataFrame(lines, "product_sku string, gross_revenue double, currency string, order_date string")
    layer = GoldLayer(small_layer.raw, as_of=small_layer.as_of)
    layer._built["fct_sales_orders"] = sales
    got = dated.currency_product_revenue(layer, load_driver_tables(spark, SF_SMALL))
    found = {r.product_sku: tuple(r)[1:] for r in got.collect()}
    assert found["s"] == ("CAD=8.00;USD=10.00", 10 + 4 * (0.5 + 1 / 64), 2) and found[None] == ("USD=2.50", 2.5, 0)
    assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Join") == 1   # the rates


def test_a_layer_writes_its_steps_in_a_denser_codec(spark, small_layer):
    from kiln.plans.dag import GoldLayer
    files = GoldLayer(small_layer.raw, as_of=small_layer.as_of).stage(spark.range(9).toDF("x"), "step").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_shuffle_partitions_grow_with_the_input_and_are_never_lowered(spark, tmp_path, monkeypatch):
    import __spark_entry__
    from kiln.operators import sizing
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    try:
        sizing.enough_partitions(spark, 1)
        assert spark.conf.get(key) == before
        monkeypatch.setattr(sizing, "PARTITION_ROWS", lines // 20)
        (tmp_path / "tables").symlink_to(SF_SMALL)
        __spark_entry__.layer_for(spark, str(tmp_path / "tables"))
        assert int(spark.conf.get(key)) >= 20
    finally:
        spark.conf.set(key, before)


def test_rows_with_unique_keys_are_not_moved_to_find_the_best(spark, tmp_path):
    from kiln.operators.dedup import By, keep_best
    from kiln.operators.keys import best_by_absence
    layer = Layer(spark, tmp_path, {})
    rows = [(f"o{i}", i % 7, f"k{i % 203}", "x") for i in range(900)]
    rows += [("o1", 9, "k1", "b"), ("o1", 9, "k1", "a"), ("o1", 9, "k1", "a"), (None, 1, "k2", "x"), (None, 2, "k2", "x"),
             (None, None, None, None)]
    fact = spark.createDataFrame(rows, "o string, n int, f string, raw string")
    dim = spark.createDataFrame([(f"k{i}",) for i in range(200)], "k string")
    order = [By("n", desc=True)]
    expected = sorted(keep_best(fact, ["o", "f"], order).drop("raw").collect(), key=str)
    for bound in (199, 1):              # within the bounds of 1, two keys that repeat are too many: all rows compete
        layer.steps.clear()
        layer.run_folder = str(tmp_path / str(bound))
        side = SizeBook(bound, stage=layer.stage).side("dim", dim)
        got, _ = best_by_absence(fact, ["o", "f"], order, {"f": (side, "k")}, drop=("raw",))
        assert sorted(got.collect(), key=str) == expected
        assert ("Window" in got._jdf.queryExecution().executedPlan().toString()) is (bound == 1)
        assert ("best-rows" in layer.steps) is (bound == 199)
    small = SizeBook(1000, stage=layer.stage).side("dim", dim)
    layer.steps.clear()
    got, _ = best_by_absence(fact, ["o", "f"], order, {"f": (small, "k")}, drop=("raw",))
    assert sorted(got.collect(), key=str) == expected and not layer.steps


def test_as_of_lookups_ship_no_side_on_an_estimate(spark):
    from kiln.operators.asof import answers_as_of
    versions = spark.createDataFrame([("a", None, "1996-12-31", "x"), ("a", "1997-01-01", None, "y"), ("b", "1996-05-01", None, "z")],
                                     "k string, start string, end string, value string").selectExpr(
        "k", "date(start) as start", "date(end) as end", "value")
    points = spark.createDataFrame([("a", "1996-05-05"), ("a", "1997-05-05"), ("a", None), ("b", "1996-04-30"), ("c", "1996-04-30")],
                                   "k string, d string").selectExpr("k", "date(d) as d")
    got = answers_as_of(points, versions)           # the estimate of either side is a few bytes
    assert {(r.k, str(r.d), r.value, r.status) for r in got.collect()} == {
        ("a", "1996-05-05", "x", "valid"), ("a", "1997-05-05", "y", "valid"), ("a", "None", None, "undated"),
        ("b", "1996-04-30", None, "outside"), ("c", "1996-04-30", None, "unknown")}
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_dates_are_read_in_methods_that_get_compiled(spark):
    import re
    from kiln.functions import dates
    texts = spark.createDataFrame([("2024-02-30", "2024-02-01", "open"), ("2460370.5", "2024-03-01 24:00", "open")],
                                  "a string, b string, st string")
    got = texts.select(dates.day_diff("a", "b").alias("days"), dates.before_flag("a", "b").alias("before"),
                       dates.overdue_flag("st", F.lit(None), "b", "2024-03-01 12:00:00").alias("overdue"))
    assert [tuple(r) for r in got.collect()] == [(29.0, 0, 1), (-1.0, 1, 0)]
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        shown = spark._jvm.PythonSQLUtils.explainString(texts.repartition(2).select(
            dates.day_diff("a", "b"), dates.before_flag("a", "b"),
            dates.overdue_flag("st", F.lit(None), "b", "2024-03-01 12:00:00"))._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set(key, before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) < 8000          # larger methods are interpreted for good


def test_a_mapping_beyond_the_bounds_is_hashed_where_a_task_can_hold_its_part(spark, monkeypatch):
    from kiln.operators import sizing
    from kiln.operators.mapping import MappingRule, Taxonomy, standardize
    rows = [("m", f" K{i}", f"s{i}", 1) for i in range(300)] + [("m", "k1", "again", 1), ("m", "k2", "off", 0), ("n", "k3", "other", 1)]
    tax = spark.createDataFrame(rows, "mapping_type string, raw_value string, standard_value string, is_active int")
    df = spark.createDataFrame([(i, f"k{i % 320} ") for i in range(900)] + [(900, None)], "i int, c string")
    expected = sorted(standardize(df, tax, [MappingRule("c", "m", "o")]).collect(), key=str)
    for part, join, other in ((1 << 20, "ShuffledHashJoin", "SortMergeJoin"), (1, "SortMergeJoin", "ShuffledHashJoin")):
        monkeypatch.setattr(sizing, "PARTITION_BYTES", part)
        got = standardize(df, Taxonomy(tax, 10), [MappingRule("c", "m", "o")])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert join in plan and other not in plan and sorted(got.collect(), key=str) == expected


def test_keys_that_a_dimension_lacks_are_found_without_sorting(spark, tmp_path):
    from kiln.operators.keys import by_absence
    layer, plans = Layer(spark, tmp_path, {}), {}

    def stage(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return layer.stage(df, name)
    dim = spark.createDataFrame([(f"k{i % 200}",) for i in range(400)] + [(None,)], "k string")
    fact = spark.createDataFrame([(i, f"k{i % 203}") for i in range(900)] + [(900, None)], "i int, f string")
    _, known = by_absence(fact, {"f": (SizeBook(10, stage=stage).side("dim", dim), "k")})
    assert sorted(r.key for r in known["f"].df.collect()) == ["k200", "k201", "k202"]
    assert "ShuffledHashJoin" in plans["absent-f"] and "Sort " not in plans["absent-f"]


def test_values_that_hardly_repeat_are_not_kept_in_a_dictionary(spark, tmp_path):
    import pyarrow.parquet as pq
    from kiln.sources.sinks import folder_writer
    df = spark.range(50_000).select(F.concat(F.lit("order-"), "id").alias("id"), (F.col("id") % 9).cast("string").alias("code"))
    folder_writer(df.coalesce(1)).save(str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("*.parquet")
    ids, codes = (pq.ParquetFile(file).metadata.row_group(0).column(i) for i in (0, 1))
    assert "PLAIN" in ids.encodings and not ids.total_uncompressed_size < 50_000 * 8
    assert codes.has_dictionary_page and codes.total_uncompressed_size < 50_000
    assert not ids.has_dictionary_page or ids.data_page_offset - ids.dictionary_page_offset < 100_000
