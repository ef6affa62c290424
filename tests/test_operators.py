"""Operators on small hand-written frames: dedup, precedence, SCD, keys, findings, expectations."""

import pytest
from pyspark.sql import functions as F

from kiln.operators import expectations as ex
from kiln.operators.dedup import By, keep_best
from kiln.operators.expectations import (AcceptedValues, ExpectationError, NotNull, Relationship, Suite, Unique,
                                         enforce)
from kiln.operators.expectations import run as run_checks
from kiln.operators.findings import Rule, evaluate
from kiln.operators.keys import orphans, with_known_flag
from kiln.operators.mapping import MappingRule, Taxonomy, duplicate_mappings, standardize
from kiln.operators.resolve import source_precedence
from kiln.operators.scd import current_rows, overlapping_pairs
from kiln.operators.sizing import SizeBook, measure
from kiln.plans import dims


def test_keep_best_orders_and_breaks_ties_deterministically(spark):
    df = spark.createDataFrame([("k", 5, "b"), ("k", None, "a"), ("k", 5, "a"), ("j", None, "z")],
                               "key string, units int, cust string")
    got = {r.key: (r.units, r.cust) for r in keep_best(df, ["key"], [By("units", desc=True), By("cust")]).collect()}
    assert got == {"k": (5, "a"), "j": (None, "z")}
    # ties on every ordering term resolve by the remaining columns, the same way every run
    t = spark.createDataFrame([("k", 1, "y"), ("k", 1, "x")], "key string, v int, other string")
    assert keep_best(t, ["key"], [By("v")]).collect()[0].other == "x"


def test_keep_best_plans_group_limit_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = keep_best(df, ["k"], [By("v", desc=True)])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dim_customer_prefers_known_then_short_country(spark):
    rows = [("C1", "Zed", "US"), ("C1", "Abe", "Republic of X"), ("C2", "B", None), ("C2", "A", "Long name"),
            ("C3", "B", None), ("C3", "A", None)]
    stg = spark.createDataFrame(
        [(c, n, None, None, k, None, 1, None) for c, n, k in rows],
        "customer_id string, customer_name string, channel string, region string, country string, tier string, "
        "is_active int, parent_customer_id string")
    got = {r.customer_id: (r.customer_name, r.country) for r in dims.dim_customer(stg).collect()}
    assert got == {"C1": ("Zed", "US"), "C2": ("A", "Long name"), "C3": ("A", None)}


def test_dim_warehouse_and_carrier_tiebreaks(spark):
    wh = spark.createDataFrame([("WH-1", "WH1", "Legacy", None, None, None, "UTC", 1),
                                ("WH-1", "WH-1", "Main", None, None, None, "Europe/Paris", 1)],
                               "warehouse_id string, warehouse_id_raw string, warehouse_name string, "
                               "warehouse_type string, region string, country string, timezone string, is_active int")
    assert dims.dim_warehouse(wh).collect()[0].warehouse_name == "Main"
    ca = spark.createDataFrame([("C", "b", None, "APAC", 3, 1), ("C", "a", None, "EMEA", 3, 1),
                                ("D", "a", None, "EMEA", None, 1), ("D", "b", None, "APAC", 5, 1)],
                               "carrier_id string, carrier_name string, service_level string, region string, "
                               "contracted_transit_days bigint, is_active int")
    got = {r.carrier_id: r.carrier_name for r in dims.dim_carrier(ca).collect()}
    assert got == {"C": "a", "D": "b"}


def test_source_precedence(spark):
    df = spark.createDataFrame([("A", "PLM", "plm-name", 1.0), ("A", "ERP", "erp-name", 2.0),
                                ("B", "ERP", "erp-only", 3.0), ("C", "PLM", None, 4.0), ("C", "ERP", "erp-c", None)],
                               "sku string, src string, name string, cost double")
    out = source_precedence(df, "sku", "src", {"name": ("name", ["PLM", "ERP"]), "cost": ("cost", ["ERP", "PLM"])},
                            presence={"in_plm": "PLM", "in_erp": "ERP"})
    got = {r.sku: (r.name, r.cost, r.in_plm, r.in_erp) for r in out.collect()}
    assert got == {"A": ("plm-name", 2.0, 1, 1), "B": ("erp-only", 3.0, 0, 1), "C": ("erp-c", 4.0, 1, 1)}


HIER = "product_sku string, effective_start_date string, effective_end_date string, tag string"


def test_current_rows_prefers_open_then_latest(spark):
    df = spark.createDataFrame([("S", "2023-01-01", None, "open"), ("S", "2024-01-01", "2024-06-30", "closed-late"),
                                ("T", "2022-01-01", "2022-12-31", "old"), ("T", "2023-01-01", "2023-12-31", "new")],
                               HIER)
    assert {r.product_sku: r.tag for r in current_rows(df, "product_sku").collect()} == {"S": "open", "T": "new"}


def test_overlapping_pairs(spark):
    df = spark.createDataFrame([
        ("S", "2022-06-01", "2023-06-30", "a"), ("S", "2023-01-01", None, "b"),      # a overlaps b
        ("S", "2023-01-01", "2023-12-31", "c"),                                       # same start as b: not a pair
        ("T", "2020-01-01", "2020-12-31", "d"), ("T", "2021-01-01", "2021-12-31", "e"),  # disjoint
        ("U", "2020-01-01", None, "f"), ("U", "2021-01-01", None, "g"), ("U", "2022-01-01", None, "h"),
        ("V", "2020-01-01", "2020-06-30", "i"), ("V", "2020-06-30", None, "j"),      # end == start counts
    ], HIER)
    got = sorted((r[3], r[7]) for r in overlapping_pairs(df, "product_sku").collect())
    assert got == [("a", "b"), ("a", "c"), ("f", "g"), ("f", "h"), ("g", "h"), ("i", "j")]


def test_overlapping_pairs_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for k in range(30):
        for i in range(rnd.randint(1, 6)):
            s = f"2020-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}"
            e = None if rnd.random() < 0.3 else f"202{rnd.randint(0, 1)}-{rnd.randint(1, 12):02d}-01"
            rows.append((f"K{k}", s, e, f"{k}-{i}"))
    df = spark.createDataFrame(rows, HIER)
    got = sorted((r[3], r[7]) for r in overlapping_pairs(df, "product_sku").collect())
    want = sorted((a[3], b[3]) for a in rows for b in rows
                  if a[0] == b[0] and a[1] < b[1] and (a[2] is None or a[2] >= b[1]))
    assert got == want


def test_orphans_null_key_policies(spark):
    camp = spark.createDataFrame([("c1", "S1"), ("c2", None), ("c3", "S9")], "campaign_id string, product_sku string")
    dim = spark.createDataFrame([("S1",)], "product_sku string")
    assert [r.campaign_id for r in orphans(camp, "product_sku", dim, "product_sku", keep_null_keys=False).collect()] \
        == ["c3"]
    assert sorted(r.campaign_id for r in orphans(camp, "product_sku", dim, "product_sku",
                                                 keep_null_keys=True).collect()) == ["c2", "c3"]


def test_with_known_flag_and_carry(spark):
    fact = spark.createDataFrame([("a", "C1"), ("b", "C9"), ("c", None)], "id string, carrier string")
    dim = spark.createDataFrame([("C1", 3)], "carrier_id string, days int")
    out = with_known_flag(fact, "carrier", dim, "carrier_id", "is_known", carry=["days"])
    assert sorted((r.id, r.is_known, r.days) for r in out.collect()) == [("a", 1, 3), ("b", 0, None), ("c", 0, None)]


def test_standardize_fallbacks_and_sized_broadcast(spark):
    tax = spark.createDataFrame([("region", "europe", "EMEA", 1), ("region", "asia", "APAC", 0)],
                                "mapping_type string, raw_value string, standard_value string, is_active int")
    src = spark.createDataFrame([(" Europe ",), ("ASIA",), ("",), (None,)], "r string")
    for t in (tax, Taxonomy(tax, 10), Taxonomy(tax, 0)):
        out = standardize(src, t, [MappingRule("r", "region", "a", "trim"), MappingRule("r", "region", "b", "blank_null"),
                                   MappingRule("r", "region", "c", "upper")])
        got = {r.r: (r.a, r.b, r.c) for r in out.collect()}
        assert got == {" Europe ": ("EMEA", "EMEA", "EMEA"), "ASIA": ("ASIA", "ASIA", "ASIA"), "": ("", None, ""),
                       None: (None, None, None)}
    plan = standardize(src, Taxonomy(tax, 10), [MappingRule("r", "region", "a")])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Broadcast" in plan
    dup = spark.createDataFrame([("uom", "ea", "EA", 1), ("uom", "EA ", "EACH", 1)],
                                "mapping_type string, raw_value string, standard_value string, is_active int")
    assert duplicate_mappings(dup).collect()[0].n_mappings == 2


def test_join_sides_respect_row_and_byte_bounds(spark):
    small = spark.range(10).select(F.col("id").alias("k"), F.lit("x" * 100).alias("text"))
    fact = spark.range(1000).select((F.col("id") % 10).alias("k"))

    def plan(book):
        return fact.join(book.side("s", small).finish(small), "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert measure(small) == (10, 10 * (100 + 48 + 8))
    assert "BroadcastHashJoin" in plan(SizeBook(50, 10_000))
    # over either bound: never broadcast, even though the planner's estimate is tiny
    assert "BroadcastHashJoin" not in plan(SizeBook(9, 10_000))
    assert "BroadcastHashJoin" not in plan(SizeBook(50, 1_000))


def test_duplicate_mappings_can_raise(spark):
    rows = [("uom", "ea", "EA", 1), ("uom", " EA ", "EACH", 1), ("uom", "cs", "CASE", 1), ("uom", "cs", "CS", 0)]
    tax = spark.createDataFrame(rows, "mapping_type string, raw_value string, standard_value string, is_active int")
    assert Taxonomy(tax, 100).slice_sizes()["uom"][0] == 3
    with pytest.raises(ValueError, match="uom 'ea'"):
        Taxonomy(tax, 100, on_duplicate="raise").slice_sizes()
    Taxonomy(tax.where("standard_value <> 'EACH'"), 100, on_duplicate="raise").slice_sizes()


def test_enforce_raises_on_failures(spark):
    t = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "k int, v string")
    suite = Suite([Unique("t", "k"), NotNull("t", "v"), AcceptedValues("t", "v", ("a", "z"))])
    with pytest.raises(ExpectationError) as e:
        enforce(run_checks({"t": t}, suite))
    assert e.value.failures == [("t", "k", "unique", 1), ("t", "v", "not_null", 1)]
    enforce(run_checks({"t": t}, Suite([AcceptedValues("t", "v", ("a", "z"))])))


def test_suite_reads_each_table_once(spark, tmp_path):
    tables = {}
    for name in ("child", "parent"):
        path = str(tmp_path / name)
        spark.range(20).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("v")).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    suite = Suite([NotNull("child", "k"), Unique("child", "v"), AcceptedValues("child", "k", (1, 2)),
                   Relationship("child", "v", "parent", "v", "k < 5"), Relationship("child", "v", "parent", "k"),
                   Unique("parent", "k")])
    res = run_checks(tables, suite)
    plan = res._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("FileScan") == 2
    assert [r["failures"] for r in sorted(res.collect(), key=lambda r: (r["model_name"], r["column_name"], r["test_name"]))] \
        == [5, 0, 0, 13, 0, 7]


def test_findings_single_pass(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 1, 1), ("c", 0, 0)], "id string, f1 int, f2 int")
    rules = [Rule("t", "one", F.col("f1") == 1, F.col("id"), F.lit("d1")),
             Rule("t", "two", F.col("f2") == 1, F.col("id"), F.lit("d2"), F.col("id"))]
    out = evaluate(df, rules)
    assert sorted((r.issue_type, r.record_id, r.offending_value) for r in out.collect()) == [
        ("one", "a", None), ("one", "b", None), ("two", "b", "b")]
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_expectations(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), (None, 3, "bad"), ("b", 9, "bad")],
                              "k string, flag int, s string")
    parent = spark.createDataFrame([("a",)], "k string")
    suite = ex.Suite([ex.NotNull("t", "k"), ex.Unique("t", "k"), ex.AcceptedValues("t", "s", ("x",)),
                      ex.Relationship("t", "k", "p", "k"), ex.Relationship("t", "k", "p", "k", where="flag < 5")])
    got = {(r.test_name, r.column_name, i): r.failures
           for i, r in enumerate(ex.run({"t": t, "p": parent}, suite).collect())}
    assert sorted(got.values()) == sorted([1, 1, 1, 1, 0])
    by_test = {}
    for (name, _, _), v in got.items():
        by_test.setdefault(name, []).append(v)
    assert by_test["not_null"] == [1] and by_test["unique"] == [1] and by_test["accepted_values"] == [1]
    assert sorted(by_test["relationships"]) == [0, 1]


def test_overlapping_pairs_hot_key_is_output_sensitive(spark):
    # one key with 20,000 chained versions: each overlaps only the next one
    n = 20_000
    base = spark.range(n).select(
        F.when(F.col("id") >= 0, F.lit("HOT")).otherwise(F.lit("COLD")).alias("product_sku"),
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd")
        .alias("effective_start_date"),
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") + 1).cast("int")), "yyyy-MM-dd")
        .alias("effective_end_date"),
        F.col("id").cast("string").alias("tag"))
    pairs = overlapping_pairs(base, "product_sku")
    assert pairs.count() == n - 1
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_rule_has_a_policy(spark):
    from kiln.operators.findings import POLICIES
    from kiln.plans import quality
    rules = [r for rs in (quality.orphan_rules(), quality.date_rules(), quality.value_rules()) for lst in rs.values()
             for r in lst]
    table = {(m, i): p for m, i, p in quality.policy_rows()}
    assert len(table) == len(quality.policy_rows()) == len(rules) + len(quality.JOIN_POLICIES) == 25
    assert set(table.values()) <= set(POLICIES)


def test_overlapping_pairs_hot_key_with_close_starts(spark):
    # 5,000 starts of one key that share their first seven characters spread over tasks
    n = 5_000
    at = lambda x: F.format_string("2024-01-%06d", x)
    base = spark.range(n).select(F.lit("HOT").alias("product_sku"), at(F.col("id")).alias("effective_start_date"),
                                 at(F.col("id") + 2).alias("effective_end_date"), F.col("id").alias("tag"))
    staged = {}

    def stage(df, name):
        staged[name] = df.cache()
        return staged[name]
    assert overlapping_pairs(base, "product_sku", stage=stage).count() == 2 * n - 3
    sizes = [r["count"] for r in staged["values"].groupBy("__part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)


def test_overlapping_pairs_on_arbitrary_text_matches_brute_force(spark):
    # numbering by ranges must keep exact text order: junk, short and long values, shared prefixes
    import random
    rnd = random.Random(23)

    def txt():
        return "".join(rnd.choice("ab-0") for _ in range(rnd.randint(0, 10)))
    rows = [(f"K{rnd.randint(0, 5)}", txt(), None if rnd.random() < 0.25 else txt(), str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, HIER)
    got = sorted((r[3], r[7]) for r in overlapping_pairs(df, "product_sku").collect())
    want = sorted((a[3], b[3]) for a in rows for b in rows
                  if a[0] == b[0] and a[1] < b[1] and (a[2] is None or a[2] >= b[1]))
    assert got == want and len(want) > 100


def test_expectation_plan_does_not_expand_rows(spark):
    t = spark.range(100).select(F.col("id").cast("string").alias("a"), (F.col("id") % 3).alias("b"))
    suite = ex.Suite([ex.NotNull("t", "a"), ex.AcceptedValues("t", "a", ("1",)), ex.AcceptedValues("t", "b", (0, 1))])
    res = ex.run({"t": t}, suite)
    assert "Expand" not in res._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.failures for r in res.collect()) == [0, 1, 99]
