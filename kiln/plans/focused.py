"""Focused queries: one cleaning operator or rule at a time, over whole tables.

Each returns a compact profile (distinct input text -> output value, with row
counts) computed from the adapted raw extracts or the built models, so an
individual operator can be checked against a reference on real data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts, dates
from ..functions.text import tier, warehouse_type, y_flag
from ..operators.expectations import AcceptedValues, NotNull, Relationship, Suite, Unique
from ..operators.expectations import run as run_checks
from ..operators.expectations import suite_models
from ..operators.mapping import MappingRule, Taxonomy, duplicate_mappings, standardize
from ..sources.raw import RAW_TABLES, read_raw
from ..sources.sinks import catalog_listing, write_tables
from . import marts, quality

PARSE_SOURCES = {
    "cast_strict_int": (casts.strict_int, [
        ("sales_orders_raw", "ordered_units"), ("sales_orders_raw", "shipped_units"), ("retail_pos_raw", "store_count"),
        ("retail_pos_raw", "pos_units"), ("retail_pos_raw", "on_hand_units"), ("retail_pos_raw", "on_order_units"),
        ("marketing_performance_raw", "impressions"), ("marketing_performance_raw", "clicks"),
        ("marketing_performance_raw", "video_views"), ("marketing_performance_raw", "conversions"),
        ("inventory_snapshots_raw", "on_hand_qty"), ("inventory_snapshots_raw", "allocated_qty"),
        ("inventory_snapshots_raw", "available_qty"), ("inventory_snapshots_raw", "in_transit_qty"),
        ("inventory_snapshots_raw", "safety_stock_qty"), ("purchase_orders_raw", "ordered_qty"),
        ("purchase_orders_raw", "received_qty"), ("shipments_raw", "shipped_units")]),
    "cast_positive_int": (casts.positive_int, [
        ("products_raw", "case_pack_qty"), ("suppliers_raw", "lead_time_days"),
        ("carrier_performance_raw", "contracted_transit_days")]),
    "cast_alpha_reject_real": (casts.alpha_reject_real, [
        ("sales_orders_raw", "unit_price"), ("retail_pos_raw", "pos_sales"), ("marketing_performance_raw", "spend"),
        ("marketing_performance_raw", "revenue"), ("purchase_orders_raw", "unit_cost"), ("shipments_raw", "freight_cost"),
        ("marketing_campaigns_raw", "budget")]),
    "cast_positive_real": (casts.positive_real, [("products_raw", "unit_cost"), ("products_raw", "list_price")]),
    "cast_unguarded_int": (casts.unguarded_int, [("sales_orders_raw", "order_line_id"),
                                                 ("purchase_orders_raw", "po_line_id")]),
    "date_mdy_to_iso": (dates.mdy_to_iso, [("products_raw", "launch_date")]),
    "date_slash_to_iso": (dates.slash_ymd_to_iso, [("retail_pos_raw", "week_start_date")]),
    "timestamp_shape": (dates.timestamp_shape, [("shipment_events_raw", "event_timestamp")]),
    "tier_canonical": (tier, [("customers_raw", "tier")]),
    "warehouse_type_canonical": (warehouse_type, [("warehouse_locations_raw", "warehouse_type")]),
    "y_flag": (y_flag, [("customers_raw", "active_flag"), ("suppliers_raw", "preferred_flag"),
                        ("suppliers_raw", "active_flag"), ("warehouse_locations_raw", "active_flag"),
                        ("carrier_performance_raw", "active_flag"), ("taxonomy_lookup_raw", "active_flag")]),
}


def parse_profile(layer, fn, sources) -> DataFrame:
    """Distinct raw texts of the given columns with their parsed value and row count; one pass over each table."""
    by_table: dict[str, list] = {}
    for t, c in sources:
        by_table.setdefault(t, []).append(F.struct(F.lit(f"{t}.{c}").alias("source_column"), F.col(c).alias("raw_text")))
    frames = [layer[t].select(F.inline(F.array(*columns))) for t, columns in by_table.items()]
    grouped = reduce(DataFrame.unionByName, frames).groupBy("source_column", "raw_text") \
        .agg(F.count(F.lit(1)).alias("n"))
    return grouped.select("source_column", "raw_text", fn("raw_text").alias("value"), "n")


# (raw table, column, mapping type, fallback when no active mapping matches)
MAPPING_SOURCES = [
    ("products_raw", "product_sku", "sku_normalization", "trim"),
    ("products_raw", "unit_of_measure", "uom", "upper"),
    ("product_hierarchy_raw", "product_sku", "sku_normalization", "trim"),
    ("customers_raw", "channel", "channel", "blank_null"),
    ("customers_raw", "region", "region", "blank_null"),
    ("customers_raw", "country", "country", "blank_null"),
    ("sales_orders_raw", "product_sku", "sku_normalization", "trim"),
    ("retail_pos_raw", "product_sku", "sku_normalization", "trim"),
    ("marketing_campaigns_raw", "product_sku", "sku_normalization", "trim"),
    ("marketing_campaigns_raw", "platform", "platform", "blank_null"),
    ("marketing_campaigns_raw", "region", "region", "blank_null"),
    ("marketing_performance_raw", "platform", "platform", "blank_null"),
    ("inventory_snapshots_raw", "product_sku", "sku_normalization", "trim"),
    ("inventory_snapshots_raw", "warehouse_id", "warehouse_normalization", "trim"),
    ("inventory_snapshots_raw", "unit_of_measure", "uom", "upper"),
    ("warehouse_locations_raw", "warehouse_id", "warehouse_normalization", "trim"),
    ("warehouse_locations_raw", "region", "region", "blank_null"),
    ("warehouse_locations_raw", "country", "country", "blank_null"),
    ("suppliers_raw", "supplier_name", "supplier", "trim"),
    ("suppliers_raw", "supplier_region", "region", "blank_null"),
    ("suppliers_raw", "country", "country", "blank_null"),
    ("purchase_orders_raw", "product_sku", "sku_normalization", "trim"),
    ("purchase_orders_raw", "warehouse_id", "warehouse_normalization", "trim"),
    ("shipments_raw", "product_sku", "sku_normalization", "trim"),
    ("shipments_raw", "warehouse_id", "warehouse_normalization", "trim"),
    ("carrier_performance_raw", "region", "region", "blank_null"),
]


def mapping_fallbacks(layer) -> DataFrame:
    """Distinct raw codes with their standardised value (mapping or fallback) and row counts.

    Rows are counted per distinct code first, and codes are mapped once per mapping type.
    """
    tax = Taxonomy(layer["stg_taxonomy_lookup"], layer.sizes.max_rows, layer.sizes.max_bytes)
    kinds = dict.fromkeys((mtype, fallback) for _, _, mtype, fallback in MAPPING_SOURCES)
    frames = []
    for mtype, fallback in kinds:
        texts = [layer[t].select(F.lit(f"{t}.{c}").alias("source_column"), F.col(c).alias("raw_text"))
                 for t, c, m, f in MAPPING_SOURCES if (m, f) == (mtype, fallback)]
        counted = reduce(DataFrame.unionByName, texts).groupBy("source_column", "raw_text") \
            .agg(F.count(F.lit(1)).alias("n"))
        frames.append(standardize(counted, tax, [MappingRule("raw_text", mtype, "value", fallback)]))
    return reduce(DataFrame.unionByName, frames).groupBy("source_column", "raw_text", "value") \
        .agg(F.sum("n").alias("n"))


def day_diff_profile(layer) -> DataFrame:
    """Distribution of day differences and their order-violation flags over the three dated facts."""
    spec = [("fct_sales_orders", "days_to_ship", "has_ship_before_order_flag"),
            ("fct_purchase_orders", "actual_lead_time_days", "has_received_before_created_flag"),
            ("fct_shipments", "actual_transit_days", "has_delivery_before_ship_flag")]
    frames = [layer[m].select(F.lit(m).alias("source_model"), F.col(d).alias("days"), F.col(f).alias("before_flag"))
              for m, d, f in spec]
    return reduce(DataFrame.unionByName, frames).groupBy("source_model", "days", "before_flag") \
        .agg(F.count(F.lit(1)).alias("n"))


def on_time_profile(layer) -> DataFrame:
    """Tri-state on-time flag against transit and contract (NULL when either is unknown)."""
    return layer["fct_shipments"].groupBy("actual_transit_days", "contracted_transit_days", "is_on_time") \
        .agg(F.count(F.lit(1)).alias("n"))


def scd_overlap(layer) -> DataFrame:
    return quality.scd_overlaps(layer["stg_product_hierarchy"], layer.stage)


def taxonomy_duplicate_mappings(layer) -> DataFrame:
    return duplicate_mappings(layer["stg_taxonomy_lookup"])


def campaign_id_repeats(layer) -> DataFrame:
    """Campaign ids present more than once (they multiply marketing fact rows)."""
    return layer["stg_marketing_campaigns"].groupBy("campaign_id").agg(F.count(F.lit(1)).alias("n_rows")) \
        .where(F.col("n_rows") > 1)


ISSUE_SUMMARY_SQL = """
select source_model, issue_type, count(*) as n_findings
from (select source_model, issue_type from dq_orphan_records
      union all select source_model, issue_type from dq_date_violations
      union all select source_model, issue_type from dq_value_violations) f
group by source_model, issue_type
"""


def dq_issue_summary(layer) -> DataFrame:
    """Ad-hoc SQL over the registered report views (``spark.sql``)."""
    layer.register_views(["dq_orphan_records", "dq_date_violations", "dq_value_violations"])
    return layer.spark.sql(ISSUE_SUMMARY_SQL)


def dq_findings_by_policy(layer) -> DataFrame:
    return quality.findings_by_policy(layer["dq_orphan_records"], layer["dq_date_violations"],
                                      layer["dq_value_violations"])


#: checks that the data is known to fail, for the failing side of every kind of check
FAILING_SUITE = Suite([
    Unique("stg_marketing_campaigns", "campaign_id"), Unique("fct_sales_orders", "product_sku"),
    NotNull("fct_shipments", "tracking_number"), NotNull("fct_sales_orders", "ordered_units"),
    AcceptedValues("fct_sales_orders", "order_status", ("shipped",)),
    AcceptedValues("dim_carrier", "is_active", (1,)),
    Relationship("fct_sales_orders", "product_sku", "dim_product", "product_sku"),
    Relationship("fct_shipments", "order_id", "fct_sales_orders", "order_id"),
    Relationship("fct_retail_pos", "product_sku", "dim_product", "product_sku", "is_known_product = 0"),
])


def expectation_failures(layer) -> DataFrame:
    """Failure counts of ``FAILING_SUITE``."""
    return run_checks({m: layer[m] for m in suite_models(FAILING_SUITE)}, FAILING_SUITE)


def weeks_of_supply_latest(layer) -> DataFrame:
    """Weeks of supply from each warehouse's latest snapshot alone."""
    return marts.mart_inventory_weeks_of_supply(layer["fct_inventory_snapshots"], layer["fct_retail_pos"],
                                                latest_only=True)


def orphan_records_extended(layer) -> DataFrame:
    """The orphan report with POS, inventory and all shipment keys."""
    inputs = ["fct_sales_orders", "fct_purchase_orders", "fct_shipments", "fct_marketing_performance",
              "stg_marketing_campaigns", "stg_product_hierarchy", "dim_product"]
    return quality.dq_orphan_records(*[layer[n] for n in inputs],
                                     extended={n: layer[n] for n in quality.EXTENDED_FACTS})


def strict_reals(layer) -> DataFrame:
    """Distinct amount texts with their strict reading."""
    return parse_profile(layer, casts.strict_real, PARSE_SOURCES["cast_alpha_reject_real"][1])


def raw_reader_profile(layer) -> DataFrame:
    """Rows and filled first and last columns of every raw extract, read back by ``read_raw`` from its landed files."""
    raw = read_raw(layer.spark, f"{layer.run_folder}/raw")
    frames = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(df.columns[0]).alias("n_first"),
                     F.count(df.columns[-1]).alias("n_last")).select(F.lit(name).alias("raw_table"), "*")
              for name, df in raw.items()]
    return reduce(DataFrame.union, frames)


CATALOGUE = ["dim_carrier", "dim_customer", "dim_product", "dim_supplier", "dim_warehouse"]


def catalogue(layer) -> DataFrame:
    """The dimensions saved as catalog tables, listed with their row counts."""
    database = f"kiln_{layer.run_folder.rsplit('-', 1)[-1]}"
    write_tables({n: layer[n] for n in CATALOGUE}, database)
    counts = reduce(DataFrame.union, [
        layer.spark.table(f"{database}.{n}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "*")
        for n in CATALOGUE])
    listed = catalog_listing(layer.spark, database).select(F.col("tableName").alias("table_name"))
    return listed.join(counts, "table_name", "left")


FACTS = ["fct_sales_orders", "fct_purchase_orders", "fct_shipments"]
REPORTS = ["dq_orphan_records", "dq_date_violations", "dq_value_violations"]

#: query -> (function of the layer, the models and raw extracts it reads from files); the profiles read a few columns of
#: each extract once, so their extracts are not landed
QUERIES = {name: ((lambda fn, src: (lambda layer: parse_profile(layer, fn, src)))(fn, src), [])
           for name, (fn, src) in PARSE_SOURCES.items()}
QUERIES.update({
    "day_diff_profile": (day_diff_profile, FACTS),
    "on_time_profile": (on_time_profile, ["fct_shipments"]),
    "scd_overlap": (scd_overlap, ["stg_product_hierarchy"]),
    "taxonomy_duplicate_mappings": (taxonomy_duplicate_mappings, ["stg_taxonomy_lookup"]),
    "campaign_id_repeats": (campaign_id_repeats, ["stg_marketing_campaigns"]),
    "dq_issue_summary": (dq_issue_summary, REPORTS),
    "dq_findings_by_policy": (dq_findings_by_policy, REPORTS),
    "mapping_fallbacks": (mapping_fallbacks, ["stg_taxonomy_lookup", *(t for t, *_ in MAPPING_SOURCES)]),
    "expectation_failures": (expectation_failures, suite_models(FAILING_SUITE)),
    "mart_inventory_weeks_of_supply_latest": (weeks_of_supply_latest, ["fct_inventory_snapshots", "fct_retail_pos"]),
    "dq_orphan_records_extended": (orphan_records_extended, ["dq_orphan_records", *quality.EXTENDED_FACTS]),
    "cast_strict_real": (strict_reals, []),
    "raw_reader_profile": (raw_reader_profile, RAW_TABLES),
    "catalogue": (catalogue, CATALOGUE),
})
