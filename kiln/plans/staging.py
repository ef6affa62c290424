"""Staging models: one per raw extract, 1:1 rows, cleaned and standardised.

No deduplication and no foreign-key checks happen here (that is the
dimension / fact layer's job); every raw row survives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts, dates
from ..functions.text import lower_code, nb, t, tier, upper_code, warehouse_type, y_flag
from ..operators.mapping import MappingRule, standardize

# Mappings observed in the data but missing from the source
# taxonomy, appended with provenance 'discovered_gap'
# (mapping_type, raw_value, standard_value, domain, is_active, effective_start_date).
DISCOVERED_GAPS = [
    ("sku_normalization", "sku1007", "SKU-1007", "product", 1, "2024-07-01"),
    ("country", "United States", "US", "enterprise", 1, "2024-01-01"),
    ("country", "Poland", "PL", "enterprise", 1, "2024-01-01"),
    ("region", "Europe", "EMEA", "enterprise", 1, "2024-01-01"),
]

TAXONOMY_COLUMNS = ["mapping_type", "raw_value", "standard_value", "domain", "is_active",
                    "effective_start_date", "effective_end_date", "mapping_source"]


def stg_taxonomy_lookup(raw: DataFrame) -> DataFrame:
    """M01. Usable mappings (raw and standard present and non-empty before trimming) + gaps."""
    src = (raw.where(F.col("raw_value").isNotNull() & (F.col("raw_value") != "")
                     & F.col("standard_value").isNotNull() & (F.col("standard_value") != ""))
           .select(lower_code("mapping_type").alias("mapping_type"),
                   t("raw_value").alias("raw_value"),
                   t("standard_value").alias("standard_value"),
                   lower_code("domain").alias("domain"),
                   y_flag("active_flag").alias("is_active"),
                   nb("effective_start_date").alias("effective_start_date"),
                   nb("effective_end_date").alias("effective_end_date"),
                   F.lit("source_taxonomy").alias("mapping_source")))
    return src.unionByName(literal_rows(raw.sparkSession, DISCOVERED_GAPS_ROWS, TAXONOMY_COLUMNS))


DISCOVERED_GAPS_ROWS = [(*g, None, "discovered_gap") for g in DISCOVERED_GAPS]


def literal_rows(spark, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A small constant relation built JVM-side (no Python-side data source)."""
    structs = [F.struct(*[F.lit(v).alias(c) for v, c in zip(r, columns)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).select(
        *[F.col(c).cast("int" if c == "is_active" else "string").alias(c) for c in columns])


def stg_products(raw: DataFrame, tax: DataFrame) -> DataFrame:
    """M02."""
    df = standardize(raw, tax, [MappingRule("product_sku", "sku_normalization", "__sku", "trim"),
                                MappingRule("unit_of_measure", "uom", "__uom", "upper")])
    return df.select(
        upper_code("source_system").alias("source_system"),
        F.col("__sku").alias("product_sku"),
        t("product_sku").alias("product_sku_raw"),
        nb("alt_sku").alias("alt_sku"),
        t("product_name").alias("product_name"),
        t("brand_family").alias("brand_family"),
        t("franchise").alias("franchise"),
        t("category").alias("category"),
        nb("sub_category").alias("sub_category"),
        nb("age_grade").alias("age_grade"),
        lower_code("lifecycle_status").alias("lifecycle_status"),
        dates.mdy_to_iso("launch_date").alias("launch_date"),
        nb("discontinue_date").alias("discontinue_date"),
        casts.positive_real("unit_cost").alias("unit_cost"),
        casts.positive_real("list_price").alias("list_price"),
        casts.positive_int("case_pack_qty").alias("case_pack_qty"),
        F.col("__uom").alias("unit_of_measure"),
        F.col("updated_at").alias("source_updated_at"))


def stg_product_hierarchy(raw: DataFrame, tax: DataFrame) -> DataFrame:
    """M03."""
    df = standardize(raw, tax, [MappingRule("product_sku", "sku_normalization", "__sku", "trim")])
    return df.select(
        F.col("__sku").alias("product_sku"),
        t("product_sku").alias("product_sku_raw"),
        nb("effective_start_date").alias("effective_start_date"),
        nb("effective_end_date").alias("effective_end_date"),
        nb("division").alias("division"),
        nb("brand_family_std").alias("brand_family_std"),
        nb("franchise_std").alias("franchise_std"),
        nb("category_std").alias("category_std"),
        nb("sub_category_std").alias("sub_category_std"),
        F.lower(nb("status_std")).alias("status_std"))


def stg_customers(raw: DataFrame, tax: DataFrame) -> DataFrame:
    """M04."""
    df = standardize(raw, tax, [MappingRule("channel", "channel", "__channel", "blank_null"),
                                MappingRule("region", "region", "__region", "blank_null"),
                                MappingRule("country", "country", "__country", "blank_null")])
    return df.select(
        t("customer_id").alias("customer_id"),
        t("customer_name").alias("customer_name"),
        F.col("__channel").alias("channel"),
        F.col("__region").alias("region"),
        F.col("__country").alias("country"),
        tier("tier").alias("tier"),
        y_flag("active_flag").alias("is_active"),
        nb("parent_customer_id").alias("parent_customer_id"))


def stg_sales_orders(raw: DataFrame, tax: DataFrame, real=casts.alpha_reject_real) -> DataFrame:
    """M05."""
    df = standardize(raw, tax, [MappingRule("product_sku", "sku_normalization", "__sku", "trim")])
    return df.select(
        t("order_id").alias("order_id"),
        casts.unguarded_int("order_line_id").alias("order_line_id"),
        t("customer_id").alias("customer_id"),
        F.col("__sku").alias("product_sku"),
        t("product_sku").alias("product_sku_raw"),
        nb("order_date").alias("order_date"),
        nb("requested_ship_date").alias("requested_ship_date"),
        nb("ship_date").alias("ship_date"),
        lower_code("order_status").alias("order_status"),
        casts.strict_int("ordered_units").alias("ordered_units"),
        casts.strict_int("shipped_units").alias("shipped_units"),
        real("unit_price").alias("unit_price"),
        upper_code("currency").alias("currency"),
        nb("cancel_reason").alias("cancel_reason"))


def stg_retail_pos(raw: DataFrame, tax: DataFrame, real=casts.alpha_reject_real) -> DataFrame:
    """M06."""
    df = standardize(raw, tax, [MappingRule("product_sku", "sku_normalization", "__sku", "trim")])
    return df.select(
        t("retailer_id").alias("retailer_id"),
        dates.slash_ymd_to_iso("week_start_date").alias("week_start_date"),
        F.col("__sku").alias("product_sku"),
        t("product_sku").alias("product_sku_raw"),
        casts.strict_int("store_count").alias("store_count"),
        casts.strict_int("pos_units").alias("pos_units"),
        real("pos_sales").alias("pos_sales"),
        casts.strict_int("on_hand_units").alias("on_hand_units"),
        casts.strict_int("on_order_units").alias("on_order_units"),
        upper_code("currency").alias("currency"),
        nb("feed_date").alias("feed_date"))


def stg_marketing_campaigns(raw: DataFrame, tax: DataFrame, real=casts.alpha_reject_real) -> DataFrame:
    """M07."""
    df = standardize(raw, tax, [MappingRule("product_sku", "sku_normalization", "__sku", "trim"),
                                MappingRule("platform", "platform", "__platform", "blank_null"),
                                MappingRule("region", "region", "__region", "blank_null")])
    return df.select(
        t("campaign_id").alias("campaign_id"),
        t("campaign_name").alias("campaign_name"),
        F.col("__platform").alias("platform"),
        t("platform").alias("platform_raw"),
        nb("campaign_start_date").alias("campaign_start_date"),
        nb("campaign_end_date").alias("campaign_end_date"),
        F.col("__sku").alias("product_sku"),
        t("product_sku").alias("product_sku_raw"),
        nb("channel").alias("channel"),
        F.col("__region").alias("region"),
        t("region").alias("region_raw"),
        nb("objective").alias("objective"),
        real("budget").alias("budget"),
        upper_code("currency").alias("currency"),
        nb("taxonomy_code").alias("taxonomy_code"))


def stg_marketing_performance(raw: DataFrame, tax: DataFrame, real=casts.alpha_reject_real) -> DataFrame:
    """M08."""
    df = standardize(raw, tax, [MappingRule("platform", "platform", "__platform", "blank_null")])
    return df.select(
        nb("performance_date").alias("performance_date"),
        t("campaign_id").alias("campaign_id"),
        F.col("__platform").alias("platform"),
        t("platform").alias("platform_raw"),
        casts.strict_int("impressions").alias("impressions"),
        casts.strict_int("clicks").alias("clicks"),
        casts.strict_int("video_views").alias("video_views"),
        real("spend").alias("spend"),
        casts.strict_int("conversions").alias("conversions"),
        real("revenue").alias("revenue"),
        upper_code("currency").alias("currency"))


def stg_inventory_snapshots(raw: DataFrame, tax: DataFrame) -> DataFrame:
    """M09."""
    df = standardize(raw, tax, [MappingRule("product_sku", "sku_normalization", "__sku", "trim"),
                                MappingRule("warehouse_id", "warehouse_normalization", "__wh", "trim"),
                                MappingRule("unit_of_measure", "uom", "__uom", "upper")])
    return df.select(
        nb("snapshot_date").alias("snapshot_date"),
        F.col("__wh").alias("warehouse_id"),
        t("warehouse_id").alias("warehouse_id_raw"),
        F.col("__sku").alias("product_sku"),
        t("product_sku").alias("product_sku_raw"),
        casts.strict_int("on_hand_qty").alias("on_hand_qty"),
        casts.strict_int("allocated_qty").alias("allocated_qty"),
        casts.strict_int("available_qty").alias("available_qty"),
        casts.strict_int("in_transit_qty").alias("in_transit_qty"),
        casts.strict_int("safety_stock_qty").alias("safety_stock_qty"),
        F.col("__uom").alias("unit_of_measure"),
        lower_code("inventory_status").alias("inventory_status"))


def stg_warehouse_locations(raw: DataFrame, tax: DataFrame) -> DataFrame:
    """M10."""
    df = standardize(raw, tax, [MappingRule("warehouse_id", "warehouse_normalization", "__wh", "trim"),
                                MappingRule("region", "region", "__region", "blank_null"),
                                MappingRule("country", "country", "__country", "blank_null")])
    return df.select(
        F.col("__wh").alias("warehouse_id"),
        t("warehouse_id").alias("warehouse_id_raw"),
        t("warehouse_name").alias("warehouse_name"),
        warehouse_type("warehouse_type").alias("warehouse_type"),
        F.col("__region").alias("region"),
        F.col("__country").alias("country"),
        nb("timezone").alias("timezone"),
        y_flag("active_flag").alias("is_active"))


def stg_suppliers(raw: DataFrame, tax: DataFrame) -> DataFrame:
    """M11."""
    df = standardize(raw, tax, [MappingRule("supplier_name", "supplier", "__name", "trim"),
                                MappingRule("supplier_region", "region", "__region", "blank_null"),
                                MappingRule("country", "country", "__country", "blank_null")])
    return df.select(
        t("supplier_id").alias("supplier_id"),
        F.col("__name").alias("supplier_name"),
        t("supplier_name").alias("supplier_name_raw"),
        F.col("__region").alias("supplier_region"),
        F.col("__country").alias("country"),
        y_flag("preferred_flag").alias("is_preferred"),
        casts.positive_int("lead_time_days").alias("lead_time_days"),
        y_flag("active_flag").alias("is_active"))


def stg_purchase_orders(raw: DataFrame, tax: DataFrame, real=casts.alpha_reject_real) -> DataFrame:
    """M12."""
    df = standardize(raw, tax, [MappingRule("product_sku", "sku_normalization", "__sku", "trim"),
                                MappingRule("warehouse_id", "warehouse_normalization", "__wh", "trim")])
    return df.select(
        t("po_id").alias("po_id"),
        casts.unguarded_int("po_line_id").alias("po_line_id"),
        t("supplier_id").alias("supplier_id"),
        F.col("__sku").alias("product_sku"),
        t("product_sku").alias("product_sku_raw"),
        F.col("__wh").alias("warehouse_id"),
        nb("po_create_date").alias("po_create_date"),
        nb("requested_delivery_date").alias("requested_delivery_date"),
        nb("received_date").alias("received_date"),
        lower_code("po_status").alias("po_status"),
        casts.strict_int("ordered_qty").alias("ordered_qty"),
        casts.strict_int("received_qty").alias("received_qty"),
        real("unit_cost").alias("unit_cost"),
        upper_code("currency").alias("currency"))


def stg_shipments(raw: DataFrame, tax: DataFrame, real=casts.alpha_reject_real) -> DataFrame:
    """M13."""
    df = standardize(raw, tax, [MappingRule("product_sku", "sku_normalization", "__sku", "trim"),
                                MappingRule("warehouse_id", "warehouse_normalization", "__wh", "trim")])
    return df.select(
        t("shipment_id").alias("shipment_id"),
        t("order_id").alias("order_id"),
        t("customer_id").alias("customer_id"),
        F.col("__sku").alias("product_sku"),
        t("product_sku").alias("product_sku_raw"),
        F.col("__wh").alias("warehouse_id"),
        t("carrier_id").alias("carrier_id"),
        nb("ship_date").alias("ship_date"),
        nb("delivery_date").alias("delivery_date"),
        lower_code("shipment_status").alias("shipment_status"),
        casts.strict_int("shipped_units").alias("shipped_units"),
        real("freight_cost").alias("freight_cost"),
        upper_code("currency").alias("currency"),
        nb("tracking_number").alias("tracking_number"))


def stg_shipment_events(raw: DataFrame) -> DataFrame:
    """M14."""
    return raw.select(
        t("shipment_id").alias("shipment_id"),
        dates.timestamp_shape("event_timestamp").alias("event_timestamp"),
        t("event_timestamp").alias("event_timestamp_raw"),
        upper_code("event_type").alias("event_type"),
        nb("event_location").alias("event_location"),
        lower_code("event_status").alias("event_status"))


def stg_carrier_performance(raw: DataFrame, tax: DataFrame) -> DataFrame:
    """M15."""
    df = standardize(raw, tax, [MappingRule("region", "region", "__region", "blank_null")])
    return df.select(
        t("carrier_id").alias("carrier_id"),
        t("carrier_name").alias("carrier_name"),
        nb("service_level").alias("service_level"),
        F.col("__region").alias("region"),
        casts.positive_int("contracted_transit_days").alias("contracted_transit_days"),
        y_flag("active_flag").alias("is_active"))


__all__ = [n for n in dir() if n.startswith("stg_")] + ["lookup"]
