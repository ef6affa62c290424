"""Raw source tables: all-text schemas, readers, and the sinks for built tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Columns each raw extract must provide (read as text; extra columns are ignored).
RAW_COLUMNS: dict[str, list[str]] = {
    "taxonomy_lookup_raw": ["mapping_type", "raw_value", "standard_value", "domain", "active_flag",
                            "effective_start_date", "effective_end_date"],
    "products_raw": ["source_system", "product_sku", "alt_sku", "product_name", "brand_family",
                     "franchise", "category", "sub_category", "age_grade", "lifecycle_status",
                     "launch_date", "discontinue_date", "unit_cost", "list_price", "case_pack_qty",
                     "unit_of_measure", "updated_at"],
    "product_hierarchy_raw": ["product_sku", "effective_start_date", "effective_end_date", "division",
                              "brand_family_std", "franchise_std", "category_std", "sub_category_std",
                              "status_std"],
    "customers_raw": ["customer_id", "customer_name", "channel", "region", "country", "tier",
                      "active_flag", "parent_customer_id"],
    "sales_orders_raw": ["order_id", "order_line_id", "customer_id", "product_sku", "order_date",
                         "requested_ship_date", "ship_date", "order_status", "ordered_units",
                         "shipped_units", "unit_price", "currency", "cancel_reason"],
    "retail_pos_raw": ["retailer_id", "week_start_date", "product_sku", "store_count", "pos_units",
                       "pos_sales", "on_hand_units", "on_order_units", "currency", "feed_date"],
    "marketing_campaigns_raw": ["campaign_id", "campaign_name", "platform", "campaign_start_date",
                                "campaign_end_date", "product_sku", "channel", "region", "objective",
                                "budget", "currency", "taxonomy_code"],
    "marketing_performance_raw": ["performance_date", "campaign_id", "platform", "impressions", "clicks",
                                  "video_views", "spend", "conversions", "revenue", "currency"],
    "inventory_snapshots_raw": ["snapshot_date", "warehouse_id", "product_sku", "on_hand_qty",
                                "allocated_qty", "available_qty", "in_transit_qty", "safety_stock_qty",
                                "unit_of_measure", "inventory_status"],
    "warehouse_locations_raw": ["warehouse_id", "warehouse_name", "warehouse_type", "region", "country",
                                "timezone", "active_flag"],
    "suppliers_raw": ["supplier_id", "supplier_name", "supplier_region", "country", "preferred_flag",
                      "lead_time_days", "active_flag"],
    "purchase_orders_raw": ["po_id", "po_line_id", "supplier_id", "product_sku", "warehouse_id",
                            "po_create_date", "requested_delivery_date", "received_date", "po_status",
                            "ordered_qty", "received_qty", "unit_cost", "currency"],
    "shipments_raw": ["shipment_id", "order_id", "customer_id", "product_sku", "warehouse_id", "carrier_id",
                      "ship_date", "delivery_date", "shipment_status", "shipped_units", "freight_cost",
                      "currency", "tracking_number"],
    "shipment_events_raw": ["shipment_id", "event_timestamp", "event_type", "event_location", "event_status"],
    "carrier_performance_raw": ["carrier_id", "carrier_name", "service_level", "region",
                                "contracted_transit_days", "active_flag"],
}

RAW_TABLES = list(RAW_COLUMNS)


def raw_schema(name: str) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS[name]])


def conform(name: str, df: DataFrame) -> DataFrame:
    """Select the declared columns of a raw table as text (missing ones as NULL)."""
    have = set(df.columns)
    return df.select(*[(F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c)
                       for c in RAW_COLUMNS[name]])


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None,
             tables: list[str] | None = None) -> dict[str, DataFrame]:
    """Read raw extracts (default: all 15) from ``path/<name>`` (parquet, csv, json, orc...).

    Text formats are read with the explicit all-string schema (never inferred),
    so '007' stays '007' and a stray letter never fails the load.
    """
    out = {}
    for name in tables or RAW_TABLES:
        r = spark.read.format(fmt).options(**(options or {}))
        if fmt in ("csv", "json"):
            r = r.schema(raw_schema(name))
        out[name] = conform(name, r.load(f"{path.rstrip('/')}/{name}"))
    return out


def read_tables(spark: SparkSession, tables: dict[str, str]) -> dict[str, DataFrame]:
    """Catalog tables (``spark.table``) named per raw extract."""
    return {name: conform(name, spark.table(tbl)) for name, tbl in tables.items()}
