"""The gold layer's declared expectations (70 checks) and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.expectations import AcceptedValues, NotNull, Relationship, Suite, Unique, enforce, run, suite_models

# The accepted vocabularies of the declared tests.
MAPPING_TYPES = ("sku_normalization", "warehouse_normalization", "channel", "region", "country", "platform",
                 "supplier", "status", "uom")
MAPPING_SOURCES = ("source_taxonomy", "discovered_gap")
SOURCE_SYSTEMS = ("PLM", "ERP")
LIFECYCLE = ("active", "discontinued", "inactive", "launched")
ORDER_STATUS = ("shipped", "partial", "cancelled", "open")
PO_STATUS = ("open", "closed")
FULFILLMENT = ("fully_fulfilled", "partially_fulfilled", "unfulfilled", "cancelled", "open", "units_unknown")
SUPPLY_HEALTH = ("stockout", "low_coverage", "healthy", "overstock", "no_velocity_data")
FLAG = (0, 1)


def _nn(model, *cols):
    return [NotNull(model, c) for c in cols]


def _rel(model, col, to, field, flag):
    return Relationship(model, col, to, field, where=f"{flag} = 1")


STAGING_CHECKS = [
    *_nn("stg_taxonomy_lookup", "mapping_type"), AcceptedValues("stg_taxonomy_lookup", "mapping_type", MAPPING_TYPES),
    *_nn("stg_taxonomy_lookup", "raw_value", "standard_value"),
    AcceptedValues("stg_taxonomy_lookup", "mapping_source", MAPPING_SOURCES),
    *_nn("stg_products", "product_sku", "source_system"),
    AcceptedValues("stg_products", "source_system", SOURCE_SYSTEMS),
    AcceptedValues("stg_products", "lifecycle_status", LIFECYCLE),
    *_nn("stg_product_hierarchy", "product_sku"),
    *_nn("stg_customers", "customer_id"),
    *_nn("stg_sales_orders", "order_id"), AcceptedValues("stg_sales_orders", "order_status", ORDER_STATUS),
    *_nn("stg_retail_pos", "retailer_id"),
    *_nn("stg_marketing_campaigns", "campaign_id"),
    *_nn("stg_marketing_performance", "campaign_id"),
    *_nn("stg_inventory_snapshots", "warehouse_id", "product_sku"),
    *_nn("stg_warehouse_locations", "warehouse_id"),
    *_nn("stg_suppliers", "supplier_id"),
    *_nn("stg_purchase_orders", "po_id"), AcceptedValues("stg_purchase_orders", "po_status", PO_STATUS),
    *_nn("stg_shipments", "shipment_id"),
    *_nn("stg_shipment_events", "shipment_id"),
    *_nn("stg_carrier_performance", "carrier_id"),
]

MART_CHECKS = [
    NotNull("dim_product", "product_sku"), Unique("dim_product", "product_sku"), NotNull("dim_product", "product_name"),
    AcceptedValues("dim_product", "lifecycle_status", LIFECYCLE),
    AcceptedValues("dim_product", "is_in_plm", FLAG), AcceptedValues("dim_product", "is_in_erp", FLAG),
    AcceptedValues("dim_product", "is_in_hierarchy", FLAG),
    NotNull("dim_customer", "customer_id"), Unique("dim_customer", "customer_id"),
    AcceptedValues("dim_customer", "is_active", FLAG),
    NotNull("dim_supplier", "supplier_id"), Unique("dim_supplier", "supplier_id"),
    AcceptedValues("dim_supplier", "is_preferred", FLAG),
    NotNull("dim_warehouse", "warehouse_id"), Unique("dim_warehouse", "warehouse_id"),
    NotNull("dim_carrier", "carrier_id"), Unique("dim_carrier", "carrier_id"),
    NotNull("fct_sales_orders", "order_id"),
    _rel("fct_sales_orders", "customer_id", "dim_customer", "customer_id", "is_known_customer"),
    _rel("fct_sales_orders", "product_sku", "dim_product", "product_sku", "is_known_product"),
    AcceptedValues("fct_sales_orders", "fulfillment_status", FULFILLMENT),
    NotNull("fct_retail_pos", "retailer_id"),
    _rel("fct_retail_pos", "product_sku", "dim_product", "product_sku", "is_known_product"),
    NotNull("fct_purchase_orders", "po_id"),
    _rel("fct_purchase_orders", "supplier_id", "dim_supplier", "supplier_id", "is_known_supplier"),
    _rel("fct_purchase_orders", "product_sku", "dim_product", "product_sku", "is_known_product"),
    _rel("fct_purchase_orders", "warehouse_id", "dim_warehouse", "warehouse_id", "is_known_warehouse"),
    AcceptedValues("fct_purchase_orders", "po_status", PO_STATUS),
    NotNull("fct_shipments", "shipment_id"),
    _rel("fct_shipments", "carrier_id", "dim_carrier", "carrier_id", "is_known_carrier"),
    _rel("fct_inventory_snapshots", "warehouse_id", "dim_warehouse", "warehouse_id", "is_known_warehouse"),
    _rel("fct_inventory_snapshots", "product_sku", "dim_product", "product_sku", "is_known_product"),
    NotNull("fct_marketing_performance", "campaign_id"),
    NotNull("mart_inventory_weeks_of_supply", "product_sku"), Unique("mart_inventory_weeks_of_supply", "product_sku"),
    AcceptedValues("mart_inventory_weeks_of_supply", "supply_health_status", SUPPLY_HEALTH),
    NotNull("mart_campaign_summary", "campaign_id"),
    NotNull("mart_product_performance", "product_sku"), Unique("mart_product_performance", "product_sku"),
]

DQ_CHECKS = [NotNull(m, c) for m in ("dq_orphan_records", "dq_date_violations", "dq_value_violations")
             for c in ("source_model", "issue_type")]

SUITE = Suite(STAGING_CHECKS + MART_CHECKS + DQ_CHECKS)
assert len(SUITE.checks) == 70


def expectation_results(tables: dict[str, DataFrame], suite: Suite = SUITE) -> DataFrame:
    """(model_name, column_name, test_name, failures) for every declared check; 0 failures = pass."""
    return run(tables, suite)


def check_models(suite: Suite = SUITE) -> list[str]:
    return suite_models(suite)


def enforce_expectations(tables: dict[str, DataFrame], suite: Suite = SUITE) -> None:
    """The gate of a build: raise ``ExpectationError`` when any check fails."""
    enforce(expectation_results(tables, suite))
