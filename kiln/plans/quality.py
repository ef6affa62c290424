"""Data-quality reports (orphans, date logic, values) as long-format DataFrames.

Rules over one table are evaluated in one pass (see ``operators.findings``);
the per-table results are unioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import nb, or_null_text, record_key
from ..operators.findings import Rule, evaluate, union_all
from ..operators.keys import orphans
from ..operators.scd import overlapping_pairs

FINDING = ["source_model", "issue_type", "record_id", "offending_value", "description"]
VIOLATION = ["source_model", "issue_type", "record_id", "description"]


def _msg(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def _lit(x: str):
    return F.lit(x)


def orphan_rules() -> dict[str, list[Rule]]:
    f = F.col
    return {
        "fct_sales_orders": [
            Rule("fct_sales_orders", "unknown_customer", f("is_known_customer") == 0, f("order_id"),
                 _lit("Customer ID not found in dim_customer"), f("customer_id"), "quarantine"),
            Rule("fct_sales_orders", "unknown_product", f("is_known_product") == 0, f("order_id"),
                 _lit("Product SKU not found in dim_product"), f("product_sku"), "quarantine")],
        "fct_purchase_orders": [
            Rule("fct_purchase_orders", "unknown_supplier", f("is_known_supplier") == 0, f("po_id"),
                 _lit("Supplier ID not found in dim_supplier"), f("supplier_id"), "quarantine"),
            Rule("fct_purchase_orders", "unknown_product", f("is_known_product") == 0, f("po_id"),
                 _lit("Product SKU not found in dim_product"), f("product_sku"), "quarantine"),
            Rule("fct_purchase_orders", "unknown_warehouse", f("is_known_warehouse") == 0, f("po_id"),
                 _lit("Warehouse ID not found in dim_warehouse"), f("warehouse_id"), "quarantine")],
        "fct_shipments": [
            Rule("fct_shipments", "unknown_order", f("is_known_order") == 0, f("shipment_id"),
                 _lit("Order ID not found in fct_sales_orders"), f("order_id"), "quarantine")],
        "fct_marketing_performance": [
            Rule("fct_marketing_performance", "unknown_campaign", f("is_known_campaign") == 0,
                 record_key("performance_date", "campaign_id"),
                 _lit("Campaign ID not found in stg_marketing_campaigns"), f("campaign_id"), "quarantine")],
    }


#: the facts that ``extended_orphan_rules`` reports on
EXTENDED_FACTS = ("fct_retail_pos", "fct_inventory_snapshots", "fct_shipments")


def extended_orphan_rules() -> dict[str, list[Rule]]:
    """Flags that the source's report leaves out: POS, inventory and the other shipment keys."""
    f = F.col

    def rule(model, issue, flag, record, value, dim):
        return Rule(model, issue, f(flag) == 0, record, _lit(f"{value} not found in {dim}"), f(value), "quarantine")

    pos = record_key("retailer_id", "product_sku", "week_start_date")
    inv = record_key("warehouse_id", "product_sku", "snapshot_date")
    ship = f("shipment_id")
    return {
        "fct_retail_pos": [
            rule("fct_retail_pos", "unknown_retailer", "is_known_retailer", pos, "retailer_id", "dim_customer"),
            rule("fct_retail_pos", "unknown_product", "is_known_product", pos, "product_sku", "dim_product")],
        "fct_inventory_snapshots": [
            rule("fct_inventory_snapshots", "unknown_product", "is_known_product", inv, "product_sku", "dim_product"),
            rule("fct_inventory_snapshots", "unknown_warehouse", "is_known_warehouse", inv, "warehouse_id",
                 "dim_warehouse")],
        "fct_shipments": [
            rule("fct_shipments", "unknown_customer", "is_known_customer", ship, "customer_id", "dim_customer"),
            rule("fct_shipments", "unknown_product", "is_known_product", ship, "product_sku", "dim_product"),
            rule("fct_shipments", "unknown_warehouse", "is_known_warehouse", ship, "warehouse_id", "dim_warehouse"),
            rule("fct_shipments", "unknown_carrier", "is_known_carrier", ship, "carrier_id", "dim_carrier")],
    }


def dq_orphan_records(fct_sales: DataFrame, fct_po: DataFrame, fct_ship: DataFrame, fct_mkt: DataFrame,
                      stg_campaigns: DataFrame, stg_hierarchy: DataFrame, dim_product: DataFrame,
                      extended: dict[str, DataFrame] | None = None) -> DataFrame:
    """M30. Foreign-key violations (orphans are kept in the facts, reported here).

    ``extended`` names the facts of ``extended_orphan_rules`` to report as well.
    """
    tables = {"fct_sales_orders": fct_sales, "fct_purchase_orders": fct_po, "fct_shipments": fct_ship,
              "fct_marketing_performance": fct_mkt}
    parts = [evaluate(tables[name], rules) for name, rules in orphan_rules().items()]
    camp = orphans(stg_campaigns, "product_sku", dim_product, "product_sku", keep_null_keys=False).select(
        _lit("stg_marketing_campaigns").alias("source_model"), _lit("unknown_product").alias("issue_type"),
        F.col("campaign_id").alias("record_id"), F.col("product_sku").alias("offending_value"),
        _lit("Product SKU not found in dim_product").alias("description"))
    hier = orphans(stg_hierarchy, "product_sku", dim_product, "product_sku", keep_null_keys=True).select(
        _lit("stg_product_hierarchy").alias("source_model"), _lit("hierarchy_without_product").alias("issue_type"),
        F.col("product_sku").alias("record_id"), F.col("product_sku").alias("offending_value"),
        _lit("Product SKU exists in hierarchy but not in product master").alias("description"))
    more = [evaluate(extended[name], rules) for name, rules in extended_orphan_rules().items()] if extended else []
    return union_all(parts + [camp, hier] + more).select(*FINDING)


def date_rules() -> dict[str, list[Rule]]:
    f = F.col
    return {
        "fct_sales_orders": [
            Rule("fct_sales_orders", "ship_before_order", f("has_ship_before_order_flag") == 1, f("order_id"),
                 _msg("order_date=", or_null_text("order_date"), ", ship_date=", or_null_text("ship_date")),
                 policy="preserve_and_flag")],
        "fct_purchase_orders": [
            Rule("fct_purchase_orders", "received_before_created", f("has_received_before_created_flag") == 1,
                 f("po_id"), _msg("create_date=", or_null_text("po_create_date"), ", received_date=",
                                  or_null_text("received_date"))),
            Rule("fct_purchase_orders", "overdue_po", f("is_overdue") == 1, f("po_id"),
                 _msg("requested=", or_null_text("requested_delivery_date"), ", received=",
                      or_null_text("received_date"), ", status=", or_null_text("po_status")))],
        "fct_shipments": [
            Rule("fct_shipments", "delivery_before_ship", f("has_delivery_before_ship_flag") == 1,
                 f("shipment_id"), _msg("ship_date=", or_null_text("ship_date"), ", delivery_date=",
                                        or_null_text("delivery_date"))),
            Rule("fct_shipments", "late_delivery", f("is_on_time") == 0, f("shipment_id"),
                 _msg("actual_transit_days=", or_null_text("actual_transit_days"), ", contracted=",
                      or_null_text("contracted_transit_days")))],
        "stg_shipment_events": [
            Rule("stg_shipment_events", "bad_timestamp",
                 f("event_timestamp").isNull() & nb("event_timestamp_raw").isNotNull(),
                 record_key("shipment_id", "event_type"),
                 _msg("raw_timestamp=", or_null_text("event_timestamp_raw")), policy="coerce_and_flag")],
    }


def scd_overlaps(stg_hierarchy: DataFrame, stage=None) -> DataFrame:
    """Overlapping effective ranges of one SKU (flag, don't resolve); ``stage`` writes the join's steps."""
    pairs = overlapping_pairs(stg_hierarchy, "product_sku", stage=stage)
    h1, h2 = "h1.", "h2."
    desc = F.concat(
        F.lit("overlap: range1=["), F.col(h1 + "effective_start_date"), F.lit(","),
        F.coalesce(F.col(h1 + "effective_end_date"), F.lit("open")), F.lit("] range2=["),
        F.col(h2 + "effective_start_date"), F.lit(","), F.coalesce(F.col(h2 + "effective_end_date"), F.lit("open")),
        F.lit("]"))
    return pairs.select(F.lit("stg_product_hierarchy").alias("source_model"), F.lit("scd_overlap").alias("issue_type"),
                        F.col(h1 + "product_sku").alias("record_id"), desc.alias("description"))


def dq_date_violations(fct_sales: DataFrame, fct_po: DataFrame, fct_ship: DataFrame,
                       stg_hierarchy: DataFrame, stg_events: DataFrame, stage=None) -> DataFrame:
    """M31. Date-logic violations."""
    tables = {"fct_sales_orders": fct_sales, "fct_purchase_orders": fct_po, "fct_shipments": fct_ship,
              "stg_shipment_events": stg_events}
    parts = [evaluate(tables[n], rules, with_offending=False) for n, rules in date_rules().items()]
    return union_all(parts + [scd_overlaps(stg_hierarchy, stage)]).select(*VIOLATION)


def value_rules() -> dict[str, list[Rule]]:
    f = F.col
    inv_id = record_key("warehouse_id", "product_sku", "snapshot_date")
    pos_id = record_key("retailer_id", "product_sku", "week_start_date")
    return {
        "fct_inventory_snapshots": [
            Rule("fct_inventory_snapshots", "negative_on_hand", f("has_negative_on_hand_flag") == 1, inv_id,
                 _msg("on_hand_qty=", f("on_hand_qty").cast("string"))),
            Rule("fct_inventory_snapshots", "oversold", f("is_oversold") == 1, inv_id, _lit("allocated > on_hand")),
            Rule("fct_inventory_snapshots", "stockout", f("is_stockout") == 1, inv_id,
                 _lit("available_qty<=0 and status!=prelaunch")),
            Rule("fct_inventory_snapshots", "below_safety_stock", f("is_below_safety_stock") == 1, inv_id,
                 _lit("available<safety_stock and status!=prelaunch"))],
        "fct_retail_pos": [
            Rule("fct_retail_pos", "negative_pos_units", f("has_negative_pos_flag") == 1, pos_id,
                 _msg("pos_units=", f("pos_units").cast("string"))),
            Rule("fct_retail_pos", "negative_retail_on_hand", f("has_negative_on_hand_flag") == 1, pos_id,
                 _msg("on_hand_units=", f("on_hand_units").cast("string")))],
        "fct_marketing_performance": [
            Rule("fct_marketing_performance", "negative_clicks", f("has_negative_clicks_flag") == 1,
                 record_key("campaign_id", "performance_date"), _msg("clicks=", f("clicks").cast("string")))],
        "fct_sales_orders": [
            Rule("fct_sales_orders", "invalid_ordered_units", f("fulfillment_status") == "units_unknown",
                 f("order_id"), _lit("ordered_units was non-numeric in source (now NULL)"), policy="coerce_and_flag")],
        "fct_shipments": [
            Rule("fct_shipments", "missing_tracking", f("is_missing_tracking") == 1, f("shipment_id"),
                 _lit("tracking_number is null"))],
    }


def dq_value_violations(fct_inv: DataFrame, fct_pos: DataFrame, fct_mkt: DataFrame, fct_sales: DataFrame,
                        fct_ship: DataFrame) -> DataFrame:
    """M32. Value and business-rule violations."""
    tables = {"fct_inventory_snapshots": fct_inv, "fct_retail_pos": fct_pos, "fct_marketing_performance": fct_mkt,
              "fct_sales_orders": fct_sales, "fct_shipments": fct_ship}
    parts = [evaluate(tables[n], rules, with_offending=False) for n, rules in value_rules().items()]
    return union_all(parts).select(*VIOLATION)


# Policies of the findings that are no row rules (see the joins above).
JOIN_POLICIES = [("stg_marketing_campaigns", "unknown_product", "quarantine"),
                 ("stg_product_hierarchy", "hierarchy_without_product", "quarantine"),
                 ("stg_product_hierarchy", "scd_overlap", "flag_dont_resolve")]


def policy_rows() -> list[tuple[str, str, str]]:
    """(source_model, issue_type, policy) for every data-quality rule."""
    rules = [r for group in (orphan_rules(), date_rules(), value_rules()) for rs in group.values() for r in rs]
    return [(r.source_model, r.issue_type, r.policy) for r in rules] + JOIN_POLICIES


def policy_table(spark) -> DataFrame:
    """The rule metadata as a small constant relation (one row per rule)."""
    from .staging import literal_rows
    return literal_rows(spark, policy_rows(), ["source_model", "issue_type", "policy"])


def findings_by_policy(orphans: DataFrame, dates: DataFrame, values: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Finding counts per handling policy and issue (the rule table is bounded by the rule count), and per ``by``."""
    found = union_all([df.select("source_model", "issue_type", *by) for df in (orphans, dates, values)])
    found = found.groupBy("source_model", "issue_type", *by).agg(F.count(F.lit(1)).alias("n_findings"))
    pol = F.broadcast(policy_table(orphans.sparkSession))
    return (found.join(pol, ["source_model", "issue_type"], "left")
            .groupBy("policy", "source_model", "issue_type", *by).agg(F.sum("n_findings").alias("n_findings")))
