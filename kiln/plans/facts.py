"""Facts: dedup at the stated grain, foreign-key flags (orphans kept), measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.measures import money, neg_flag, ratio, z
from ..functions.text import nb
from ..operators.dedup import By, keep_best
from ..operators.keys import best_by_absence, with_known_flag
from ..operators.sizing import JoinSide, unwrap

FULFILLMENT_STATUSES = ["fully_fulfilled", "partially_fulfilled", "unfulfilled", "cancelled", "open",
                        "units_unknown"]


def fulfillment_status(status, ordered, shipped):
    shipped0 = z(shipped)
    return (F.when(F.col(status) == "cancelled", F.lit("cancelled"))
            .when(F.col(status) == "open", F.lit("open"))
            .when(F.col(ordered).isNull(), F.lit("units_unknown"))
            .when(shipped0 >= F.col(ordered), F.lit("fully_fulfilled"))
            .when(shipped0 > 0, F.lit("partially_fulfilled"))
            .otherwise(F.lit("unfulfilled")))


def fct_sales_orders(stg: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """M21. Grain: order line (order_id, order_line_id, product_sku)."""
    d, known = best_by_absence(stg, ["order_id", "order_line_id", "product_sku"],
                               [By("ordered_units", desc=True), By("customer_id")], {
        "customer_id": (dim_customer, "customer_id"), "product_sku": (dim_product, "product_sku")},
        drop=("product_sku_raw",))
    d = with_known_flag(d, "customer_id", known["customer_id"], "customer_id", "is_known_customer")
    d = with_known_flag(d, "product_sku", known["product_sku"], "product_sku", "is_known_product")
    return d.select(
        "order_id", "order_line_id", "customer_id", "product_sku", "is_known_customer", "is_known_product",
        "order_date", "requested_ship_date", "ship_date", "order_status", "ordered_units", "shipped_units",
        ratio(z("shipped_units"), "ordered_units", 4,
              guard=F.col("ordered_units").isNull() | (F.col("ordered_units") == 0)).alias("fill_rate"),
        fulfillment_status("order_status", "ordered_units", "shipped_units").alias("fulfillment_status"),
        dates.day_diff("ship_date", "order_date").alias("days_to_ship"),
        dates.before_flag("ship_date", "order_date").alias("has_ship_before_order_flag"),
        "unit_price",
        money("unit_price", "shipped_units").alias("gross_revenue"),
        "currency", "cancel_reason")


def fct_retail_pos(stg: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """M22. Grain: retailer x week x SKU."""
    d, known = best_by_absence(stg, ["retailer_id", "week_start_date", "product_sku"], [By("pos_units", desc=True)], {
        "retailer_id": (dim_customer, "customer_id"), "product_sku": (dim_product, "product_sku")},
        drop=("product_sku_raw",))
    d = with_known_flag(d, "retailer_id", known["retailer_id"], "customer_id", "is_known_retailer")
    d = with_known_flag(d, "product_sku", known["product_sku"], "product_sku", "is_known_product")
    return d.select(
        "retailer_id", "week_start_date", "product_sku", "is_known_retailer", "is_known_product",
        "store_count", "pos_units", "pos_sales", "on_hand_units", "on_order_units",
        ratio(z("pos_units"), "on_hand_units", 4).alias("sell_through_rate"),
        ratio(z("pos_units"), "store_count", 4).alias("pos_units_per_store"),
        neg_flag("pos_units").alias("has_negative_pos_flag"),
        neg_flag("on_hand_units").alias("has_negative_on_hand_flag"),
        "currency", "feed_date")


def fct_inventory_snapshots(stg: DataFrame, dim_product: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    """M23. Grain: snapshot date x warehouse x SKU."""
    d, known = best_by_absence(stg, ["snapshot_date", "warehouse_id", "product_sku"], [By("on_hand_qty", desc=True)], {
        "product_sku": (dim_product, "product_sku"), "warehouse_id": (dim_warehouse, "warehouse_id")},
        drop=("product_sku_raw", "warehouse_id_raw"))
    d = with_known_flag(d, "product_sku", known["product_sku"], "product_sku", "is_known_product")
    d = with_known_flag(d, "warehouse_id", known["warehouse_id"], "warehouse_id", "is_known_warehouse")
    not_prelaunch = F.coalesce(F.col("inventory_status"), F.lit("")) != "prelaunch"
    return d.select(
        "snapshot_date", "warehouse_id", "product_sku", "is_known_product", "is_known_warehouse",
        "on_hand_qty", "allocated_qty", "available_qty", "in_transit_qty", "safety_stock_qty",
        "unit_of_measure", "inventory_status",
        neg_flag("on_hand_qty").alias("has_negative_on_hand_flag"),
        neg_flag("available_qty").alias("has_negative_available_flag"),
        F.when((z("available_qty") <= 0) & not_prelaunch, 1).otherwise(0).alias("is_stockout"),
        F.when(z("allocated_qty") > z("on_hand_qty"), 1).otherwise(0).alias("is_oversold"),
        F.when((z("available_qty") < z("safety_stock_qty")) & not_prelaunch, 1).otherwise(0)
        .alias("is_below_safety_stock"))


def fct_purchase_orders(stg: DataFrame, dim_supplier: DataFrame, dim_product: DataFrame,
                        dim_warehouse: DataFrame, as_of) -> DataFrame:
    """M24. Grain: PO line. ``as_of``: the instant overdue is judged against."""
    d, known = best_by_absence(stg, ["po_id", "po_line_id", "product_sku"],
                               [By("ordered_qty", desc=True), By("supplier_id")], {
        "supplier_id": (dim_supplier, "supplier_id"), "product_sku": (dim_product, "product_sku"),
        "warehouse_id": (dim_warehouse, "warehouse_id")}, drop=("product_sku_raw",))
    d = with_known_flag(d, "supplier_id", known["supplier_id"], "supplier_id", "is_known_supplier")
    d = with_known_flag(d, "product_sku", known["product_sku"], "product_sku", "is_known_product")
    d = with_known_flag(d, "warehouse_id", known["warehouse_id"], "warehouse_id", "is_known_warehouse")
    return d.select(
        "po_id", "po_line_id", "supplier_id", "product_sku", "warehouse_id",
        "is_known_supplier", "is_known_product", "is_known_warehouse",
        "po_create_date", "requested_delivery_date", "received_date", "po_status", "ordered_qty", "received_qty",
        (F.col("received_qty") - F.col("ordered_qty")).alias("received_qty_variance"),
        dates.day_diff("received_date", "po_create_date").alias("actual_lead_time_days"),
        dates.before_flag("received_date", "po_create_date").alias("has_received_before_created_flag"),
        dates.overdue_flag("po_status", "received_date", "requested_delivery_date", as_of).alias("is_overdue"),
        "unit_cost",
        money("unit_cost", "received_qty").alias("received_cost"),
        "currency")


def fct_shipments(stg: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_warehouse: DataFrame,
                  dim_carrier: DataFrame, fct_sales: DataFrame) -> DataFrame:
    """M25. Grain: shipment. Order membership is a fact-to-fact check on distinct order ids."""
    d, known = best_by_absence(stg, ["shipment_id"],
                               [By("shipped_units", desc=True), By("tracking_number", desc=True)], {
        "customer_id": (dim_customer, "customer_id"), "product_sku": (dim_product, "product_sku"),
        "warehouse_id": (dim_warehouse, "warehouse_id")}, {"order_id": (fct_sales, "order_id")}, drop=("product_sku_raw",))
    d = with_known_flag(d, "customer_id", known["customer_id"], "customer_id", "is_known_customer")
    d = with_known_flag(d, "product_sku", known["product_sku"], "product_sku", "is_known_product")
    d = with_known_flag(d, "warehouse_id", known["warehouse_id"], "warehouse_id", "is_known_warehouse")
    d = with_known_flag(d, "carrier_id", dim_carrier, "carrier_id", "is_known_carrier",
                        carry=["contracted_transit_days"])
    d = with_known_flag(d, "order_id", known["order_id"], "order_id", "is_known_order", distinct=True)
    transit = dates.day_diff("delivery_date", "ship_date")
    return d.select(
        "shipment_id", "order_id", "customer_id", "product_sku", "warehouse_id", "carrier_id",
        "is_known_customer", "is_known_product", "is_known_warehouse", "is_known_carrier", "is_known_order",
        "ship_date", "delivery_date", "shipment_status", "shipped_units", "freight_cost", "currency",
        "tracking_number",
        transit.alias("actual_transit_days"),
        "contracted_transit_days",
        dates.on_time_flag("delivery_date", "ship_date", "contracted_transit_days").alias("is_on_time"),
        dates.before_flag("delivery_date", "ship_date").alias("has_delivery_before_ship_flag"),
        F.when(nb("tracking_number").isNull(), 1).otherwise(0).alias("is_missing_tracking"))


def fct_marketing_performance(stg: DataFrame, campaigns, dim_product) -> DataFrame:
    """M26. Grain: date x campaign x platform, enriched with campaign attributes.

    The campaign side is not deduplicated (a repeated campaign id multiplies
    rows, as in the source model); the `campaign_id_repeats` query reports repeated ids.
    """
    d = keep_best(stg, ["performance_date", "campaign_id", "platform"], [By("impressions", desc=True)])
    if isinstance(campaigns, JoinSide):
        campaigns = campaigns.pick(["campaign_id", "campaign_name", "product_sku", "channel", "region", "objective"])
    campaigns, finish = unwrap(campaigns)
    camp = finish(campaigns.select(F.col("campaign_id").alias("c_campaign_id"), "campaign_name",
                                   F.col("product_sku"), "channel", "region", "objective"))
    j = d.join(camp, d["campaign_id"] == camp["c_campaign_id"], "left")
    j = j.withColumn("is_known_campaign", F.when(F.col("c_campaign_id").isNotNull(), 1).otherwise(0))
    j = with_known_flag(j, "product_sku", dim_product, "product_sku", "is_known_product")
    return j.select(
        "performance_date", "campaign_id", "platform", "campaign_name", "product_sku", "channel", "region",
        "objective", "is_known_campaign", "is_known_product",
        "impressions", "clicks", "video_views", "spend", "conversions", "revenue", "currency",
        ratio(z("clicks"), "impressions", 6).alias("ctr"),
        ratio(z("spend"), "clicks", 4).alias("cpc"),
        F.when(z("impressions") > 0,
               F.round(z("spend").cast("double") / F.col("impressions") * 1000, 4)).alias("cpm"),
        ratio(z("revenue"), "spend", 4).alias("roas"),
        neg_flag("clicks").alias("has_negative_clicks_flag"))
