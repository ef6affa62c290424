"""Published examples of the source project, rebuilt as tiny raw extracts and run end to end."""

import pytest

from kiln.plans.dag import GoldLayer
from kiln.sources.raw import RAW_COLUMNS, raw_schema


def _raw(spark, rows: dict):
    out = {}
    for name, cols in RAW_COLUMNS.items():
        data = [tuple(r.get(c) for c in cols) for r in rows.get(name, [])]
        out[name] = spark.createDataFrame(data, raw_schema(name))
    return out


def _prod(sku, name, status):
    return dict(source_system="PLM", product_sku=sku, product_name=name, brand_family="B", franchise="F",
                category="C", lifecycle_status=status, launch_date="01/15/2024", unit_cost="5.00", list_price="9.99",
                case_pack_qty="6", unit_of_measure="ea")


@pytest.fixture(scope="module")
def layer(spark):
    rows = {
        "taxonomy_lookup_raw": [dict(mapping_type="uom", raw_value="ea", standard_value="EA", active_flag="Y")],
        "products_raw": [_prod("SKU-1004", "Product 1004", "active"),
                         _prod("SKU-1005", "Product 1005", "active"),
                         _prod("SKU-1006", "Product 1006", "discontinued"),
                         _prod("SKU-1007", "Product 1007", "launched")],
        "product_hierarchy_raw": [dict(product_sku="sku1007", effective_start_date="2024-07-01", division="Toys")],
        "customers_raw": [dict(customer_id="CUST-001", customer_name="Retailer One", region="Europe",
                               tier="Strategic", active_flag="Y")],
        "suppliers_raw": [dict(supplier_id="SUP-001", supplier_name="Supplier One", lead_time_days="30",
                               preferred_flag="Y", active_flag="Y")],
        "warehouse_locations_raw": [dict(warehouse_id="WH-001", warehouse_name="Main", warehouse_type="DC",
                                         timezone="America/New_York", active_flag="Y")],
        "sales_orders_raw": [
            dict(order_id="SO-10007", order_line_id="1", customer_id="CUST-007", product_sku="SKU-1007",
                 order_date="2024-05-01", order_status="open", ordered_units="300", shipped_units="0",
                 unit_price="20.00", currency="usd"),
            dict(order_id="SO-10008", order_line_id="1", customer_id="CUST-001", product_sku="SKU-1005",
                 order_date="2024-05-01", ship_date="2024-05-03", order_status="shipped", ordered_units="abc",
                 shipped_units="10", unit_price="20.00", currency="usd")],
        "retail_pos_raw": [dict(retailer_id="CUST-001", week_start_date="2024/04/08", product_sku="SKU-1006",
                                store_count="2", pos_units="10", pos_sales="99.90", on_hand_units="5", currency="usd")],
        "inventory_snapshots_raw": [
            dict(snapshot_date="2024-05-01", warehouse_id="WH-001", product_sku="SKU-1005", on_hand_qty="-25",
                 allocated_qty="50", available_qty="-75", in_transit_qty="0", safety_stock_qty="10",
                 inventory_status="active"),
            dict(snapshot_date="2024-05-01", warehouse_id="WH-001", product_sku="SKU-1004", on_hand_qty="0",
                 allocated_qty="0", available_qty="0", in_transit_qty="0", safety_stock_qty="10",
                 inventory_status="active"),
            dict(snapshot_date="2024-05-01", warehouse_id="WH-001", product_sku="SKU-1007", on_hand_qty="0",
                 allocated_qty="0", available_qty="0", in_transit_qty="900", safety_stock_qty="0",
                 inventory_status="prelaunch")],
        "purchase_orders_raw": [
            dict(po_id="PO-5004", po_line_id="1", supplier_id="SUP-001", product_sku="SKU-1004", warehouse_id="WH-001",
                 po_create_date="2024-03-01", requested_delivery_date="2024-04-25", po_status="open",
                 ordered_qty="1200", received_qty="0", unit_cost="4.00", currency="usd"),
            dict(po_id="PO-5006", po_line_id="1", supplier_id="SUP-404", product_sku="SKU-1007", warehouse_id="WH-001",
                 po_create_date="2024-05-01", requested_delivery_date="2030-01-01", po_status="open",
                 ordered_qty="900", unit_cost="4.00", currency="usd")],
    }
    return GoldLayer(_raw(spark, rows), as_of="2025-01-01 00:00:00")


def test_oversold_with_negative_inventory(layer):
    r = layer["fct_inventory_snapshots"].where("product_sku = 'SKU-1005'").collect()[0]
    assert (r.on_hand_qty, r.available_qty, r.has_negative_on_hand_flag, r.is_oversold) == (-25, -75, 1, 1)


def test_prelaunch_is_not_a_stockout(layer):
    inv = {r.product_sku: r.is_stockout for r in layer["fct_inventory_snapshots"].collect()}
    assert inv["SKU-1004"] == 1 and inv["SKU-1007"] == 0


def test_orphans_are_kept_and_reported(layer):
    so = layer["fct_sales_orders"].where("order_id = 'SO-10007'").collect()[0]
    assert so.is_known_customer == 0
    dq = {(r.issue_type, r.record_id, r.offending_value) for r in layer["dq_orphan_records"].collect()}
    assert ("unknown_customer", "SO-10007", "CUST-007") in dq
    assert ("unknown_supplier", "PO-5006", "SUP-404") in dq


def test_non_numeric_units_are_coerced_and_flagged(layer):
    so = layer["fct_sales_orders"].where("order_id = 'SO-10008'").collect()[0]
    assert so.ordered_units is None and so.fulfillment_status == "units_unknown"
    assert ("invalid_ordered_units", "SO-10008") in {(r.issue_type, r.record_id)
                                                    for r in layer["dq_value_violations"].collect()}


def test_overdue_po_behind_stockout(layer):
    m = {r.product_sku: r for r in layer["mart_product_performance"].collect()}
    assert m["SKU-1004"].has_overdue_po == 1 and m["SKU-1004"].ever_had_stockout == 1
    assert m["SKU-1007"].has_overdue_po == 0 and m["SKU-1007"].current_in_transit == 900


def test_discontinued_still_selling(layer):
    m = {r.product_sku: r for r in layer["mart_product_performance"].collect()}
    assert m["SKU-1006"].lifecycle_status == "discontinued" and m["SKU-1006"].total_pos_units == 10


def test_discovered_gap_mapping_links_hierarchy(layer):
    h = layer["stg_product_hierarchy"].collect()[0]
    assert (h.product_sku_raw, h.product_sku) == ("sku1007", "SKU-1007")
    d = {r.product_sku: r for r in layer["dim_product"].collect()}
    assert d["SKU-1007"].is_in_hierarchy == 1 and d["SKU-1007"].division == "Toys"
    assert d["SKU-1004"].division == "Unassigned" and d["SKU-1004"].launch_date == "2024-01-15"
    assert layer["dim_customer"].collect()[0].region == "EMEA"
