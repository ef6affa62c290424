"""Adapters: the driver's TPC-H-style tables -> the 15 messy raw extracts.

Every messy value is a pure function of key columns (no randomness), so the
same raw tables can be derived independently in any SQL engine. The recipes
inject the defects the gold layer has to handle: spelling variants of codes,
blank and junk numbers, duplicate records, orphan keys, dates in other
shapes, negative quantities, overlapping effective ranges.

The driver tables ``nation`` and ``region`` are fixed-size by the TPC-H
definition (25 and 5 rows at every scale), so they are the only sides joined
with a broadcast hint; fact-sized joins are left to the planner.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .raw import RAW_COLUMNS

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def load_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in DRIVER_TABLES}


# ---- small text builders -------------------------------------------------

def s(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("string")


def lit(v) -> Column:
    return F.lit(v)


def lp(x, n: int) -> Column:
    return F.lpad(s(x), n, "0")


def cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def case(*pairs, default=None) -> Column:
    """case(cond1, val1, cond2, val2, ..., default=...)"""
    expr = None
    for cond, val in zip(pairs[0::2], pairs[1::2]):
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if default is not None:
        expr = expr.otherwise(default if isinstance(default, Column) else F.lit(default))
    return expr


def mod(x, m: int) -> Column:
    return F.col(x) % m


def sku(k, v: Column) -> Column:
    """One of five spellings of the canonical SKU 'SKU-nnnnnnn' chosen by v in 0..4."""
    p = lp(k, 7)
    return case(v == 1, cat("  sku-", p, " "), v == 2, cat("SKU", p), v == 3, cat("sku_", p),
                default=cat("SKU-", p))


def canonical_sku(k) -> Column:
    return cat("SKU-", lp(k, 7))


def day(ts) -> Column:
    """The day's text; a date is formatted for less than a time whose clock is then cut off."""
    return F.substring(s(F.to_date(ts)), 1, 10)


def money(x) -> Column:
    return s(F.col(x).cast("decimal(18,2)"))


def qty(x) -> Column:
    return s(F.col(x).cast("bigint"))


def _nation_region(d) -> DataFrame:
    return d["nation"].join(F.broadcast(d["region"]), F.col("n_regionkey") == F.col("r_regionkey"))


def _finish(name: str, df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[name]])


#: fixed instant against which the fixtures' orders are overdue (the library's default is now)
AS_OF = "2025-01-01 00:00:00"


# ---- the 15 raw extracts ---------------------------------------------------

def taxonomy_lookup_raw(d) -> DataFrame:
    k = "p_partkey"
    sku_type = case(mod(k, 3) == 0, "sku_normalization", mod(k, 3) == 1, "SKU_Normalization",
                    default=" sku_normalization ")
    flag = case(mod(k, 97) == 0, "N", default=" y")
    spellings = F.array(cat("SKU-", lp(k, 7)), cat("SKU", lp(k, 7)), cat("sku_", lp(k, 7)))
    skus = d["part"].select(
        sku_type.alias("mapping_type"), F.explode(spellings).alias("raw_value"),
        canonical_sku(k).alias("standard_value"), lit("Product").alias("domain"),
        flag.alias("active_flag"), lit("2024-01-01").alias("effective_start_date"),
        lit("").alias("effective_end_date"))

    def rows(df, mtype, raw, std, domain):
        return df.select(lit(mtype).alias("mapping_type"), raw.alias("raw_value"), std.alias("standard_value"),
                         lit(domain).alias("domain"), lit("Y").alias("active_flag"),
                         lit("2024-01-01").alias("effective_start_date"), lit("").alias("effective_end_date"))

    rk = F.col("r_regionkey")
    regions = rows(d["region"].where(rk != 3), "Region", F.col("r_name"),
                   case(rk == 1, "AMER", rk == 2, "APAC", default="EMEA"), "Enterprise")
    nk = F.col("n_nationkey")
    countries = rows(d["nation"].where(nk < 20), "country", F.col("n_name"), cat("C", lp(nk, 2)), "Enterprise")
    warehouses = rows(d["nation"], "warehouse_normalization", cat("WH", lp(nk, 3)), cat("WH-", lp(nk, 3)),
                      "Supply Chain")
    suppliers = rows(d["supplier"].where(mod("s_suppkey", 3) == 0), "supplier", F.upper("s_name"),
                     F.col("s_name"), "Supply Chain")
    seg = F.col("c_mktsegment")
    channels = rows(d["customer"].select("c_mktsegment").distinct(), "channel", seg,
                    case(seg == "AUTOMOBILE", "Mass Retail", seg == "BUILDING", "Specialty",
                         seg == "FURNITURE", "E-commerce", seg == "HOUSEHOLD", "Grocery"), "Commercial")
    # fixed vocabulary rows (platforms, units, statuses, and three unusable rows)
    from ..plans.staging import literal_rows
    fixed = literal_rows(d["part"].sparkSession, [
        ("platform", "fb", "Meta", "Marketing"), ("platform", "facebook", "Meta", "Marketing"),
         ("platform", "meta ", "Meta", "Marketing"), ("platform", "YT", "YouTube", "Marketing"),
         ("platform", "tiktok", "TikTok", "Marketing"), ("uom", "ea", "EA", "Product"),
         ("uom", "each", "EA", "Product"), ("uom", "cs", "CASE", "Product"), ("platform", "TikTok ", "TikTok", "Marketing"),
         ("status", "actv", "active", "Product"), ("status", "", "x", "Product"),
         ("status", "disc", None, "Product"), ("status", "   ", "blank", "Product")],
        ["mapping_type", "raw_value", "standard_value", "domain"])
    fixed = fixed.select("*", lit("Y").alias("active_flag"), lit("2024-01-01").alias("effective_start_date"),
                         lit("").alias("effective_end_date"))
    parts = [skus, regions, countries, warehouses, suppliers, channels, fixed]
    return _finish("taxonomy_lookup_raw", reduce(DataFrame.unionByName, parts))


def products_raw(d) -> DataFrame:
    k, p = "p_partkey", d["part"]
    price = money("p_retailprice")
    size = F.col("p_size")
    plm = p.where(mod(k, 10) != 9).select(
        case(mod(k, 2) == 0, " plm", default="PLM").alias("source_system"),
        sku(k, mod(k, 5)).alias("product_sku"),
        case(mod(k, 4) == 0, cat("ALT-", s(k)), default="").alias("alt_sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand_family"),
        F.col("p_type").alias("franchise"),
        case(size % 3 == 0, "Action Figures", size % 3 == 1, "Board Games", default="Vehicles").alias("category"),
        case(mod(k, 6) == 0, "", default=cat("Line ", s(size % 7))).alias("sub_category"),
        case(mod(k, 5) == 0, " ", default=cat(s(size % 10 + 3), "+")).alias("age_grade"),
        case(mod(k, 4) == 0, "Active", mod(k, 4) == 1, " ACTIVE", mod(k, 4) == 2, "discontinued",
             default="Launched").alias("lifecycle_status"),
        case(mod(k, 11) == 0, "03/15/2024", mod(k, 13) == 0, "",
             default=cat("2024-0", s(mod(k, 9) + 1), "-15")).alias("launch_date"),
        case(mod(k, 4) == 2, "2025-06-30", default="").alias("discontinue_date"),
        cat(" ", price).alias("unit_cost"),
        case(mod(k, 7) == 0, cat(price, "USD"), default=price).alias("list_price"),
        case(mod(k, 101) == 0, "99999999999999999999", mod(k, 8) == 0, cat(s(size), "pk"), mod(k, 9) == 0, "0",
             default=s(size)).alias("case_pack_qty"),
        case(mod(k, 3) == 0, "ea", mod(k, 3) == 1, "Each").alias("unit_of_measure"),
        lit("2024-01-01").alias("updated_at"))
    erp = p.where(mod(k, 3) != 0).select(
        case(mod(k, 2) == 0, "ERP", default="erp ").alias("source_system"),
        sku(k, (F.col(k) + 1) % 5).alias("product_sku"),
        lit("").alias("alt_sku"),
        F.upper("p_name").alias("product_name"),
        F.upper("p_brand").alias("brand_family"),
        lit("").alias("franchise"),
        lit("General").alias("category"),
        lit("").alias("sub_category"),
        lit("").alias("age_grade"),
        case(mod(k, 5) == 0, "inactive", default="active").alias("lifecycle_status"),
        lit("2023-12-01").alias("launch_date"),
        lit("").alias("discontinue_date"),
        case(mod(k, 17) == 0, "TBD", mod(k, 19) == 0, "-1", default=price).alias("unit_cost"),
        price.alias("list_price"),
        case(mod(k, 5) == 0, "12abc", default="24").alias("case_pack_qty"),
        case(mod(k, 2) == 0, "EA", default="cs").alias("unit_of_measure"),
        lit("2024-02-01").alias("updated_at"))
    return _finish("products_raw", plm.unionByName(erp))


def product_hierarchy_raw(d) -> DataFrame:
    k, p = "p_partkey", d["part"]
    current = p.where(mod(k, 4) != 0).select(
        sku(k, (F.col(k) + 2) % 5).alias("product_sku"),
        lit("2023-01-01").alias("effective_start_date"), lit("").alias("effective_end_date"),
        case(mod(k, 3) == 0, "Toys", mod(k, 3) == 1, "Games", default=" ").alias("division"),
        case(mod(k, 5) == 0, "", default=cat("BF-", F.col("p_brand"))).alias("brand_family_std"),
        case(mod(k, 2) == 0, F.col("p_type"), default="").alias("franchise_std"),
        lit("").alias("category_std"), lit("").alias("sub_category_std"),
        case(mod(k, 6) == 0, " Active ", mod(k, 6) == 1, "DISCONTINUED", default="").alias("status_std"))
    legacy = p.where(mod(k, 7) == 0).select(
        sku(k, lit(0)).alias("product_sku"),
        lit("2022-06-01").alias("effective_start_date"), lit("2023-06-30").alias("effective_end_date"),
        lit("Legacy").alias("division"), lit("OLD").alias("brand_family_std"), lit("").alias("franchise_std"),
        lit("Old Cat").alias("category_std"), lit("").alias("sub_category_std"),
        lit("inactive").alias("status_std"))
    interim = p.where(mod(k, 14) == 0).select(
        sku(k, lit(3)).alias("product_sku"),
        lit("2023-01-01").alias("effective_start_date"), lit("2023-12-31").alias("effective_end_date"),
        lit("Interim").alias("division"), lit("").alias("brand_family_std"), lit("").alias("franchise_std"),
        lit("").alias("category_std"), lit("").alias("sub_category_std"), lit("").alias("status_std"))
    return _finish("product_hierarchy_raw", current.unionByName(legacy).unionByName(interim))


def customers_raw(d) -> DataFrame:
    c = "c_custkey"
    base = d["customer"].where(mod(c, 40) != 8).join(
        F.broadcast(_nation_region(d)), F.col("c_nationkey") == F.col("n_nationkey"))
    cid = cat("CUST-", lp(c, 6))
    seg = F.col("c_mktsegment")
    common = dict(
        channel=case(mod(c, 3) == 0, F.lower(seg), mod(c, 3) == 1, cat(seg, " "), default=cat(" ", seg)),
        region=case(mod(c, 4) == 0, F.col("r_name"), mod(c, 4) == 1, F.lower("r_name"), mod(c, 4) == 2, "",
                    default=cat(" ", F.col("r_name"))),
        tier=case(mod(c, 5) == 0, "tier-1", mod(c, 5) == 1, "Tier 2", mod(c, 5) == 2, "TIER3",
                  mod(c, 5) == 3, "Strategic ", default=""),
        active_flag=case(F.col("c_acctbal") >= 0, "y ", default="N"),
        parent_customer_id=case(mod(c, 10) == 1, cat("CUST-", lp(F.col(c) - 1, 6)), default=""),
    )
    main = base.select(
        case(mod(c, 7) == 0, cat(" ", cid), default=cid).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        case(mod(c, 3) == 0, F.col("n_name"), mod(c, 3) == 1, F.lower("n_name"),
             default=cat(F.col("n_name"), " ")).alias("country"),
        *[v.alias(n) for n, v in common.items()])
    dup = base.where(mod(c, 20) == 0).select(
        cid.alias("customer_id"), cat(F.col("c_name"), " (dup)").alias("customer_name"),
        cat("Republic of ", F.col("n_name")).alias("country"),
        *[v.alias(n) for n, v in common.items()])
    return _finish("customers_raw", main.unionByName(dup))


def suppliers_raw(d) -> DataFrame:
    k = "s_suppkey"
    base = d["supplier"].where(mod(k, 25) != 4).join(
        F.broadcast(_nation_region(d)), F.col("s_nationkey") == F.col("n_nationkey"))
    lead = s(F.col(k) % 20 + 7)
    cols = dict(
        supplier_id=cat("SUP-", lp(k, 5)),
        supplier_name=case(mod(k, 3) == 0, F.upper("s_name"), default=F.col("s_name")),
        supplier_region=case(mod(k, 2) == 0, F.col("r_name"), default=F.lower("r_name")),
        preferred_flag=case(mod(k, 4) == 0, "Y", default="n"),
        active_flag=lit("Y"),
    )
    main = base.select(*[v.alias(n) for n, v in cols.items()], F.col("n_name").alias("country"),
                       case(mod(k, 13) == 0, "0", mod(k, 11) == 0, cat(lead, "days"), default=lead)
                       .alias("lead_time_days"))
    dup = base.where(mod(k, 10) == 0).select(*[v.alias(n) for n, v in cols.items()],
                                              cat("Country ", F.col("n_name")).alias("country"),
                                              lit("").alias("lead_time_days"))
    return _finish("suppliers_raw", main.unionByName(dup))


def warehouse_locations_raw(d) -> DataFrame:
    n = "n_nationkey"
    base = _nation_region(d)
    main = base.select(
        cat("WH-", lp(n, 3)).alias("warehouse_id"), cat("DC ", F.col("n_name")).alias("warehouse_name"),
        case(mod(n, 5) == 0, "DC", mod(n, 5) == 1, "distribution center", mod(n, 5) == 2, "3pl",
             mod(n, 5) == 3, "unknown", default="Cross-Dock").alias("warehouse_type"),
        F.col("r_name").alias("region"), F.col("n_name").alias("country"),
        cat("Region/", F.replace(F.col("r_name"), lit(" "), lit("_"))).alias("timezone"),
        case(mod(n, 6) == 5, "N", default="Y").alias("active_flag"))
    legacy = base.where(mod(n, 5) == 0).select(
        cat("WH", lp(n, 3)).alias("warehouse_id"), cat("DC ", F.col("n_name"), " (legacy)").alias("warehouse_name"),
        lit("").alias("warehouse_type"), F.col("r_name").alias("region"), F.col("n_name").alias("country"),
        lit("UTC").alias("timezone"), lit("Y").alias("active_flag"))
    return _finish("warehouse_locations_raw", main.unionByName(legacy))


def carrier_performance_raw(d) -> DataFrame:
    n = "n_nationkey"
    base = _nation_region(d)
    main = base.select(
        cat("CAR-", s(n)).alias("carrier_id"), cat("Carrier ", F.col("n_name")).alias("carrier_name"),
        case(mod(n, 2) == 0, "Ground", default="Express").alias("service_level"),
        F.col("r_name").alias("region"), s(F.col(n) + 3).alias("contracted_transit_days"),
        lit("Y").alias("active_flag"))
    dup = base.where(mod(n, 10) == 4).select(
        cat("CAR-", s(n)).alias("carrier_id"), cat("Carrier ", F.col("n_name"), " dup").alias("carrier_name"),
        lit("Ground").alias("service_level"), lit("ASIA").alias("region"),
        lit("").alias("contracted_transit_days"), lit("N").alias("active_flag"))
    return _finish("carrier_performance_raw", main.unionByName(dup))


def _lines(d) -> DataFrame:
    """lineitem joined to its order (fact-to-fact: a shuffle join on the order key)."""
    return d["lineitem"].join(d["orders"], F.col("l_orderkey") == F.col("o_orderkey"))


def _variant(offset: int = 0) -> Column:
    return (F.col("l_orderkey") + F.col("l_linenumber") + offset) % 5


def sales_orders_raw(d) -> DataFrame:
    ln, sk = F.col("l_linenumber"), F.col("l_suppkey")
    q = qty("l_quantity")
    so = cat("SO-", s("l_orderkey"))
    cancelled = F.col("l_partkey") % 29 == 0
    st = F.col("o_orderstatus")
    df = _lines(d).select(
        case(ln == 3, cat(" ", so), default=so).alias("order_id"),
        case(F.col("l_partkey") % 211 == 0, cat("-9999999999999999999", s(ln)), default=s(ln)).alias("order_line_id"),
        cat("CUST-", lp("o_custkey", 6)).alias("customer_id"),
        sku("l_partkey", _variant()).alias("product_sku"),
        day("o_orderdate").alias("order_date"),
        case(ln == 2, "", default=day("o_orderdate")).alias("requested_ship_date"),
        case(ln == 7, "", F.col("l_partkey") % 41 == 0, F.replace(day("l_shipdate"), lit("-"), lit("/")),
             F.col("l_partkey") % 59 == 0, cat(F.substring(day("l_shipdate"), 1, 8), "31"),
             default=day("l_shipdate")).alias("ship_date"),
        case(cancelled, "Cancelled", st == "F", "Shipped ", st == "O", " open", default="PARTIAL")
        .alias("order_status"),
        case(F.col("l_partkey") % 23 == 0, "abc", default=q).alias("ordered_units"),
        case(F.col("l_returnflag") == "R", "0",
             F.col("l_linestatus") == "O", s(F.floor(F.col("l_quantity") / 2).cast("bigint")),
             default=q).alias("shipped_units"),
        case(sk % 31 == 0, "N/A", sk % 37 == 0, cat("$", money("l_extendedprice")),
             default=money("l_extendedprice")).alias("unit_price"),
        case(sk % 3 == 0, "usd", sk % 3 == 1, "USD ", default="cad").alias("currency"),
        case(cancelled, "customer request", default="").alias("cancel_reason"))
    return _finish("sales_orders_raw", df)


def retail_pos_raw(d) -> DataFrame:
    ln, sk = F.col("l_linenumber"), F.col("l_suppkey")
    q = qty("l_quantity")
    wk = day(F.trunc("l_shipdate", "week"))
    df = _lines(d).select(
        cat("CUST-", lp("o_custkey", 6)).alias("retailer_id"),
        case(F.col("l_partkey") % 6 == 0, F.replace(wk, lit("-"), lit("/")), default=wk).alias("week_start_date"),
        sku("l_partkey", _variant()).alias("product_sku"),
        case(ln == 2, "", default=s(ln * 3)).alias("store_count"),
        case(F.col("l_returnflag") == "R", cat("-", q), sk % 43 == 0, cat(q, ".0"), default=q).alias("pos_units"),
        case(sk % 41 == 0, "n/a", sk % 47 == 0, cat("1,", money("l_extendedprice")), sk % 7 == 0, "0.0000004",
             default=money("l_extendedprice")).alias("pos_sales"),
        s(F.col("l_quantity").cast("bigint") - 10).alias("on_hand_units"),
        case(ln == 5, "1,200", default="5").alias("on_order_units"),
        lit("usd").alias("currency"),
        day("l_shipdate").alias("feed_date"))
    return _finish("retail_pos_raw", df)


def purchase_orders_raw(d) -> DataFrame:
    ln = F.col("l_linenumber")
    q = qty("l_quantity")
    w = lp(F.col("l_suppkey") % 27, 3)
    is_open = ln == 6
    df = _lines(d).select(
        cat("PO-", s("l_orderkey")).alias("po_id"),
        s(ln).alias("po_line_id"),
        cat("SUP-", lp("l_suppkey", 5)).alias("supplier_id"),
        sku("l_partkey", _variant(2)).alias("product_sku"),
        case(ln == 4, cat("wh", w), default=cat("WH-", w)).alias("warehouse_id"),
        day("o_orderdate").alias("po_create_date"),
        case(F.col("l_partkey") % 61 == 0, cat(day("l_shipdate"), " 24:00:00"), default=day("l_shipdate"))
        .alias("requested_delivery_date"),
        case(is_open, "", default=day("l_shipdate")).alias("received_date"),
        case(is_open, " OPEN", default="closed ").alias("po_status"),
        case(F.col("l_partkey") % 53 == 0, cat("00", q), default=q).alias("ordered_qty"),
        case(is_open, "", default=q).alias("received_qty"),
        case(F.col("l_partkey") % 31 == 0, "TBD", default=money("l_extendedprice")).alias("unit_cost"),
        lit("usd").alias("currency"))
    return _finish("purchase_orders_raw", df)


def shipments_raw(d) -> DataFrame:
    ln, ok, pk = F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_partkey")
    q = qty("l_quantity")
    delivered = s(F.date_add(F.to_date(F.col("l_shipdate")), (pk % 9 - 1).cast("int")))
    df = _lines(d).select(
        cat("SH-", s(ok), "-", s(ln)).alias("shipment_id"),
        case(ok % 50 == 0, cat("SO-X", s(ok)), default=cat("SO-", s(ok))).alias("order_id"),
        cat("CUST-", lp("o_custkey", 6)).alias("customer_id"),
        sku("l_partkey", _variant()).alias("product_sku"),
        cat("WH-", lp(F.col("l_suppkey") % 25, 3)).alias("warehouse_id"),
        cat("CAR-", s(F.col("l_suppkey") % 27)).alias("carrier_id"),
        day("l_shipdate").alias("ship_date"),
        case(ln == 5, "", pk % 37 == 0, "pending",
             pk % 31 == 0, cat(s(F.unix_date(F.to_date(F.col("l_shipdate"))) + 2440590), ".5"),
             default=delivered).alias("delivery_date"),
        case(F.col("l_linestatus") == "O", "In_Transit", default="DELIVERED").alias("shipment_status"),
        case(pk % 19 == 0, cat("x", q), default=q).alias("shipped_units"),
        case(pk % 13 == 0, "FREE", default=s(F.col("l_tax").cast("decimal(18,2)") * 1000)).alias("freight_cost"),
        lit("usd").alias("currency"),
        case(pk % 10 == 0, "", default=cat("1Z", lp(ok, 9), s(ln))).alias("tracking_number"))
    return _finish("shipments_raw", df)


def shipment_events_raw(d) -> DataFrame:
    eid = F.col("event_id")
    ts19 = F.substring(s("ts"), 1, 19)
    df = d["events"].select(
        cat("SH-", s("user_id"), "-", s(eid % 7 + 1)).alias("shipment_id"),
        case(eid % 10 == 0, "", eid % 9 == 0, F.replace(ts19, lit("-"), lit("/")), eid % 4 == 0, cat(" ", ts19),
             default=ts19).alias("event_timestamp"),
        case(eid % 2 == 0, F.col("event_type"), default=F.upper("event_type")).alias("event_type"),
        case(F.col("user_id") % 5 == 0, "", default=cat("HUB-", s(F.col("user_id") % 5))).alias("event_location"),
        case(F.col("value") > 10, "Delayed", default="OK ").alias("event_status"))
    return _finish("shipment_events_raw", df)


def inventory_snapshots_raw(d) -> DataFrame:
    ln, pk = F.col("l_linenumber"), F.col("l_partkey")
    w = lp(F.col("l_suppkey") % 25, 3)
    qn = F.col("l_quantity").cast("bigint")
    df = d["lineitem"].select(
        cat(F.substring(s("l_shipdate"), 1, 7), "-01").alias("snapshot_date"),
        case(ln == 3, cat("WH", w), default=cat("WH-", w)).alias("warehouse_id"),
        sku("l_partkey", _variant()).alias("product_sku"),
        case(pk % 43 == 0, cat(" ", s(qn - 5), " "), default=s(qn - 5)).alias("on_hand_qty"),
        s(ln * 4).alias("allocated_qty"),
        case(pk % 17 == 0, "n/a", default=s(qn - 5 - ln * 4)).alias("available_qty"),
        case(ln % 2 == 0, "", default=s(ln * 10)).alias("in_transit_qty"),
        s(F.col("l_suppkey") % 20).alias("safety_stock_qty"),
        case(ln % 3 == 0, "ea", ln % 3 == 1, "EACH ", default="pcs").alias("unit_of_measure"),
        case(pk % 41 == 0, "PreLaunch", default=" Active").alias("inventory_status"))
    return _finish("inventory_snapshots_raw", df)


def marketing_campaigns_raw(d) -> DataFrame:
    """One campaign per product (id 'CMP-' + part key); every 1000th product's campaign is listed twice."""
    k = "p_partkey"
    cols = dict(
        campaign_id=cat("CMP-", lp(k, 7)),
        campaign_start_date=lit("2024-01-01"),
        campaign_end_date=case(mod(k, 80) == 0, "", default="2024-03-31"),
        product_sku=case(mod(k, 120) == 0, "", default=sku(k, (F.col(k) % 7) % 5)),
        channel=case(mod(k, 3) == 0, "Social", default="Video"),
        region=case(mod(k, 3) == 0, "Europe", mod(k, 3) == 1, "AMERICA ", default=""),
        objective=case(mod(k, 2) == 0, "awareness", default="conversion"),
        budget=case(mod(k, 7) == 0, "TBD", default=money("p_retailprice")),
        currency=case(mod(k, 3) == 0, "gbp", default="usd"),
        taxonomy_code=lit(""),
    )
    base = d["part"]
    main = base.select(*[v.alias(n) for n, v in cols.items()],
                       cat("Campaign ", F.col("p_name")).alias("campaign_name"),
                       case(mod(k, 4) == 0, "fb", mod(k, 4) == 1, "Facebook ", mod(k, 4) == 2, "YT",
                            default="tiktok").alias("platform"))
    dup = base.where(mod(k, 1000) == 0).select(*[v.alias(n) for n, v in cols.items()],
                                                cat("Campaign ", F.col("p_name"), " v2").alias("campaign_name"),
                                                lit("YT").alias("platform"))
    return _finish("marketing_campaigns_raw", main.unionByName(dup))


def marketing_performance_raw(d) -> DataFrame:
    eid, uid = F.col("event_id"), F.col("user_id")
    cents = F.col("value").cast("decimal(18,2)")
    df = d["events"].select(
        day("ts").alias("performance_date"),
        case(uid % 25 == 24, cat("CMP-X", s(uid)), default=cat("CMP-", lp(uid * 40, 7))).alias("campaign_id"),
        case(uid % 4 == 0, case(eid % 3 == 0, "fb", eid % 3 == 1, "Facebook", default="META "),
             uid % 4 == 1, "facebook", uid % 4 == 2, "yt", default="TikTok").alias("platform"),
        s((cents * 100).cast("bigint")).alias("impressions"),
        s(eid % 70 - 3).alias("clicks"),
        case(eid % 11 == 0, "", default=s(eid % 11)).alias("video_views"),
        case(eid % 50 == 0, "free", eid % 997 == 0, "12345678901234567890123456789012345678901",
             default=s(cents)).alias("spend"),
        s(eid % 5).alias("conversions"),
        s(cents * 3).alias("revenue"),
        lit("usd").alias("currency"))
    return _finish("marketing_performance_raw", df)


ADAPTERS = {
    "taxonomy_lookup_raw": taxonomy_lookup_raw,
    "products_raw": products_raw,
    "product_hierarchy_raw": product_hierarchy_raw,
    "customers_raw": customers_raw,
    "sales_orders_raw": sales_orders_raw,
    "retail_pos_raw": retail_pos_raw,
    "marketing_campaigns_raw": marketing_campaigns_raw,
    "marketing_performance_raw": marketing_performance_raw,
    "inventory_snapshots_raw": inventory_snapshots_raw,
    "warehouse_locations_raw": warehouse_locations_raw,
    "suppliers_raw": suppliers_raw,
    "purchase_orders_raw": purchase_orders_raw,
    "shipments_raw": shipments_raw,
    "shipment_events_raw": shipment_events_raw,
    "carrier_performance_raw": carrier_performance_raw,
}


def raw_from_testdata(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All 15 raw extracts as lazy DataFrames over the driver tables in ``sf_dir``."""
    d = load_driver_tables(spark, sf_dir)
    return {name: fn(d) for name, fn in ADAPTERS.items()}


# ---- extracts of the dated features (effective-dated mappings, exchange rates) ------------------

def mapping_history(d) -> DataFrame:
    """Effective-dated SKU mappings, shaped like the standardised taxonomy: replaced, nested, ended, tied and open
    ranges by ``p_partkey % 6``; one spelling of every sixth part is missing and some rows are inactive."""
    k = F.col("p_partkey")
    kind = k % 6
    p = lp("p_partkey", 7)
    std = cat("SKU-", p)

    def row(value: Column, start: str | None, end: str | None, active: int = 1) -> Column:
        return F.struct(value.alias("standard_value"), F.lit(start).cast("string").alias("effective_start_date"),
                        F.lit(end).cast("string").alias("effective_end_date"), F.lit(active).alias("is_active"))

    ranges = (F.when(kind == 0, F.array(row(cat(std, "-A"), None, "1997-12-31"), row(std, "1998-01-01", None)))
              .when(kind == 1, F.array(row(std, "1992-01-01", None), row(cat(std, "-PROMO"), "1998-01-01", "1998-06-30")))
              .when(kind == 2, F.array(row(std, "1998-01-01", "2000-06-30")))
              .when(kind == 3, F.array(row(cat(std, "-B"), "1996-01-01", None), row(std, "1996-01-01", "not a day")))
              .when(kind == 4, F.array(row(std, None, None)))
              .otherwise(F.array(row(std, None, None), row(cat(std, "-OFF"), "1999-01-01", None, active=0))))
    spellings = F.array(cat("SKU-", p), cat("SKU", p), cat(" sku_", p))
    rows = d["part"].select("p_partkey", F.explode(spellings).alias("raw_value"), ranges.alias("ranges")).where(
        ~((F.col("p_partkey") % 6 == 4) & F.col("raw_value").startswith("SKU0")))
    return rows.select(F.lit("sku_normalization").alias("mapping_type"), "raw_value", F.explode("ranges").alias("r")
                       ).select("mapping_type", "raw_value", "r.*")


def exchange_rates(d) -> DataFrame:
    """Monthly CAD rates to USD for the months with orders from 1996 on, and one rate of a code that nobody uses."""
    month = F.trunc(F.to_date("o_orderdate"), "month")
    months = d["orders"].select(month.alias("effective_date")).distinct().where("effective_date >= date'1996-01-01'")
    steps = F.month("effective_date") + F.year("effective_date") % 4
    cad = months.select(F.lit(" cad").alias("currency"), "effective_date", (F.lit(0.5) + steps / 64).alias("rate"))
    other = months.agg(F.min("effective_date").alias("effective_date")).select(
        F.lit("XTS").alias("currency"), "effective_date", F.lit(2.0).alias("rate"))
    return cad.unionByName(other)
