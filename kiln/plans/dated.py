"""Dated features over the gold layer: as-of mapping, currency-safe totals, incremental merges, history, positions.

Each query takes the layer and the driver tables (for the extracts that only these features have) and returns one
feature's whole result.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import exact_parts, exact_total
from ..operators import sketches
from ..operators.asof import iso_day, standardize_as_of
from ..operators.currency import converted, currency_code, map_sum, total_map, totals_by_currency
from ..operators.dedup import By
from ..operators.position import carried_changes, daily_position, out_of_sequence, reconciled
from ..sources.history import HistoryTable
from ..sources.surrogate import SurrogateKeys
from ..sources.testdata import exchange_rates, mapping_history
from ..sources.upsert import UpsertTable
from ..streaming import latest
from ..streaming.incremental import raw_stream
from . import facts, monitoring, quality, staging

BASE_CURRENCY = "USD"


def own_folder(layer, name: str) -> str:
    """A folder below the layer's for the state of one call; a query that runs again starts anew."""
    return f"{layer.run_folder}/{name}-{uuid.uuid4().hex[:8]}"


# ---- effective-dated mapping

def asof_order_skus(layer, tables) -> DataFrame:
    """Order lines with the standard SKU that was valid on their ship date."""
    lines = layer["sales_orders_raw"].select(F.trim("order_id").alias("order_id"), "order_line_id", "ship_date", "product_sku")
    found = standardize_as_of(lines, mapping_history(tables), "product_sku", "sku_normalization", "ship_date", "standard_sku",
                              layer.stage, layer.sizes)
    return found.withColumnRenamed("product_sku", "raw_sku")


# ---- currencies

def currency_sales_totals(layer, tables) -> DataFrame:
    """Sales per SKU and currency; amounts of two currencies are never added."""
    return totals_by_currency(layer["fct_sales_orders"], ["product_sku"], "gross_revenue", "currency")


def _map_text(column: str) -> Column:
    entry = lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(38,2)").cast("string"))
    return F.concat_ws(";", F.transform(F.map_entries(column), entry))


def currency_product_revenue(layer, tables) -> DataFrame:
    """Per SKU the revenue of each currency, the revenue in the base currency by the rates of the order dates, and the
    lines that no rate converts (left out of the converted sum, never counted at par)."""
    sales = layer["fct_sales_orders"].select("product_sku", "gross_revenue", "currency", "order_date")
    lines = converted(sales, "gross_revenue", "currency", iso_day("order_date"), exchange_rates(tables), BASE_CURRENCY,
                      layer.stage, layer.sizes, "in_base")
    # the lines move once: what is summed over all currencies is added up from the sums per currency
    part, rest = exact_parts("in_base")
    by_currency = totals_by_currency(lines, ["product_sku"], "gross_revenue", "currency", also=[
        F.sum(part).alias("part"), F.sum(rest).alias("rest"),
        F.count(F.when(F.col("in_base").isNull(), 1)).alias("unconverted")])
    maps = total_map(by_currency, ["product_sku"], also=[
        exact_total(F.sum("part"), F.sum("rest")).alias("revenue_in_base"), F.sum("unconverted").alias("n_unconverted")])
    return maps.select("product_sku", _map_text("totals").alias("revenue_by_currency"), "revenue_in_base", "n_unconverted")


def currency_division_revenue(layer, tables) -> DataFrame:
    """The per-SKU currency maps re-aggregated to divisions, currency by currency."""
    maps = total_map(totals_by_currency(layer["fct_sales_orders"], ["product_sku"], "gross_revenue", "currency"), ["product_sku"])
    divisions = layer["dim_product"].select(F.col("product_sku").alias("sku"), "division")
    known = maps.join(divisions, F.col("product_sku") == F.col("sku"), "left").withColumn(
        "division", F.coalesce("division", F.lit("Unknown product")))
    by_division = map_sum(known, ["division"], "totals")
    return by_division.select("division", F.explode("totals").alias("currency", "total"))


# ---- incremental merge of the big facts

def month_of(day: str) -> Column:
    return F.when(F.col(day).rlike("^[0-9]{4}-[0-9]{2}"), F.substring(day, 1, 7))


#: staging model -> (keys, order) of its fact's deduplication and the day whose month is the partition
MERGED = {
    "stg_inventory_snapshots": (["snapshot_date", "warehouse_id", "product_sku"], [By("on_hand_qty", desc=True)], "snapshot_date"),
    "stg_retail_pos": (["retailer_id", "week_start_date", "product_sku"], [By("pos_units", desc=True)], "week_start_date"),
    "stg_marketing_performance": (["performance_date", "campaign_id", "platform"], [By("impressions", desc=True)],
                                  "performance_date"),
}
BATCHES = 2


def merge_table(spark, path: str, model: str, schema) -> UpsertTable:
    keys, order, day = MERGED[model]
    return UpsertTable(spark, path, schema, keys, order, month_of(day))


def merged_staging(layer, model: str) -> DataFrame:
    """The staging model taken in as batches that share keys and months, the first one twice."""
    staged = layer.stage(layer[model], model)
    table = merge_table(layer.spark, own_folder(layer, f"merged-{model}"), model, staged.schema)
    batch = F.pmod(F.xxhash64(*staged.columns), F.lit(BATCHES))
    for number in [*range(BATCHES), 0]:
        table.merge(staged.where(batch == number))
    return table.read()


def incremental_inventory(layer, tables) -> DataFrame:
    """The inventory fact over an incrementally merged table: equal to the full refresh."""
    return facts.fct_inventory_snapshots(merged_staging(layer, "stg_inventory_snapshots"),
                                         *[layer.sizes.side(n, layer[n]) for n in ("dim_product", "dim_warehouse")])


def incremental_pos(layer, tables) -> DataFrame:
    return facts.fct_retail_pos(merged_staging(layer, "stg_retail_pos"),
                                *[layer.sizes.side(n, layer[n]) for n in ("dim_customer", "dim_product")])


def incremental_marketing(layer, tables) -> DataFrame:
    return facts.fct_marketing_performance(merged_staging(layer, "stg_marketing_performance"), layer["stg_marketing_campaigns"],
                                           layer.sizes.side("dim_product", layer["dim_product"]))


# ---- history of products

SNAPSHOT_DAYS = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
TRACKED = ["product_name", "brand_family", "category", "lifecycle_status"]


def product_snapshot(products: DataFrame, number: int) -> DataFrame:
    """The product dimension as a daily extract would show it: what changes is told by a digit of the SKU's MD5."""
    digit = F.substring(F.md5(F.col("product_sku").cast("binary")), 1, 1)
    gone = ((digit == "3") & F.lit(number == 1)) | ((digit == "5") & F.lit(number >= 2)) | ((digit == "7") & F.lit(number == 0))
    status = F.when((digit == "2") & F.lit(number >= 2), F.lit("discontinued")).otherwise(F.col("lifecycle_status"))
    brand = F.when(~((digit == "9") & F.lit(number == 1)), F.col("brand_family"))
    category = F.when(digit == "a", F.concat("category", F.lit(f" {number}"))).otherwise(F.col("category"))
    return products.where(~gone).select("product_sku", "product_name", brand.alias("brand_family"), category.alias("category"),
                                        status.alias("lifecycle_status"))


def product_history(layer, tables) -> DataFrame:
    """Every version of every product over four snapshots, the last one applied twice."""
    products = layer["dim_product"]
    table = HistoryTable(layer.spark, own_folder(layer, "history-product"), product_snapshot(products, 0).schema, ["product_sku"])
    for day, number in [*zip(SNAPSHOT_DAYS, range(len(SNAPSHOT_DAYS))), (SNAPSHOT_DAYS[-1], len(SNAPSHOT_DAYS) - 1)]:
        table.apply(product_snapshot(products, number), day)
    return table.versions().select("product_sku", *TRACKED, F.col("valid_from").cast("string").alias("valid_from"),
                                   F.col("valid_to").cast("string").alias("valid_to"))


# ---- positions, balances, order of events

TRAILING_DAYS = 28


def warehouse_daily_position(layer, tables) -> DataFrame:
    """Units on hand per warehouse and day (each SKU's last-known count carried forward), units shipped in the
    trailing 28 days, and the days of supply at that speed."""
    changes = carried_changes(layer["fct_inventory_snapshots"].withColumn("__d", iso_day("snapshot_date")),
                              ["warehouse_id", "product_sku"], "__d", "on_hand_qty")
    shipped = layer["fct_shipments"].select("warehouse_id", iso_day("ship_date").alias("day"),
                                            F.col("shipped_units").alias("flow"))
    daily = daily_position(changes.drop("product_sku"), shipped, ["warehouse_id"], TRAILING_DAYS)
    supply = F.when((F.col("trailing_flow") > 0) & (F.col("position") > 0),
                    F.round(F.col("position") * TRAILING_DAYS / F.col("trailing_flow"), 2))
    return daily.select("warehouse_id", F.col("day").cast("string").alias("day"), F.col("position").alias("on_hand"),
                        F.col("trailing_flow").alias("shipped_28d"), supply.alias("days_of_supply"))


def inventory_reconciliation(layer, tables) -> DataFrame:
    """Each inventory reading against the one before it plus receipts minus shipments since."""
    keys = ["warehouse_id", "product_sku"]
    into = layer["fct_purchase_orders"].select(*keys, iso_day("received_date").alias("day"),
                                               F.col("received_qty").cast("long").alias("quantity"))
    out = layer["fct_shipments"].select(*keys, iso_day("ship_date").alias("day"),
                                        (-F.col("shipped_units").cast("long")).alias("quantity"))
    got = reconciled(layer["fct_inventory_snapshots"].withColumn("__d", iso_day("snapshot_date")), into.unionByName(out),
                     keys, "__d", "on_hand_qty")
    return got.withColumn("day", F.col("day").cast("string"))


#: the order in which a shipment's events are expected
EVENT_STEPS = {"VIEW": 1, "SIGNUP": 2, "CLICK": 3, "ERROR": 4, "PURCHASE": 5}


def event_step(event_type: str = "event_type") -> Column:
    out = None
    for name, number in EVENT_STEPS.items():
        hit = F.col(event_type) == name
        out = F.when(hit, number) if out is None else out.when(hit, number)
    return out


def shipment_event_order(layer, tables) -> DataFrame:
    """Shipment events with a flag for those that come after an event of a later step."""
    events = layer["stg_shipment_events"].withColumn("step", event_step())
    return out_of_sequence(events, ["shipment_id"], "event_timestamp", "step").select(
        "shipment_id", "event_timestamp", "event_type", "step", "is_out_of_order")


# ---- surrogate keys

def surrogate_product_keys(layer, tables) -> DataFrame:
    """Dense product numbers: SKUs known to the PLM first, then (a later run) all SKUs, then the same run again."""
    products = layer["dim_product"]
    keys = SurrogateKeys(layer.spark, own_folder(layer, "keys-product"), products.schema, ["product_sku"])
    for df in (products.where("is_in_plm = 1"), products, products):
        keys.assign(df, layer.stage)
    return keys.read()


# ---- mergeable distinct counts

def distinct_by_year(layer, tables) -> DataFrame:
    """Distinct retailers per year from stored weekly sketches, checked against the exact count: 1 where the estimate
    lies within four standard errors."""
    weeks = layer["fct_retail_pos"].select("week_start_date", "retailer_id")
    stored = layer.stage(sketches.sketches(weeks, ["week_start_date"], "retailer_id"), "weekly-sketches")
    year = F.substring("week_start_date", 1, 4).alias("year")
    estimated = sketches.merged(stored.withColumn("year", year), ["year"]).withColumn("estimate", sketches.estimate())
    exact = weeks.select(year, "retailer_id").distinct().groupBy("year").agg(F.count("retailer_id").alias("n_retailers"))
    near = F.abs(F.col("estimate") - F.col("n_retailers")) <= F.ceil(4 * sketches.STANDARD_ERROR * F.col("n_retailers"))
    return exact.alias("x").join(estimated.alias("e"), F.col("x.year").eqNullSafe(F.col("e.year"))).select(
        "x.year", "n_retailers", near.cast("int").alias("is_within_error"))


# ---- thresholds of findings

def finding_thresholds(layer, tables) -> DataFrame:
    """Two recorded runs (the first over the findings that a first load would have had) and the report of the second."""
    reports = [layer[n] for n in ("dq_orphan_records", "dq_date_violations", "dq_value_violations")]
    names = sorted({m for models in monitoring.DOMAINS.values() for m in models})
    rows = reduce(DataFrame.unionAll, [layer[n].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("source_model"), "n_rows")
                                       for n in names])
    rows = layer.stage(rows, "model-rows")
    counts = monitoring.FindingCounts(layer.spark, own_folder(layer, "finding-counts"))
    is_early = F.substring(F.md5(F.coalesce("record_id", F.lit("")).cast("binary")), 1, 1) < "8"
    # every run's counts come from one pass over the reports; a few rows a rule are written
    counted = layer.stage(quality.findings_by_policy(*[df.withColumn("is_early", is_early) for df in reports],
                                                     by=("is_early",)), "finding-counts")
    issue = ["policy", "source_model", "issue_type"]
    early = counted.where("is_early").select(*issue, "n_findings")
    found = counted.groupBy(*issue).agg(F.sum("n_findings").alias("n_findings"))
    for run, findings in (("2024-01-01", early), ("2024-01-02", found), ("2024-01-02", found)):
        counts.record(run, findings, rows)
    return counts.report("2024-01-02")


# ---- streaming

LATE_SECONDS = 3600


def streamed_latest_events(layer, tables) -> DataFrame:
    """The last event of each shipment and type, taken in by a stream of several micro-batches over landed files."""
    base = own_folder(layer, "latest-events")
    landed = f"{base}/landed"
    layer["shipment_events_raw"].repartition(3, "event_timestamp", "event_type").write.mode("overwrite").parquet(landed)
    schema = layer["stg_shipment_events"].schema
    table = UpsertTable(layer.spark, f"{base}/table", schema, ["shipment_id", "event_type"],
                        [By("event_timestamp", desc=True)], F.substring(F.md5(F.col("shipment_id").cast("binary")), 1, 1))
    raw = raw_stream(layer.spark, "shipment_events_raw", landed, max_files_per_trigger=1)
    return latest.take_in_landed(layer.spark, raw, staging.stg_shipment_events, table, base, "event_timestamp", LATE_SECONDS)[0]


FACTS_AND_DIMS = ["dim_product", "fct_sales_orders"]
#: query -> (function of the layer and the driver tables, the models and raw extracts it reads)
QUERIES = {
    "asof_order_skus": (asof_order_skus, ["sales_orders_raw"]),
    "currency_sales_totals": (currency_sales_totals, ["fct_sales_orders"]),
    "currency_product_revenue": (currency_product_revenue, ["fct_sales_orders"]),
    "currency_division_revenue": (currency_division_revenue, FACTS_AND_DIMS),
    "incremental_fct_inventory_snapshots": (incremental_inventory, ["stg_inventory_snapshots", "dim_product", "dim_warehouse"]),
    "incremental_fct_retail_pos": (incremental_pos, ["stg_retail_pos", "dim_customer", "dim_product"]),
    "incremental_fct_marketing_performance": (incremental_marketing, ["stg_marketing_performance", "stg_marketing_campaigns",
                                                                      "dim_product"]),
    "product_history": (product_history, ["dim_product"]),
    "warehouse_daily_position": (warehouse_daily_position, ["fct_inventory_snapshots", "fct_shipments"]),
    "inventory_reconciliation": (inventory_reconciliation, ["fct_inventory_snapshots", "fct_purchase_orders", "fct_shipments"]),
    "shipment_event_order": (shipment_event_order, ["stg_shipment_events"]),
    "surrogate_product_keys": (surrogate_product_keys, ["dim_product"]),
    "distinct_retailers_by_year": (distinct_by_year, ["fct_retail_pos"]),
    "finding_thresholds": (finding_thresholds, [*(m for models in monitoring.DOMAINS.values() for m in models),
                                                "dq_orphan_records", "dq_date_violations", "dq_value_violations"]),
    "streamed_latest_events": (streamed_latest_events, ["stg_shipment_events"]),
}
