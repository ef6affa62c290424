"""Incremental staging with Structured Streaming.

Raw extracts usually land as files, batch after batch. The staging models are
row-wise cleaning plus lookups into the (static) taxonomy, so the very same
functions run on a streaming source: each trigger stages only the files that
arrived since the last run. Offsets and sink metadata live under a
checkpoint folder in the shared ``spark.checkpoint.dir``, so a restarted or
failed run resumes exactly where it stopped and the file sink stays
exactly-once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.findings import evaluate
from ..operators.mapping import Taxonomy
from ..operators.sizing import max_broadcast_bytes, max_broadcast_rows
from ..plans import quality, staging
from ..plans.dag import shared_folder
from ..sources.raw import raw_schema

# staging models that need the taxonomy as their second argument
_WITH_TAXONOMY = {"stg_products", "stg_product_hierarchy", "stg_customers", "stg_sales_orders", "stg_retail_pos",
                  "stg_marketing_campaigns", "stg_marketing_performance", "stg_inventory_snapshots",
                  "stg_warehouse_locations", "stg_suppliers", "stg_purchase_orders", "stg_shipments",
                  "stg_carrier_performance"}


def raw_stream(spark: SparkSession, raw_name: str, path: str, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over landed files of one raw extract (explicit all-text schema)."""
    r = spark.readStream.format(fmt).schema(raw_schema(raw_name))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def staged_stream(model: str, raw: DataFrame, taxonomy: DataFrame | None = None) -> DataFrame:
    """Apply a staging model to a (streaming) raw frame; lookups are stream-static left joins."""
    fn = getattr(staging, model)
    if model in _WITH_TAXONOMY:
        if taxonomy is None:
            raise ValueError(f"{model} needs the standardised taxonomy")
        # lookup slices of a static table; sizes measured once, small slices broadcast
        spark = raw.sparkSession
        return fn(raw, Taxonomy(taxonomy, max_broadcast_rows(spark), max_broadcast_bytes(spark)))
    return fn(raw)


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "kiln-streams", name)


def start_incremental(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                      fmt: str = "parquet") -> StreamingQuery:
    """Append the staged rows to ``out_path``; ``available_now`` processes what has landed, then stops."""
    w = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_path)


def stage_landed_files(spark: SparkSession, model: str, raw_name: str, raw_path: str, out_path: str,
                       taxonomy: DataFrame | None = None, checkpoint: str | None = None) -> DataFrame:
    """Run one catch-up pass (new files only) and return the staged table as a batch DataFrame."""
    q = start_incremental(staged_stream(model, raw_stream(spark, raw_name, raw_path), taxonomy), out_path,
                          checkpoint or checkpoint_location(spark, model))
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out_path)


def event_findings_sink(findings_path: str):
    """``foreachBatch`` writer: stateless timestamp findings of each micro-batch of staged events.

    Each micro-batch overwrites its own ``batch=<id>`` folder, so a batch
    replayed after a failure replaces its earlier output instead of adding to
    it (idempotent per batch id).
    """
    rules = quality.date_rules()["stg_shipment_events"]

    def write(batch: DataFrame, batch_id: int) -> None:
        evaluate(batch, rules, with_offending=False).write.mode("overwrite") \
            .parquet(os.path.join(findings_path, f"batch={batch_id}"))
    return write


def monitor_events(spark: SparkSession, raw_path: str, findings_path: str, checkpoint: str | None = None
                   ) -> StreamingQuery:
    """Stage shipment events as they land and write their bad-timestamp findings per micro-batch."""
    staged = staged_stream("stg_shipment_events", raw_stream(spark, "shipment_events_raw", raw_path))
    return (staged.writeStream.foreachBatch(event_findings_sink(findings_path))
            .option("checkpointLocation", checkpoint or checkpoint_location(spark, "event_findings"))
            .trigger(availableNow=True).start())
