"""Best row per key of a stream, with late events: equal to the batch result once everything has arrived.

Each micro-batch is staged by the batch staging function and merged into an ``UpsertTable``: the table is the keyed
state, so it survives restarts, grows with the keys and not with the events, and a micro-batch that is replayed after
a failure changes nothing. No event is too late to count: instead of dropping what a watermark has passed, each batch
is compared with the greatest event time taken in before it, and events older than that by more than the allowed
delay are appended to a findings folder (one per batch, overwritten on a replay).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.upsert import Folder, UpsertTable


def late_events(batch: DataFrame, table: UpsertTable, event_time: str, delay_seconds: int) -> DataFrame:
    """Rows of ``batch`` that lie more than the delay behind the greatest event time in the table."""
    at = F.unix_timestamp(F.substring(event_time, 1, 19))
    mark = table.read().agg(F.max(at)).first()[0]
    return batch.where(at < F.lit(mark) - delay_seconds) if mark is not None else batch.limit(0)


def latest_stream(stream: DataFrame, table: UpsertTable, checkpoint: str, late_path: str, event_time: str,
                  delay_seconds: int) -> StreamingQuery:
    """Merge every micro-batch of staged rows into ``table``; process what has landed, then stop."""
    def take_in(batch: DataFrame, number: int) -> None:
        late_events(batch, table, event_time, delay_seconds).write.mode("overwrite").parquet(f"{late_path}/batch={number}")
        table.merge(batch)
    return (stream.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def take_in_landed(spark: SparkSession, raw: DataFrame, staged: Callable[[DataFrame], DataFrame], table: UpsertTable,
                   base: str, event_time: str, delay_seconds: int) -> tuple[DataFrame, DataFrame]:
    """Run one catch-up over the landed files; (the best rows so far, the late events of all batches)."""
    query = latest_stream(staged(raw), table, f"{base}/checkpoint", f"{base}/late", event_time, delay_seconds)
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    late = f"{base}/late"
    schema = StructType([*table.schema.fields[:-1]])
    found = (spark.read.schema(schema).parquet(*Folder(spark, late).children()) if Folder(spark, late).exists()
             else spark.createDataFrame([], schema))
    return table.read(), found
