"""Incremental order loads as a Structured Streaming query.

The reference is a daily batch whose overlapping 7-day look-back is made safe
by insert-if-absent. The same load runs here per micro-batch of new source
files (``foreachBatch``): each batch is cleaned and its new rows, by key
(order_id, load_date), are appended to fact_orders_simple; only the load_date
partitions of the batch are read, no file that exists is written again. Rows
that do not convert go to the rejected rows. Because the load is idempotent, a
batch replayed after a failure (the sink is at-least-once) leaves the table
unchanged; the stream's progress lives in the checkpoint location, which must
be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vitrina.operators import clean, facts, merge


def order_files(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New parquet files of orders under ``path`` (a glob such as ``in/*`` reaches
    one level of sub-directories) as a stream."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def load_batch(batch: DataFrame, target: str, run_date: str, batch_id: int = 0) -> None:
    """One micro-batch: clean, set aside what does not convert, append what is absent."""
    valid, rejected = merge.tolerant_load(clean.clean_orders_simple(batch), facts.SIMPLE_ORDER_TYPES)
    merge.write_rejected(rejected, f"{target}_rejected", run_date, f"orders-{batch_id}")
    merge.append_absent(batch.sparkSession, target, facts.SIMPLE_ORDERS_SCHEMA,
                        facts.simple_order_rows(valid, run_date), ["order_id", "load_date"], "load_date", ["order_id"])


def start_orders_load(stream: DataFrame, target: str, checkpoint_location: str, run_date: str,
                      available_now: bool = True) -> StreamingQuery:
    """Start the load. ``available_now`` processes what is there and stops
    (a scheduled run); otherwise it keeps polling for new files."""
    w = (stream.writeStream.foreachBatch(lambda df, i: load_batch(df, target, run_date, i))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
