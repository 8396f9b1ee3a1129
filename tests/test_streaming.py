"""The incremental order load as a stream: all files once, replays change nothing."""

import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from vitrina.operators import facts, merge
from vitrina.sources import standins as st
from vitrina.streaming.incremental import order_files, start_orders_load


def test_stream_load_is_idempotent(spark, sf):
    base = tempfile.mkdtemp(prefix="vitrina-stream-")
    src, target, ckpt = f"{base}/in", f"{base}/fact_orders_simple", f"{base}/ckpt"
    orders = st.orders(spark, sf, with_city=True).cache()
    early = orders.where(F.col("order_date") < "1997-01-01")
    early.write.parquet(f"{src}/part-a")
    q = start_orders_load(order_files(spark, f"{src}/*", orders.schema), target, ckpt, "1998-08-02")
    q.awaitTermination(300)
    read = lambda: merge.read_appended(spark, target, facts.SIMPLE_ORDERS_SCHEMA)
    assert read().count() == early.count()
    there = {str(p): p.stat().st_mtime_ns for p in Path(target).rglob("part-*")}
    # new files arrive, one of them repeating every early order
    orders.where(F.col("order_date") >= "1997-01-01").write.parquet(f"{src}/part-b")
    early.write.parquet(f"{src}/part-c")
    q = start_orders_load(order_files(spark, f"{src}/*", orders.schema), target, ckpt, "1998-08-02")
    q.awaitTermination(300)
    out = read()
    now = {str(p): p.stat().st_mtime_ns for p in Path(target).rglob("part-*")}
    assert there.items() <= now.items()  # a micro-batch touches no file that exists
    assert out.count() == orders.count()
    assert out.groupBy("order_id", "load_date").count().where("count > 1").count() == 0
