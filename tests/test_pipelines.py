"""Daily runs end to end on the sf0.001 driver tables: a re-run of the same
date leaves every table as it was; a later date moves the state on."""

import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from vitrina.operators import facts, merge, scd2
from vitrina.plans.pipelines import Sources, run_final, run_simple, run_warehouse
from vitrina.sources import standins as st

RUN_1, RUN_2 = "1998-08-01", "1998-08-02"


def sources(spark, sf):
    fb = st.feedback(spark, sf).select(F.col("doc_id").cast("string").alias("feedback_id"), "comment",
                                       F.col("rating_raw").alias("rating"))
    return Sources(customers=st.customers(spark, sf), products=st.products(spark, sf),
                   orders=st.orders(spark, sf, with_city=True), feedback=fb)


def snapshot(spark, target, name):
    if name == "dim_customers":
        df = scd2.read_dimension(spark, f"{target}/{name}")
    elif name == "fact_orders_simple":
        df = merge.read_appended(spark, f"{target}/{name}", facts.SIMPLE_ORDERS_SCHEMA)
    else:
        df = merge.read_current(spark, f"{target}/{name}")
    return sorted(tuple(r) for r in df.collect())


def files(base):
    """Files under a folder with their times."""
    return {str(p): p.stat().st_mtime_ns for p in Path(base).rglob("part-*")}


def test_simple_run_is_repeatable(spark, sf):
    target = tempfile.mkdtemp(prefix="vitrina-dwh-")
    src = sources(spark, sf)
    checks = run_simple(spark, src, target, RUN_1).collect()
    assert checks[-1]["check_name"] == "success"
    tables = ["daily_business_analytics", "dim_customers_simple", "dim_products_simple", "fact_orders_simple"]
    before = {t: snapshot(spark, target, t) for t in tables}
    run_simple(spark, src, target, RUN_1)
    after = {t: snapshot(spark, target, t) for t in tables}
    assert before == after
    there = files(f"{target}/fact_orders_simple")
    run_simple(spark, src, target, RUN_2)
    assert there.items() <= files(f"{target}/fact_orders_simple").items()  # earlier load dates keep their files
    loaded = merge.read_appended(spark, f"{target}/fact_orders_simple", facts.SIMPLE_ORDERS_SCHEMA)
    # the look-back window puts an order into every load date that sees it
    assert loaded.select("load_date").distinct().count() == 2
    assert loaded.groupBy("order_id", "load_date").count().where("count > 1").count() == 0
    kpis = merge.read_current(spark, f"{target}/daily_business_analytics")
    assert kpis.count() == 2


def test_final_run_is_repeatable(spark, sf):
    target = tempfile.mkdtemp(prefix="vitrina-dwh-")
    src = sources(spark, sf)
    report = run_final(spark, src, target, RUN_1)
    counts = {r["metric"]: r["value_long"] for r in report.where("section = 'scd2'").collect()}
    assert int(counts["new_records"]) == src.customers.count()
    tables = ["daily_business_analytics", "dim_customers", "fact_feedback"]
    before = {t: snapshot(spark, target, t) for t in tables}
    report2 = run_final(spark, src, target, RUN_1)
    counts2 = {r["metric"]: r["value_long"] for r in report2.where("section = 'scd2'").collect()}
    assert int(counts2["new_records"]) == 0 and int(counts2["updated_records"]) == 0
    assert {t: snapshot(spark, target, t) for t in tables} == before
    assert {r["section"] for r in report2.select("section").distinct().collect()} == {
        "scd2", "feedback", "latest_kpi", "totals", "table_counts"}
    dim = scd2.read_dimension(spark, f"{target}/dim_customers")
    assert dim.where("is_current").groupBy("customer_id").count().where("count > 1").count() == 0


def test_history_is_appended_only(spark, sf):
    target = tempfile.mkdtemp(prefix="vitrina-dwh-")
    src = sources(spark, sf)
    run_final(spark, src, target, RUN_1)
    src.customers = src.customers.withColumn("city", F.when(F.col("customer_id") % 2 == 0, "Moved").otherwise(F.col("city")))
    run_final(spark, src, target, RUN_2)
    history = files(f"{target}/dim_customers/history")
    src.customers = src.customers.withColumn("city", F.lit("Elsewhere"))
    run_final(spark, src, target, "1998-08-03")
    assert history.items() <= files(f"{target}/dim_customers/history").items()
    dim = scd2.read_dimension(spark, f"{target}/dim_customers")
    n = src.customers.count()
    moved = src.customers.where("customer_id % 2 = 0").count()
    assert dim.count() == 2 * n + moved and dim.where("is_current").count() == n
    assert dim.select("customer_key").distinct().count() == dim.count()


def test_rows_in_are_rows_loaded_or_rejected(spark, sf):
    target = tempfile.mkdtemp(prefix="vitrina-dwh-")
    src = sources(spark, sf)
    o = src.orders.limit(50).select(F.col("order_id").cast("string"), F.col("customer_id").cast("string"), "order_date",
                                    F.col("total_amount").cast("string"), "status", "payment_method", "shipping_city")
    o = o.withColumn("order_date", F.lit(RUN_1).cast("date"))
    bad = spark.createDataFrame([("x", "1", "10"), ("-1", "y", "10"), ("-2", "1", "99999999999999"), ("-3", None, "1"),
                                 ("-4", "1", "no number")], "order_id string, customer_id string, total_amount string")
    src.orders = o.unionByName(bad.withColumn("order_date", F.lit(RUN_1).cast("date")), allowMissingColumns=True)
    for _ in range(2):
        run_simple(spark, src, target, RUN_1)
        loaded = merge.read_appended(spark, f"{target}/fact_orders_simple", facts.SIMPLE_ORDERS_SCHEMA)
        rejected = merge.read_rejected(spark, f"{target}/rejected_rows").where("table_name = 'fact_orders_simple'")
        assert (loaded.count(), rejected.count()) == (51, 4)  # what is no number is 0, as in the cleaning rules
    reasons = sorted(r["reject_reason"] for r in rejected.collect())
    assert reasons == ["bad customer_id", "bad order_id", "missing customer_id", "missing total_amount"]
    # final run: late rows and rows without a key are kept beside the dimension
    src = sources(spark, sf)
    run_final(spark, src, target, RUN_2)
    n = src.customers.count()
    src.customers = src.customers.withColumn("city", F.lit("Late")).unionByName(
        src.customers.limit(3).withColumn("customer_id", F.lit(None).cast("long")))
    report = run_final(spark, src, target, RUN_1)
    got = {r["metric"]: r["value_long"] for r in report.where("section in ('scd2', 'rejected')").collect()}
    assert got["dim_customers: late"] == n and got["dim_customers: no natural key"] == 3
    assert got["new_records"] + got["updated_records"] + got["unchanged_records"] == 0


def test_kpi_audit_columns(spark, sf):
    target = tempfile.mkdtemp(prefix="vitrina-dwh-")
    src = sources(spark, sf)
    run_final(spark, src, target, RUN_1)
    run_simple(spark, src, target, RUN_1)
    row = merge.read_current(spark, f"{target}/daily_business_analytics").first()
    assert row["processed_at"] is not None and row["created_at"] is not None and row["updated_at"] is not None
    assert row["data_source"] == "simple_etl_dag"


def test_warehouse_run(spark, sf):
    target = tempfile.mkdtemp(prefix="vitrina-dwh-")
    src = sources(spark, sf)
    src.order_items, src.payments = st.order_items(spark, sf), st.payments(spark, sf, with_order=True)
    src.orders = src.orders.where(F.col("order_date") < "1998-01-01")
    run_warehouse(spark, src, target, "1992-01-01")
    loaded = merge.read_current(spark, f"{target}/fact_orders")
    rejected = merge.read_rejected(spark, f"{target}/rejected_rows").where("table_name = 'fact_orders'")
    assert loaded.count() + rejected.count() == src.order_items.count() and rejected.count() > 0
    assert loaded.where("customer_key is null or product_key is null or status_key is null").count() == 0
    for table in ("dim_date", "dim_time", "dim_order_status", "fact_payments", "data_quality_metrics"):
        assert merge.read_current(spark, f"{target}/{table}").count() > 0
