"""The two daily runs as Spark jobs.

``run_final``: customers -> SCD2 dimension, feedback -> fact_feedback (full
refresh), orders of the look-back window + ratings -> one KPI row upserted by
date, CSV products -> csv_products (full refresh) with statistics, then a
report. ``run_simple``: richer cleaning, KPI upsert, current-state
dimensions by partial upsert and order facts by insert-if-absent, then a check
suite. ``run_warehouse``: all dimensions and bound facts with quality metrics.
Rows that a load does not take are kept in ``rejected_rows`` with their reason.

Every table is a directory of versions (``<target>/<table>/v=N``); a run
reads the newest committed version and writes the next one, so a failed run
leaves the previous state readable and a re-run of the same date gives the
same tables (upserts and insert-if-absent are idempotent, SCD2 sees no
change). DataFrames are passed between steps; nothing is serialised through
the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators import clean, dims, facts, kpi, merge, quality, scd2, state, views
from vitrina.operators.catalog import Catalog

LOOKBACK_DAYS = 7

KPI_SCHEMA = T.StructType([
    T.StructField("analytics_date", T.DateType()), T.StructField("total_orders", T.LongType()),
    T.StructField("total_revenue", T.DecimalType(22, 2)), T.StructField("avg_order_value", T.DecimalType(10, 2)),
    T.StructField("active_customers", T.LongType()), T.StructField("top_city", T.StringType()),
    T.StructField("avg_customer_rating", T.DecimalType(3, 2)), T.StructField("complaint_count", T.LongType()),
    T.StructField("data_source", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])

DIM_CUSTOMERS_SIMPLE = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()), T.StructField("email", T.StringType()),
    T.StructField("city", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("customer_segment", T.StringType()), T.StructField("registration_date", T.DateType()),
    T.StructField("load_date", T.DateType()),
])

DIM_PRODUCTS_SIMPLE = T.StructType([
    T.StructField("product_id", T.LongType()), T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("brand", T.StringType()),
    T.StructField("unit_price", T.DecimalType(10, 2)), T.StructField("stock_quantity", T.IntegerType()),
    T.StructField("load_date", T.DateType()),
])


@dataclass
class Sources:
    """Extracted source frames (any may be None when the source is absent)."""
    customers: DataFrame | None = None
    products: DataFrame | None = None
    orders: DataFrame | None = None
    feedback: DataFrame | None = None
    csv_products: DataFrame | None = None
    order_items: DataFrame | None = None
    payments: DataFrame | None = None


# Columns that the CSV source must have (Q-1).
CSV_REQUIRED = ["product_id", "product_name", "unit_price"]


def lookback(orders: DataFrame, run_date: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """S-2: order_date >= run_date - days, no upper bound (pushed to the scan)."""
    return orders.where(F.col("order_date") >= F.date_sub(F.lit(run_date).cast("date"), days))


def _table(target: str, name: str) -> str:
    return f"{target.rstrip('/')}/{name}"


def _stamp(run_date: str, hour: int = 9) -> F.Column:
    """Deterministic 'now' of a run (a re-run writes the same values)."""
    return F.lit(f"{run_date} {hour:02d}:00:00").cast("timestamp_ntz")


def upsert_kpis(spark: SparkSession, target: str, row: DataFrame, run_date: str, source: str,
                audit: str) -> DataFrame:
    """K-2: the KPI row of the run replaces the measures of its date; other
    declared columns keep their value. ``audit``: the column that the run sets
    on every update, 'updated_at' (final run) or 'processed_at' (simple run);
    created_at and processed_at have the insert's time by default."""
    path = _table(target, "daily_business_analytics")
    cur = merge.ensure_table(spark, path, KPI_SCHEMA)
    now = _stamp(run_date)
    src = row.withColumn("data_source", F.lit(source))
    measures = ["total_orders", "total_revenue", "avg_order_value", "active_customers", "top_city",
                "avg_customer_rating", "complaint_count", "data_source"]
    insert_only = {c: now for c in ("created_at", "processed_at") if c != audit}
    out = merge.upsert(cur, src, "analytics_date", measures, touch={audit: now}, insert_only=insert_only)
    merge.write_version(out, path)
    return merge.read_current(spark, path, KPI_SCHEMA)


def upsert_declared(spark: SparkSession, target: str, kpis: DataFrame, run_date: str) -> None:
    """D-1 ... D-7 of every date that the run's orders have, upserted by date."""
    path = _table(target, "daily_declared_kpis")
    cur = merge.ensure_table(spark, path, kpis.schema)
    merge.write_version(merge.upsert(cur, kpis, "analytics_date"), path)


def _reject(target: str, run_date: str, table: str, rows: DataFrame) -> None:
    merge.write_rejected(rows, _table(target, "rejected_rows"), run_date, table)


def rejected_counts(spark: SparkSession, target: str, run_date: str) -> DataFrame:
    """Rejected rows of a run by table and reason."""
    rows = merge.read_rejected(spark, _table(target, "rejected_rows")).where(F.col("run_date") == F.lit(run_date).cast("date"))
    name = F.concat_ws(": ", "table_name", "reject_reason").alias("name")
    return rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def load_dimension(spark: SparkSession, target: str, table: str, rows: DataFrame, run_date: str, order: list[str],
                   spec: scd2.DimSpec) -> DataFrame:
    """K-5: one batch into a stored dimension; returns the counts. History is
    appended to, rows that are not applied are kept as rejected."""
    path = _table(target, table)
    last = scd2.max_key(scd2.read_dimension(spark, path, spec), spec.surrogate_key)
    merged = scd2.merge_current(scd2.read_current_rows(spark, path, spec), rows, run_date, order, spec, last,
                                now=_stamp(run_date))
    scd2.write_dimension(merged, path)
    _reject(target, run_date, table, merged.rejected)
    return merged.counts


def run_final(spark: SparkSession, src: Sources, target: str, run_date: str) -> DataFrame:
    """The final daily run. Returns the report (section, metric and a value
    column for each kind of value)."""
    sections: dict = {}
    tables: dict[str, DataFrame] = {}
    if src.customers is not None:  # customers -> SCD2 dimension
        cust = clean.clean_customers_final(src.customers)
        order = ["customer_id"] if "updated_at" not in cust.columns else ["updated_at", "customer_id"]
        sections["scd2"] = load_dimension(spark, target, "dim_customers", cust, run_date, order, scd2.CUSTOMERS)
        tables["dim_customers"] = scd2.read_dimension(spark, _table(target, "dim_customers"))
    if src.feedback is not None:  # feedback -> fact_feedback, full refresh with keys 1..n
        order = [c for c in ("_id", "feedback_id") if c in src.feedback.columns] or src.feedback.columns[:1]
        path = _table(target, "fact_feedback")
        merge.write_version(facts.fact_feedback(src.feedback, run_date, order), path)
        tables["fact_feedback"] = merge.read_current(spark, path)
        sections["feedback"] = kpi.rating_stats(tables["fact_feedback"])
    if src.orders is not None:  # orders of the look-back window + ratings -> one KPI row, upserted
        o = clean.clean_orders_final(lookback(src.orders, run_date))
        ratings = None
        if src.feedback is not None and "rating" in src.feedback.columns:
            ratings = src.feedback.select(F.col("rating").try_cast("double").alias("rating"))
        row = kpi.run_kpis(o, ratings, run_date, LOOKBACK_DAYS, variant="final")
        kpis = upsert_kpis(spark, target, row, run_date, "final_etl_working", "updated_at")
        sections["latest_kpi"] = views.latest_row(kpis)
        tables["daily_business_analytics"] = kpis
        sections["totals"] = kpis.agg(F.count(F.lit(1)).alias("days"), F.sum("total_orders").alias("orders"),
                                      F.sum("total_revenue").alias("revenue"))
        if src.order_items is not None and src.products is not None:
            tx = Catalog(spark, _table(target, "state")).begin()
            if tx.entry("first_orders") is None:  # the first run alone reads all orders
                state.record_first_orders(tx, clean.clean_orders_final(src.orders))
            declared = state.daily_declared_kpis(tx, o, src.order_items, src.products)
            upsert_declared(spark, target, declared, run_date)
            tx.commit()
    if src.csv_products is not None:  # CSV products -> csv_products, full refresh, validation, statistics
        sections["csv_validation"] = quality.validation_report(src.csv_products, CSV_REQUIRED)
        rows, bad = facts.csv_products_rows(src.csv_products, run_date, ["product_id"])
        _reject(target, run_date, "csv_products",
                bad.withColumn("reject_reason", F.array_join("failed_checks", "; ")).drop("failed_checks"))
        path = _table(target, "csv_products")
        merge.write_version(rows, path)
        stored = tables["csv_products"] = merge.read_current(spark, path)
        sections["csv_stats"] = kpi.product_stats(stored)
        sections["csv_categories"] = (stored.groupBy("category").agg(F.count(F.lit(1)).alias("count")), "category", "count")
        sections["top_categories"] = (kpi.top_by_count(stored, "category", 3), "category", "count")
    if not sections:
        return None
    sections["table_counts"] = (kpi.table_counts(tables), "table_name", "row_count")
    sections["rejected"] = (rejected_counts(spark, target, run_date), "name", "n")
    return quality.pipeline_report(sections)


def run_warehouse(spark: SparkSession, src: Sources, target: str, run_date: str) -> DataFrame:
    """The warehouse load: customer and product dimensions, date, time and
    status dimensions, order and payment facts bound to the versions valid on
    their date, and one quality-metrics row per source. Returns the metrics."""
    cust = clean.clean_customers_final(src.customers)
    load_dimension(spark, target, "dim_customers", cust, run_date, ["customer_id"], scd2.CUSTOMERS)
    load_dimension(spark, target, "dim_products", src.products, run_date, ["product_id"], scd2.PRODUCTS)
    dim_c = scd2.read_dimension(spark, _table(target, "dim_customers"))
    dim_p = scd2.read_dimension(spark, _table(target, "dim_products"), scd2.PRODUCTS)
    statuses = dims.order_status_seed(spark)
    merge.write_version(dims.dim_date_between(src.orders, "order_date"), _table(target, "dim_date"))
    merge.write_version(dims.dim_time(spark), _table(target, "dim_time"))
    merge.write_version(statuses, _table(target, "dim_order_status"))
    lines = facts.order_lines(src.orders, src.order_items, src.products)
    rows, bad = facts.fact_orders(lines, dim_c, dim_p, statuses, run_date)
    merge.write_version(rows, _table(target, "fact_orders"))
    _reject(target, run_date, "fact_orders",
            bad.withColumn("reject_reason", F.array_join("failed_checks", "; ")).drop("failed_checks"))
    if src.payments is not None:
        merge.write_version(facts.fact_payments(src.payments, dim_c, run_date), _table(target, "fact_payments"))
    metrics = quality.quality_metrics("customers", src.customers, "customer_id", {}, run_date).unionByName(
        quality.quality_metrics("order_items", lines, ["order_id", "product_id"], facts.fact_checks(), run_date))
    path = _table(target, "data_quality_metrics")
    cur = merge.ensure_table(spark, path, metrics.schema)
    merge.write_version(merge.upsert(cur, metrics, ["run_date", "source_name"]), path)
    return merge.read_current(spark, path, metrics.schema)


def commit_warehouse(catalog: Catalog, src: Sources, run_date: str, buckets: int = 256) -> int:
    """The warehouse load in one commit (K-10): customer and product dimensions
    (current rows in buckets), order and payment facts bound to them by a sorted
    merge, and one quality-metrics row per source, upserted. All of it becomes
    current at once or, if anything fails or another load has changed a table
    meanwhile, nothing does. Returns the commit's version."""
    tx = catalog.begin()
    stamp = {"now": _stamp(run_date), "buckets": buckets}
    tx.merge_dimension("dim_customers", clean.clean_customers_final(src.customers), run_date, ["customer_id"], scd2.CUSTOMERS, **stamp)
    tx.merge_dimension("dim_products", src.products, run_date, ["product_id"], scd2.PRODUCTS, **stamp)
    dim_c, dim_p = tx.dimension("dim_customers"), tx.dimension("dim_products")
    lines = facts.order_lines(src.orders, src.order_items, src.products)
    rows, bad = facts.fact_orders(lines, dim_c, dim_p, dims.order_status_seed(catalog.spark), run_date, bind=facts.asof_merge)
    tx.replace("fact_orders", rows, ["order_id", "product_id"])
    bad = bad.withColumn("reject_reason", F.array_join("failed_checks", "; ")).drop("failed_checks")
    tx.replace("rejected_orders", bad, ["order_id", "product_id"])
    if src.payments is not None:
        payments = facts.fact_payments(src.payments, dim_c, run_date, bind=facts.asof_merge)
        tx.replace("fact_payments", payments, "payment_id")
    metrics = quality.quality_metrics("customers", src.customers, "customer_id", {}, run_date).unionByName(
        quality.quality_metrics("order_items", lines, ["order_id", "product_id"], facts.fact_checks(), run_date))
    if tx.entry("data_quality_metrics") is None:
        tx.replace("data_quality_metrics", metrics, ["run_date", "source_name"])
    else:
        tx.upsert("data_quality_metrics", metrics)
    return tx.commit()


def run_simple(spark: SparkSession, src: Sources, target: str, run_date: str) -> DataFrame:
    """The simple daily run. Returns the check suite."""
    checks: list[tuple[str, DataFrame]] = []
    cust = clean.clean_customers_simple(src.customers) if src.customers is not None else None
    prod = clean.clean_products_simple(src.products) if src.products is not None else None
    orders = clean.clean_orders_simple(lookback(src.orders, run_date)) if src.orders is not None else None
    fb = None
    if src.feedback is not None and "rating" in src.feedback.columns:
        fb = clean.clean_feedback_simple(src.feedback)
    if orders is not None:
        row = kpi.run_kpis(orders, fb, run_date, LOOKBACK_DAYS, variant="simple")
        upsert_kpis(spark, target, row, run_date, "simple_etl_dag", "processed_at")
    run = F.lit(run_date).cast("date")
    if cust is not None:
        path = _table(target, "dim_customers_simple")
        cur = merge.ensure_table(spark, path, DIM_CUSTOMERS_SIMPLE)
        valid, bad = merge.tolerant_load(cust, {"customer_id": "bigint"})
        _reject(target, run_date, "dim_customers_simple", bad)
        out = merge.upsert(cur, valid.withColumn("load_date", run), "customer_id",
                           ["city", "country", "customer_segment"], order_cols=["customer_id"])
        merge.write_version(out, path)
        loaded = merge.read_current(spark, path)
        checks.append(("customers_loaded", loaded.agg((F.count(F.lit(1)) > 0).alias("passed"),
                                                      F.count(F.lit(1)).alias("value"))))
    if prod is not None:
        path = _table(target, "dim_products_simple")
        cur = merge.ensure_table(spark, path, DIM_PRODUCTS_SIMPLE)
        valid, bad = merge.tolerant_load(prod, {"product_id": "bigint", "unit_price": "decimal(10,2)"})
        _reject(target, run_date, "dim_products_simple", bad)
        out = merge.upsert(cur, valid.withColumn("load_date", run), "product_id",
                           ["product_name", "unit_price", "stock_quantity"], order_cols=["product_id"])
        merge.write_version(out, path)
    if orders is not None:
        path = _table(target, "fact_orders_simple")
        valid, bad = merge.tolerant_load(orders, {c: t for c, t in facts.SIMPLE_ORDER_TYPES.items() if c in orders.columns})
        _reject(target, run_date, "fact_orders_simple", bad)
        merge.append_absent(spark, path, facts.SIMPLE_ORDERS_SCHEMA, facts.simple_order_rows(valid, run_date),
                            ["order_id", "load_date"], "load_date", ["order_id"])
        loaded = merge.read_appended(spark, path, facts.SIMPLE_ORDERS_SCHEMA)
        dup = quality.duplicate_keys(loaded, ["order_id", "load_date"])
        checks.append(("fact_keys_unique", dup.agg((F.count(F.lit(1)) == 0).alias("passed"),
                                                   F.count(F.lit(1)).alias("value"))))
    return quality.check_suite(checks) if checks else None
