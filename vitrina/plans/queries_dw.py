"""Registered warehouse queries: merges, SCD2, dimensions, facts, views and
quality checks, each over the whole driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.operators import dims, facts, kpi, merge, quality, scd2, views
from vitrina.operators.clean import clean_orders_simple
from vitrina.plans.queries import RUN_DATE, register
from vitrina.session import cut_lineage
from vitrina.sources import standins as st
from vitrina.sources.tables import read_table

# Fixed parameters of the registered warehouse runs.
SCD_RUN_1 = "1994-01-01"   # first load of the customer dimension
SCD_RUN_2 = "1998-01-01"   # second load, with changes
SPLIT_DATE = "1998-01-01"  # upsert: target holds dates before, source from the overlap start
OVERLAP_START = "1997-07-01"


# ---------------------------------------------------------------- SCD2
def customer_batches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Batch 1: customers outside ASIA. Batch 2: every customer; BUILDING moves
    city (change), MACHINERY upper-cases e-mail (case only: no change),
    FURNITURE shifts a letter from last to first name (same concatenation: no
    change), HOUSEHOLD arrives twice (new e-mail, then the old one again:
    two chained versions)."""
    c = st.customers(spark, d).select("customer_id", "first_name", "last_name", "email", "city", "country",
                                      "customer_segment")
    seq = (F.col("customer_id") * 2).alias("seq")
    cols = ["customer_id", "first_name", "last_name", "email", "city"]
    b1 = c.where(F.col("country") != "ASIA").select(*cols, seq)
    seg = F.col("customer_segment")
    first = F.when(seg == "FURNITURE", F.concat("first_name", F.substring("last_name", 1, 1))).otherwise(
        F.col("first_name"))
    last = F.when(seg == "FURNITURE", F.substring("last_name", 2, 1 << 20)).otherwise(F.col("last_name"))
    email = (F.when(seg == "MACHINERY", F.upper("email"))
              .when(seg == "HOUSEHOLD", F.concat(F.lit("new."), F.col("email"))).otherwise(F.col("email")))
    city = F.when(seg == "BUILDING", F.concat(F.col("city"), F.lit(" 2"))).otherwise(F.col("city"))
    main = c.select("customer_id", first.alias("first_name"), last.alias("last_name"), email.alias("email"),
                    city.alias("city"), seq)
    again = c.where(seg == "HOUSEHOLD").select(*cols, (F.col("customer_id") * 2 + 1).alias("seq"))
    return b1, main.unionByName(again)


def customer_dimension(spark: SparkSession, d: str):
    """(dimension after both loads, counts of the second load)."""
    b1, b2 = customer_batches(spark, d)
    dim1, _, _ = scd2.scd2_merge(scd2.empty_dim(spark), b1, SCD_RUN_1, ["seq"])
    dim1 = cut_lineage(dim1)
    dim2, counts, _ = scd2.scd2_merge(dim1, b2, SCD_RUN_2, ["seq"])
    return cut_lineage(dim2), counts


@register("scd2_customers")
def q_scd2_customers(spark, d):
    """K-5: customer dimension after two loads (all versions)."""
    return customer_dimension(spark, d)[0]


@register("scd2_counts")
def q_scd2_counts(spark, d):
    """A-13: new / updated / unchanged of the second load."""
    return customer_dimension(spark, d)[1]


@register("current_customers")
def q_current_customers(spark, d):
    """V-1."""
    return views.current_customers(customer_dimension(spark, d)[0])


@register("customer_history")
def q_customer_history(spark, d):
    """V-2."""
    return views.customer_history(customer_dimension(spark, d)[0])


def product_dimension(spark: SparkSession, d: str) -> DataFrame:
    """B-4: products loaded twice; the second load changes the price of
    SMALL-type parts and the brand case of others (case only: no change)."""
    p = st.products(spark, d)
    b1 = p.select("product_id", "product_name", "category", "brand", "unit_price",
                  F.col("product_id").alias("seq"))
    small = F.col("category").startswith("SMALL")
    b2 = p.select("product_id", "product_name", "category", F.lower("brand").alias("brand"),
                  F.when(small, F.col("unit_price") + 1).otherwise(F.col("unit_price")).alias("unit_price"),
                  F.col("product_id").alias("seq"))
    dim1, _, _ = scd2.scd2_merge(scd2.empty_dim(spark, scd2.PRODUCTS), b1, SCD_RUN_1, ["seq"], spec=scd2.PRODUCTS)
    dim2, _, _ = scd2.scd2_merge(cut_lineage(dim1), b2, SCD_RUN_2, ["seq"], spec=scd2.PRODUCTS)
    return cut_lineage(dim2)


@register("scd2_products")
def q_scd2_products(spark, d):
    """B-4: product dimension with versions."""
    return product_dimension(spark, d)


# ---------------------------------------------------------------- merges
def _kpi_frame(orders: DataFrame) -> DataFrame:
    return kpi.daily_kpis(orders)


@register("upsert_full")
def q_upsert_full(spark, d):
    """K-2 / K-11: KPI rows per date. Target: dates before the split, with
    extra columns the load does not write; source: dates from the overlap
    start. Matched dates get the new measures and updated_at; other columns
    keep their value; new dates are inserted."""
    o = clean_orders_simple(st.orders(spark, d, with_city=True))
    tgt = (o.where(F.col("order_date") < F.lit(SPLIT_DATE).cast("date")).groupBy(F.col("order_date")
           .alias("analytics_date"))
           .agg(F.count(F.lit(1)).alias("total_orders"), kpi.money_sum("total_amount").alias("total_revenue"),
                F.count_if(F.col("status") == "Pending").alias("new_orders"),
                F.count_if(F.col("status") == "Cancelled").alias("cancelled_orders"))
           .withColumn("created_at", F.lit("1997-12-31 00:00:00").cast("timestamp_ntz"))
           .withColumn("updated_at", F.lit(None).cast("timestamp_ntz")))
    src = _kpi_frame(o.where(F.col("order_date") >= F.lit(OVERLAP_START).cast("date")))
    now = F.lit(f"{RUN_DATE} 09:00:00").cast("timestamp_ntz")
    return merge.upsert(tgt.withColumn("avg_order_value", F.lit(None).cast("double"))
                        .withColumn("top_city", F.lit(None).cast("string")),
                        src, "analytics_date", ["total_orders", "total_revenue", "avg_order_value", "top_city"],
                        touch={"updated_at": now}, insert_only={"created_at": now})


@register("upsert_partial")
def q_upsert_partial(spark, d):
    """K-3 (dim_customers_simple): only city, country, segment are updated;
    other columns keep the old value even when it is NULL."""
    old = st.customers(spark, d).where(F.col("country") != "AFRICA").select(
        "customer_id", F.when(F.col("customer_segment") == "AUTOMOBILE", F.lit(None).cast("string"))
        .otherwise(F.col("first_name")).alias("first_name"), "last_name", "email", "phone", "city", "country",
        "customer_segment")
    from vitrina.operators.clean import clean_customers_simple
    new = clean_customers_simple(st.customers_raw(spark, d))
    return merge.upsert(old, new, "customer_id", ["city", "country", "customer_segment"])


def daily_loads(spark: SparkSession, d: str) -> DataFrame:
    """fact_orders_simple rows of every daily load: the load of day L takes
    the orders with L - 7 <= order_date <= L, so each order is loaded on the
    8 days from its order date (key (order_id, load_date): kept as is)."""
    o = clean_orders_simple(st.orders(spark, d, with_city=True))
    rows = facts.simple_order_rows(o, RUN_DATE)
    return rows.withColumn("load_date", F.explode(F.sequence(F.col("order_date"), F.date_add("order_date", 7))))


@register("insert_if_absent")
def q_insert_if_absent(spark, d):
    """K-4 / B-9: fact_orders_simple keyed (order_id, load_date). Target: the
    loads before the split date; source: every load, delivered twice (the
    second copy, with another payment method, must not win)."""
    rows = daily_loads(spark, d)
    tgt = rows.where(F.col("load_date") < F.lit(SPLIT_DATE).cast("date"))
    src = (rows.withColumn("seq", F.lit(0))
           .unionByName(rows.withColumn("payment_method", F.lit("retry")).withColumn("seq", F.lit(1))))
    return merge.insert_if_absent(tgt, src, ["order_id", "load_date"], ["seq"])


@register("tolerant_load")
def q_tolerant_load(spark, d):
    """K-9: amounts as text; rows that do not convert are set aside with a
    reason, the rest load."""
    e = read_table(spark, d, "events")
    raw = (F.when(F.col("event_type") == "error", F.lit("n/a"))
            .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
            .otherwise(F.col("value").cast("string")))
    df = e.select(F.col("event_id").alias("payment_id"), F.col("user_id").cast("string").alias("customer_id"),
                  raw.alias("amount"))
    valid, rejected = merge.tolerant_load(df, {"customer_id": "bigint", "amount": "decimal(12,2)"})
    return (valid.select("payment_id", F.col("amount").cast("string").alias("amount"),
                         F.lit(None).cast("string").alias("reject_reason"))
            .unionByName(rejected.select("payment_id", "amount", "reject_reason")))


@register("fact_feedback")
def q_fact_feedback(spark, d):
    """B-7 / P-13 / K-1 / K-8: full refresh with keys 1..n, default ids
    FB_0000... by document order, text capped at 500, rating int or 0."""
    fb = st.feedback(spark, d).select("doc_id", "comment", F.col("rating_raw").alias("rating"))
    return facts.fact_feedback(fb, RUN_DATE, ["doc_id"])


# ---------------------------------------------------------------- dimensions
@register("dim_date")
def q_dim_date(spark, d):
    """B-1 over the span of order dates."""
    return dims.dim_date_between(read_table(spark, d, "orders"), "o_orderdate")


@register("orders_by_time_of_day")
def q_orders_by_time_of_day(spark, d):
    """B-2 + J-4: orders bound to the time dimension by computed time_key."""
    from vitrina.functions.keys import time_key_from_text
    o = st.orders(spark, d).select(time_key_from_text("order_time").alias("time_key"))
    t = dims.dim_time(spark)
    return (o.join(t, "time_key").groupBy("time_of_day", "am_pm")
            .agg(F.count(F.lit(1)).alias("orders"), F.min("hour_12").alias("min_hour_12"),
                 F.max("hour_12").alias("max_hour_12")))


@register("orders_by_status")
def q_orders_by_status(spark, d):
    """B-3 + J-4: the status seed inserted twice (insert-if-absent keeps 6
    rows), orders bound by upper(status)."""
    seed = dims.order_status_seed(spark)
    statuses = merge.insert_if_absent(seed, seed, "status_code")
    o = st.orders(spark, d).select(F.col("status").alias("order_status"))
    return (facts.status_lookup(o, statuses).groupBy("status_key", "order_status")
            .agg(F.count(F.lit(1)).alias("orders")))


# ---------------------------------------------------------------- facts
def fact_orders_frame(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    dim_c, _ = customer_dimension(spark, d)
    dim_p = product_dimension(spark, d)
    lines = facts.order_lines(st.orders(spark, d, with_city=True), st.order_items(spark, d), st.products(spark, d))
    seed = dims.order_status_seed(spark)
    return facts.fact_orders(lines, dim_c, dim_p, seed, RUN_DATE)


@register("fact_orders")
def q_fact_orders(spark, d):
    """B-5 / J-3 / J-4 / J-5: one row per order item, bound to the customer
    and product versions valid on the order date."""
    return fact_orders_frame(spark, d)[0]


@register("daily_sales")
def q_daily_sales(spark, d):
    """V-3 / A-12 / J-2: facts joined to the date dimension, per date."""
    f = fact_orders_frame(spark, d)[0]
    dd = dims.dim_date_between(read_table(spark, d, "orders"), "o_orderdate")
    return views.daily_sales(f, dd)


@register("fact_payments")
def q_fact_payments(spark, d):
    """B-6: purchase events as payments with their order, bound to the customer
    version valid on the payment date (events are from 2024: the current versions)."""
    dim_c, _ = customer_dimension(spark, d)
    return facts.fact_payments(st.payments(spark, d, with_order=True), dim_c, RUN_DATE)


@register("orphan_payments")
def q_orphan_payments(spark, d):
    """J-6: payments whose customer does not exist."""
    return facts.orphans(st.payments(spark, d), read_table(spark, d, "customer"), "customer_id", "c_custkey")


# ---------------------------------------------------------------- quality
def _line_checks():
    return {"quantity_positive": F.col("l_quantity") > 0,
            "discount_in_range": F.col("l_discount").between(0, 0.09),
            "tax_non_negative": F.col("l_tax") >= 0}


@register("constraint_violations")
def q_constraint_violations(spark, d):
    """Q-3: lineitem rows failing a CHECK, with the failed check names."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    _, bad = merge.split_valid(li, _line_checks())
    return bad.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                      F.array_join("failed_checks", ",").alias("failed_checks"))


@register("duplicate_keys")
def q_duplicate_keys(spark, d):
    """Q-4: (l_orderkey, l_linenumber) occurring more than once."""
    return quality.duplicate_keys(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def metrics_frame(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer")
    return reduce(DataFrame.unionByName, [
        quality.quality_metrics("lineitem", li, ["l_orderkey", "l_linenumber"], _line_checks(), RUN_DATE),
        quality.quality_metrics("orders", o, "o_orderkey", {"price_positive": F.col("o_totalprice") > 0}, RUN_DATE),
        quality.quality_metrics("customer", c, "c_custkey", {"balance_non_negative": F.col("c_acctbal") >= 0},
                                SCD_RUN_2),
    ])


@register("quality_metrics")
def q_quality_metrics(spark, d):
    """Q-5: one metrics row per source."""
    return metrics_frame(spark, d)


@register("latest_quality")
def q_latest_quality(spark, d):
    """V-4: metrics of the newest run date (customer was checked earlier, so
    it is not shown)."""
    return views.latest_quality(metrics_frame(spark, d))


@register("validation_report")
def q_validation_report(spark, d):
    """Q-1 over products with a required column that is absent."""
    p = st.products(spark, d)
    return quality.validation_report(p, ["product_id", "product_name", "supplier"])


@register("check_suite")
def q_check_suite(spark, d):
    """Q-2: post-load checks over the loaded tables."""
    o = read_table(spark, d, "orders")
    li = read_table(spark, d, "lineitem")
    dup = quality.duplicate_keys(li, ["l_orderkey", "l_linenumber"])
    orph = facts.orphans(st.payments(spark, d), read_table(spark, d, "customer"), "customer_id", "c_custkey")
    return quality.check_suite([
        ("orders_loaded", o.agg((F.count(F.lit(1)) > 0).alias("passed"), F.count(F.lit(1)).alias("value"))),
        ("lineitem_keys_unique", dup.agg((F.count(F.lit(1)) == 0).alias("passed"), F.count(F.lit(1)).alias("value"))),
        ("payments_have_customer", orph.agg((F.count(F.lit(1)) == 0).alias("passed"),
                                            F.count(F.lit(1)).alias("value"))),
        ("revenue_positive", o.agg((F.sum("o_totalprice") > 0).alias("passed"),
                                   F.sum("o_totalprice").alias("value"))),
    ])


@register("load_report")
def q_load_report(spark, d):
    """Q-6: long-format report of a run: table counts (one table that can't be
    read is left out), product statistics, top categories, average rating,
    latest KPI row; a value column for each kind of value."""
    p = st.products(spark, d).withColumnRenamed("brand", "supplier")
    tables = {n: (lambda n=n: read_table(spark, d, n)) for n in ["customer", "orders", "lineitem", "part"]}
    tables["no_such_table"] = lambda: spark.read.parquet(f"{d}/no_such_table.parquet")
    fb = st.feedback(spark, d)
    rating = kpi.rating_stats(fb.select(F.coalesce(F.col("rating_raw").try_cast("int"), F.lit(0)).alias("rating")))
    latest = views.latest_row(kpi.daily_kpis(clean_orders_simple(st.orders(spark, d, with_city=True))))
    return quality.pipeline_report({
        "table_counts": (kpi.table_counts(tables), "table_name", "row_count"), "csv_stats": kpi.product_stats(p),
        "top_categories": (kpi.top_by_count(p, "category", 3), "category", "count"), "feedback": rating,
        "latest_kpi": latest})


@register("latest_kpi")
def q_latest_kpi(spark, d):
    """T-1: newest KPI row."""
    return views.latest_row(kpi.daily_kpis(clean_orders_simple(st.orders(spark, d, with_city=True))))


# ---------------------------------------------------------------- CSV source
CSV_HEADER = ("product_name,product_id,category,subcategory,unit_price,stock_quantity,supplier,country_of_origin,"
              "weight_kg,shelf,created_at,updated_at,dimensions")


def part_csv_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every part as one CSV record of csv_products: columns in another order
    than the table's and one that it lacks, quoted names with line breaks
    (p_size 7) and '""' inside, 'N/A' and empty cells, stock as '5.0', dates
    alone, with 'T' or unparseable, a record with one field too many whose
    last declared field is empty (p_size 50) and one cut short (p_size 1)."""
    p = read_table(spark, d, "part")
    size = F.col("p_size")
    q = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))
    name = F.when(size == 7, F.concat(F.lit("new\n"), F.col("p_name"))).otherwise(F.col("p_name"))
    head = [q(name), F.col("p_partkey").cast("string"), F.col("p_type"), F.col("p_brand"),
            F.col("p_retailprice").cast("string"), F.concat(size.cast("string"), F.when(size % 2 == 0, ".0").otherwise("")),
            q(F.concat(F.lit('Supplier "'), F.col("p_brand"), F.lit('", Ltd'))),
            F.when(size < 5, F.lit("N/A")).otherwise(F.lit("Russia")), (size / 10).cast("string")]
    tail = [F.lit("A1"), F.when(size < 25, F.lit("2024-01-01")).otherwise(F.lit("2024-01-01T10:00:00")),
            F.when(size > 45, F.lit("not a date")).otherwise(F.lit("2024-02-01 12:30:00")),
            F.when(size.between(10, 19) | (size == 50), F.lit("")).otherwise(F.lit("10x20x30"))]
    full = F.concat_ws(",", *head, *tail)
    line = (F.when(size == 50, F.concat(full, F.lit(",EXTRA")))
             .when(size == 1, F.concat_ws(",", *head)).otherwise(full))
    return p.select(line.alias("value"))


def csv_products_source(spark: SparkSession, d: str) -> DataFrame:
    """The records written as CSV files, each with its header, and read back."""
    from vitrina.session import scratch_path
    from vitrina.sources.csv import read_csv
    path = scratch_path(spark, "csv-products")
    lines = part_csv_lines(spark, d)
    # the header is the first record of its file: ordered before the others
    headers = lines.select(F.spark_partition_id().alias("p")).distinct()
    rows = (lines.select(F.spark_partition_id().alias("p"), F.lit(1).alias("o"), "value")
            .unionByName(headers.select("p", F.lit(0).alias("o"), F.lit(CSV_HEADER).alias("value"))))
    (rows.repartition("p").sortWithinPartitions("p", "o").select("p", "value")
     .write.partitionBy("p").mode("overwrite").text(path))
    return read_csv(spark, f"{path}/*")


@register("csv_products")
def q_csv_products(spark, d):
    """S-6 / S-7 / S-8 / B-8 / P-14: CSV files read with the pandas rules
    (columns by name, NA tokens, over-long lines dropped, short lines padded,
    bad timestamps NULL), loaded with keys 1..n."""
    return facts.csv_products_rows(csv_products_source(spark, d), RUN_DATE, ["product_id"])[0]


@register("csv_timestamps")
def q_csv_timestamps(spark, d):
    """S-8: the parsed timestamps of the CSV records."""
    return csv_products_source(spark, d).select("product_id", "created_at", "updated_at")


@register("csv_product_stats")
def q_csv_product_stats(spark, d):
    """A-4 over the loaded csv_products: count, stock, mean price, distinct
    categories and suppliers."""
    return kpi.product_stats(q_csv_products(spark, d))


@register("current_lookup_payments")
def q_current_lookup_payments(spark, d):
    """J-1: payments bound to the customer's current version only."""
    dim_c, _ = customer_dimension(spark, d)
    return facts.current_lookup(st.payments(spark, d), dim_c, "customer_id", "customer_id", "customer_key")


# ---------------------------------------------------------------- rows that a load does not take
@register("rejected_orders")
def q_rejected_orders(spark, d):
    """J-5 / J-6 / K-9: items loaded before the orders of the split date and
    later are there: every such item is rejected with the reason, none is lost."""
    orders = st.orders(spark, d).where(F.col("order_date") < F.lit(SPLIT_DATE).cast("date"))
    lines = facts.order_lines(orders, st.order_items(spark, d), st.products(spark, d))
    _, bad = merge.split_valid(lines, facts.fact_checks())
    return bad.select("order_id", "product_id", "quantity", "total_amount",
                      F.array_join("failed_checks", "; ").alias("reject_reason"))


@register("scd2_rejected")
def q_scd2_rejected(spark, d):
    """K-5: the second batch is run with a date before the first one's, and some
    of its rows have no key: rows of keys that have a version by then are late,
    the others (ASIA) are new."""
    b1, b2 = customer_batches(spark, d)
    b2 = b2.withColumn("customer_id", F.when(F.col("city") != "CHINA", F.col("customer_id")))
    dim, _, _ = scd2.scd2_merge(scd2.empty_dim(spark), b1, SCD_RUN_2, ["seq"])
    _, _, rejected = scd2.scd2_merge(cut_lineage(dim), b2, SCD_RUN_1, ["seq"])
    return rejected.select("customer_id", "seq", "email", "reject_reason")


@register("kpis_with_orphans")
def q_kpis_with_orphans(spark, d):
    """A-2 / S-1: customers of ASIA are not there: their orders stay, without a city."""
    c = st.customers(spark, d).where(F.col("country") != "ASIA").select("customer_id", F.col("city").alias("shipping_city"))
    return kpi.daily_kpis(st.orders(spark, d).join(c, "customer_id", "left"))


@register("orphan_orders")
def q_orphan_orders(spark, d):
    """J-6: orders of customers who never appear in events."""
    return facts.orphans(st.orders(spark, d), read_table(spark, d, "events"), "customer_id", "user_id")


# ---------------------------------------------------------------- more of the operators' own rows
@register("run_kpis_final")
def q_run_kpis_final(spark, d):
    """A-1 for one run date, with ratings."""
    r = st.feedback(spark, d).select(F.col("rating_raw").try_cast("double").alias("rating"))
    return kpi.run_kpis(st.orders(spark, d, with_city=True), r, RUN_DATE, variant="final")


@register("clean_products")
def q_clean_products(spark, d):
    """P-4 / P-9: products with missing and bad values, filled and coerced; a
    price beyond the type is NULL, not 0."""
    from vitrina.operators.clean import clean_products_simple
    size = F.col("stock_quantity")
    raw = st.products(spark, d).select(
        "product_id", "product_name", F.when(size > 5, F.col("category")).alias("category"),
        F.when(size % 3 > 0, F.col("brand")).alias("brand"),
        F.when(size == 10, "n/a").when(size == 11, "99999999999").otherwise(F.col("unit_price").cast("string"))
        .alias("unit_price"), F.when(size < 48, size).alias("stock_quantity"))
    return clean_products_simple(raw)


@register("cleaned_events")
def q_cleaned_events(spark, d):
    """P-5: the rows that the cleaner keeps."""
    from vitrina.operators import clean
    e = read_table(spark, d, "events").select(
        "user_id", "event_id", "ts",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type")).alias("event_type"))
    return clean.clean_with_stats(e, "user_id", {"event_type": "unknown", "not_a_column": "x"}, ["ts", "event_id"])[0]


@register("normalized_orders")
def q_normalized_orders(spark, d):
    """P-6: the rows that the normaliser gives."""
    from vitrina.operators import clean
    o = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("1998-13-01"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("\t")).alias("payment_method"))
    out, _ = clean.normalize_with_stats(o, ["order_date"], ["payment_method", "absent"])
    return out.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


@register("dim_products_simple")
def q_dim_products_simple(spark, d):
    """K-3 / B-9: only name, price and stock of known products are updated."""
    p = st.products(spark, d).select("product_id", "product_name", "category", "brand", "unit_price", "stock_quantity")
    old = p.where(F.col("stock_quantity") > 25).withColumn("category", F.lit(None).cast("string"))
    new = p.withColumn("unit_price", (F.col("unit_price") + 1).cast("decimal(10,2)")).withColumn("brand", F.lit("new"))
    return merge.upsert(old, new, "product_id", ["product_name", "unit_price", "stock_quantity"])


@register("total_price")
def q_total_price(spark, d):
    """P-17: quantity x unit price of every order item."""
    i = st.order_items(spark, d).join(st.products(spark, d).select("product_id", "unit_price"), "product_id", "left")
    return i.select("order_id", "line_number", "quantity", "unit_price",
                    (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("total_price"))


@register("customer_history_ordered")
def q_customer_history_ordered(spark, d):
    """T-2 / V-2: the ordered view, its order as a row number."""
    from vitrina.operators.surrogate import dense_index
    dim, _ = customer_dimension(spark, d)
    h = dense_index(dim.select("customer_id", "effective_date", "customer_key", "is_current"),
                    ["customer_id", "effective_date", "customer_key"], "row_no")
    return h.select("row_no", "customer_id", "effective_date", "is_current")


@register("document_scan")
def q_document_scan(spark, d):
    """S-4 / S-5: events written as JSON lines with object ids, plain ids and
    broken lines, read with a schema; broken lines are returned as such."""
    from vitrina.session import scratch_path
    from vitrina.sources.documents import read_documents
    e = read_table(spark, d, "events")
    rest = F.substring(F.to_json(F.struct("event_type", "value")), 2, 1 << 20)
    ident = F.col("event_id").cast("string")
    line = (F.when(F.col("event_type") == "error", F.concat(F.lit('{"_id": "'), ident, F.lit('", "event_type": ')))
             .when(F.col("event_type") == "view", F.concat(F.lit('{"_id": "'), ident, F.lit('", '), rest))
             .otherwise(F.concat(F.lit('{"_id": {"$oid": "'), ident, F.lit('"}, '), rest)))
    path = scratch_path(spark, "documents")
    e.select(line.alias("value")).write.mode("overwrite").text(path)
    good, bad = read_documents(spark, path, "_id STRING, event_type STRING, value DOUBLE", malformed=True)
    return (good.select("_id", "event_type", "value", F.lit(None).cast("string").alias("reject_reason"))
            .unionByName(bad.select(F.get(F.split("line", '"'), F.lit(3)).alias("_id"), F.lit(None).cast("string").alias("event_type"),
                                    F.lit(None).cast("double").alias("value"), "reject_reason")))
