"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame that
exercises one or more operators over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions import clip_rating, email_norm, preview, title_case, to_date, to_decimal, truncate
from vitrina.operators import clean, kpi
from vitrina.sources import standins as st
from vitrina.sources.documents import parse_documents
from vitrina.sources.tables import extract_table, read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Run dates of the registered daily runs (fixed parameters of the queries).
RUN_DATE = "1998-08-02"
LOOKBACK_DAYS = 7


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- sources
@register("scan_filter_project")
def q_scan_filter_project(spark, d):
    """S-1, P-1, P-2: projection + predicate as SQL text, pushed to the scan."""
    o = read_table(spark, d, "orders")
    return extract_table(o, "o_orderkey, o_custkey, round(o_totalprice, 1) as o_totalprice, "
                            "cast(o_orderdate as date) as order_date",
                         "o_orderstatus = 'F' and o_totalprice > 300000")


@register("limited_sql_extract")
def q_limited_sql_extract(spark, d):
    """S-1, S-3: a predicate text that ends in a limit."""
    o = read_table(spark, d, "orders")
    return extract_table(o, "o_orderkey, coalesce(o_orderpriority, 'none') as priority", "1=1 ORDER BY o_orderkey LIMIT 10")


@register("lookback_window")
def q_lookback_window(spark, d):
    """S-2: order_date >= run_date - 7 days, no upper bound."""
    o = st.orders(spark, d)
    return o.where(F.col("order_date") >= F.date_sub(F.lit(RUN_DATE).cast("date"), LOOKBACK_DAYS))


@register("limited_extract")
def q_limited_extract(spark, d):
    """S-3 / S-9: first n rows in key order (the limit is the feature)."""
    return st.orders(spark, d).orderBy("order_id").limit(10)


@register("json_document_scan")
def q_json_document_scan(spark, d):
    """S-4 / S-5: schema'd parse of JSON documents (events.props); a field
    missing from a document reads as NULL."""
    e = read_table(spark, d, "events").select("event_id", "event_type", "props")
    return parse_documents(e, "props", "k INT, missing_field STRING").select(
        "event_id", "event_type", F.col("doc.k").alias("k"), F.col("doc.missing_field").alias("missing_field"))


@register("document_preview")
def q_document_preview(spark, d):
    """S-10: every value longer than 50 characters cut to 50 + '...'."""
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", preview("text").alias("text"), preview("lang").alias("lang"),
                       preview("source").alias("source"))


# ---------------------------------------------------------------- cleaning
@register("fill_rules")
def q_fill_rules(spark, d):
    """P-3 / P-4: fill missing city, country, segment (only existing columns)."""
    c = st.customers_raw(spark, d).select("customer_id", "city", "country", "customer_segment")
    return clean.fill_missing(c, clean.SIMPLE_FILL["customers"])


@register("title_case")
def q_title_case(spark, d):
    """P-7 over customer names and whole document texts."""
    c = st.customers_raw(spark, d)
    docs = read_table(spark, d, "documents")
    names = c.select(F.col("customer_id").alias("id"), F.lit("customer").alias("kind"),
                     title_case("first_name").alias("value"))
    texts = docs.select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), title_case("text").alias("value"))
    return names.unionByName(texts)


@register("email_norm")
def q_email_norm(spark, d):
    """P-8: lower + Unicode strip."""
    c = st.customers_raw(spark, d)
    return c.select("customer_id", email_norm("email").alias("email"))


@register("clean_customers")
def q_clean_customers(spark, d):
    """P-4, P-7, P-8 together (simple run's customer cleaning)."""
    return clean.clean_customers_simple(st.customers_raw(spark, d))


@register("coerce_number")
def q_coerce_number(spark, d):
    """P-9: text to number, bad -> 0."""
    e = read_table(spark, d, "events")
    raw = (F.when(F.col("event_type") == "error", F.lit("abc"))
            .when(F.col("event_type") == "view", F.lit("nan"))
            .when(F.col("event_type") == "signup", F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
            .otherwise(F.col("value").cast("string")))
    return e.select("event_id", raw.alias("raw"), to_decimal(raw, 12, 2, default=0).alias("amount"))


@register("clip_rating")
def q_clip_rating(spark, d):
    """P-10: rating to number, clip 1..5, missing -> 3."""
    fb = st.feedback(spark, d)
    return fb.select("doc_id", "rating_raw", clip_rating("rating_raw").alias("rating"))


@register("coerce_date")
def q_coerce_date(spark, d):
    """P-11 / P-12: bad dates -> NULL -> run date."""
    o = read_table(spark, d, "orders")
    raw = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("1998-13-01")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    parsed = to_date(raw)
    return o.select(F.col("o_orderkey").alias("order_id"), raw.alias("raw"), parsed.alias("order_date"),
                    F.coalesce(parsed, F.lit(RUN_DATE).cast("date")).alias("load_order_date"))


@register("truncate_text")
def q_truncate_text(spark, d):
    """P-13 / P-14 length caps (characters) on whole texts."""
    docs = read_table(spark, d, "documents")
    return docs.select("doc_id", truncate("text", 500).alias("text_500"), truncate("text", 255).alias("text_255"),
                       truncate("source", 100).alias("source_100"))


@register("dedupe_keep_last")
def q_dedupe_keep_last(spark, d):
    """W-1 / T-4: last event per user by (ts, event_id)."""
    e = read_table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return clean.dedupe_keep_last(e, "user_id", ["ts", "event_id"])


@register("cleaner_stats")
def q_cleaner_stats(spark, d):
    """P-5 stats: dedupe events by user, fill event_type, counts."""
    e = read_table(spark, d, "events").select(
        "user_id", "event_id", "ts",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type")).alias("event_type"))
    _, stats = clean.clean_with_stats(e, "user_id", {"event_type": "unknown", "not_a_column": "x"}, ["ts", "event_id"])
    return stats


@register("normalizer_stats")
def q_normalizer_stats(spark, d):
    """P-6 stats over orders with text dates (some invalid) and padded text."""
    o = read_table(spark, d, "orders").select(
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("1998-13-01"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("\t")).alias("payment_method"))
    _, stats = clean.normalize_with_stats(o, ["order_date"], ["payment_method", "absent"])
    return stats


# ---------------------------------------------------------------- KPIs
@register("daily_kpis_simple")
def q_daily_kpis_simple(spark, d):
    """A-2 + A-3 per order date over cleaned orders."""
    return kpi.daily_kpis(clean.clean_orders_simple(st.orders(spark, d, with_city=True)))


@register("daily_kpis_final")
def q_daily_kpis_final(spark, d):
    """A-1 for every run date with its 7-day look-back."""
    return kpi.rolling_kpis(clean.clean_orders_final(st.orders(spark, d, with_city=True)), LOOKBACK_DAYS)


@register("run_kpis")
def q_run_kpis(spark, d):
    """A-1/A-2 as one run writes them: orders of the look-back window of the
    run date and the cleaned feedback ratings, one row."""
    o = clean.clean_orders_simple(st.orders(spark, d, with_city=True))
    fb = clean.clean_feedback_simple(st.feedback(spark, d).withColumnRenamed("rating_raw", "rating"))
    return kpi.run_kpis(o, fb, RUN_DATE, LOOKBACK_DAYS, "simple")


@register("top_categories")
def q_top_categories(spark, d):
    """A-5 / T-3: top 3 categories by product count."""
    return kpi.top_by_count(st.products(spark, d), "category", 3)


@register("product_stats")
def q_product_stats(spark, d):
    """A-4 over products (supplier = brand)."""
    p = st.products(spark, d).withColumnRenamed("brand", "supplier")
    return kpi.product_stats(p)


@register("table_counts")
def q_table_counts(spark, d):
    """A-6: rows per table and in total."""
    names = ["customer", "orders", "lineitem", "part", "documents", "events"]
    return kpi.table_counts({n: read_table(spark, d, n) for n in names})


@register("rating_stats")
def q_rating_stats(spark, d):
    """A-7 / A-8 over fact_feedback ratings (int, 0 when unparseable)."""
    fb = st.feedback(spark, d)
    return kpi.rating_stats(fb.select(F.coalesce(F.col("rating_raw").try_cast("int"), F.lit(0)).alias("rating")))


@register("rating_histogram")
def q_rating_histogram(spark, d):
    """A-9: ratings 1..5 with empty buckets."""
    fb = st.feedback(spark, d).select(F.col("rating_raw").try_cast("int").alias("rating"))
    return kpi.rating_histogram(spark, fb)


@register("missing_cells")
def q_missing_cells(spark, d):
    """A-10 over the raw customer source."""
    return kpi.missing_cells(st.customers_raw(spark, d))


@register("declared_kpis")
def q_declared_kpis(spark, d):
    """D-1 ... D-8 per order date."""
    return kpi.declared_kpis(st.orders(spark, d, with_city=True), st.order_items(spark, d), st.products(spark, d))


def queries() -> dict[str, Query]:
    # Import the modules that register more queries.
    from vitrina.plans import queries_catalog, queries_dw  # noqa: F401
    return dict(REGISTRY)
