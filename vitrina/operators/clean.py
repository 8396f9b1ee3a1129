"""Cleaning: fill rules, normalisation, coercion, keep-last dedupe, with stats.

All rules are column expressions inside one projection (one codegen stage);
stats are computed as one aggregate DataFrame, never as driver counters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.functions.coerce import clip_rating, to_date, to_decimal
from vitrina.functions.text import email_norm, title_case, ustrip

# Fill rules of the two daily runs.
NOT_GIVEN = "Не указан"
RUSSIA = "Россия"
FINAL_FILL = {
    "customers": {"city": NOT_GIVEN, "country": RUSSIA},
    "orders": {"status": "Pending"},
}
SIMPLE_FILL = {
    "customers": {"city": NOT_GIVEN, "country": RUSSIA, "customer_segment": "Standard"},
    "products": {"category": "Другое", "brand": "Неизвестно"},
    "orders": {"status": "Pending", "payment_method": NOT_GIVEN, "shipping_city": NOT_GIVEN},
}


def fill_missing(df: DataFrame, rules: dict) -> DataFrame:
    """``fillna`` per column, applied only to columns that exist (P-3, P-4)."""
    present = {c: v for c, v in rules.items() if c in df.columns}
    if not present:
        return df
    return df.select(*[F.coalesce(F.col(c), F.lit(present[c])).alias(c) if c in present else F.col(c)
                       for c in df.columns])


def _replace(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Replace existing columns in place (keeps the column order)."""
    exprs = {c: e for c, e in exprs.items() if c in df.columns}
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def clean_customers_final(df: DataFrame) -> DataFrame:
    return fill_missing(df, FINAL_FILL["customers"])


def clean_orders_final(df: DataFrame) -> DataFrame:
    return fill_missing(df, FINAL_FILL["orders"])


def clean_customers_simple(df: DataFrame) -> DataFrame:
    """Fill, then title-case names and canonicalise e-mail (P-4, P-7, P-8)."""
    df = fill_missing(df, SIMPLE_FILL["customers"])
    return _replace(df, {"first_name": title_case("first_name"),
                         "last_name": title_case("last_name"),
                         "email": email_norm("email")})


def clean_products_simple(df: DataFrame) -> DataFrame:
    """Fill, price to number with bad -> 0 (P-4, P-9)."""
    df = fill_missing(df, SIMPLE_FILL["products"])
    return _replace(df, {"unit_price": to_decimal("unit_price", 10, 2, default=0)})


def clean_orders_simple(df: DataFrame) -> DataFrame:
    """Fill, order_date to date (bad -> NULL), amount to number (bad -> 0)
    (P-4, P-9, P-11)."""
    df = fill_missing(df, SIMPLE_FILL["orders"])
    return _replace(df, {"order_date": to_date("order_date"),
                         "total_amount": to_decimal("total_amount", 12, 2, default=0)})


def clean_feedback_simple(df: DataFrame, rating_col: str = "rating") -> DataFrame:
    """Rating to number, clipped to 1..5, missing -> 3 (P-10)."""
    return _replace(df, {rating_col: clip_rating(rating_col)})


def dedupe_keep_last(df: DataFrame, key: str | list[str], order_cols: list[str]) -> DataFrame:
    """Keep the last row per key by ``order_cols`` (W-1, T-4).

    Expressed as ``groupBy(key).agg(max_by(row, order))``: the aggregate is
    combined map-side, so a key holding a third of all rows is reduced before
    the shuffle instead of being sorted in one window task. Rows with a NULL
    key form one group, as in pandas. The order is made total by appending
    every other column, so the survivor is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    tie = [c for c in rest if c not in order_cols]
    order = F.struct(*[F.col(c) for c in order_cols + tie])
    row = F.struct(*[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    return out.select(*[F.col(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def clean_with_stats(df: DataFrame, primary_key: str | None = None, fill_rules: dict | None = None,
                     order_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """P-5: dedupe by key keeping the last row, then fill; plus a one-row stats
    frame (original_rows, duplicates_removed, nulls_filled, cleaned_rows).

    ``nulls_filled`` counts the missing cells of the fill columns that exist,
    after dedupe (per call). The stats come from the same keyed aggregate as
    the dedupe (one extra count per key), so no second pass over the input.
    """
    fill_rules = fill_rules or {}
    fill_cols = [c for c in fill_rules if c in df.columns]
    if primary_key:
        rest = [c for c in df.columns if c != primary_key]
        order = F.struct(*[F.col(c) for c in (order_cols or []) + [c for c in rest if c not in (order_cols or [])]])
        g = df.groupBy(primary_key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row"),
                                        F.count(F.lit(1)).alias("_n"))
        kept = g.select(F.col(primary_key), *[F.col("_row")[c].alias(c) for c in rest], "_n")
    else:
        kept = df.withColumn("_n", F.lit(1).cast("long"))
    nulls = sum((F.count_if(F.col(c).isNull()) for c in fill_cols), F.lit(0).cast("long"))
    stats = kept.agg(F.sum("_n").cast("long").alias("original_rows"),
                     (F.sum("_n") - F.count(F.lit(1))).cast("long").alias("duplicates_removed"),
                     nulls.cast("long").alias("nulls_filled"),
                     F.count(F.lit(1)).alias("cleaned_rows"))
    stats = stats.select(*[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in stats.columns])
    cleaned = fill_missing(kept.drop("_n").select(*df.columns), fill_rules)
    return cleaned, stats


def normalize_with_stats(df: DataFrame, date_columns: list[str] | None = None,
                         string_columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """P-6: dates coerced (bad -> NULL), strings stripped; stats count the
    non-missing values after each step. Missing stays NULL (not 'nan' text)."""
    date_columns = [c for c in (date_columns or []) if c in df.columns]
    string_columns = [c for c in (string_columns or []) if c in df.columns]
    exprs = {c: F.coalesce(F.try_to_timestamp(F.col(c)), F.col(c).try_cast("timestamp"))
             for c in date_columns}
    exprs.update({c: ustrip(c) for c in string_columns})
    out = _replace(df, exprs)
    zero = F.lit(0).cast("long")
    stats = out.agg(sum((F.count(c) for c in date_columns), zero).alias("dates_normalized"),
                    sum((F.count(c) for c in string_columns), zero).alias("strings_normalized"),
                    F.lit(0).cast("long").alias("types_converted"))
    return out, stats
