"""Analytic views (V-1 ... V-4, T-1) as functions returning DataFrames.

Ordering is applied only at the presentation edge (``ordered=True``); inside
a pipeline the unordered form is used so no global sort is planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.operators.kpi import MONEY_SUM

# Version labels of the customer history view.
CURRENT_LABEL, HISTORIC_LABEL = "Текущая", "Историческая"


def current_customers(dim: DataFrame) -> DataFrame:
    """V-1 v_current_customers."""
    return dim.where(F.col("is_current")).select(
        "customer_key", "customer_id", "first_name", "last_name", "full_name", "email", "city", "country",
        "customer_segment", "effective_date", "expiration_date")


def customer_history(dim: DataFrame, ordered: bool = False) -> DataFrame:
    """V-2 v_customer_history: every version, its label and days between
    effective and expiration date."""
    out = dim.select(
        "customer_id", "first_name", "last_name", "city", "country", "customer_segment", "effective_date",
        "expiration_date",
        F.when(F.col("is_current"), CURRENT_LABEL).otherwise(HISTORIC_LABEL).alias("version_status"),
        F.datediff("expiration_date", "effective_date").alias("days_active"))
    return out.orderBy("customer_id", "effective_date") if ordered else out


def daily_sales(fact_orders: DataFrame, dim_date: DataFrame, ordered: bool = False) -> DataFrame:
    """V-3 v_daily_sales: facts joined to the date dimension (inner), per
    date: distinct orders and customers, items, revenue, mean per fact row.
    Facts are summed by (date, order, customer) before the distinct counts
    multiply the rows. The date dimension has one row per day (bounded by the calendar span);
    AQE broadcasts it when its measured size allows, else sort-merge."""
    amount = F.col("total_amount").cast("decimal(12,2)")
    parts = (fact_orders.groupBy("date_key", "order_id", "customer_id")
             .agg(F.sum(F.col("quantity").cast("long")).alias("items"), F.sum(amount).alias("amount"), F.count("total_amount").alias("amounts")))
    j = parts.join(dim_date.select("date_key", "full_date"), "date_key")
    out = (j.groupBy("full_date")
           .agg(F.countDistinct("order_id").alias("total_orders"),
                F.countDistinct("customer_id").alias("unique_customers"),
                F.sum("items").alias("total_items"),
                F.sum("amount").cast(MONEY_SUM).alias("total_revenue"),
                F.try_divide(F.sum("amount").cast("double"), F.sum("amounts").cast("double")).alias("avg_order_value")))
    return out.orderBy(F.desc("full_date")) if ordered else out


def latest_quality(metrics: DataFrame, ordered: bool = False) -> DataFrame:
    """V-4 latest_data_quality: rows of the newest run date (over all
    sources), quality % = valid / total x 100 rounded half-up to 2 places,
    NULL when total is 0."""
    newest = metrics.agg(F.max("run_date").alias("_newest"))
    pct = F.round(F.col("valid_records").cast("decimal(20,6)")
                  / F.nullif(F.col("total_records"), F.lit(0)).cast("decimal(20,6)") * 100, 2)
    out = (metrics.join(F.broadcast(newest), F.col("run_date") == F.col("_newest"))
           .select("source_name", "run_date", "total_records", "valid_records",
                   pct.cast("decimal(10,2)").alias("quality_percentage"), "processing_time_seconds"))
    return out.orderBy("source_name") if ordered else out


def latest_row(df: DataFrame, date_col: str = "analytics_date") -> DataFrame:
    """T-1 ``ORDER BY date DESC LIMIT 1`` (a top-1, planned as TakeOrdered)."""
    return df.orderBy(F.desc(date_col)).limit(1)
