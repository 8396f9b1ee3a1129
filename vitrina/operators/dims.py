"""Dimension builders (B-1 date, B-2 time, B-3 order status).

Date and time rows come from ``spark.range`` (split over tasks), not from a
driver-side loop; the keys are computed (YYYYMMDD, HHMMSS), so facts get
their keys without a lookup join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.keys import date_key, seconds_to_hms

# Time-of-day labels by hour (6-11, 12-17, 18-23, otherwise).
MORNING, DAYTIME, EVENING, NIGHT = "Утро", "День", "Вечер", "Ночь"

# The seeded order statuses (code, name, category, description).
ORDER_STATUSES = [
    ("PENDING", "В обработке", "Активный", "Заказ создан, ожидает обработки"),
    ("PROCESSING", "Обрабатывается", "Активный", "Заказ находится в обработке"),
    ("SHIPPED", "Отправлен", "Активный", "Заказ отправлен клиенту"),
    ("DELIVERED", "Доставлен", "Завершен", "Заказ успешно доставлен"),
    ("CANCELLED", "Отменен", "Отменен", "Заказ был отменен"),
    ("REFUNDED", "Возвращен", "Возврат", "Заказ был возвращен"),
]

DIM_STATUS_SCHEMA = T.StructType([
    T.StructField("status_key", T.IntegerType()), T.StructField("status_code", T.StringType()),
    T.StructField("status_name", T.StringType()), T.StructField("status_category", T.StringType()),
    T.StructField("description", T.StringType()),
])


def dim_date(spark: SparkSession, start: str = "2023-01-01", end: str = "2030-12-31") -> DataFrame:
    """B-1: one row per day, both ends included."""
    first = F.lit(start).cast("date")
    n_days = spark.range(1).select(F.datediff(F.lit(end).cast("date"), first).alias("n")).first()["n"]
    return date_rows(spark.range(0, n_days + 1).select(F.date_add(first, F.col("id").cast("int")).alias("full_date")))


def dim_date_between(dates: DataFrame, col: str) -> DataFrame:
    """B-1 over the date span of a column of a fact or source table (min and
    max from one aggregate; the rows themselves come from ``range``)."""
    spark = dates.sparkSession
    lo, hi = dates.agg(F.min(F.col(col).cast("date")), F.max(F.col(col).cast("date"))).first()
    if lo is None:
        return date_rows(spark.range(0).select(F.lit(None).cast("date").alias("full_date")))
    return dim_date(spark, lo.isoformat(), hi.isoformat())


def date_rows(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    dow = F.weekday(d) + 1  # ISO: Monday 1 ... Sunday 7
    return days.select(
        date_key(d).cast("int").alias("date_key"), d.alias("full_date"),
        F.dayofmonth(d).alias("day_of_month"), dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"), F.weekofyear(d).alias("week_number"),
        F.month(d).alias("month_number"), F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"), F.year(d).alias("year"), dow.isin(6, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"), F.lit(None).cast("string").alias("holiday_name"))


def time_of_day(hour) -> F.Column:
    h = F.col(hour) if isinstance(hour, str) else hour
    return (F.when(h.between(6, 11), MORNING).when(h.between(12, 17), DAYTIME)
             .when(h.between(18, 23), EVENING).otherwise(NIGHT))


def dim_time(spark: SparkSession) -> DataFrame:
    """B-2: 86,400 rows, one per second of the day. hour_12 is h-12 after
    noon, else h (midnight 0, noon 12); PM from 12:00."""
    s = F.col("id")
    h, m, sec = (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"), (s % 60).cast("int")
    return spark.range(86400).select(
        (h * 10000 + m * 100 + sec).alias("time_key"), seconds_to_hms(s).alias("full_time"),
        h.alias("hour_24"), F.when(h > 12, h - 12).otherwise(h).alias("hour_12"), m.alias("minute"),
        sec.alias("second"), F.when(h >= 12, "PM").otherwise("AM").alias("am_pm"),
        time_of_day(h).alias("time_of_day"))


def order_status_seed(spark: SparkSession) -> DataFrame:
    """B-3 seed rows with keys 1..6 (SERIAL order)."""
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(ORDER_STATUSES)], DIM_STATUS_SCHEMA)
