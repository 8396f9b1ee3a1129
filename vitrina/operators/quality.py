"""Data-quality checks (Q-1 ... Q-6) as DataFrames, never driver counters.

Each check is one aggregate over its table (partial + final, map-side
combined); reports are unions of one-row aggregates in long format.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing_total(df: DataFrame) -> Column:
    return sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("long")).cast("long")


def validation_report(df: DataFrame, required_columns: list[str] | None = None) -> DataFrame:
    """Q-1: one row - is_valid, errors, warnings, total_rows, total_columns,
    missing_values. Only a missing required column makes it invalid; an
    empty frame is a warning."""
    absent = [c for c in (required_columns or []) if c not in df.columns]
    errors = F.array(*[F.lit(f"missing required column: {c}") for c in absent]) if absent else \
        F.array().cast("array<string>")
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("total_rows"), missing_total(df).alias("missing_values")).select(
        F.lit(not absent).alias("is_valid"), errors.alias("errors"),
        F.when(F.col("total_rows") == 0, F.array(F.lit("empty frame"))).otherwise(F.array().cast("array<string>"))
        .alias("warnings"),
        "total_rows", F.lit(len(df.columns)).alias("total_columns"), "missing_values")


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q-4: keys that occur more than once (NULL keys do not clash)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def quality_metrics(source_name: str, df: DataFrame, keys, checks: dict[str, Column], run_date: str,
                    dag_id: str = "vitrina", task_id: str = "load") -> DataFrame:
    """Q-5: one data_quality_metrics row for a source: total, valid (no CHECK
    false; NULL passes), invalid, duplicate (rows - distinct keys), NULL
    cells. Distinct keys are counted exactly (two-level aggregate)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ok = reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(True)) for c in checks.values()], F.lit(True))
    agg = df.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(ok).alias("valid_records"),
                 F.count_distinct(*[F.col(k) for k in keys]).alias("_distinct"),
                 missing_total(df).alias("null_values_count"))
    return agg.select(
        F.lit(run_date).cast("date").alias("run_date"), F.lit(dag_id).alias("dag_id"), F.lit(task_id).alias("task_id"),
        F.lit(source_name).alias("source_name"), "total_records", "valid_records",
        (F.col("total_records") - F.col("valid_records")).alias("invalid_records"),
        (F.col("total_records") - F.col("_distinct")).alias("duplicate_records"), "null_values_count",
        F.lit(0).cast("long").alias("error_count"), F.lit(None).cast("decimal(10,2)").alias("processing_time_seconds"),
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("error_message"))


def check_suite(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """Q-2: each check is (name, one-row frame with ``passed`` boolean and
    ``value``); result: the checks plus a summary row with passed / failed
    totals and status success (all passed) or warning."""
    rows = [df.select(F.lit(name).alias("check_name"), F.col("passed").cast("boolean").alias("passed"),
                      F.col("value").cast("double").alias("value")) for name, df in checks]
    u = reduce(DataFrame.unionByName, rows)
    summary = u.agg(F.count_if("passed").alias("p"), F.count_if(~F.col("passed")).alias("f")).select(
        F.when(F.col("f") == 0, "success").otherwise("warning").alias("check_name"),
        (F.col("f") == 0).alias("passed"), F.col("p").cast("double").alias("value"))
    return u.unionByName(summary)


def metric_rows(section: str, one_row: DataFrame) -> DataFrame:
    """Q-6: one-row frame of metrics -> long rows (section, metric, value_long,
    value_double, value_text): whole numbers, other numbers and anything else
    each have a column of their type."""
    def value(f: T.StructField) -> Column:
        kinds = {"value_long": isinstance(f.dataType, T.IntegralType),
                 "value_double": isinstance(f.dataType, (T.FractionalType, T.DecimalType))}
        kinds["value_text"] = not any(kinds.values())
        types = {"value_long": "bigint", "value_double": "double", "value_text": "string"}
        return F.struct(F.lit(f.name).alias("metric"), *[
            (F.col(f.name) if mine else F.lit(None)).cast(types[k]).alias(k) for k, mine in kinds.items()])
    stack = F.explode(F.array(*[value(f) for f in one_row.schema.fields]))
    return one_row.select(stack.alias("_m")).select(F.lit(section).alias("section"), "_m.*")


def named_rows(section: str, rows: DataFrame, name: str, value: str) -> DataFrame:
    """Long rows of a frame of (name, count) rows, such as table counts."""
    return rows.select(F.lit(section).alias("section"), F.col(name).cast("string").alias("metric"),
                       F.col(value).cast("bigint").alias("value_long"), F.lit(None).cast("double").alias("value_double"),
                       F.lit(None).cast("string").alias("value_text"))


def pipeline_report(sections: dict[str, DataFrame | tuple[DataFrame, str, str]]) -> DataFrame:
    """Q-6 final report: union of long-format sections, each a one-row frame of
    metrics or (rows, name column, count column)."""
    return reduce(DataFrame.unionByName, [named_rows(k, *v) if isinstance(v, tuple) else metric_rows(k, v)
                                          for k, v in sections.items()])
