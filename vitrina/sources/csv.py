"""CSV source with the missing-value and bad-line rules of a pandas reader
(S-6, S-7, S-8), expressed with Spark's CSV reader plus column rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.coerce import to_int
from vitrina.sources.csv_split import csv_records

# The text tokens a pandas CSV reader treats as missing by default.
PANDAS_NA_TOKENS = ['', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
                    '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null']

CSV_PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.IntegerType()), T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("subcategory", T.StringType()),
    T.StructField("unit_price", T.DecimalType(10, 2)), T.StructField("stock_quantity", T.IntegerType()),
    T.StructField("supplier", T.StringType()), T.StructField("country_of_origin", T.StringType()),
    T.StructField("weight_kg", T.DecimalType(6, 2)), T.StructField("dimensions", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
])

_CORRUPT = "_corrupt_record"


# Timestamp patterns tried after ISO text (blank or 'T' before the time, or a date alone).
TIMESTAMP_FORMATS = ["yyyy-MM-dd HH:mm", "M/d/yyyy H:mm", "M/d/yyyy", "yyyyMMdd"]


def read_csv_raw(spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ",", quote: str = '"',
                 escape: str = '"', encoding: str = "utf-8", multi_line: bool = True, split: bool | None = None) -> DataFrame:
    """Every column of the file as text, named by its header (or ``columns`` for
    files without one), plus the corrupt-record marker (PERMISSIVE).

    ``multi_line``: a quoted cell may hold line breaks. ``split``: such files
    are read by many tasks each (``csv_records``), the default where quotes are
    escaped by doubling and text is UTF-8; else one task reads a file.
    """
    if split is None:
        split = multi_line and escape == quote and encoding.lower() in ("utf-8", "utf8")
    reader = (spark.read.option("sep", sep).option("quote", quote).option("escape", escape)
              .option("encoding", encoding).option("multiLine", multi_line).option("header", columns is None))
    names = columns or reader.csv(path).columns  # reads the header only
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _CORRUPT]])
    if split:
        ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
        options = {"sep": sep, "quote": quote, "escape": escape, "multiLine": "true", "nullValue": "", "mode": "PERMISSIVE",
                   "columnNameOfCorruptRecord": _CORRUPT}
        records = csv_records(spark, path, sep, quote).where(F.lit(columns is not None) | ~F.col("first"))
        row = records.select(F.from_csv("record", ddl, options).alias("r"))
        return row.select(*[F.col("r")[f.name].alias(f.name) for f in schema])
    return (reader.schema(schema).option("nullValue", "").option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).csv(path))


def field_count(record: F.Column, sep: str = ",", quote: str = '"') -> F.Column:
    """Fields of a raw record: separators outside quotes, plus one."""
    plain = F.regexp_replace(record, f"{quote}[^{quote}]*{quote}", "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) + 1


def apply_bad_line_policy(raw: DataFrame, sep: str = ",", quote: str = '"') -> DataFrame:
    """S-7 ('warn' policy): a row with too many fields is dropped, a row with
    too few is kept and padded with NULL. Spark flags both as corrupt; the
    fields of the flagged records are counted."""
    columns = [c for c in raw.columns if c != _CORRUPT]
    # This always-true test references every column: with CSV column pruning
    # the parser would otherwise read only the projected fields and miss extra
    # ones, so which rows are dropped would depend on the caller's projection.
    # (A null test of a hash would be folded away by the optimizer.)
    whole_row = F.length(F.concat_ws("\u0001", *[F.col(c) for c in columns])) >= 0
    too_long = F.col(_CORRUPT).isNotNull() & (field_count(F.col(_CORRUPT), sep, quote) > len(columns)) & whole_row
    return raw.withColumn("_too_long", F.coalesce(too_long, F.lit(False)))


def na_to_null(c: str, tokens: list[str] = PANDAS_NA_TOKENS) -> F.Column:
    col = F.col(c)
    return F.when(col.isin(*tokens), F.lit(None).cast("string")).otherwise(col)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CSV_PRODUCTS_SCHEMA,
             na_tokens: list[str] = PANDAS_NA_TOKENS, columns: list[str] | None = None,
             with_report: bool = False, sep: str = ",", quote: str = '"', **opts):
    """S-6: header CSV, ',' separator, '"' quote with '""' as a literal quote,
    pandas missing tokens, typed columns, over-long rows dropped.

    Columns are found by their name in the header, in whatever order; those of
    ``schema`` that the file lacks are not in the result (``validation_report``
    tells), those that it has beyond are left out. ``columns`` names the fields
    of files without a header. Returns the typed frame, or (frame, report) with
    a one-row report of rows_read / rows_dropped / rows_padded when
    ``with_report``.
    """
    raw = apply_bad_line_policy(read_csv_raw(spark, path, columns, sep, quote, **opts), sep, quote)
    kept = raw.where(~F.col("_too_long"))
    out = kept.select(*[typed_na(f.name, f.dataType, na_tokens) for f in schema.fields if f.name in raw.columns])
    if not with_report:
        return out
    report = raw.agg(F.count(F.lit(1)).alias("rows_read"),
                     F.count_if(F.col("_too_long")).alias("rows_dropped"),
                     F.count_if(F.col(_CORRUPT).isNotNull() & ~F.col("_too_long")).alias("rows_padded"))
    return out, report


def typed_na(c: str, dtype: T.DataType, na_tokens: list[str]) -> F.Column:
    """Text -> declared type; missing tokens and what does not parse -> NULL
    (S-8); whole numbers may have a decimal point ('5.0')."""
    col = na_to_null(c, na_tokens)
    if isinstance(dtype, T.StringType):
        return col.alias(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        tried = [F.try_to_timestamp(col, F.lit(f)).cast(dtype) for f in TIMESTAMP_FORMATS]
        return F.coalesce(col.try_cast(dtype), *tried).alias(c)
    if isinstance(dtype, T.IntegralType):
        return to_int(col).try_cast(dtype).alias(c)
    x = col.try_cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        x = F.when(F.isnan(x), F.lit(None).cast(dtype)).otherwise(x)
    return x.alias(c)
