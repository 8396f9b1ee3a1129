"""Document-collection sources (S-4, S-5, S-10).

Documents arrive as JSON lines (one flat object per line) or as a JSON text
column. Both are read with an explicit schema; a field missing from a
document is NULL, a field not in the schema is ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.text import preview

FEEDBACK_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("feedback_id", T.StringType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("customer_email", T.StringType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("feedback_date", T.TimestampType()),
    T.StructField("helpful_votes", T.IntegerType()),
    T.StructField("verified_purchase", T.BooleanType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
])

_CORRUPT = "_corrupt_record"


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str,
                   limit: int | None = None, malformed: bool = False):
    """S-4: scan a collection exported as JSON lines. ``limit`` 0/None = all.

    An ``_id`` given as extended JSON (``{"$oid": "..."}``) is read as its
    string (S-5). Lines that are not a document are left out; ``malformed``
    returns (documents, malformed lines) so that a load can keep and count them.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    read_schema = schema
    if "_id" in schema.fieldNames():
        # read _id as raw text so both "abc" and {"$oid": "abc"} survive
        read_schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "_id" else f
                                    for f in schema.fields])
    read_schema = T.StructType([*read_schema.fields, T.StructField(_CORRUPT, T.StringType())])
    raw = (spark.read.schema(read_schema).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _CORRUPT).json(path))
    # every field is asked for, so what counts as malformed does not depend on the caller's projection
    broken = F.col(_CORRUPT).isNotNull() & (F.length(F.to_json(F.struct(*schema.fieldNames()))) >= 0)
    df = raw.where(~F.coalesce(broken, F.lit(False))).select(*schema.fieldNames())
    if "_id" in df.columns:
        df = df.withColumn("_id", object_id_to_string("_id"))
    df = df.limit(limit) if limit else df
    if not malformed:
        return df
    return df, raw.where(broken).select(F.col(_CORRUPT).alias("line"), F.lit("malformed document").alias("reject_reason"))


def object_id_to_string(c) -> F.Column:
    """S-5: ``{"$oid": "..."}`` -> "...", plain strings unchanged."""
    col = F.col(c) if isinstance(c, str) else c
    oid = F.get_json_object(col, "$.$oid")
    return F.when(col.startswith("{"), oid).otherwise(col)


def parse_documents(df: DataFrame, json_col: str, schema: T.StructType | str, alias: str = "doc") -> DataFrame:
    """Parse a JSON text column with an explicit schema into struct ``alias``."""
    return df.withColumn(alias, F.from_json(F.col(json_col), schema))


def sample_documents(df: DataFrame, n: int = 3, width: int = 50,
                     skip: tuple[str, ...] = ("_id", "password")) -> DataFrame:
    """S-10: first ``n`` documents with every value longer than ``width``
    characters cut to ``width`` + '...'; ``skip`` columns are left out."""
    cols = [preview(F.col(c).cast("string"), width).alias(c) for c in df.columns if c not in skip]
    out = df.select(*cols)
    return out.limit(n) if n else out
