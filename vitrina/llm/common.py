"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.session import scratch_path, ship_package
from vitrina.sources.tables import read_table

# White space that separates words, as characters and as a pattern.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
# A null doc_id takes this place while documents are joined and ordered; the value itself is reserved.
NO_ID = -(2 ** 63)
KEY = "_doc"
#: Rows that a function of map_batches sees at a time: some MB of text.
ROWS = 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return read_table(spark, sf_dir, "documents")


def one_row_per_document(docs: DataFrame, *extra: str, text: bool = True) -> DataFrame:
    """Columns ``_doc`` (doc_id, nulls as one reserved id), ``text`` and ``extra`` of documents, one row an id.

    Rows that repeat an id are one document; the greatest (text, extra...) row speaks for it. Ids are counted first
    (8 bytes a row are shuffled), so that whole texts are shuffled only where an id does repeat. Other columns of the
    input, whatever their names, are left out here.
    """
    cols = [*(["text"] if text else []), *extra]
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias(KEY), *cols)
    if d.groupBy(KEY).count().where("count > 1").limit(1).isEmpty():
        return d
    row = F.max(F.struct(*cols)) if cols else F.max(F.lit(1))
    return d.groupBy(KEY).agg(row.alias("_row")).select(KEY, *[F.col(f"_row.{c}").alias(c) for c in cols])


def keyed_rows(docs: DataFrame, *cols: str) -> DataFrame:
    """Columns ``_doc``, ``doc_id`` and ``cols`` of documents, every row a document with a key of its own.

    Keys follow doc_id, nulls first. Where ids are unique they are the keys, a single null has NO_ID. Else rows are
    sorted by id and hashes of the other columns, stored, and numbered in that order, so that the keys are the same in
    each run, rows without an id are spread over tasks, and only rows that are equal throughout can change places.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *cols)
    key = F.coalesce("doc_id", F.lit(NO_ID)).alias(KEY)
    if d.groupBy(key).count().where("count > 1").limit(1).isEmpty():
        return d.select(key, "*")
    # the last column spreads rows that are equal throughout
    tie = [F.xxhash64(*cols), F.hash(*cols)] if cols else []
    d = d.withColumn("_at", F.monotonically_increasing_id()).orderBy("doc_id", *tie, "_at").drop("_at")
    d = stored(d.select("*", F.monotonically_increasing_id().alias("_at")), "rows")
    part = F.shiftright("_at", 33)
    counts = d.groupBy(part.alias("_part")).count().orderBy("_part").collect()  # one row a partition
    first, n = [], 0
    for r in counts:
        first += [F.lit(r["_part"]), F.lit(n)]
        n += r["count"]
    base = F.create_map(*first)[part].cast("long")
    return d.select((base + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(KEY), "doc_id", *cols)


def doc_id(key: str = KEY) -> Column:
    """The id to return for ``_doc``: the reserved value becomes null again."""
    return F.nullif(F.col(key), F.lit(NO_ID)).alias("doc_id")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, computed once, written to the shared checkpoint folder and read again: cuts the lineage there, and a
    lost executor takes nothing with it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])).parquet(path)


def words(text: Column) -> Column:
    """The runs of characters other than WHITE."""
    return F.filter(F.split(text, WHITE_RUN), lambda w: w != "")


def positions(n: Column) -> Column:
    """0 .. n - 1, empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def map_batches(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow of a function on at most ROWS rows at a time."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield per_batch(batch.slice(at, ROWS))
    return df.mapInArrow(run, schema)
