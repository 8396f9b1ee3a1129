"""Relational sources over JDBC (S-1, S-2, S-3) and catalog probes (S-11,
S-12).

Projection and predicate are DataFrame operations, so Catalyst pushes them
into the SQL sent to the database; big tables are read in parallel slices
of a numeric column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrina.sources.tables import extract_table


def read_jdbc(spark: SparkSession, url: str, table: str, columns: str | list[str] = "*", where: str = "",
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              properties: dict | None = None, fetch_size: int = 10000) -> DataFrame:
    """S-1: ``extract_table(table, columns, where)`` against a database.

    The scan is split into ``num_partitions`` parallel range queries on
    ``partition_column``; bounds that are not given are asked for with one
    min / max query (they only decide the slices, no row is filtered by them).
    A small table may be read over one connection with ``num_partitions=1``.
    """
    if not partition_column and num_partitions != 1:
        raise ValueError("name a numeric partition_column, or num_partitions=1 for a small table")
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column and None in (lower_bound, upper_bound):
        ask = f"(SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM {table}) bounds"
        lo, hi = reader.option("dbtable", ask).load().first()
        lower_bound, upper_bound = (lo or 0, (hi or 0) + 1)
        reader = reader.option("dbtable", table)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return extract_table(reader.load(), columns, where)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", truncate: bool = False,
               properties: dict | None = None) -> None:
    """K-1 over JDBC: ``truncate`` keeps the table definition on overwrite."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    if truncate:
        w = w.option("truncate", "true")
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """S-11: table names of a database, sorted (metadata only)."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def table_exists(spark: SparkSession, name: str, database: str | None = None) -> bool:
    """S-12."""
    return spark.catalog.tableExists(name, database)
