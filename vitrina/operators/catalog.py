"""Tables of indexed files under one commit log (K-2, K-3, K-5, K-10).

A *catalog* is a directory with a log of numbered commits. A commit names, for
every table, one index: a small parquet table with a row per data file (path,
rows, smallest and largest key, bucket). Data files and indexes are only ever
added; a transaction writes what it needs beside them and then adds the next
commit, by creating a file that must not exist yet. So the tables of a
transaction change together or not at all, readers keep the files of the
commit that they began with, and of two transactions that touch one table the
second fails (``Conflict``) instead of undoing the first.

With the index a load finds the files that it concerns. An upsert reads the
keys of the files whose range meets one of the batch's, and rewrites only
those files that hold a key of the batch. A type-2 dimension keeps its current
rows in hash buckets; a batch reads and writes the buckets of its keys. All
other files are named by the new commit as they are.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators.merge import _fs, _keys, last_per_key, upsert
from vitrina.operators.scd2 import CUSTOMERS, DimSpec, Merged, merge_current
from vitrina.session import cut_lineage, shuffles_dropped

#: Rows of a data file, and key ranges that a batch is described by.
FILE_ROWS, SPANS = 1_000_000, 256
_BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another transaction changed a table that this one has read or written."""


@dataclass(frozen=True)
class Commit:
    version: int = 0
    tables: dict = field(default_factory=dict)  # name -> {"index", "schema", "keys", and what its loads keep}


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist, whole or not at all; False if it does exist."""
    fs, p, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    fs.mkdirs(p.getParent())
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":  # a rename would replace a file there
            name = lambda x: unquote(urlparse(x.toString()).path)
            os.link(name(tmp), name(p))
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(tmp, p, none)
            return True
    except FileExistsError:
        return False
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(tmp, False)
    return True


class Catalog:
    """The tables under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _commit_path(self, version: int) -> str:
        return f"{self.base}/_commits/{version:08d}.json"

    def head(self) -> Commit:
        """The newest commit."""
        fs, p, _ = _fs(self.spark, f"{self.base}/_commits")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        versions = [int(n[:8]) for n in names if n[:8].isdigit() and n.endswith(".json")]
        return self.commit(max(versions)) if versions else Commit()

    def commit(self, version: int) -> Commit:
        """An earlier commit: what it names is still there."""
        fs, p, jvm = _fs(self.spark, self._commit_path(version))
        stream = fs.open(p)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit(version, json.loads(text))

    def begin(self) -> Transaction:
        return Transaction(self)

    def read(self, name: str) -> DataFrame:
        return self.begin().read(name)

    def files(self, name: str, commit: Commit | None = None) -> list[str]:
        """The data files of a table."""
        entry = (commit or self.head()).tables.get(name)
        return [r[0] for r in self.spark.read.parquet(entry["index"]).select("file").orderBy("file").collect()] if entry else []


class Transaction:
    """Loads that are committed together. They see the tables as of the start, with what the transaction itself wrote."""

    def __init__(self, catalog: Catalog):
        self.catalog, self.spark, self.start = catalog, catalog.spark, catalog.head()
        self.changed: dict[str, dict] = {}
        self.seen: set[str] = set()

    # ------------------------------------------------------------- reading
    def entry(self, name: str) -> dict | None:
        self.seen.add(name)
        return self.changed.get(name) or self.start.tables.get(name)

    def index(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.entry(name)["index"])

    def read(self, name: str) -> DataFrame:
        entry = self.entry(name)
        if entry is None:
            raise KeyError(f"no table {name}")
        return self._rows([r[0] for r in self.index(name).select("file").collect()], T.StructType.fromJson(entry["schema"]))

    def _rows(self, files: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def meeting(self, index: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
        """Index rows of files whose key range meets one of at most SPANS key ranges of ``rows`` (of the table's types)."""
        spans = (rows.select(*keys).repartitionByRange(SPANS, *keys).groupBy(F.spark_partition_id())
                 .agg(F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi")))
        ranges = spans.agg(F.collect_list(F.struct("lo", "hi"))).scalar()  # one array, in the plan as it is
        meets = F.exists("_ranges", lambda s: (F.col("lo") <= s["hi"]) & (F.col("hi") >= s["lo"]))
        return index.withColumn("_ranges", ranges).where(meets).drop("_ranges")

    # ------------------------------------------------------------- writing
    def _write(self, df: DataFrame, name: str, keys: list[str], partition_by: list[str] | None = None) -> tuple[str, DataFrame]:
        """New data files; (their folder, their index rows)."""
        path = f"{self.catalog.base}/{name}/data-{uuid.uuid4().hex[:12]}"
        w = df.write.partitionBy(*partition_by) if partition_by else df.write
        with shuffles_dropped(self.spark):
            w.parquet(path)
        key = F.struct(*keys)
        schema = T.StructType([f for f in df.schema if f.name in keys])
        rows = self.spark.read.schema(schema.add(_BUCKET, T.IntegerType()) if partition_by else schema).parquet(path)
        bucket = F.col(_BUCKET) if partition_by else F.lit(None).cast("int")
        return path, (rows.groupBy(F.col("_metadata.file_path").alias("file"), bucket.alias("bucket"))
                      .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi")))

    def stage(self, name: str, index: DataFrame, schema: T.StructType, keys: list[str], **kept) -> None:
        """Name the files of ``index`` as the table from this transaction on."""
        self.entry(name)
        path = f"{self.catalog.base}/{name}/index-{uuid.uuid4().hex[:12]}"
        index.select("file", "bucket", "rows", "lo", "hi").coalesce(1).write.parquet(path)
        self.changed[name] = {"index": path, "schema": json.loads(schema.json()), "keys": keys, **kept}

    def replace(self, name: str, df: DataFrame, keys, files: int | None = None) -> None:
        """K-1: the whole table anew, its files sorted by key."""
        keys = _keys(keys)
        df = cut_lineage(df)
        n = files or max(1, -(-df.count() // FILE_ROWS))
        rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        self.stage(name, self._write(rows, name, keys)[1], df.schema, keys)

    def append(self, name: str, df: DataFrame, keys) -> None:
        """More files beside those that there are."""
        new = self._write(df, name, _keys(keys))[1]
        index = new if self.entry(name) is None else self.index(name).unionByName(new)
        self.stage(name, index, df.schema, _keys(keys))

    def upsert(self, name: str, source: DataFrame, update_cols: list[str] | None = None, order_cols: list[str] | None = None,
               touch: dict[str, Column] | None = None, insert_only: dict[str, Column] | None = None) -> dict:
        """K-2 / K-3 (options as of ``merge.upsert``) on the files that a batch concerns.

        Files are chosen by key range first, then by a semi join of their key
        columns with the batch; only files that do hold one of its keys are
        read whole and written again, together with the new keys. Returns how
        many files the table had, had their keys read, were written again.
        """
        entry = self.entry(name)
        keys, schema = entry["keys"], T.StructType.fromJson(entry["schema"])
        src = cut_lineage(last_per_key(source, keys, order_cols or []))
        typed = [F.col(k).cast(schema[k].dataType).alias(k) for k in keys]
        index = cut_lineage(self.index(name))
        near = [r[0] for r in self.meeting(index, src.select(*typed), keys).select("file").collect()]
        held = []
        if near:
            there = self._rows(near, T.StructType([schema[k] for k in keys])).select(*keys, F.col("_metadata.file_path").alias("file"))
            held = [r[0] for r in there.join(src.select(*typed), keys, "left_semi").select("file").distinct().collect()]
        out = cut_lineage(upsert(self._rows(held, schema), src, keys, update_cols, None, touch, insert_only))
        per_file = max(1, index.agg(F.max("rows")).first()[0] or FILE_ROWS)
        n = max(1, -(-out.count() // per_file))
        new = self._write(out.repartitionByRange(n, *keys).sortWithinPartitions(*keys), name, keys)[1]
        kept = index.where(~F.col("file").isin(held)) if held else index
        self.stage(name, kept.unionByName(new), schema, keys)
        return {"files": index.count(), "keys_read": len(near), "rewritten": len(held)}

    def merge_dimension(self, name: str, batch: DataFrame, run_date: str, order_cols: list[str], spec: DimSpec = CUSTOMERS,
                        buckets: int = 256, **options) -> Merged:
        """K-5 / B-4: a batch into the dimension ``name`` (current rows, in buckets) and ``name_history`` (options as of
        ``merge_current``). Only files of buckets that the batch has keys of are read and written; closed rows are
        appended. ``buckets`` counts on the first load. The largest surrogate key is kept by the commit."""
        entry = self.entry(name) or {"buckets": buckets, "last_key": 0}
        of = F.pmod(F.xxhash64(F.col(spec.natural_key).cast("string")), F.lit(entry["buckets"])).cast("int")
        key = F.col(spec.natural_key).try_cast(spec.schema[spec.natural_key].dataType).alias(spec.natural_key)
        batch = cut_lineage(batch)
        hit = sorted(r[0] for r in batch.select(key).where(F.col(spec.natural_key).isNotNull()).select(of.alias("b")).distinct().collect())
        index = cut_lineage(self.index(name)) if "index" in entry else None
        files = [r[0] for r in index.where(F.col("bucket").isin(hit)).select("file").collect()] if index is not None and hit else []
        m = merge_current(self._rows(files, spec.schema), batch, run_date, order_cols, spec, entry["last_key"], **options)
        m = Merged(cut_lineage(m.current), cut_lineage(m.closed), m.counts, m.rejected)
        new = self._write(m.current.withColumn(_BUCKET, of).repartition(_BUCKET), name, [spec.natural_key], [_BUCKET])[1]
        if index is not None:
            new = index.where(~F.col("file").isin(files)).unionByName(new) if files else index.unionByName(new)
        last = max([entry["last_key"], *(x for x in m.current.select(spec.surrogate_key).unionByName(m.closed.select(spec.surrogate_key))
                                         .agg(F.max(spec.surrogate_key)).first() if x is not None)])
        self.stage(name, new, spec.schema, [spec.natural_key], buckets=entry["buckets"], last_key=last)
        if not m.closed.isEmpty() or self.entry(f"{name}_history") is None:
            self.append(f"{name}_history", m.closed, [spec.natural_key])
        return m

    def dimension(self, name: str) -> DataFrame:
        """All versions of a dimension: its history and its current rows."""
        return self.read(f"{name}_history").unionByName(self.read(name))

    # -------------------------------------------------------------- commit
    def commit(self) -> int:
        """K-10: name all changed tables in the next commit; its version. What
        others committed since the start stays, if this transaction has
        neither read nor written those tables; else nothing changes and
        ``Conflict`` is raised."""
        head = self.start
        while self.changed:
            if _create(self.spark, self.catalog._commit_path(head.version + 1), json.dumps(head.tables | self.changed)):
                return head.version + 1
            newer = self.catalog.head()
            lost = sorted(n for n in self.seen if newer.tables.get(n) != self.start.tables.get(n))
            if lost:
                raise Conflict(f"changed since commit {self.start.version}: {', '.join(lost)}")
            head = newer
        return head.version
