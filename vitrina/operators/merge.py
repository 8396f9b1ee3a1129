"""Loads into warehouse tables: upsert, partial upsert, insert-if-absent,
tolerant load, partial-column insert, full refresh and versioned commits
(K-1 ... K-12).

Parquet tables have no MERGE, so a merge is a join that produces the next
version of the table, written to a new directory and committed by a marker
(K-10). Both sides of every merge join are unique on the key (the source is
always reduced per key first with a map-side-combinable ``max_by``/``min_by``),
so no key can be hot in the join. Tables that are only ever added to are
directories of appended parts instead (``append_absent``): a load reads the
partitions that its rows belong to and writes its new rows, nothing else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators.surrogate import tie_break
from vitrina.session import cut_lineage

_TP, _SP = "_t_present", "_s_present"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def last_per_key(df: DataFrame, keys, order_cols: list[str], first: bool = False) -> DataFrame:
    """One row per key: the last (or first) by ``order_cols``, a hash of the
    other columns as tie-break. Partial aggregation, so a key with a third of the rows is
    reduced before the shuffle."""
    keys = _keys(keys)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols], *tie_break(df, list(order_cols) + keys))
    row = F.struct(*[F.col(c) for c in rest])
    pick = F.min_by(row, order) if first else F.max_by(row, order)
    return (df.groupBy(*keys).agg(pick.alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]))


def upsert(target: DataFrame, source: DataFrame, keys, update_cols: list[str] | None = None,
           order_cols: list[str] | None = None, touch: dict[str, Column] | None = None,
           insert_only: dict[str, Column] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET c = EXCLUDED.c`` (K-2, K-3).

    * ``update_cols``: the SET list (default: every source column). Other
      columns keep the target's value on a match -- even a NULL one -- and take
      the source value (or NULL) on an insert.
    * ``order_cols``: batch order of the source; with several source rows of
      one key the last wins (row-by-row inserts), without an order the one
      with the greatest hash.
    * ``touch``: columns set to a value on update and on insert (e.g.
      updated_at = now, K-11); ``insert_only``: set on insert, kept on update
      (e.g. processed_at / created_at).
    Output has the target's columns; one full outer join on the keys.
    """
    keys = _keys(keys)
    src = last_per_key(source, keys, order_cols or [])
    upd = [c for c in (update_cols if update_cols is not None else src.columns) if c not in keys]
    touch, insert_only = touch or {}, insert_only or {}
    t = target.withColumn(_TP, F.lit(True)).alias("t")
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in src.columns if c not in keys],
                   F.lit(True).alias(_SP))
    j = t.join(s, keys, "full_outer")
    tp, sp = F.coalesce(F.col(_TP), F.lit(False)), F.coalesce(F.col(_SP), F.lit(False))
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            out.append(F.col(c))
            continue
        sval = F.col(f"_s_{c}").try_cast(f.dataType) if c in src.columns else F.lit(None).cast(f.dataType)
        if c in touch:
            e = F.when(sp, touch[c]).otherwise(F.col(f"t.{c}"))
        elif c in insert_only:
            e = F.when(tp, F.col(f"t.{c}")).otherwise(insert_only[c])
        elif c in upd:
            e = F.when(sp, sval).otherwise(F.col(f"t.{c}"))
        else:
            e = F.when(tp, F.col(f"t.{c}")).otherwise(sval)
        out.append(e.cast(f.dataType).alias(c))
    return j.select(*out)


def insert_if_absent(target: DataFrame, source: DataFrame, keys, order_cols: list[str] | None = None
                     ) -> DataFrame:
    """``ON CONFLICT (keys) DO NOTHING`` (K-4, B-3): the first source row of a
    new key is inserted, everything else is ignored. Target rows pass
    untouched; the anti join reads only the target's key columns. It comes
    first: source rows are shuffled for it as they are, and only those with a
    new key are hashed, paired with their order and reduced, where they lie."""
    keys = _keys(keys)
    new = last_per_key(source.join(target.select(*keys), keys, "left_anti"), keys, order_cols or [], first=True)
    return target.unionByName(conform(new, target.schema))


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Partial-column insert (K-7, K-12): select the target's columns in its
    order, cast, and give absent columns their default (or NULL). Rows whose
    values do not convert are for ``tolerant_load`` to set aside before."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            e = F.col(f.name)
            if f.name in defaults:
                e = F.coalesce(e, _lit(defaults[f.name]))
        elif f.name in defaults:
            e = _lit(defaults[f.name])
        else:
            e = F.lit(None)
        cols.append(e.try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def tolerant_load(df: DataFrame, required: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """K-9: rows whose required columns do not convert are set aside instead of
    failing the load. ``required`` maps column -> Spark type. Returns
    (valid rows with converted columns, rejected rows + reason)."""
    conv = {c: F.col(c).try_cast(t) for c, t in required.items()}
    bad = [F.when(F.col(c).isNotNull() & conv[c].isNull(), F.lit(f"bad {c}"))
           .when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    reason = F.array_compact(F.array(*bad)) if bad else F.array()
    tagged = df.withColumn("_reasons", reason)
    valid = (tagged.where(F.size("_reasons") == 0)
             .select(*[conv[c].alias(c) if c in conv else F.col(c) for c in df.columns]))
    rejected = (tagged.where(F.size("_reasons") > 0)
                .select(*df.columns, F.array_join("_reasons", "; ").alias("reject_reason")))
    return valid, rejected


def split_valid(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Q-3 style split: a row is kept when no check is FALSE (NULL passes, as
    SQL CHECK). Rejected rows carry the names of the failed checks."""
    holds = {name: F.coalesce(cond, F.lit(True)) for name, cond in checks.items()}
    kept = reduce(Column.__and__, holds.values(), F.lit(True))  # plain conditions: a filter of compiled code
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in holds.items()]))
    return df.where(kept), df.where(~kept).withColumn("failed_checks", failed)


# ------------------------------------------------------------------ storage
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _versions(spark: SparkSession, base: str) -> dict[int, bool]:
    """Version -> whether its write finished (Spark's _SUCCESS marker)."""
    fs, p, jvm = _fs(spark, base)
    out = {}
    for st in fs.listStatus(p) if fs.exists(p) else []:
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            out[int(name[2:])] = bool(fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")))
    return out


def committed_versions(spark: SparkSession, base: str) -> list[int]:
    """Versions under ``base`` whose write finished."""
    return sorted(v for v, done in _versions(spark, base).items() if done)


def read_current(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Newest committed version of a table, or None (or an empty frame of
    ``schema``) when nothing was committed yet."""
    vs = committed_versions(spark, base)
    if not vs:
        return spark.createDataFrame([], schema) if schema is not None else None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{base.rstrip('/')}/v={vs[-1]:06d}")


def write_version(df: DataFrame, base: str, partition_by: list[str] | None = None) -> str:
    """K-10 all-or-nothing: write the next version to a new directory. Readers
    see it only once the job committed (``_SUCCESS``); a failed job leaves the
    previous version current. Returns the new directory."""
    path = f"{base.rstrip('/')}/v={max(_versions(df.sparkSession, base), default=0) + 1:06d}"
    w = df.write.mode("errorifexists")  # of two writers at once the second fails
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_appended(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """A table of appended parts: the rows of every committed part; filters on
    the partition column skip the files of other partitions. One scan, however
    many parts there are."""
    parts = [f"{base.rstrip('/')}/v={v:06d}" for v in committed_versions(spark, base)]
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*parts).select(*schema.fieldNames())


def append_absent(spark: SparkSession, base: str, schema: T.StructType, source: DataFrame, keys,
                  partition_col: str, order_cols: list[str] | None = None) -> int:
    """K-4 on storage: ``ON CONFLICT (keys) DO NOTHING`` for a table partitioned
    by a column that is part of the key. Only the partitions that the source
    has rows of are read, only new rows are written, as one more committed
    part; no file that exists is touched. Returns the rows added. Idempotent:
    the same source again adds nothing."""
    keys = _keys(keys)
    if partition_col not in keys:
        raise ValueError(f"{partition_col} must be part of the key")
    new = last_per_key(conform(source, schema), keys, order_cols or [], first=True)
    # one value per load date of the batch; a load has one, a catch-up run a few
    dates = [r[0] for r in new.select(partition_col).distinct().collect()]
    there = read_appended(spark, base, schema).where(F.col(partition_col).isin(dates)).select(*keys)
    new = cut_lineage(new.join(there, keys, "left_anti").select(*schema.fieldNames()))
    added = new.count()
    if added:
        write_version(new, base, [partition_col])
    return added


REJECTED_SCHEMA = "run_date date, table_name string, reject_reason string, row string"


def write_rejected(rejected: DataFrame, base: str, run_date: str, table_name: str) -> None:
    """Rows that a load did not take, as JSON with their reason; a re-run of the
    same date and table replaces them."""
    rest = [c for c in rejected.columns if c != "reject_reason"]
    rows = rejected.select("reject_reason", F.to_json(F.struct(*rest)).alias("row"))
    rows.write.mode("overwrite").parquet(f"{base.rstrip('/')}/run_date={run_date}/table_name={table_name}")


def read_rejected(spark: SparkSession, base: str) -> DataFrame:
    """(run_date, table_name, reject_reason, row) of all runs; none before the first."""
    fs, p, _ = _fs(spark, base)
    if not fs.exists(p):
        return spark.createDataFrame([], REJECTED_SCHEMA)
    return (spark.read.schema(REJECTED_SCHEMA).parquet(base)
            .select("run_date", "table_name", "reject_reason", "row"))


def ensure_table(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """K-6 ``CREATE TABLE IF NOT EXISTS``: an empty first version."""
    if not committed_versions(spark, base):
        write_version(spark.createDataFrame([], schema), base)
    return read_current(spark, base, schema)
