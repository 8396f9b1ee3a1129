"""Slowly changing dimension, type 2 (K-5, A-13, B-4, V-1, V-2).

Semantics (per incoming row, in batch order): compare ``lower(strip(concat of
the tracked columns))`` with the key's latest version; no version -> insert
(*new*); different -> close every current version with expiration = run date
and insert a new one (*updated*); equal -> nothing (*unchanged*). Keys absent
from the batch are untouched; a key repeated in a batch chains versions.

Plan. Rows are counted per natural key first (map-side combined, keys only).
Keys that come once -- all of them in a usual batch -- are settled by one
full-outer join of the current rows and the batch on the natural key, which
also yields late keys, untouched rows and the counts. Keys that come several
times, however often, never enter that join: their rows and current rows are
range-partitioned on (natural key, batch order) and the partition number
becomes a *bucket*, so a key with a third of all rows spreads over many tasks.
``lag``/``lead`` run inside a bucket; what crosses a bucket edge (the last
compare text, whether a later bucket holds a newer version) is read from
per-bucket summaries -- one row per partition, broadcast. Only inserted rows
are numbered: max existing key + position in (natural key, batch order).

Closed history takes no part. ``Merged`` keeps the new current rows and the
rows closed by this batch apart, so a stored dimension (``write_dimension``)
appends the closed rows and never writes history again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.text import full_name, ustrip
from vitrina.operators.merge import _versions, committed_versions
from vitrina.operators.surrogate import dense_index, max_key, tie_break
from vitrina.session import cut_lineage

# Fixed values of the customer dimension.
OPEN_END = "9999-12-31"
SOURCE_SYSTEM = "postgres_source"
CUSTOMER_TRACKED = ["first_name", "last_name", "email", "city"]
PRODUCT_TRACKED = ["product_name", "category", "brand", "unit_price"]

DIM_CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_key", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()), T.StructField("last_name", T.StringType()),
    T.StructField("full_name", T.StringType()), T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("customer_segment", T.StringType()),
    T.StructField("registration_date", T.DateType()), T.StructField("effective_date", T.DateType()),
    T.StructField("expiration_date", T.DateType()), T.StructField("is_current", T.BooleanType()),
    T.StructField("source_system", T.StringType()), T.StructField("load_date", T.DateType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
])

DIM_PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_key", T.LongType()), T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("subcategory", T.StringType()), T.StructField("brand", T.StringType()),
    T.StructField("unit_price", T.DecimalType(10, 2)), T.StructField("cost_price", T.DecimalType(10, 2)),
    T.StructField("stock_quantity", T.IntegerType()), T.StructField("effective_date", T.DateType()),
    T.StructField("expiration_date", T.DateType()), T.StructField("is_current", T.BooleanType()),
    T.StructField("source_system", T.StringType()), T.StructField("load_date", T.DateType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
])


@dataclass(frozen=True)
class DimSpec:
    """Which dimension: natural key, surrogate key, tracked columns, schema."""
    natural_key: str
    surrogate_key: str
    tracked: tuple[str, ...]
    schema: T.StructType
    derived: tuple[tuple[str, str, str], ...] = ()  # (column, first part, last part) concatenations


CUSTOMERS = DimSpec("customer_id", "customer_key", tuple(CUSTOMER_TRACKED), DIM_CUSTOMERS_SCHEMA,
                    (("full_name", "first_name", "last_name"),))
PRODUCTS = DimSpec("product_id", "product_key", tuple(PRODUCT_TRACKED), DIM_PRODUCTS_SCHEMA)


def empty_dim(spark, spec: DimSpec = CUSTOMERS) -> DataFrame:
    return spark.createDataFrame([], spec.schema)


def compare_text(cols, sep: str = "") -> Column:
    """``f"{a}{b}{c}{d}".lower().strip()`` with missing values as ''.
    ``sep=''`` is the parity form (('ab','c') equals ('a','bc')); pass e.g.
    '\\u0001' to tell such rows apart."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return ustrip(F.lower(F.concat_ws(sep, *parts)))


@dataclass
class Merged:
    """What a batch makes of a dimension."""
    current: DataFrame   # all current rows after the batch
    closed: DataFrame    # rows that this batch closed (or that were superseded inside it), for the history
    counts: DataFrame    # one row: new / updated / unchanged
    rejected: DataFrame  # batch rows that were not applied, with reject_reason


#: Rows of the several-times path for which one bucket is made.
BUCKET_ROWS = 1_000_000


def merge_current(current: DataFrame, batch: DataFrame, run_date: str, order_cols: list[str],
                  spec: DimSpec = CUSTOMERS, last_key: int = 0, carry_columns: list[str] | None = None, sep: str = "",
                  now: Column | None = None, partitions: int | None = None,
                  source_system: str = SOURCE_SYSTEM) -> Merged:
    """Apply one batch to the current rows of a dimension; ``last_key`` is its
    largest surrogate key.

    ``order_cols`` give the batch order (a source sequence or updated_at);
    remaining columns break ties. ``carry_columns`` are copied into new
    versions (parity: none, so e.g. phone stays NULL). ``now`` stamps
    created_at/updated_at (default: the run date at midnight, so a re-run is
    reproducible). ``partitions``: buckets of the several-times path (default:
    by its size). Not applied and returned as rejected: rows without a natural
    key, or with one that does not convert, and rows of keys whose current
    version starts after ``run_date`` (closing it would end it before it began).
    """
    key, skey = spec.natural_key, spec.surrogate_key
    names = spec.schema.fieldNames()
    carry = [c for c in (carry_columns or []) if c in batch.columns and c in names
             and c not in spec.tracked and c not in (key, skey)]
    run = F.lit(run_date).cast("date")
    now = now if now is not None else F.lit(run_date).cast("timestamp_ntz")
    given = batch.columns
    for c in spec.tracked:
        if c not in batch.columns:  # row.get(c, '') in the reference
            batch = batch.withColumn(c, F.lit(None).cast(spec.schema[c].dataType))
    pay = list(spec.tracked) + carry
    order = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)],
                     *[e.alias(f"t{i}") for i, e in enumerate(tie_break(batch, list(order_cols) + [key]))])
    rows = batch.select(F.col(key).try_cast(spec.schema[key].dataType).alias(key), F.struct(*given).alias("_given"),
                        F.struct(*[F.col(c).try_cast(spec.schema[c].dataType).alias(c) for c in pay]).alias("_new"),
                        order.alias("_ord"), compare_text(spec.tracked, sep).alias("_cmp"))
    no_key = rows.where(F.col(key).isNull()).select("_given", F.lit("no natural key").alias("reject_reason"))
    rows = rows.where(F.col(key).isNotNull())
    cur = current.select(key, F.struct(*names).alias("_cur"), compare_text(spec.tracked, sep).alias("_was"))

    often = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    chained = not often.limit(1).isEmpty()
    once, cur_once = (rows.join(often, key, "left_anti"), cur.join(often, key, "left_anti")) if chained else (rows, cur)
    j = cut_lineage(cur_once.join(once, key, "full_outer"))
    came, had = F.col("_ord").isNotNull(), F.col("_cur").isNotNull()
    late = came & had & (F.col("_cur.effective_date") > run)
    fresh, changed = came & ~had, came & had & ~late & (F.col("_cmp") != F.col("_was"))
    counts = j.agg(F.count_if(fresh).alias("new_records"), F.count_if(changed).alias("updated_records"),
                   F.count_if(came & ~fresh & ~changed & ~late).alias("unchanged_records"))
    rejected = no_key.unionByName(j.where(late).select("_given", F.lit("late").alias("reject_reason")))
    kept = j.where(had & ~changed).select("_cur.*")
    ended = j.where(changed).select("_cur.*")
    inserted = j.where(fresh | changed).select(key, "_ord", "_new", F.lit(True).alias("_current"))

    if chained:
        many, cur_many = rows.join(often, key, "left_semi"), cur.join(often, key, "left_semi")
        behind = cur_many.where(F.col("_cur.effective_date") > run)
        rejected = rejected.unionByName(many.join(behind.select(key), key, "left_semi")
                                        .select("_given", F.lit("late").alias("reject_reason")))
        kept = kept.unionByName(behind.select("_cur.*"))
        y, more = _chained(cur_many.where(F.col("_cur.effective_date") <= run),
                           many.join(behind.select(key), key, "left_anti").drop("_given"), key, partitions)
        old = F.col("_side") == 0
        kept = kept.unionByName(y.where(old & F.col("_current")).select("_cur.*"))
        ended = ended.unionByName(y.where(old & ~F.col("_current")).select("_cur.*"))
        inserted = inserted.unionByName(y.where(~old).select(key, "_ord", "_new", "_current"))
        counts = counts.unionByName(more).agg(*[F.sum(c).alias(c) for c in counts.columns])

    inserted = dense_index(inserted, [key, "_ord"], "_pos", start=last_key + 1)
    fills = {"effective_date": run,
             "expiration_date": F.when(F.col("_current"), F.lit(OPEN_END).cast("date")).otherwise(run),
             "is_current": F.col("_current"), "source_system": F.lit(source_system), "load_date": run,
             "created_at": now, "updated_at": now, skey: F.col("_pos")}
    for col, a, b in spec.derived:
        fills[col] = full_name(a, b)
    versions = (inserted.select("_pos", "_current", key, "_new.*")
                .select(*[_field(f, fills, set(pay) | {key}) for f in spec.schema.fields]))
    ended = ended.select(*[_close(f.name, run, now) for f in spec.schema.fields])
    return Merged(kept.select(*names).unionByName(versions.where("is_current")),
                  ended.unionByName(versions.where("not is_current")), counts,
                  rejected.select("_given.*", "reject_reason"))


def scd2_merge(dim: DataFrame, batch: DataFrame, run_date: str, order_cols: list[str],
               spec: DimSpec = CUSTOMERS, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply one batch to a whole dimension. Returns (new dimension, counts,
    rejected rows with reason); options as of ``merge_current``."""
    m = merge_current(dim.where("is_current"), batch, run_date, order_cols, spec,
                      max_key(dim, spec.surrogate_key), **options)
    names = spec.schema.fieldNames()
    history = dim.where(~F.col("is_current")).select(*names)
    return history.unionByName(m.closed).unionByName(m.current), m.counts, m.rejected


def _chained(cur: DataFrame, rows: DataFrame, key: str, partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """Keys that come several times in a batch: (accepted rows, counts).

    Accepted rows: ``_side`` 0 with ``_cur`` for current rows, 1 with ``_new``
    for new versions; ``_current`` tells whether the row is its key's last.
    """
    spark = rows.sparkSession
    inc = rows.select(key, "_new", "_cmp", "_ord", F.lit(1).alias("_side"))
    no_order = F.lit(None).cast(rows.schema["_ord"].dataType)
    old = cur.select(key, "_cur", F.col("_was").alias("_cmp"), no_order.alias("_ord"), F.lit(0).alias("_side"))
    x = old.unionByName(inc, allowMissingColumns=True)
    if partitions is None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BUCKET_ROWS))
    x = cut_lineage(x.repartitionByRange(partitions, F.col(key), F.col("_side"), F.col("_ord"))
                    .withColumn("_b", F.spark_partition_id()))

    w = Window.partitionBy("_b").orderBy(key, "_side", "_ord")
    by_b = Window.orderBy("_b")  # over per-bucket summaries only: one row per partition
    sort_key = F.struct(key, "_side", "_ord")
    side1 = F.col("_side") == 1

    # pass 1: predecessor's compare text, across bucket edges via summaries
    s1 = (x.groupBy("_b").agg(F.max_by(F.col(key), sort_key).alias("_lk"),
                              F.max_by(F.col("_cmp"), sort_key).alias("_lc"))
          .select("_b", F.lag("_lk").over(by_b).alias("_ck"), F.lag("_lc").over(by_b).alias("_cc")))
    lag_key, lag_cmp = F.lag(key).over(w), F.lag("_cmp").over(w)
    x1 = (x.join(F.broadcast(s1), "_b", "left")
          .withColumn("_prev", F.when(lag_key == F.col(key), lag_cmp)
                      .when(lag_key.isNull() & (F.col("_ck") == F.col(key)), F.col("_cc")))
          .withColumn("_acc", ~side1 | F.col("_prev").isNull() | (F.col("_cmp") != F.col("_prev"))))
    counts = x1.agg(
        F.count_if(side1 & F.col("_acc") & F.col("_prev").isNull()).alias("new_records"),
        F.count_if(side1 & F.col("_acc") & F.col("_prev").isNotNull()).alias("updated_records"),
        F.count_if(side1 & ~F.col("_acc")).alias("unchanged_records"))

    # pass 2: an accepted row stays current unless a later accepted *incoming*
    # row of its key exists -- later in the bucket, or in a later bucket
    y = x1.where("_acc").drop("_ck", "_cc", "_prev")
    last_acc = y.groupBy("_b").agg(F.max_by(F.col(key), sort_key).alias("_k"))
    first_inc = y.where(side1).groupBy("_b").agg(F.min_by(F.col(key), sort_key).alias("_k"))
    marks = (last_acc.select("_b", F.lit(0).alias("_t"), "_k")
             .unionByName(first_inc.select("_b", F.lit(1).alias("_t"), "_k")))
    desc = Window.orderBy(F.desc("_b"), F.asc("_t")).rowsBetween(Window.unboundedPreceding, -1)
    s2 = (marks.withColumn("_nk", F.last(F.when(F.col("_t") == 1, F.col("_k")), ignorenulls=True).over(desc))
          .where(F.col("_t") == 0).select("_b", F.col("_k").alias("_lak"), (F.col("_nk") == F.col("_k")).alias("_later")))
    in_bucket = Window.partitionBy("_b", key)
    later_here = F.when(side1, F.lead(key).over(w) == F.col(key)).otherwise(F.max("_side").over(in_bucket) == 1)
    cross = (F.col(key) == F.col("_lak")) & F.coalesce(F.col("_later"), F.lit(False))
    y = (y.join(F.broadcast(s2), "_b", "left")
         .withColumn("_current", ~F.coalesce(later_here, F.lit(False)) & ~cross).drop("_lak", "_later"))
    return cut_lineage(y), counts


# ------------------------------------------------------------------ storage
def write_dimension(merged: Merged, base: str) -> None:
    """Commit a merge: closed rows are appended under ``history``, current rows
    become the next version under ``current``. The current version's _SUCCESS
    marker commits both, so a failed run leaves the previous state; history
    of earlier runs is never written again. A run takes a version that no
    other one has begun, and fails where another has taken it meanwhile;
    ``catalog.Transaction`` commits several tables at once."""
    spark = merged.current.sparkSession
    begun = [*_versions(spark, f"{base}/current"), *_versions(spark, f"{base}/history")]
    v = f"v={max(begun, default=0) + 1:06d}"
    merged.closed.write.mode("errorifexists").parquet(f"{base}/history/{v}")
    merged.current.write.mode("errorifexists").parquet(f"{base}/current/{v}")


def read_current_rows(spark, base: str, spec: DimSpec = CUSTOMERS) -> DataFrame:
    """Current rows of a stored dimension; none before the first run."""
    versions = committed_versions(spark, f"{base}/current")
    if not versions:
        return empty_dim(spark, spec)
    return spark.read.schema(spec.schema).parquet(f"{base}/current/v={versions[-1]:06d}")


def read_dimension(spark, base: str, spec: DimSpec = CUSTOMERS) -> DataFrame:
    """All versions of a stored dimension: its current rows and the history of every committed run."""
    versions = committed_versions(spark, f"{base}/current")
    if not versions:
        return empty_dim(spark, spec)
    past = [f"{base}/history/v={v:06d}" for v in versions]
    return spark.read.schema(spec.schema).parquet(*past).unionByName(read_current_rows(spark, base, spec))


def _field(f: T.StructField, fills: dict, present: set) -> Column:
    if f.name in fills:
        return fills[f.name].cast(f.dataType).alias(f.name)
    if f.name in present:
        return F.col(f.name).cast(f.dataType).alias(f.name)
    return F.lit(None).cast(f.dataType).alias(f.name)


def _close(name: str, run: Column, now: Column) -> Column:
    """A current row is closed: is_current false, expiration = run date,
    updated_at = now; every other column unchanged."""
    changed = {"is_current": F.lit(False), "expiration_date": run, "updated_at": now}
    return changed[name].alias(name) if name in changed else F.col(name)
