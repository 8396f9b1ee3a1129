"""Fact builders and lookups (J-1 ... J-7, B-5 ... B-9).

* As-of binding (J-3): an equi-join on the natural key with the validity
  range as a residual condition, half-open ``[effective, expiration)`` so a
  fact meets at most one version. Spark plans it as a sort-merge (or, when
  AQE measures a small dimension, broadcast) join on the key; a customer
  holding a third of the facts is split by AQE's skew-join handling, the
  dimension side of that key being just its few versions.
* Date and time keys are computed, not joined; small lookups are left to
  AQE's measured sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.functions.coerce import to_date, to_int
from vitrina.functions.keys import date_key, time_key_from_text
from vitrina.functions.text import truncate
from vitrina.operators.clean import NOT_GIVEN
from vitrina.operators.merge import split_valid
from vitrina.operators.surrogate import dense_index
from vitrina.session import cut_lineage

MONEY = "decimal(12,2)"


def asof_bind(facts: DataFrame, dim: DataFrame, fact_key: str, fact_date: str, dim_key: str,
              surrogate: str, how: str = "left") -> DataFrame:
    """J-3: attach ``surrogate`` of the dimension version valid on the fact's
    date. Facts before the first version (or in a gap) get NULL with
    ``how='left'``."""
    d = dim.select(F.col(dim_key).alias("_dk"), F.col(surrogate), F.col("effective_date").alias("_eff"),
                   F.col("expiration_date").alias("_exp"))
    dt = F.col(fact_date).cast("date")
    cond = (F.col(fact_key) == F.col("_dk")) & (dt >= F.col("_eff")) & (dt < F.col("_exp"))
    return facts.join(d, cond, how).drop("_dk", "_eff", "_exp")


def asof_merge(facts: DataFrame, dim: DataFrame, fact_key: str, fact_date: str, dim_key: str, surrogate: str,
               partitions: int | None = None) -> DataFrame:
    """J-3 by a sorted merge, for dimensions whose keys may have very many
    versions: ``asof_bind`` pairs a fact with all versions of its key before it
    tests the dates, this reads each fact and each version once.

    The distinct (key, date) of the facts and the versions are united and
    range-partitioned on (key, date, versions first). Inside a partition the
    last version so far is carried forward; what crosses a partition's edge
    comes from a summary with one row a partition. The version holds if it is
    the fact's key's and the date lies in [effective, expiration). Facts then
    take the one row of their (key, date), so whole facts are moved once, not
    sorted with the versions; a hot (key, date) is split by AQE's skew join. A
    key may have a third of all facts and of all versions. Versions of a key
    must not overlap (as those of a type-2 dimension don't); facts without a
    version, a key or a date get NULL.

    ``facts`` is read twice, the first time for its key and date alone: cut
    its lineage before if it is costly.
    """
    kind = dim.schema[dim_key].dataType
    version = F.struct(F.col(dim_key).alias("k"), F.col("effective_date").cast("date").alias("eff"),
                       F.col("expiration_date").cast("date").alias("exp"), F.col(surrogate).alias("v"))
    key, at = F.col(fact_key).try_cast(kind), F.col(fact_date).cast("date")
    f = (facts.select(key.alias("_k"), at.alias("_at")).where("_k is not null and _at is not null").distinct()
         .select("*", F.lit(1).alias("_side"), F.lit(None).cast(dim.select(version).schema[0].dataType).alias("_ver")))
    v = dim.select(F.col(dim_key).alias("_k"), F.col("effective_date").cast("date").alias("_at"), F.lit(0).alias("_side"), version.alias("_ver"))
    x = f.unionByName(v)
    order = ["_k", "_at", "_side", F.col("_ver.exp")]
    n = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = cut_lineage(x.repartitionByRange(n, *order).withColumn("_b", F.spark_partition_id()))

    last = x.where("_side = 0").groupBy("_b").agg(F.max_by("_ver", F.struct("_k", "_at", F.col("_ver.exp"))).alias("_ver"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    edges = (x.select("_b").distinct().join(last, "_b", "left")
             .select("_b", F.last("_ver", ignorenulls=True).over(before).alias("_edge")))
    so_far = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    y = (x.withColumn("_last", F.last("_ver", ignorenulls=True).over(so_far)).where("_side = 1")
         .join(F.broadcast(edges), "_b").withColumn("_ver", F.coalesce("_last", "_edge")))
    holds = (F.col("_ver.k") == F.col("_k")) & (F.col("_at") >= F.col("_ver.eff")) & (F.col("_at") < F.col("_ver.exp"))
    y = y.where(holds).select("_k", "_at", F.col("_ver.v").alias(surrogate))
    return facts.withColumns({"_k": key, "_at": at}).join(y, ["_k", "_at"], "left").drop("_k", "_at")


def current_lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, surrogate: str) -> DataFrame:
    """J-1: bind to the current version only."""
    d = dim.where("is_current").select(F.col(dim_key).alias("_dk"), F.col(surrogate))
    return facts.join(d, F.col(fact_key) == F.col("_dk"), "left").drop("_dk")


def status_lookup(facts: DataFrame, statuses: DataFrame, status_col: str = "order_status") -> DataFrame:
    """J-4: status_key by code, case-insensitive ('Pending' vs 'PENDING')."""
    s = statuses.select(F.col("status_code").alias("_code"), "status_key")
    return (facts.join(s, F.upper(F.col(status_col)) == F.col("_code"), "left").drop("_code"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """J-6: child rows whose (non-NULL) key has no parent."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(p, F.col(child_key) == F.col("_pk"), "left_anti")


def order_lines(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """J-5: one row per order item with its order and product attributes,
    cost = quantity x cost_price, profit = total - cost. An item without an
    order stays, with ``order_found`` false; ``fact_orders`` rejects it.
    Products come first, so that items move for them without the columns of
    their orders."""
    o = orders.select("order_id", "customer_id", "order_date", "order_time", F.col("status").alias("order_status"),
                      "payment_method", *[c for c in ("shipping_city",) if c in orders.columns],
                      F.lit(True).alias("order_found"))
    p = products.select("product_id", "cost_price")
    li = (items.select("order_id", "product_id", "quantity", F.col("total_price").alias("total_amount"))
          .join(p, "product_id", "left").join(o, "order_id", "left"))
    cost = (F.col("quantity") * F.col("cost_price")).cast(MONEY)
    return li.select(
        "order_id", "customer_id", "product_id", "order_date", "order_time", "order_status", "payment_method",
        *[c for c in ("shipping_city",) if c in orders.columns], "quantity",
        F.try_divide(F.col("total_amount"), F.col("quantity")).cast("decimal(10,2)").alias("unit_price"),
        F.col("total_amount").cast(MONEY).alias("total_amount"), cost.alias("cost_amount"),
        (F.col("total_amount") - cost).cast(MONEY).alias("profit_amount"),
        F.coalesce("order_found", F.lit(False)).alias("order_found"))


def fact_checks() -> dict[str, Column]:
    """Q-3 CHECK constraints of fact_orders, and J-6: the item has its order."""
    return {"order_exists": F.col("order_found"),
            "quantity_positive": F.col("quantity") > 0,
            "unit_price_non_negative": F.col("unit_price") >= 0,
            "total_amount_non_negative": F.col("total_amount") >= 0}


def fact_orders(lines: DataFrame, dim_customers: DataFrame, dim_products: DataFrame, statuses: DataFrame,
                load_date: str, source_system: str = "postgres_source", bind=asof_bind) -> tuple[DataFrame, DataFrame]:
    """B-5: order lines bound to the customer and product versions valid on
    the order date, with date/time/status keys. ``bind``: asof_bind, or
    asof_merge for keys with very many versions. Customers are bound last: the
    lines of an order then lie together, and sums by order are combined before
    they are moved. Returns (facts, rejected by the CHECK constraints)."""
    valid, rejected = split_valid(lines, fact_checks())
    f = cut_lineage(valid) if bind is asof_merge else valid  # which reads facts twice for each dimension
    f = bind(f, dim_products, "product_id", "order_date", "product_id", "product_key")
    f = bind(f, dim_customers, "customer_id", "order_date", "customer_id", "customer_key")
    f = status_lookup(f, statuses)
    out = f.select(
        "customer_key", "product_key", date_key("order_date").cast("int").alias("date_key"),
        time_key_from_text("order_time").alias("time_key"), "status_key", "order_id", "customer_id", "product_id",
        "order_status", "payment_method", *[c for c in ("shipping_city",) if c in f.columns], "quantity",
        "unit_price", "total_amount", "cost_amount", "profit_amount", F.lit(source_system).alias("source_system"),
        F.lit(load_date).cast("date").alias("load_date"))
    return out, rejected


def fact_payments(payments: DataFrame, dim_customers: DataFrame, load_date: str,
                  source_system: str = "postgres_source", bind=asof_bind) -> DataFrame:
    """B-6: payments bound to the customer version valid on the payment date."""
    f = bind(payments, dim_customers, "customer_id", "payment_ts", "customer_id", "customer_key")
    ts = F.col("payment_ts")
    return f.select(
        "customer_key", date_key(ts).cast("int").alias("date_key"),
        (F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)).alias("time_key"), "payment_id",
        *[c for c in ("order_id",) if c in f.columns], "customer_id", "payment_amount", "payment_method",
        "payment_status", F.lit(source_system).alias("source_system"), F.lit(load_date).cast("date").alias("load_date"))


# Fixed values of the feedback fact.
FEEDBACK_ID_FORMAT = "FB_%04d"
FEEDBACK_TEXT_MAX = 500
FEEDBACK_SOURCE = "mongo_source"


def fact_feedback(feedback: DataFrame, load_date: str, order_cols: list[str], with_ids: bool = False,
                  id_base: int = 0) -> DataFrame:
    """B-7 / P-13 full refresh of fact_feedback with keys 1..n (K-1, K-8).

    feedback_id: the document's own, else 'FB_%04d' of its position (from 0)
    when the column is absent; text: ``feedback`` preferred over ``comment``,
    capped at 500 characters; rating: integer or 0; customer_id / product_id
    stay 0 unless ``with_ids``. Columns are cut to what the fact needs before
    rows are sorted, so whole texts are not moved; rows equal on
    ``order_cols`` are ordered by those columns.
    """
    pos = "_pos"
    fid = (F.col("feedback_id").cast("string") if "feedback_id" in feedback.columns
           else F.format_string(FEEDBACK_ID_FORMAT, F.col(pos)))
    texts = [F.col(c) for c in ("feedback", "comment") if c in feedback.columns]
    text = truncate(F.coalesce(*texts, F.lit("")), FEEDBACK_TEXT_MAX)
    rating = to_int("rating", 0) if "rating" in feedback.columns else F.lit(0)

    def ident(c: str) -> Column:
        if with_ids and c in feedback.columns:
            return to_int(c, 0)
        return F.lit(0)
    own = [F.col("feedback_id")] if "feedback_id" in feedback.columns else []
    rows = feedback.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)], *own,
                           text.alias("feedback_text"), ident("customer_id").alias("customer_id"),
                           ident("product_id").alias("product_id"), rating.alias("rating"))
    return dense_index(rows, [f"_o{i}" for i in range(len(order_cols))], name=pos, start=id_base).select(
        (F.col(pos) - F.lit(id_base) + 1).alias("feedback_key"), truncate(fid, 50).alias("feedback_id"),
        "feedback_text", "customer_id", "product_id", "rating",
        F.lit(FEEDBACK_SOURCE).alias("source_system"), F.lit(load_date).cast("date").alias("load_date"))


CSV_CAPS = {"product_name": 255, "category": 100, "subcategory": 100, "supplier": 100, "country_of_origin": 100,
            "dimensions": 100}


def csv_products_rows(csv_df: DataFrame, load_date: str, order_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """B-8 / P-14: typed, capped rows with keys 1..n; rows without id or price
    are rejected instead of failing the load."""
    valid, rejected = split_valid(csv_df, {"product_id_present": F.col("product_id").isNotNull(),
                                           "unit_price_present": F.col("unit_price").isNotNull()})
    out = dense_index(valid.select(
        F.col("product_id").cast("int").alias("product_id"),
        *[truncate(c, CSV_CAPS[c]).alias(c) if c in CSV_CAPS else F.col(c)
          for c in ("product_name", "category", "subcategory")],
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.coalesce(F.col("stock_quantity").cast("int"), F.lit(0)).alias("stock_quantity"),
        *[truncate(c, CSV_CAPS[c]).alias(c) for c in ("supplier", "country_of_origin")],
        F.col("weight_kg").cast("decimal(6,2)").alias("weight_kg"), truncate("dimensions", 100).alias("dimensions")),
        order_cols, name="csv_product_key")
    out = out.select("csv_product_key", *[c for c in out.columns if c != "csv_product_key"],
                     F.lit("csv_source").alias("source_system"), F.lit(load_date).cast("date").alias("load_date"))
    return out, rejected


SIMPLE_ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()), T.StructField("order_date", T.DateType()),
    T.StructField("total_amount", T.DecimalType(12, 2)), T.StructField("status", T.StringType()),
    T.StructField("payment_method", T.StringType()), T.StructField("shipping_city", T.StringType()),
    T.StructField("load_date", T.DateType()),
])


# What each converted column of an order must convert to, and whether it may be missing (K-9).
SIMPLE_ORDER_TYPES = {"order_id": "bigint", "customer_id": "bigint", "total_amount": "decimal(12,2)"}


def simple_order_rows(orders: DataFrame, load_date: str, product_id: Column | None = None) -> DataFrame:
    """B-9 / P-12 / P-15 / P-19: fact_orders_simple rows of one load; missing
    order_date -> load date, customer_id 0 when the column is absent, product
    id 1 (parity) unless given. Values must have passed ``tolerant_load`` with
    SIMPLE_ORDER_TYPES: one that does not convert would be NULL here."""
    run = F.lit(load_date).cast("date")
    cols = orders.columns

    def get(c, kind, default):
        return F.col(c).try_cast(kind) if c in cols else F.lit(default).cast(kind)
    return orders.select(
        get("order_id", "long", None).alias("order_id"), get("customer_id", "long", 0).alias("customer_id"),
        (product_id if product_id is not None else F.lit(1)).cast("long").alias("product_id"),
        F.coalesce(to_date("order_date"), run).alias("order_date"),
        get("total_amount", "decimal(12,2)", 0).alias("total_amount"),
        get("status", "string", "Pending").alias("status"),
        get("payment_method", "string", NOT_GIVEN).alias("payment_method"),
        get("shipping_city", "string", NOT_GIVEN).alias("shipping_city"), run.alias("load_date"))
