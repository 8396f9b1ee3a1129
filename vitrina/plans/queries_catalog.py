"""Registered queries over indexed tables under one commit log: loads are
written to a fresh catalog in the shared checkpoint folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators import dims, facts, merge, state, uniqueness
from vitrina.operators.catalog import Catalog
from vitrina.operators.scd2 import PRODUCTS
from vitrina.plans.pipelines import Sources, commit_warehouse
from vitrina.plans.queries import LOOKBACK_DAYS, RUN_DATE, register
from vitrina.plans.queries_dw import SCD_RUN_1, SCD_RUN_2, customer_batches, customer_dimension, fact_orders_frame, product_dimension
from vitrina.session import cut_lineage, scratch_path
from vitrina.sources import standins as st
from vitrina.sources.tables import read_table

#: Files of the order table that the upsert meets, at least.
FILES = 64


@register("upsert_by_files")
def q_upsert_by_files(spark, d):
    """K-2 / K-11 on files: the table has all orders but the newest 0.5 %, the
    batch is the newest 1 % with another status; files without a key of the
    batch stay as they are."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                                              F.col("o_totalprice").alias("total"))
    top = F.lit(o.agg(F.max("order_id")).first()[0]).cast("long")
    now = F.lit(f"{RUN_DATE} 09:00:00").cast("timestamp_ntz")
    table = (o.where(F.col("order_id") * 1000 <= top * 995)
             .select("*", F.lit("first").alias("note"), F.lit(None).cast("timestamp_ntz").alias("updated_at")))
    batch = o.where(F.col("order_id") * 100 > top * 99).select("order_id", F.lower("status").alias("status"), (F.col("total") * 2).alias("total"),
                                                              F.lit("second").alias("note"))
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    tx = catalog.begin()
    tx.replace("orders", table, "order_id", files=FILES)
    tx.commit()
    tx = catalog.begin()
    tx.upsert("orders", batch, ["status", "total"], touch={"updated_at": now})
    tx.commit()
    return catalog.read("orders")


@register("scd2_by_buckets")
def q_scd2_by_buckets(spark, d):
    """K-5 on files: the customer dimension after two loads, current rows in buckets."""
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    for batch, run in zip(customer_batches(spark, d), (SCD_RUN_1, SCD_RUN_2)):
        tx = catalog.begin()
        tx.merge_dimension("dim_customers", batch, run, ["seq"], buckets=16)
        tx.commit()
    return catalog.begin().dimension("dim_customers")


@register("fact_orders_merged")
def q_fact_orders_merged(spark, d):
    """J-3 by a sorted merge: the rows of fact_orders, bound without pairing a
    fact with all versions of its key."""
    dim_c, _ = customer_dimension(spark, d)
    lines = facts.order_lines(st.orders(spark, d, with_city=True), st.order_items(spark, d), st.products(spark, d))
    return facts.fact_orders(lines, dim_c, product_dimension(spark, d), dims.order_status_seed(spark), RUN_DATE, bind=facts.asof_merge)[0]


@register("warehouse_commit")
def q_warehouse_commit(spark, d):
    """K-10: dimensions, facts and metrics of a load in one commit; the rows of each table."""
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    orders = st.orders(spark, d, with_city=True)
    commit_warehouse(catalog, Sources(customers=st.customers(spark, d), products=st.products(spark, d), orders=orders,
                                      order_items=st.order_items(spark, d), payments=st.payments(spark, d, with_order=True)),
                     SCD_RUN_1, buckets=16)
    names = sorted(catalog.head().tables)
    counts = [catalog.read(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n in names]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("insert_defaults")
def q_insert_defaults(spark, d):
    """K-7 / K-12: an insert that names some columns; the others, and nulls,
    take the table's defaults."""
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("status", T.StringType()),
                           T.StructField("payment_method", T.StringType()), T.StructField("quantity", T.IntegerType()),
                           T.StructField("source_system", T.StringType()), T.StructField("load_date", T.DateType()),
                           T.StructField("comment", T.StringType())])
    rows = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    return merge.conform(rows, schema, {"status": "Pending", "quantity": 1, "source_system": "postgres_source",
                                        "load_date": F.lit(RUN_DATE).cast("date")})


@register("daily_sales_by_load")
def q_daily_sales_by_load(spark, d):
    """V-3 / A-12 kept by load: the facts come in two loads that share dates,
    orders and customers, the second is run twice; only its dates are computed again."""
    f = cut_lineage(fact_orders_frame(spark, d)[0].select(*state.SALES_FACTS))  # the joins move these columns alone
    late = F.coalesce((F.col("date_key") >= 19980101) | (F.col("quantity") > 45), F.lit(False))
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    for load, rows in (("first", f.where(~late)), ("second", f.where(late & (F.col("quantity") > 10))), ("second", f.where(late))):
        tx = catalog.begin()
        state.record_sales(tx, load, rows)
        tx.commit()
    return state.daily_sales(catalog.begin(), dims.dim_date_between(read_table(spark, d, "orders"), "o_orderdate"))


@register("declared_kpis_by_state")
def q_declared_kpis_by_state(spark, d):
    """D-1 ... D-8 of a look-back window: earlier orders are known by the kept
    first order of each customer alone."""
    o = st.orders(spark, d, with_city=True)
    recent = F.col("order_date") >= F.date_sub(F.lit(RUN_DATE).cast("date"), LOOKBACK_DAYS)
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    tx = catalog.begin()
    state.record_first_orders(tx, o.where(~recent))
    tx.commit()
    return state.daily_declared_kpis(catalog.begin(), o.where(recent), st.order_items(spark, d), st.products(spark, d))


@register("duplicates_across_loads")
def q_duplicates_across_loads(spark, d):
    """Q-4 against history: order keys come in four loads that overlap, the
    last names some orders several times; the clashes of each load."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"))
    li = read_table(spark, d, "lineitem")
    top = F.lit(o.agg(F.max("order_id")).first()[0]).cast("long")
    loads = {"a": o.where(F.col("order_id") * 10 <= top * 6), "b": o.where(F.col("order_id") * 100 > top * 55),
             "c": li.where("l_quantity = 50").select(F.col("l_orderkey").alias("order_id")),
             "d": li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).select(F.col("l_orderkey").alias("order_id"))}
    catalog = Catalog(spark, scratch_path(spark, "catalog"))
    out = []
    for load, rows in loads.items():
        tx = catalog.begin()
        clashes, _ = uniqueness.check_load(tx, load, rows, "order_id")
        tx.commit()
        out.append(clashes.select(F.lit(load).alias("load"), "*"))
    return reduce(DataFrame.unionByName, out)
