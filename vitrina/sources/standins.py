"""The shop's source tables, derived from the driver tables.

customer -> customers, part -> products, orders -> orders, lineitem ->
order_items, events (purchase) -> payments, documents + labels -> feedback.
Every derivation is a projection or a join on a key; the bounded lookup
tables (nation, region) are broadcast, everything else is left to Catalyst
and AQE (they broadcast by measured size, or sort-merge join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.functions.keys import seconds_to_hms
from vitrina.sources.tables import read_table


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> (city, country). 25 rows by definition: safe to broadcast."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
                       .select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("country")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean customers: customer_id, first_name, last_name, email, phone, city,
    country, customer_segment."""
    c = read_table(spark, sf_dir, "customer")
    first = F.split_part(c.c_name, F.lit("#"), F.lit(1))
    last = F.split_part(c.c_name, F.lit("#"), F.lit(2))
    return (c.join(_geo(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left")
            .select(c.c_custkey.alias("customer_id"),
                    first.alias("first_name"),
                    last.alias("last_name"),
                    F.concat(F.lower(first), F.lit("."), last, F.lit("@example.com")).alias("email"),
                    F.concat(F.lit("+7"), F.lpad(c.c_custkey.cast("string"), 10, "0")).alias("phone"),
                    "city", "country",
                    c.c_mktsegment.alias("customer_segment")))


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an operational source delivers them: padded, mixed-case
    names and e-mails, missing city / country / segment."""
    c = read_table(spark, sf_dir, "customer")
    g = _geo(spark, sf_dir)
    j = c.join(g, c.c_nationkey == g.n_nationkey, "left")
    seg, city = F.col("c_mktsegment"), F.col("city")
    first = (F.when(F.col("c_acctbal") < 0,
                    F.concat(F.lit("\t"), F.lower(seg), F.lit("'"), F.lower(city), F.lit(" ")))
              .otherwise(F.concat(F.lit(" "), F.upper(seg), F.lit("-"), F.lower(city), F.lit(" "))))
    email = F.concat(F.lit(" "), F.upper(F.split_part("c_name", F.lit("#"), F.lit(1))), F.lit("."),
                     F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit("@Example.COM"), F.lit("\t"))
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        first.alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        email.alias("email"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string")).otherwise(city).alias("city"),
        F.when(seg == "AUTOMOBILE", F.lit(None).cast("string")).otherwise(F.col("country")).alias("country"),
        F.when(F.col("c_acctbal") > 9000, F.lit(None).cast("string")).otherwise(seg).alias("customer_segment"),
    )


def order_status() -> F.Column:
    """Shop status from (o_orderstatus, o_orderpriority)."""
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (F.when((st == "F") & (pr == "1-URGENT"), "Refunded")
             .when(st == "F", "Delivered")
             .when((st == "P") & (pr == "5-LOW"), "Cancelled")
             .when(st == "P", "Shipped")
             .otherwise("Pending"))


def orders(spark: SparkSession, sf_dir: str, with_city: bool = False) -> DataFrame:
    """order_id, customer_id, order_date, order_time ('HH:mm:ss'), total_amount
    decimal(12,2), status, payment_method [, shipping_city, shipping_country].
    An order whose customer or nation is missing stays, without a city."""
    o = read_table(spark, sf_dir, "orders")
    cols = [o.o_orderkey.alias("order_id"),
            o.o_custkey.alias("customer_id"),
            o.o_orderdate.cast("date").alias("order_date"),
            seconds_to_hms((o.o_orderkey * 7919) % 86400).alias("order_time"),
            o.o_totalprice.cast("decimal(12,2)").alias("total_amount"),
            order_status().alias("status"),
            o.o_orderpriority.alias("payment_method")]
    if not with_city:
        return o.select(*cols)
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    g = _geo(spark, sf_dir)
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
             .join(g, F.col("c_nationkey") == g.n_nationkey, "left")
             .select(*cols, F.col("city").alias("shipping_city"), F.col("country").alias("shipping_country")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(p.p_partkey.alias("product_id"),
                    p.p_name.alias("product_name"),
                    p.p_type.alias("category"),
                    p.p_brand.alias("brand"),
                    p.p_retailprice.cast("decimal(10,2)").alias("unit_price"),
                    (F.floor(p.p_retailprice * 60) / 100).cast("decimal(10,2)").alias("cost_price"),
                    p.p_size.alias("stock_quantity"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(li.l_orderkey.alias("order_id"),
                     li.l_partkey.alias("product_id"),
                     li.l_linenumber.alias("line_number"),
                     li.l_quantity.cast("int").alias("quantity"),
                     li.l_extendedprice.cast("decimal(12,2)").alias("total_price"),
                     li.l_shipdate.cast("date").alias("ship_date"))


def payments(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    """Payments are the purchase events, by definition of this stand-in; other
    events are not payments. ``with_order``: the customer's latest order, NULL
    for a customer without one."""
    e = read_table(spark, sf_dir, "events")
    p = (e.where(e.event_type == "purchase")
             .select(e.event_id.alias("payment_id"),
                     e.user_id.alias("customer_id"),
                     e.ts.alias("payment_ts"),
                     e.value.cast("decimal(12,2)").alias("payment_amount"),
                     F.lit("card").alias("payment_method"),
                     F.lit("Completed").alias("payment_status")))
    if not with_order:
        return p
    last = (read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("order_id")))
    return p.join(last, "customer_id", "left")


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents (+ labels) as feedback documents: doc_id, comment, raw rating
    text (unparseable 'x' for toxic ones, missing when unlabelled)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    rating = (F.when(lab.toxic.isNull(), F.lit(None).cast("string"))
               .when(lab.toxic == 1, F.lit("x"))
               .otherwise((d.n_chars % 8).cast("string")))
    return j.select("doc_id", F.col("text").alias("comment"), rating.alias("rating_raw"))
