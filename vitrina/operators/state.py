"""State kept between daily loads, so that a load reads itself and the state, not all history (D-3, V-3, A-12).

Both states are tables of a catalog and change in the transaction of the load
that they follow: all of it is committed, or none.

* First orders: (customer, first date), appended to. A load adds the customers
  that it sees first and those whose earlier orders come late; the smallest
  date counts.
* Daily sales: a row per (date, order, customer, load) with its sums, in files
  of one month and one load. Rows of several loads merge without loss -- also the
  distinct counts -- so a load computes its own dates again and no others, and a
  load that is run again replaces its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrina.operators.catalog import _BUCKET, FILE_ROWS, Transaction
from vitrina.operators.kpi import MONEY_SUM, declared_kpis
from vitrina.session import cut_lineage

#: Files of the first orders beyond which they are written anew, sorted, one row a customer.
MANY_FILES = 256


def first_orders(tx: Transaction, name: str = "first_orders") -> DataFrame:
    """(customer_id, first_date) of all loads so far."""
    return tx.read(name).groupBy("customer_id").agg(F.min("first_date").alias("first_date"))


def record_first_orders(tx: Transaction, orders: DataFrame, name: str = "first_orders") -> int:
    """Fold the orders of a load into the state; the customers added or moved to an earlier date. The same orders again
    add none. Orders without a customer or a date are no one's first."""
    new = (orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
           .groupBy("customer_id").agg(F.min("order_date").alias("first_date")))
    there = tx.entry(name) is not None
    if there:
        known = first_orders(tx, name).withColumnRenamed("first_date", "_known")
        new = (new.join(known, "customer_id", "left")
               .where(F.col("_known").isNull() | (F.col("first_date") < F.col("_known"))).drop("_known"))
    new = cut_lineage(new)
    n = new.count()
    if n or not there:
        tx.append(name, new.repartitionByRange(max(1, -(-n // FILE_ROWS)), "customer_id"), "customer_id")
    if tx.index(name).count() > MANY_FILES:
        tx.replace(name, first_orders(tx, name), "customer_id")
    return n


def daily_declared_kpis(tx: Transaction, orders: DataFrame, items: DataFrame, products: DataFrame,
                        name: str = "first_orders") -> DataFrame:
    """D-1 ... D-8 for the dates of a load, which must be there whole: new and returning customers are told by the state,
    which the load's orders are folded into first."""
    record_first_orders(tx, orders, name)
    return declared_kpis(orders, items, products, first_orders(tx, name))


# ------------------------------------------------------------------ daily sales
#: Columns of the order facts that ``record_sales`` reads.
SALES_FACTS = ["date_key", "order_id", "customer_id", "quantity", "total_amount"]
SALES_PARTS = T.StructType([
    T.StructField("date_key", T.IntegerType()), T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()), T.StructField("items", T.LongType()),
    T.StructField("amount", T.DecimalType(22, 2)), T.StructField("amounts", T.LongType()), T.StructField("load", T.StringType())])


def record_sales(tx: Transaction, load: str, facts: DataFrame, name: str = "daily_sales") -> list[int]:
    """Fold the order facts of a load (its id: the load date, say) into the state; the date keys computed again.

    Facts without a date key are in no date. Files of a month that neither this load nor its earlier run has facts of are
    not read, and of the others only the dates in question. The table ``name`` has a row a date, as many as the calendar has days.
    """
    part = (facts.where(F.col("date_key").isNotNull()).groupBy("date_key", "order_id", "customer_id")
            .agg(F.sum(F.col("quantity").cast("long")).alias("items"),
                 F.sum(F.col("total_amount").cast("decimal(12,2)")).alias("amount"),
                 F.count("total_amount").alias("amounts"))
            .withColumn("load", F.lit(load)))
    month = (F.col("date_key") / 100).cast("int")
    part = part.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SALES_PARTS], month.alias(_BUCKET))
    parts = f"{name}_parts"
    # ranges, not a hash of the month: a date with a third of the load is spread over files
    new = cut_lineage(tx._write(part.repartitionByRange("date_key", "order_id", "customer_id"), parts, ["load"], [_BUCKET])[1])
    concerned = [r[0] for r in new.select("file").collect()]
    if tx.entry(parts) is not None:
        index = tx.index(parts)
        own = F.col("lo")["load"] == load
        concerned += [r[0] for r in index.where(own).select("file").collect()]
        new = index.where(~own).unionByName(new)
    tx.stage(parts, new, SALES_PARTS, ["load"])
    dates = sorted(r[0] for r in tx._rows(concerned, SALES_PARTS).select("date_key").distinct().collect())  # of the calendar
    months = sorted({x // 100 for x in dates})
    files = [r[0] for r in tx.index(parts).where(F.col("bucket").isin(months)).select("file").collect()] if dates else []
    found = tx._rows(files, SALES_PARTS)
    rows = ((found.where(F.col("date_key").isin(dates)) if dates else found).groupBy("date_key")
            .agg(F.countDistinct("order_id").alias("total_orders"), F.countDistinct("customer_id").alias("unique_customers"),
                 F.sum("items").alias("total_items"), F.sum("amount").cast(MONEY_SUM).alias("total_revenue"),
                 F.sum("amounts").alias("amounts")))
    if tx.entry(name) is not None:
        old = tx.read(name)
        rows = (old.where(~F.col("date_key").isin(dates)) if dates else old).unionByName(rows)
    tx.replace(name, rows, "date_key", files=1)
    return dates


def daily_sales(tx: Transaction, dim_date: DataFrame, name: str = "daily_sales") -> DataFrame:
    """V-3 from the state: the rows of ``views.daily_sales`` over the facts of all loads."""
    mean = F.try_divide(F.col("total_revenue").cast("double"), F.col("amounts").cast("double"))
    return (tx.read(name).join(dim_date.select("date_key", "full_date"), "date_key")
            .select("full_date", "total_orders", "unique_customers", "total_items", "total_revenue", mean.alias("avg_order_value")))
