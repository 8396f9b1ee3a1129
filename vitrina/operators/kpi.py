"""Business indicators and simple statistics (A-1 ... A-11, D-1 ... D-8).

Every indicator is a chain of partial+final hash aggregates, combined
map-side: orders are first reduced per (date, customer) and per (date, city),
items per (date, product), so a hot date, city or product is spread over the
second key and reduced before it meets; only reduced rows go on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrina.operators.clean import NOT_GIVEN

# Fallback top city of each run when no city is known.
FINAL_TOP_CITY_FALLBACK = "Москва"
SIMPLE_TOP_CITY_FALLBACK = NOT_GIVEN

MONEY = "decimal(12,2)"
MONEY_SUM = "decimal(22,2)"


def money_sum(c) -> Column:
    """Exact sum of amounts as decimal(22,2)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(MONEY)).cast(MONEY_SUM)


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is 0 (ANSI would raise)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def _most_frequent(rows: DataFrame, by: list[str], value: str, n: str = "_c") -> DataFrame:
    """Per ``by`` the value with the greatest count, ties to the smallest value
    (A-3). ``rows``: counts per (by, value); NULL values are left out."""
    pick = F.min_by(value, F.struct(-F.col(n), F.col(value))).alias("_top")
    rows = rows.where(F.col(value).isNotNull())
    return rows.groupBy(*by).agg(pick) if by else rows.agg(pick)


def _per_customer(orders: DataFrame, *by: Column) -> DataFrame:
    """Orders reduced per (by, customer): rows, sum of amounts, amounts."""
    amount = F.col("total_amount").cast(MONEY)
    return orders.groupBy(*by, "customer_id").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_s"),
                                                  F.count(amount).alias("_a"))


def _totals(variant: str = "simple") -> list[Column]:
    """Measures over rows of ``_per_customer``. A window whose amounts are all
    missing has revenue 0; the final run divides by all rows, the simple one
    by those with an amount."""
    revenue = F.coalesce(F.sum("_s"), F.lit(0).cast(MONEY))
    return [F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_orders"),
            revenue.cast(MONEY_SUM).alias("total_revenue"),
            ratio(revenue, F.sum("_n" if variant == "final" else "_a")).alias("avg_order_value"),
            F.count("customer_id").alias("active_customers")]


def daily_kpis(orders: DataFrame, date_col: str = "order_date",
               city_fallback: str = SIMPLE_TOP_CITY_FALLBACK) -> DataFrame:
    """A-2 per date: total_orders, total_revenue, avg_order_value,
    active_customers, top_city. Orders are reduced per (date, customer) and,
    for the city, per (date, city); both meet per date."""
    date = F.col(date_col).alias("analytics_date")
    out = _per_customer(orders, date).groupBy("analytics_date").agg(*_totals())
    if "shipping_city" not in orders.columns:
        return out.withColumn("top_city", F.lit(city_fallback))
    cities = orders.groupBy(date, "shipping_city").agg(F.count(F.lit(1)).alias("_c"))
    top = _most_frequent(cities, ["analytics_date"], "shipping_city")
    same = F.col("t.analytics_date").eqNullSafe(F.col("c.analytics_date"))  # orders without a date are one row
    return (out.alias("t").join(top.alias("c"), same, "left")
            .select("t.*", F.coalesce("_top", F.lit(city_fallback)).alias("top_city")))


def active_customers(orders: DataFrame, dates: DataFrame, lookback_days: int) -> DataFrame:
    """(analytics_date, active_customers) of ``dates`` (one column, distinct):
    customers with an order in the ``lookback_days`` + 1 days up to the date.
    ``orders``: (_d, customer_id).

    An interval sweep: a customer is active from an order date until the look-
    back has passed; dates that follow within it go on with the same interval.
    An interval's start counts +1 and the day after its end -1, so a customer's
    order dates are never copied to run dates. Events are summed per date,
    combined map-side, and their running sum over the calendar (a row a date)
    is the number of active customers.
    """
    w = Window.partitionBy("customer_id").orderBy("_d")  # at most a row a date
    once = orders.where("_d is not null and customer_id is not null").select(F.col("_d").cast("date").alias("_d"), "customer_id").distinct()
    after = lookback_days + 1
    starts = F.coalesce(F.datediff("_d", F.lag("_d").over(w)) > after, F.lit(True)).cast("int")
    ends = F.coalesce(F.datediff(F.lead("_d").over(w), "_d") > after, F.lit(True)).cast("int")
    # per date first: how many intervals start, and how many end with it
    by_date = once.select("_d", starts.alias("s"), ends.alias("e")).groupBy("_d").agg(F.sum("s").alias("s"), F.sum("e").alias("e"))
    events = (by_date.select(F.col("_d").alias("day"), F.col("s").alias("n"))
              .unionByName(by_date.select(F.date_add("_d", after).alias("day"), (-F.col("e")).alias("n")))
              .select(F.col("day").alias("analytics_date"), "n", F.lit(False).alias("_asked")))
    days = dates.select(F.col("analytics_date").cast("date").alias("analytics_date"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("_asked"))
    calendar = events.unionByName(days).groupBy("analytics_date").agg(F.sum("n").alias("n"), F.bool_or("_asked").alias("_asked"))
    running = F.sum("n").over(Window.orderBy("analytics_date").rowsBetween(Window.unboundedPreceding, 0))
    return (calendar.where("analytics_date is not null").withColumn("active_customers", running).where("_asked")
            .select("analytics_date", "active_customers"))


def rolling_kpis(orders: DataFrame, lookback_days: int = 7, date_col: str = "order_date",
                 city_fallback: str = FINAL_TOP_CITY_FALLBACK) -> DataFrame:
    """A-1 for every run date: the final run reports, on run date R, all
    orders with order_date >= R - lookback (nothing later exists yet), as one
    row keyed by R; avg_order_value divides by all rows of the window.

    Orders are first reduced per order date (totals) and per (date, city)
    (counts); only these reduced rows are replicated to the lookback+1 run
    dates that see them, then summed per run date. Customers are counted by
    ``active_customers``, without copies. The three results are one row per
    run date and joined on it.
    """
    d = F.col(date_col)
    runs = F.explode(F.sequence(d, F.date_add(d, lookback_days))).alias("analytics_date")
    totals = (orders.groupBy(d.alias("_d"))
              .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("total_amount").cast(MONEY)).alias("_s"))
              .select(F.explode(F.sequence(F.col("_d"), F.date_add("_d", lookback_days))).alias("analytics_date"),
                      "_n", "_s")
              .groupBy("analytics_date")
              .agg(F.sum("_n").alias("total_orders"),
                   F.coalesce(F.sum("_s"), F.lit(0)).cast(MONEY_SUM).alias("total_revenue"),
                   ratio(F.coalesce(F.sum("_s"), F.lit(0)), F.sum("_n")).alias("avg_order_value")))
    customers = active_customers(orders.select(d.alias("_d"), "customer_id"), totals.select("analytics_date"), lookback_days)
    out = totals.join(customers, "analytics_date", "left")
    if "shipping_city" in orders.columns:
        cities = (orders.groupBy(d, "shipping_city").agg(F.count(F.lit(1)).alias("_c"))
                  .select(runs, "shipping_city", "_c")
                  .groupBy("analytics_date", "shipping_city").agg(F.sum("_c").alias("_c")))
        cities = _most_frequent(cities, ["analytics_date"], "shipping_city")
        out = out.join(cities, "analytics_date", "left")
        top = F.coalesce(F.col("_top"), F.lit(city_fallback))
    else:
        top = F.lit(city_fallback)
    return out.select("analytics_date", "total_orders", "total_revenue", "avg_order_value",
                      F.coalesce("active_customers", F.lit(0).cast("long")).alias("active_customers"),
                      top.alias("top_city"))


def run_kpis(orders: DataFrame, ratings: DataFrame | None, run_date: str, lookback_days: int = 7,
             variant: str = "simple") -> DataFrame:
    """One KPI row for one run (A-1 / A-2, D-8 complaint_count = ratings <= 2)
    over the orders of the look-back window and the ratings of the run. Three
    one-row aggregates, put together by a last one."""
    lo = F.date_sub(F.lit(run_date).cast("date"), lookback_days)
    o = orders.where(F.col("order_date") >= lo)
    for c in ("customer_id", "total_amount", "shipping_city"):
        if c not in o.columns:
            o = o.withColumn(c, F.lit(None).cast("string"))
    parts = [_per_customer(o).agg(*_totals(variant)),
             _most_frequent(o.groupBy("shipping_city").agg(F.count(F.lit(1)).alias("_c")), [], "shipping_city")]
    if ratings is not None:
        r = F.col("rating").cast("double")
        parts.append(ratings.agg(F.avg(r).alias("_rating"), F.count_if(r <= 2).alias("_complaints")))
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    u = u.agg(*[F.max(c).alias(c) for c in u.columns])
    fallback = FINAL_TOP_CITY_FALLBACK if variant == "final" else SIMPLE_TOP_CITY_FALLBACK
    rating, complaints = (F.col("_rating"), F.col("_complaints")) if ratings is not None else (F.lit(None), F.lit(None))
    average = F.col("avg_order_value")
    out = u.select(F.lit(run_date).cast("date").alias("analytics_date"), "total_orders", "total_revenue",
                   (F.coalesce(average, F.lit(0.0)) if variant == "final" else average).alias("avg_order_value"),
                   "active_customers", F.coalesce("_top", F.lit(fallback)).alias("top_city"),
                   F.coalesce(rating.cast("double"), F.lit(0.0)).alias("avg_customer_rating"),
                   F.coalesce(complaints.cast("long"), F.lit(0).cast("long")).alias("complaint_count"))
    if variant == "simple":
        # The simple run writes no row when the window holds no order.
        out = out.where(F.col("total_orders") > 0)
    return out


def top_by_count(df: DataFrame, col: str, k: int) -> DataFrame:
    """A-5 / T-3: the k most frequent values, ties by value."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(k))


def product_stats(df: DataFrame, stock="stock_quantity", price="unit_price",
                  category="category", supplier="supplier") -> DataFrame:
    """A-4: one row - total_products, total_stock, avg_price (0 when empty),
    categories_count, suppliers_count. NULLs skipped."""
    return df.agg(F.count(F.lit(1)).alias("total_products"),
                  F.sum(F.col(stock).cast("long")).alias("total_stock"),
                  F.coalesce(ratio(F.sum(F.col(price).cast(MONEY)), F.count(price)), F.lit(0.0)).alias("avg_price"),
                  F.countDistinct(category).alias("categories_count"),
                  F.countDistinct(supplier).alias("suppliers_count"))


def table_counts(tables: dict[str, DataFrame | Callable[[], DataFrame]]) -> DataFrame:
    """A-6: one row per table (table_name, row_count) plus a 'TOTAL' row.

    A table may be given as a function that reads it; one that can't be read
    (no such path or table) is left out, as the total leaves it out. Each count
    is a map-side partial count; the union is of one-row frames.
    """
    found = {}
    for name, table in tables.items():
        try:
            found[name] = table() if callable(table) else table
        except AnalysisException:
            continue
    rows = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in found.items()]
    if not rows:
        raise ValueError(f"none of the tables can be read: {', '.join(tables)}")
    u = reduce(DataFrame.unionByName, rows)
    total = u.agg(F.sum("row_count").cast("long").alias("row_count")).select(F.lit("TOTAL").alias("table_name"),
                                                                            "row_count")
    return u.unionByName(total)


def rating_stats(df: DataFrame, rating: str = "rating") -> DataFrame:
    """A-7 (avg over all, NULL -> 0) and A-8 (avg ignoring 0 and missing)."""
    r = F.col(rating).cast("double")
    return df.agg(F.count(F.lit(1)).alias("feedback_count"),
                  F.coalesce(F.avg(r), F.lit(0.0)).alias("avg_rating"),
                  F.coalesce(F.avg(F.when(r != 0, r)), F.lit(0.0)).alias("avg_nonzero_rating"))


def rating_histogram(spark: SparkSession, df: DataFrame, rating: str = "rating") -> DataFrame:
    """A-9: count per rating 1..5 including empty buckets; others not shown.
    The counts are aggregated first (at most 5 rows) and then laid over the
    5 buckets."""
    counts = (df.where(F.col(rating).isin(1, 2, 3, 4, 5))
              .groupBy(F.col(rating).cast("int").alias("rating")).agg(F.count(F.lit(1)).alias("n")))
    buckets = spark.range(1, 6).select(F.col("id").cast("int").alias("rating"))
    return (buckets.join(F.broadcast(counts), "rating", "left")
            .select("rating", F.coalesce("n", F.lit(0).cast("long")).alias("feedback_count")))


def missing_cells(df: DataFrame) -> DataFrame:
    """A-10: missing cells per column and in total, one row, one pass."""
    per = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in df.columns]
    total = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0).cast("long"))
    return df.agg(*per, total.cast("long").alias("missing_total"))


def declared_kpis(orders: DataFrame, items: DataFrame, products: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """D-1 ... D-8 per order date (definitions are ours; the reference only
    declares the columns).

    * new_orders / cancelled_orders: status Pending / Cancelled.
    * total_cost = sum(quantity * cost_price), total_profit = item revenue -
      cost, profit_margin = profit / item revenue * 100 (2 d.p.).
    * new_customers: first order on the date; returning = active - new. First
      dates come from ``firsts`` (customer_id, first_date; ``state.first_orders``),
      without it from ``orders``, which must then be all orders.
    * top product / category by item revenue (ties by id / name), maps of
      orders per city and revenue per category as JSON.
    * delivery_success_rate = delivered / (delivered + cancelled + refunded).

    Items are reduced per (date, product) once; money, top product, categories
    and their map all come from that. Orders are reduced per (date, customer)
    and per (date, city). An item without its order has no date and is left to
    the rejected rows of the facts; one without its product counts for revenue
    under the category NOT_GIVEN at no cost.
    """
    o = orders.select("order_id", "customer_id", "order_date", "status", "shipping_city")
    rollup = (items.select("order_id", "product_id", "quantity", "total_price")
              .join(o.select("order_id", "order_date"), "order_id")
              .groupBy("order_date", "product_id")
              .agg(F.sum("quantity").alias("_q"), money_sum("total_price").alias("rev")))
    rollup = (rollup.join(products.select("product_id", "product_name", "category", "cost_price"), "product_id", "left")
              .withColumn("cost", F.coalesce((F.col("_q") * F.col("cost_price")), F.lit(0)).cast(MONEY_SUM))
              .withColumn("category", F.coalesce("category", F.lit(NOT_GIVEN))))
    best = F.struct(F.col("rev"), -F.col("product_id"))
    sold = (rollup.groupBy("order_date", "category")
            .agg(F.sum("rev").cast(MONEY_SUM).alias("rev"), F.sum("cost").cast(MONEY_SUM).alias("cost"),
                 F.max_by(F.struct("product_id", "product_name", "rev"), best).alias("_p"))
            .groupBy("order_date")
            .agg(F.sum("rev").cast(MONEY_SUM).alias("_rev"), F.sum("cost").cast(MONEY_SUM).alias("total_cost"),
                 F.max_by("_p", F.struct(F.col("_p.rev"), -F.col("_p.product_id"))).alias("_p"),
                 F.min_by("category", F.struct(-F.col("rev"), F.col("category"))).alias("top_category"),
                 F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
                     F.col("category"), F.col("rev").cast("string")))))).alias("revenue_by_category")))

    per_customer = o.groupBy("order_date", "customer_id").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col("status").isin(*which)).alias(name) for name, which in
          (("_new", ["Pending"]), ("_cancelled", ["Cancelled"]), ("_delivered", ["Delivered"]),
           ("_closed", ["Delivered", "Cancelled", "Refunded"]))])
    if firsts is None:  # a customer's window has one row a date
        first = F.min("order_date").over(Window.partitionBy("customer_id")) == F.col("order_date")
    else:
        per_customer = per_customer.join(firsts.select("customer_id", "first_date"), "customer_id", "left")
        first = F.coalesce(F.col("first_date") == F.col("order_date"), F.lit(False))
    base = (per_customer.withColumn("_first", F.col("customer_id").isNotNull() & first)
            .groupBy("order_date")
            .agg(F.sum("_n").alias("total_orders"), F.sum("_new").alias("new_orders"),
                 F.sum("_cancelled").alias("cancelled_orders"), F.count("customer_id").alias("active_customers"),
                 F.count_if("_first").alias("new_customers"), F.sum("_delivered").alias("_delivered"),
                 F.sum("_closed").alias("_closed")))
    city = (o.groupBy("order_date", F.coalesce("shipping_city", F.lit(NOT_GIVEN)).alias("shipping_city"))
            .agg(F.count(F.lit(1)).alias("n")).groupBy("order_date")
            .agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("shipping_city", "n")))))
                 .alias("orders_by_city")))
    out = base.join(city, "order_date", "left").join(sold, "order_date", "left")
    profit = (F.col("_rev") - F.col("total_cost")).cast(MONEY_SUM)
    return out.select(
        F.col("order_date").alias("analytics_date"), "total_orders", "new_orders", "cancelled_orders",
        F.coalesce("total_cost", F.lit(0).cast(MONEY_SUM)).alias("total_cost"),
        F.coalesce(profit, F.lit(0).cast(MONEY_SUM)).alias("total_profit"),
        F.round(F.try_divide(profit.cast("double"), F.col("_rev").cast("double")) * 100, 2).alias("profit_margin"),
        "active_customers",
        "new_customers", (F.col("active_customers") - F.col("new_customers")).alias("returning_customers"),
        F.col("_p.product_id").alias("top_product_id"), F.col("_p.product_name").alias("top_product_name"),
        F.col("_p.rev").alias("top_product_revenue"),
        "orders_by_city", "top_category", "revenue_by_category",
        F.lit(None).cast("decimal(5,2)").alias("avg_delivery_time_hours"),
        F.round(F.try_divide(F.col("_delivered").cast("double"), F.col("_closed").cast("double")) * 100, 2)
        .alias("delivery_success_rate"))
