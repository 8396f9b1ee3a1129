"""State kept between loads against recomputation from all rows."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from vitrina.operators import facts as facts_ops
from vitrina.operators import dims, kpi, scd2, state, views
from vitrina.operators.catalog import Catalog
from vitrina.plans import queries_catalog
from vitrina.session import cut_lineage

FACT = "date_key int, order_id long, customer_id long, quantity int, total_amount decimal(12,2)"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, f"{tmp_path}/state")


def facts(spark, seed, days, n=300):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.03 else 20240100 + (days[0] if rng.random() < 0.4 else rng.choice(days))
    return spark.createDataFrame([(day(), rng.randint(1, 60), rng.choice([None, *range(20)]), rng.choice([None, 1, 2]),
                                   rng.choice([None, 5, 7])) for _ in range(n)],
                                 "date_key int, order_id long, customer_id long, quantity int, a int").select(
        "date_key", "order_id", "customer_id", "quantity", (F.col("a") * F.lit(1.25)).cast("decimal(12,2)").alias("total_amount"))


def test_daily_sales_by_load(spark, catalog):
    dd = spark.createDataFrame([(20240100 + i, dt.date(2024, 1, i)) for i in range(1, 20)], "date_key int, full_date date")
    first, second, again = facts(spark, 1, range(1, 11)), facts(spark, 2, range(9, 14)), facts(spark, 3, range(10, 13))

    def load(name, f):
        tx = catalog.begin()
        dates = state.record_sales(tx, name, f)
        tx.commit()
        return dates

    def same(*loads):
        all_facts = loads[0]
        for f in loads[1:]:
            all_facts = all_facts.unionByName(f)
        assert rows(state.daily_sales(catalog.begin(), dd)) == rows(views.daily_sales(all_facts, dd))

    load("a", first)
    same(first)
    before = set(catalog.files("daily_sales_parts"))
    assert set(load("b", second)) <= {20240100 + i for i in range(9, 14)}
    same(first, second)
    assert before < set(catalog.files("daily_sales_parts"))  # no file of an earlier load is touched
    load("b", again)  # run again with other rows: dates 9 and 13 lose theirs
    same(first, again)
    assert before < set(catalog.files("daily_sales_parts"))
    load("b", again.limit(0))
    same(first)
    tx = catalog.begin()  # not committed: nothing changes
    state.record_sales(tx, "c", second)
    same(first)
    assert load("none", first.limit(0)) == []
    same(first)


def test_query_keeps_the_columns_of_the_state_alone(spark, monkeypatch):
    mine = facts(spark, 5, range(1, 11)).withColumn("quantity", F.col("quantity") * 23).cache()
    kept = []
    monkeypatch.setattr(queries_catalog, "fact_orders_frame", lambda *_: (mine.withColumn("payment_method", F.lit("x" * 200)), None))
    monkeypatch.setattr(queries_catalog, "read_table", lambda *_: spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-10')) o_orderdate"))
    monkeypatch.setattr(queries_catalog, "cut_lineage", lambda df: kept.append(df.columns) or cut_lineage(df))
    got = queries_catalog.q_daily_sales_by_load(spark, "")
    assert kept == [state.SALES_FACTS]
    dd = dims.dim_date_between(queries_catalog.read_table(), "o_orderdate")
    assert rows(got) == rows(views.daily_sales(mine, dd)) and got.count() == 10


def test_lines_of_an_order_are_summed_before_they_move(spark):
    """Customers are bound last: a customer's lines lie together, so that partial sums by order leave a row an order."""
    n, each = 200, 6
    orders = spark.range(n).select(F.col("id").alias("order_id"), (F.col("id") % 50).alias("customer_id"), F.lit("2024-01-05").cast("date").alias("order_date"),
                                   F.lit("10:00:00").alias("order_time"), F.lit("Pending").alias("status"), F.lit("card").alias("payment_method"))
    items = spark.range(n * each).select((F.col("id") % n).alias("order_id"), (F.col("id") * 7 % 97).alias("product_id"), F.lit(1).alias("quantity"),
                                         F.lit("2.50").cast("decimal(12,2)").alias("total_price"))
    products = spark.range(97).select(F.col("id").alias("product_id"), F.lit("1.00").cast("decimal(10,2)").alias("cost_price"))
    lines = facts_ops.order_lines(orders, items, products)
    dim_c, dim_p = scd2.empty_dim(spark), scd2.empty_dim(spark, scd2.PRODUCTS)
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(held, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        f = facts_ops.fact_orders(lines, dim_c, dim_p, F.broadcast(dims.order_status_seed(spark)), "2024-01-05")[0].select(*state.SALES_FACTS)
        parts = f.withColumn("p", F.spark_partition_id()).groupBy("order_id").agg(F.countDistinct("p").alias("places"), F.count(F.lit(1)).alias("lines"))
        assert rows(parts.select("places", "lines").distinct()) == [(1, each)]
        assert f.count() == n * each and f.agg(F.sum("total_amount")).first()[0] * 2 == n * each * 5
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("write", ["cut", "table"])
def test_writes_leave_no_shuffle_files(spark, catalog, write):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getPath() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    df = spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).agg(F.sum("id").alias("s"))
    if write == "cut":
        out = cut_lineage(df)
    else:
        catalog.begin()._write(df, "t", ["k"])
        out = df
    until = time.time() + 10
    while files() - before and time.time() < until:  # executors remove them on their own time
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert out.count() == df.count() == 1000  # what a frame has left to do, it does again


def test_first_load_without_facts(spark, catalog):
    dd = spark.createDataFrame([(20240101, dt.date(2024, 1, 1))], "date_key int, full_date date")
    tx = catalog.begin()
    assert state.record_sales(tx, "a", facts(spark, 1, [1], 5).limit(0)) == []
    tx.commit()
    assert state.daily_sales(catalog.begin(), dd).count() == 0


def test_first_orders(spark, catalog, monkeypatch):
    rng = random.Random(4)
    start = dt.date(2024, 1, 1)
    made = [(i, rng.choice([None, *range(30)]), None if rng.random() < 0.02 else start + dt.timedelta(rng.randint(0, 29)), "Pending", "X")
            for i in range(200)]
    schema = "order_id long, customer_id long, order_date date, status string, shipping_city string"
    o = spark.createDataFrame(made, schema)
    items = spark.createDataFrame([(i, 1, 1, 2) for i in range(200)], "order_id long, product_id long, quantity int, p int").select(
        "order_id", "product_id", "quantity", F.col("p").cast("decimal(12,2)").alias("total_price"))
    products = spark.createDataFrame([(1, "n", "c", 1)], "product_id long, product_name string, category string, p int").select(
        "product_id", "product_name", "category", F.col("p").cast("decimal(10,2)").alias("cost_price"))
    want = {r["analytics_date"]: r for r in kpi.declared_kpis(o, items, products).collect()}
    monkeypatch.setattr(state, "MANY_FILES", 2)
    for lo, hi in ((0, 10), (10, 20), (10, 20), (20, 30)):
        day = F.datediff("order_date", F.lit(start))
        tx = catalog.begin()
        got = state.daily_declared_kpis(tx, o.where((day >= lo) & (day < hi)), items, products).collect()
        tx.commit()
        assert got and all(r == want[r["analytics_date"]] for r in got)
    firsts = {}
    for _, c, day, *_ in made:
        if c is not None and day is not None:
            firsts[c] = min(day, firsts.get(c, day))
    assert dict(rows(state.first_orders(catalog.begin()))) == firsts
    tx = catalog.begin()
    assert state.record_first_orders(tx, o) == 0 and len(catalog.files("first_orders")) <= 2
    late = spark.createDataFrame([(999, min(firsts), dt.date(2023, 1, 1), "Pending", "X")], schema)  # comes after later orders
    assert state.record_first_orders(tx, late) == 1
    assert dict(rows(state.first_orders(tx)))[min(firsts)] == dt.date(2023, 1, 1)
