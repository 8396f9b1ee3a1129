"""The sorted as-of merge and the interval sweep against their plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitrina.operators.facts import asof_bind, asof_merge
from vitrina.operators.kpi import active_customers
from vitrina.operators.merge import append_absent, read_appended

DAY = dt.date(2024, 1, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_merge_is_the_range_join(spark, partitions):
    r = random.Random(partitions)
    dim, key = [], 0
    for k in [*range(30), 1000]:
        at = r.randrange(20)
        for _ in range(r.randrange(0, 6) if k < 1000 else 200):
            end = at + r.choice([0, 1, 3, 9])
            key += 1
            dim.append((k, key, days(at), days(end)))  # also empty ones: superseded on the same day
            at = end + r.choice([0, 0, 0, 4])  # and gaps
        if k % 3 == 0:
            dim.append((k, key := key + 1, days(at), dt.date(9999, 12, 31)))
    facts = [(r.choice([1000, 1000, None, 77, *range(30)]), r.choice([None, *(days(n) for n in range(60))]), n, "own") for n in range(900)]
    facts += [(1000, days(30), 5, "equal")] * 400
    d = spark.createDataFrame(dim, "id long, dim_key long, effective_date date, expiration_date date")
    f = spark.createDataFrame(facts, "customer long, at date, n int, id string")
    got = asof_merge(f, d, "customer", "at", "id", "dim_key", partitions)
    assert got.columns == ["customer", "at", "n", "id", "dim_key"]
    assert rows(got) == rows(asof_bind(f, d, "customer", "at", "id", "dim_key"))


def test_a_key_with_very_many_versions(spark):
    n = 100_000
    at = "date_add(date'1800-01-01', cast({} as int))".format
    d = spark.range(n).selectExpr("1L as id", "id as dim_key", f"{at('id')} as effective_date", f"{at('id + 1')} as expiration_date")
    d = d.unionByName(spark.range(50).selectExpr("id + 2 as id", "id + 1000000 as dim_key", f"{at(0)} as effective_date", f"{at(n)} as expiration_date"))
    f = spark.range(30_000).selectExpr("if(id % 3 = 0, 1L, id % 50 + 2) as customer", f"{at('(id * 7919) % 100000')} as on", "(id * 7919) % 100000 as want")
    got = asof_merge(f, d, "customer", "on", "id", "dim_key", 8)
    assert got.where("customer = 1 and dim_key = want").count() == 10_000
    assert got.where("customer > 1 and dim_key = 1000000 + customer - 2").count() == 20_000


@pytest.mark.parametrize("lookback", [0, 1, 7])
def test_sweep_counts_active_customers(spark, lookback):
    r = random.Random(lookback)
    orders = [(r.choice([None, *(days(n) for n in range(0, 90))]), r.choice([None, 1, 1, 1, *range(40)])) for _ in range(500)]
    dates = sorted({d + dt.timedelta(days=k) for d, _ in orders if d for k in range(lookback + 1)})
    want = [(x, len({c for d, c in orders if d and c is not None and 0 <= (x - d).days <= lookback})) for x in dates]
    got = active_customers(spark.createDataFrame(orders, "_d date, customer_id long"),
                           spark.createDataFrame([(x,) for x in dates], "analytics_date date"), lookback)
    assert rows(got) == sorted(want, key=str)
    assert "Expand" not in got._jdf.queryExecution().toString()


def test_appended_loads_are_one_scan(spark, tmp_path):
    schema = spark.range(0).selectExpr("id", "cast(null as date) as load_date", "'x' as t").schema
    base = f"{tmp_path}/t"
    for k in range(4):
        load = spark.range(k, k + 3).selectExpr("id", f"date'2024-01-0{k + 1}' as load_date", "'x' as t")
        assert append_absent(spark, base, schema, load, ["id", "load_date"], "load_date") == 3
        assert append_absent(spark, base, schema, load, ["id", "load_date"], "load_date") == 0
    got = read_appended(spark, base, schema)
    assert got.columns == ["id", "load_date", "t"] and got.count() == 12
    assert got.where(F.col("load_date") == "2024-01-02").count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_merge_moves_whole_facts_once(spark):
    """The sorted merge sees keys and dates alone: no sort or range partitioning carries the other columns of a fact."""
    f = spark.createDataFrame([(1, dt.date(2024, 1, 2), "wide"), (None, dt.date(2024, 1, 2), "no key"), (1, None, "no date"), (1, dt.date(2024, 1, 2), "wide")],
                              "customer long, at date, wide string")
    d = spark.createDataFrame([(1, 10, dt.date(2024, 1, 1), dt.date(9999, 12, 31))], "id long, dim_key long, effective_date date, expiration_date date")
    got = asof_merge(f, d, "customer", "at", "id", "dim_key", 2)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_row" not in plan and "Window" in plan
    assert sorted((r["wide"], r["dim_key"]) for r in got.collect()) == [("no date", None), ("no key", None), ("wide", 10), ("wide", 10)]
