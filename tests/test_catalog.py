"""Indexed tables under one commit log: which files a load touches, what a failure or a second writer leaves."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitrina.operators import scd2
from vitrina.operators.catalog import Catalog, Conflict
from vitrina.operators.merge import upsert


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, f"{tmp_path}/warehouse")


def keyed(spark, ids, mark):
    return spark.createDataFrame([(i, f"k{i % 7}", mark, i * 2) for i in ids], "id long, code string, mark string, n long")


def test_upsert_writes_few_files_again(spark, catalog):
    tx = catalog.begin()
    tx.replace("t", keyed(spark, range(0, 20_000, 2), "old"), ["id", "code"], files=100)
    tx.commit()
    before = set(catalog.files("t"))
    ids = [*range(8000, 8200), 50_001, -5]  # 1 % of the rows: half are there, half are new
    batch = keyed(spark, ids, "new").unionByName(keyed(spark, [8000], "newer"))
    want = rows(upsert(catalog.read("t"), batch, ["id", "code"], ["mark"], ["mark"]))
    tx = catalog.begin()
    did = tx.upsert("t", batch, ["mark"], ["mark"])
    assert rows(catalog.read("t")) != want and rows(tx.read("t")) == want  # not yet for others
    tx.commit()
    after = set(catalog.files("t"))
    assert rows(catalog.read("t")) == want
    assert did["files"] == 100 and did["rewritten"] <= 2 and len(before - after) == did["rewritten"]
    assert did["keys_read"] <= 5
    assert rows(catalog.begin().read("t")) == want and len(rows(catalog.read("t"))) == 10_000 + 102


def test_new_keys_write_no_file_again(spark, catalog):
    tx = catalog.begin()
    tx.replace("t", keyed(spark, range(0, 2000, 2), "old"), ["id", "code"], files=10)
    tx.commit()
    before = set(catalog.files("t"))
    tx = catalog.begin()
    assert tx.upsert("t", keyed(spark, range(1, 2000, 200), "new"))["rewritten"] == 0
    tx.commit()
    assert before < set(catalog.files("t")) and catalog.read("t").count() == 1010


def test_all_tables_or_none(spark, catalog):
    tx = catalog.begin()
    tx.replace("a", keyed(spark, range(10), "one"), "id")
    tx.replace("b", keyed(spark, range(5), "one"), "id")
    assert tx.commit() == 1
    a, b = rows(catalog.read("a")), rows(catalog.read("b"))
    tx = catalog.begin()
    tx.upsert("a", keyed(spark, [3, 99], "two"))
    with pytest.raises(Exception, match="NO_SUCH|cannot be resolved|UNRESOLVED"):
        tx.upsert("b", spark.createDataFrame([(1,)], "other long"))  # fails between two writes
    assert rows(catalog.read("a")) == a and rows(catalog.read("b")) == b and catalog.head().version == 1
    tx = catalog.begin()
    tx.upsert("a", keyed(spark, [3, 99], "two"))
    tx.replace("b", keyed(spark, [], "two"), "id")
    assert tx.commit() == 2
    assert len(rows(catalog.read("a"))) == 11 and rows(catalog.read("b")) == []
    first = Catalog(spark, catalog.base).commit(1)
    assert rows(spark.read.parquet(*catalog.files("b", first))) == b  # what began earlier still reads its files


def test_of_two_writers_the_second_fails(spark, catalog):
    tx = catalog.begin()
    tx.replace("a", keyed(spark, range(10), "one"), "id")
    tx.replace("b", keyed(spark, range(10), "one"), "id")
    tx.commit()
    one, two, other = catalog.begin(), catalog.begin(), catalog.begin()
    one.upsert("a", keyed(spark, [1], "one"))
    two.upsert("a", keyed(spark, [2], "two"))
    two.upsert("b", keyed(spark, [2], "two"))
    other.upsert("b", keyed(spark, [3], "three"))
    assert one.commit() == 2
    assert other.commit() == 3  # another table: goes on top
    with pytest.raises(Conflict, match="a, b"):
        two.commit()
    marks = {r["mark"] for r in catalog.read("a").unionByName(catalog.read("b")).collect()}
    assert marks == {"one", "three"}


def test_a_commit_is_made_once(spark, catalog):
    from vitrina.operators.catalog import _create
    path = f"{catalog.base}/_commits/00000001.json"
    assert _create(spark, path, "{}") and not _create(spark, path, '{"x": 1}')
    assert catalog.head().version == 1 and catalog.head().tables == {}


def customers(r, ids, run):
    return [(i, r.choice("ab"), r.choice("cd"), f"{r.choice('ef')}@x", r.choice(["Rome", "Oslo"]), k) for k, i in enumerate(ids)]


def test_dimension_by_buckets_is_the_whole_merge(spark, catalog):
    r = random.Random(3)
    cols = "customer_id long, first_name string, last_name string, email string, city string, seq int"
    whole = scd2.empty_dim(spark)
    untouched = 0
    for k, ids in enumerate([range(200), [5, 7, 7, 7, 300], [None, 5, 301, 302], [], [7, 11]]):
        run = (dt.date(2024, 1, 1) + dt.timedelta(days=k)).isoformat()
        batch = spark.createDataFrame(customers(r, ids, run), cols)
        whole, counts, rejected = scd2.scd2_merge(whole, batch, run, ["seq"])
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        before = catalog.files("dim")
        tx = catalog.begin()
        m = tx.merge_dimension("dim", batch, run, ["seq"], buckets=64)
        tx.commit()
        assert m.counts.collect() == counts.collect() and m.rejected.count() == rejected.count()
        got = catalog.begin().dimension("dim")
        assert rows(got.select(*whole.columns)) == rows(whole)
        after = catalog.files("dim")
        if k:
            assert len(set(before) - set(after)) <= len(set(ids))
            untouched += len(set(before) & set(after))
    assert untouched > 150
    assert catalog.read("dim").groupBy("customer_id").count().where(F.col("count") > 1).isEmpty()


def test_queries_with_keys_beyond_32_bits_as_multiples(spark, tmp_path):
    """The bounds of the loads are multiples of the largest key, which itself fits an integer."""
    from vitrina.plans.queries_catalog import q_duplicates_across_loads, q_upsert_by_files
    top = 2_000_000_000
    keys = [1, top * 6 // 10, top * 57 // 100, top * 99 // 100 + 1, top * 997 // 1000, top]
    o = spark.createDataFrame([(k, "F", 10.0) for k in keys], "o_orderkey long, o_orderstatus string, o_totalprice double")
    o.write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(top, 50.0, "N")], "l_orderkey long, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted((r["order_id"], r["status"], r["total"], r["note"]) for r in q_upsert_by_files(spark, str(tmp_path)).collect())
    assert got == [(1, "F", 10.0, "first"), (keys[2], "F", 10.0, "first"), (keys[1], "F", 10.0, "first"), (keys[3], "f", 20.0, "first"),
                   (keys[4], "f", 20.0, "second"), (top, "f", 20.0, "second")]
    clashes = q_duplicates_across_loads(spark, str(tmp_path))
    assert sorted((r["load"], r["order_id"]) for r in clashes.collect()) == [("b", keys[2]), ("b", keys[1]), ("c", top)]
