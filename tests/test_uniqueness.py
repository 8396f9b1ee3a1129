"""Keys of a load that earlier loads have, against plain counting, and what is read for it."""

import random
from collections import Counter

import pytest

from vitrina.operators import uniqueness
from vitrina.operators.catalog import Catalog

KEYS = ["id", "code"]


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, f"{tmp_path}/keys")


def loaded(spark, catalog, load, keys):
    tx = catalog.begin()
    clashes, did = uniqueness.check_load(tx, load, spark.createDataFrame(keys, "id long, code string"), KEYS)
    tx.commit()
    return {(r["id"], r["code"]): (r["occurrences"], r["earlier_loads"], r["first_load"]) for r in clashes.collect()}, did


def expected(load, keys, history):
    out = {}
    for k, n in Counter(k for k in keys if None not in k).items():
        there = sorted(x for x, ks in history.items() if x != load and k in ks)
        if n > 1 or there:
            out[k] = (n, len(there), there[0] if there else None)
    return out


def test_clashes_are_those_of_counting(spark, catalog):
    rng = random.Random(5)
    key = lambda: (rng.choice([None, *range(4000)]), rng.choice(["a", "b", None]))
    history = {}
    for load, n in (("d1", 900), ("d2", 1), ("d3", 0), ("d4", 1500), ("d2", 700), ("d5", 1500)):  # d2 is run again
        keys = [key() for _ in range(n)]
        got, did = loaded(spark, catalog, load, keys)
        assert got == expected(load, keys, history) and did["loads"] == len(history.keys() - {load})
        history[load] = set(keys)


def test_only_loads_that_hold_a_key_are_read(spark, catalog):
    ids = random.Random(1).sample(range(10 ** 9), 6000)  # every load spans all ids: ranges tell nothing
    for i in range(4):
        assert loaded(spark, catalog, f"d{i}", [(x, "a") for x in ids[1000 * i:1000 * i + 1000]])[0] == {}
    got, did = loaded(spark, catalog, "d9", [(x, "a") for x in ids[4000:4010] + ids[2000:2003]])
    assert got == {(x, "a"): (1, 1, "d2") for x in ids[2000:2003]}
    assert did == {"loads": 4, "filters_read": 4, "keys_read": 1}
    beyond, did = loaded(spark, catalog, "da", [(10 ** 10, "a"), (10 ** 10, "a")])
    assert beyond == {(10 ** 10, "a"): (2, 0, None)} and did == {"loads": 5, "filters_read": 0, "keys_read": 0}


def test_filters_hold_all_their_keys_and_few_others(spark):
    distinct = spark.range(20_000).selectExpr("id", "cast(id AS string) AS code")
    blocks = 1024
    f = uniqueness._filter(distinct, KEYS, "d", blocks)
    probe = spark.range(40_000).selectExpr("id", "cast(id AS string) AS code").withColumn("block", uniqueness._block(KEYS, uniqueness.F.lit(blocks)))
    held = [r["id"] for r in probe.join(f, "block").where(uniqueness._holds(KEYS)).select("id").collect()]
    assert sum(x < 20_000 for x in held) == 20_000 and len(held) < 20_600


def test_an_aborted_load_leaves_no_keys(spark, catalog):
    loaded(spark, catalog, "d1", [(1, "a")])
    uniqueness.check_load(catalog.begin(), "d2", spark.createDataFrame([(2, "a")], "id long, code string"), KEYS)  # not committed
    assert loaded(spark, catalog, "d3", [(1, "a"), (2, "a")])[0] == {(1, "a"): (1, 1, "d1")}
