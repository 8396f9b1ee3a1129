"""SCD2 merge against a row-by-row simulation of the documented semantics."""

import datetime as dt
import random

from pyspark.sql import functions as F

from vitrina.operators.scd2 import CUSTOMERS, empty_dim, scd2_merge

OPEN = dt.date(9999, 12, 31)


def simulate(dim, batch, run):
    """dim: list of dicts (customer_key, customer_id, tracked..., effective_date,
    expiration_date, is_current); batch: list of dicts in batch order."""
    dim = [dict(r) for r in dim]
    nxt = max([r["customer_key"] for r in dim], default=0)
    counts = {"new_records": 0, "updated_records": 0, "unchanged_records": 0}
    pending = []
    for row in batch:
        k = row["customer_id"]
        cur = [r for r in dim + pending if r["customer_id"] == k and r["is_current"]]

        def txt(r):
            return "".join((r.get(c) or "") for c in ("first_name", "last_name", "email", "city")).lower().strip()
        if cur:
            if txt(cur[-1]) != txt(row):
                for r in cur:
                    r["is_current"], r["expiration_date"] = False, run
                pending.append(dict(row, is_current=True, effective_date=run, expiration_date=OPEN))
                counts["updated_records"] += 1
            else:
                counts["unchanged_records"] += 1
        else:
            pending.append(dict(row, is_current=True, effective_date=run, expiration_date=OPEN))
            counts["new_records"] += 1
    # dense keys in (customer_id, batch order) order
    order = sorted(range(len(pending)), key=lambda i: (pending[i]["customer_id"], pending[i]["seq"]))
    for i in order:
        nxt += 1
        pending[i]["customer_key"] = nxt
    return dim + pending, counts


def as_tuples(rows):
    return sorted((r["customer_key"], r["customer_id"], r["first_name"], r["last_name"], r["email"], r["city"],
                   r["effective_date"], r["expiration_date"], r["is_current"]) for r in rows)


CITIES = ["Tver", "tver", " TVER ", None, "Omsk", "Perm"]


def random_batch(rng, n, keys, start_seq):
    out = []
    for i in range(n):
        k = rng.choice(keys)
        out.append({"customer_id": k, "seq": start_seq + i,
                    "first_name": rng.choice(["ab", "a", "Ann", None]),
                    "last_name": rng.choice(["c", "bc", "Lee"]),
                    "email": rng.choice(["x@y", "X@Y", "z@y"]),
                    "city": rng.choice(CITIES)})
    return out


def run_spark(spark, dim_df, batch, run, partitions):
    schema = "customer_id long, seq long, first_name string, last_name string, email string, city string"
    bdf = spark.createDataFrame([(r["customer_id"], r["seq"], r["first_name"], r["last_name"], r["email"],
                                  r["city"]) for r in batch], schema)
    out, counts, rejected = scd2_merge(dim_df, bdf, run.isoformat(), ["seq"], partitions=partitions)
    return out, counts.first().asDict(), rejected.count()


def test_scd2_matches_sequential_simulation(spark):
    rng = random.Random(7)
    dim_rows, dim_df = [], empty_dim(spark, CUSTOMERS)
    keys = list(range(1, 25))
    seq = 0
    for step, (n, parts) in enumerate([(40, 3), (60, 5), (30, 2), (80, 7)]):
        run = dt.date(2024, 1, 1) + dt.timedelta(days=step)
        # one hot key: about a third of the batch, spread over several buckets
        batch = random_batch(rng, n, keys, seq) + [dict(r, customer_id=1) for r in random_batch(rng, n // 2, keys,
                                                                                              seq + n)]
        batch.sort(key=lambda r: r["seq"])
        seq += 2 * n
        dim_rows, want_counts = simulate(dim_rows, batch, run)
        dim_df, got_counts, rejected = run_spark(spark, dim_df, batch, run, parts)
        dim_df = dim_df.checkpoint()
        got = [r.asDict() for r in dim_df.collect()]
        assert got_counts == want_counts, step
        assert rejected == 0
        assert as_tuples(got) == as_tuples(dim_rows), step
        # invariants: at most one current row per key; versions do not overlap
        cur = dim_df.where("is_current").groupBy("customer_id").count().where("count > 1").count()
        assert cur == 0


def test_scd2_rerun_same_batch_changes_nothing(spark):
    rng = random.Random(3)
    batch = random_batch(rng, 30, list(range(1, 10)), 0)
    run = dt.date(2024, 2, 1)
    d1, _, _ = run_spark(spark, empty_dim(spark), batch, run, 4)
    d1 = d1.checkpoint()
    # the last version of each key equals the last batch row, so a re-run is all unchanged
    last = {}
    for r in batch:
        last[r["customer_id"]] = r
    d2, counts, _ = run_spark(spark, d1, list(last.values()), run, 4)
    assert counts["new_records"] == 0 and counts["updated_records"] == 0
    assert d2.count() == d1.count()


def test_scd2_late_run_is_rejected(spark):
    batch = [{"customer_id": 1, "seq": 0, "first_name": "A", "last_name": "B", "email": "e", "city": "X"}]
    d1, _, _ = run_spark(spark, empty_dim(spark), batch, dt.date(2024, 3, 10), 2)
    d1 = d1.checkpoint()
    changed = [dict(batch[0], city="Y")]
    d2, counts, rejected = run_spark(spark, d1, changed, dt.date(2024, 3, 1), 2)
    assert rejected == 1
    assert counts == {"new_records": 0, "updated_records": 0, "unchanged_records": 0}
    assert d2.where(F.col("city") == "Y").count() == 0


def test_scd2_rows_without_a_key_are_rejected(spark):
    batch = [{"customer_id": k, "seq": i, "first_name": "A", "last_name": "B", "email": "e", "city": "X"}
             for i, k in enumerate([1, None, 2, None])]
    d, counts, rejected = run_spark(spark, empty_dim(spark), batch, dt.date(2024, 1, 1), 2)
    assert rejected == 2 and counts["new_records"] == 2 and d.count() == 2


def test_scd2_keys_that_come_once_skip_the_buckets(spark, monkeypatch):
    from vitrina.operators import scd2

    def never(*_):
        raise AssertionError("keys that come once need no buckets")
    dim = spark.range(100).selectExpr("id as customer_id", "id as seq", "'a' as first_name", "'b' as last_name",
                                      "'c' as email", "'d' as city")
    monkeypatch.setattr(scd2, "_chained", never)
    first, _, _ = scd2_merge(empty_dim(spark), dim, "2024-01-01", ["seq"])
    m = scd2.merge_current(first.checkpoint(), dim.withColumn("city", F.lit("e")), "2024-01-02", ["seq"], last_key=100)
    assert m.current.count() == 100 and m.closed.count() == 100 and m.counts.first()["updated_records"] == 100
    assert m.current.agg(F.min("customer_key"), F.max("customer_key")).first() == (101, 200)
