"""Edge cases of the cleaning, merge, KPI and source operators on small
literal frames (the traps listed in FIXTURES.md §6)."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from vitrina.functions import clip_rating, email_norm, title_case, to_date, to_decimal, to_int, truncate, ustrip
from vitrina.operators import clean, dims, kpi, merge, quality
from vitrina.operators.surrogate import dense_index
from vitrina.sources.csv import read_csv


def col_values(df, c):
    """Values of column ``c`` (a name, or a position in the frame)."""
    if isinstance(c, int):
        return [r[c] for r in df.collect()]
    return [r[0] for r in df.select(c).collect()]


def test_title_strip_email(spark):
    rows = [(" o'neil-smith ",), ("\tанна-мария ",), ("ÉCOLE du MONDE",), (None,), ("straße",), ("ßa",)]
    df = spark.createDataFrame(rows, "s string")
    got = col_values(df.select(title_case("s").alias("t")), "t")
    assert got == [s.strip().title() if s is not None else None for (s,) in rows]
    got = col_values(df.select(email_norm("s").alias("e")), "e")
    assert got == [s.lower().strip() if s is not None else None for (s,) in rows]
    assert col_values(spark.createDataFrame([("\n x 　",)], "s string").select(ustrip("s")), 0) == ["x"]


def test_number_and_rating_coercion(spark):
    df = spark.createDataFrame([("12.5 ",), ("abc",), ("nan",), (None,), ("-3",)], "s string")
    got = col_values(df.select(F.coalesce(to_decimal("s", 12, 2), F.lit(0)).alias("v")), "v")
    assert got == [Decimal("12.50"), Decimal("0"), Decimal("0"), Decimal("0"), Decimal("-3.00")]
    r = spark.createDataFrame([(None,), ("0",), ("6",), ("4.7",), ("x",), ("NaN",)], "r string")
    assert col_values(r.select(clip_rating("r")), 0) == [3.0, 1.0, 5.0, 4.7, 3.0, 3.0]


def test_date_coercion_and_run_date_default(spark):
    df = spark.createDataFrame([("2024-13-01",), (None,), ("2024-02-29",)], "s string")
    got = col_values(df.select(F.coalesce(to_date("s"), F.lit("2024-05-01").cast("date"))), 0)
    assert got == [dt.date(2024, 5, 1), dt.date(2024, 5, 1), dt.date(2024, 2, 29)]


def test_truncate_counts_characters(spark):
    s = "a" * 499 + "😀" + "b"
    got = col_values(spark.createDataFrame([(s,)], "s string").select(truncate("s", 500)), 0)[0]
    assert got == s[:500]


def test_dedupe_keep_last_and_stats(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 3, None), (None, 4, "x"), (None, 5, None), (2, 1, None)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    kept = {r["k"]: (r["o"], r["v"]) for r in clean.dedupe_keep_last(df, "k", ["o"]).collect()}
    assert kept == {1: (3, None), None: (5, None), 2: (1, None)}
    cleaned, stats = clean.clean_with_stats(df, "k", {"v": "filled", "absent": 1}, ["o"])
    s = stats.first().asDict()
    assert s == {"original_rows": 6, "duplicates_removed": 3, "nulls_filled": 3, "cleaned_rows": 3}
    assert sorted(col_values(cleaned, "v")) == ["filled"] * 3


def test_fill_only_existing_columns(spark):
    df = spark.createDataFrame([(None, None)], "city string, status string")
    out = clean.fill_missing(df, clean.SIMPLE_FILL["customers"]).first()
    assert out["city"] == clean.NOT_GIVEN and out["status"] is None


def test_partial_upsert_keeps_null_outside_update_set(spark):
    tgt = spark.createDataFrame([(1, None, "Omsk"), (2, "B", "Tver")], "id int, name string, city string")
    src = spark.createDataFrame([(1, "A", "Perm", 1), (1, "A2", "Kazan", 2), (3, "C", "Ufa", 1)],
                                "id int, name string, city string, seq int")
    out = {r["id"]: (r["name"], r["city"]) for r in merge.upsert(tgt, src, "id", ["city"], ["seq"]).collect()}
    assert out == {1: (None, "Kazan"), 2: ("B", "Tver"), 3: ("C", "Ufa")}


def test_insert_if_absent_first_wins_and_is_idempotent(spark):
    tgt = spark.createDataFrame([(1, dt.date(2024, 1, 1), "old")], "id int, d date, v string")
    src = spark.createDataFrame([(1, dt.date(2024, 1, 1), "new", 0), (1, dt.date(2024, 1, 2), "a", 0),
                                 (1, dt.date(2024, 1, 2), "b", 1)], "id int, d date, v string, seq int")
    once = merge.insert_if_absent(tgt, src, ["id", "d"], ["seq"])
    twice = merge.insert_if_absent(once, src, ["id", "d"], ["seq"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert sorted(col_values(once, "v")) == ["a", "old"]


def test_top_city_ties_and_empty(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1, Decimal("10.00"), "Omsk"),
                                (dt.date(2024, 1, 1), 2, Decimal("20.00"), "Kazan"),
                                (dt.date(2024, 1, 2), 3, None, None)],
                               "order_date date, customer_id int, total_amount decimal(12,2), shipping_city string")
    out = {r["analytics_date"]: r for r in kpi.daily_kpis(df).collect()}
    assert out[dt.date(2024, 1, 1)]["top_city"] == "Kazan"
    assert out[dt.date(2024, 1, 2)]["top_city"] == clean.NOT_GIVEN
    assert out[dt.date(2024, 1, 2)]["avg_order_value"] is None


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("g"), F.col("id")).repartition(5)
    got = sorted((r["row_index"], r["g"], r["id"]) for r in dense_index(df, ["g", "id"]).collect())
    want = [(i + 1, g, x) for i, (g, x) in enumerate(sorted((x % 7, x) for x in range(1000)))]
    assert got == want


def test_dim_date_and_time(spark):
    d = dims.dim_date(spark)
    assert d.count() == 2922
    r = d.where(F.col("full_date") == "2024-12-30").first()
    assert (r["date_key"], r["day_of_week"], r["week_number"], r["year"]) == (20241230, 1, 1, 2024)
    t = dims.dim_time(spark)
    assert t.count() == 86400 and t.agg(F.max("time_key")).first()[0] == 235959
    noon = t.where("time_key = 120000").first()
    midnight = t.where("time_key = 0").first()
    assert (noon["hour_12"], noon["am_pm"], midnight["hour_12"], midnight["time_of_day"]) == (12, "PM", 0, "Ночь")


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, 1), (None, 1)], "k int, q int")
    assert quality.duplicate_keys(df, "k").count() == 1
    valid, bad = merge.split_valid(df, {"q_gt_1": F.col("q") > 1, "k_not_null": F.col("k").isNotNull()})
    assert valid.count() == 2 and bad.count() == 2
    rep = quality.validation_report(df, ["k", "missing"]).first()
    assert rep["is_valid"] is False and rep["missing_values"] == 2


def test_csv_reader_pandas_rules(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="vitrina-csv-"), "p.csv")
    header = ("product_id,product_name,category,subcategory,unit_price,stock_quantity,supplier,country_of_origin,"
              "weight_kg,dimensions,created_at,updated_at")
    lines = [header,
             '1,"Чайник ""Люкс""",Кухня,Чайники,1999.90,5,ООО Ромашка,Россия,1.20,"N/A",2024-01-01 10:00:00,'
             '2024-01-02 11:00:00',
             "2,Too,many,fields,1,1,s,c,1,d,2024-01-01 10:00:00,2024-01-01 10:00:00,EXTRA",
             "3,Short,row,sub,5.5,2",
             "4,Bad,ts,sub,abc,NULL,s,c,1,d,yesterday,2024-01-01 10:00:00"]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines))
    df, report = read_csv(spark, path, with_report=True)
    rows = {r["product_id"]: r for r in df.collect()}
    assert sorted(rows) == [1, 3, 4]
    assert rows[1]["product_name"] == 'Чайник "Люкс"' and rows[1]["dimensions"] is None
    assert rows[3]["supplier"] is None and rows[3]["unit_price"] == Decimal("5.50")
    assert rows[4]["unit_price"] is None and rows[4]["stock_quantity"] is None and rows[4]["created_at"] is None
    assert report.first()["rows_dropped"] == 1


def test_asof_binding_edges(spark):
    from vitrina.operators.facts import asof_bind
    dim = spark.createDataFrame(
        [(10, 1, dt.date(2024, 1, 1), dt.date(2024, 3, 1)), (11, 1, dt.date(2024, 3, 1), dt.date(2024, 3, 1)),
         (12, 1, dt.date(2024, 3, 1), dt.date(9999, 12, 31))],
        "customer_key long, customer_id long, effective_date date, expiration_date date")
    facts = spark.createDataFrame([(1, 1, dt.date(2023, 12, 31)), (2, 1, dt.date(2024, 2, 29)),
                                   (3, 1, dt.date(2024, 3, 1)), (4, 1, dt.date(2030, 1, 1)), (5, 2, dt.date(2024, 1, 5))],
                                  "order_id int, customer_id long, order_date date")
    got = {r["order_id"]: r["customer_key"]
           for r in asof_bind(facts, dim, "customer_id", "order_date", "customer_id", "customer_key").collect()}
    # before the first version: none; on the change date: the new version (zero-length one never matches)
    assert got == {1: None, 2: 10, 3: 12, 4: 12, 5: None}


def test_upsert_touch_and_insert_only(spark):
    now = F.lit("2024-05-01 09:00:00").cast("timestamp_ntz")
    tgt = spark.createDataFrame([(1, 5, dt.datetime(2024, 1, 1), None)],
                                "d int, v int, created_at timestamp_ntz, updated_at timestamp_ntz")
    src = spark.createDataFrame([(1, 6), (2, 7)], "d int, v int")
    out = {r["d"]: r for r in merge.upsert(tgt, src, "d", ["v"], touch={"updated_at": now},
                                           insert_only={"created_at": now}).collect()}
    assert out[1]["v"] == 6 and out[1]["created_at"] == dt.datetime(2024, 1, 1)
    assert out[1]["updated_at"] == dt.datetime(2024, 5, 1, 9)
    assert out[2]["created_at"] == dt.datetime(2024, 5, 1, 9) and out[2]["updated_at"] == dt.datetime(2024, 5, 1, 9)


def test_document_scan_object_ids_and_missing_fields(spark):
    from vitrina.sources.documents import FEEDBACK_SCHEMA, read_documents, sample_documents
    path = os.path.join(tempfile.mkdtemp(prefix="vitrina-docs-"), "fb.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"_id": {"$oid": "65a1b2"}, "feedback_id": "FB001", "customer_id": 1, "rating": 5, '
                '"comment": "' + "x" * 60 + '", "sentiment_score": 0.9}\n')
        f.write('{"_id": "plain-id", "feedback_id": "FB002", "customer_id": 2, "rating": 2, '
                '"customer_name": "Анна", "extra": true}\n')
    docs = read_documents(spark, path, FEEDBACK_SCHEMA)
    rows = {r["feedback_id"]: r for r in docs.collect()}
    assert rows["FB001"]["_id"] == "65a1b2" and rows["FB002"]["_id"] == "plain-id"
    assert rows["FB001"]["customer_name"] is None and rows["FB002"]["sentiment_score"] is None
    prev = {r["feedback_id"]: r for r in sample_documents(docs, n=0).collect()}
    assert prev["FB001"]["comment"] == "x" * 50 + "..." and "_id" not in prev["FB001"].asDict()


def test_title_case_is_pythons(spark):
    rows = ["中abc", "ǆan", "ﬁx it", "ΑΣ ΟΔΟΣ", "éCOLE 3rd a1b", "ªb cª", "ⅷa ⅷ", "they're", "a__b--c  d", "ÅNGSTRÖM", ""]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string").orderBy("i")
    assert col_values(df.select(title_case("s")), 0) == [s.strip().title() for s in rows]


def test_numbers_beyond_the_type_are_not_zero(spark):
    df = spark.createDataFrame([("10000000000.00",), ("x",), ("7",)], "s string")
    assert col_values(df.select(to_decimal("s", 12, 2, default=0)), 0) == [None, Decimal("0.00"), Decimal("7.00")]
    df = spark.createDataFrame([("5.0",), ("7",), ("4.5",), ("x",), ("1e20",)], "s string")
    assert col_values(df.select(to_int("s", 0)), 0) == [5, 7, 0, 0, 0]


def test_dates_in_other_forms(spark):
    rows = ["2024-01-05", "01/05/2024", "20240105", "Jan 5 2024", "2024-01-05T10:00:00", "5 Jan 2024", "2024/1/5"]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    assert col_values(df.select(to_date("s")), 0) == [dt.date(2024, 1, 5)] * len(rows)


def test_csv_by_name_with_line_breaks_and_long_rows(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="vitrina-csv-"), "p.csv")
    lines = ["stock_quantity,product_name,product_id,more,created_at,unit_price",
             '5.0,"two\nlines, quoted",7.0,x,2024-01-01,1.50',
             "1,long,2,x,2024-01-01T10:00:00,,EXTRA",
             "1,short,3",
             "n,stamp,4,x,2024-01-01T10:00:00,2"]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines))
    df, report = read_csv(spark, path, with_report=True)
    rows = {r["product_id"]: r for r in df.collect()}
    assert sorted(rows) == [3, 4, 7] and "supplier" not in df.columns
    assert rows[7]["product_name"] == "two\nlines, quoted" and rows[7]["stock_quantity"] == 5
    assert rows[7]["created_at"] == dt.datetime(2024, 1, 1) and rows[4]["created_at"] == dt.datetime(2024, 1, 1, 10)
    assert rows[4]["stock_quantity"] is None and rows[3]["created_at"] is None
    assert tuple(report.first()) == (4, 1, 1)
    rep = quality.validation_report(df, ["product_id", "supplier"]).first()
    assert not rep["is_valid"] and rep["errors"] == ["missing required column: supplier"]


def test_malformed_documents_are_returned(spark):
    from vitrina.sources.documents import read_documents
    path = os.path.join(tempfile.mkdtemp(prefix="vitrina-docs-"), "d.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"a": 1}\n{"a": \n{"a": 2, "b": "x"}\n')
    good, bad = read_documents(spark, path, "a INT, b STRING", malformed=True)
    assert sorted(r["a"] for r in good.collect()) == [1, 2] and [r["line"] for r in bad.collect()] == ['{"a": ']
    assert good.count() == 2 and good.select("b").count() == 2


def test_merges_without_an_order_keep_keys_unique(spark):
    tgt = spark.createDataFrame([(1, "old")], "id int, v string")
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, v string")
    assert sorted(r["id"] for r in merge.upsert(tgt, src, "id").collect()) == [1, 2]
    assert sorted(r["id"] for r in merge.insert_if_absent(tgt, src, "id").collect()) == [1, 2]


def test_defaults_of_absent_columns(spark):
    schema = spark.createDataFrame([], "id long, state string, created_at date").schema
    df = spark.createDataFrame([(1, None)], "id int, state string")
    out = merge.conform(df, schema, {"state": "new", "created_at": F.lit("2024-01-01").cast("date")})
    assert out.first() == (1, "new", dt.date(2024, 1, 1)) and out.schema.simpleString() == schema.simpleString()


def test_two_writers_of_one_version(spark):
    base = tempfile.mkdtemp(prefix="vitrina-table-")
    df = spark.range(3)
    first = merge.write_version(df, base)
    os.makedirs(f"{base}/v=000002")  # a failed attempt: not committed, not written over
    second = merge.write_version(df, base)
    assert (first[-3:], second[-3:]) == ("001", "003") and merge.committed_versions(spark, base) == [1, 3]


def test_counts_skip_a_table_that_cannot_be_read(spark):
    got = kpi.table_counts({"a": spark.range(3), "b": lambda: spark.read.parquet("/no/such/table"), "c": lambda: spark.range(2)})
    assert {r["table_name"]: r["row_count"] for r in got.collect()} == {"a": 3, "c": 2, "TOTAL": 5}


def test_kpis_of_missing_amounts_and_customers(spark):
    o = spark.createDataFrame([(1, None, dt.date(2024, 1, 1), None, None), (2, None, dt.date(2024, 1, 1), None, "Tver")],
                              "order_id int, customer_id int, order_date date, total_amount string, shipping_city string")
    row = kpi.run_kpis(o, None, "2024-01-02", variant="final").first()
    assert (row["total_orders"], row["total_revenue"], row["avg_order_value"], row["active_customers"]) == (2, 0, 0.0, 0)
    assert kpi.daily_kpis(o).first()["top_city"] == "Tver"
    assert kpi.run_kpis(o.limit(0), None, "2024-01-02", variant="final").first()["total_orders"] == 0


def test_catalog_probes(spark):
    from vitrina.sources.jdbc import list_tables, table_exists
    spark.range(1).createOrReplaceTempView("probe_me")
    assert "probe_me" in list_tables(spark) and table_exists(spark, "probe_me") and not table_exists(spark, "not_there")


def test_rating_with_a_decimal_point(spark):
    from vitrina.operators.facts import fact_feedback
    df = spark.createDataFrame([("a", "5.0"), ("b", "x")], "_id string, rating string")
    got = {r["feedback_key"]: r["rating"] for r in fact_feedback(df, "2024-01-01", ["_id"]).collect()}
    assert got == {1: 5, 2: 0}


def test_asof_binding_of_a_hot_customer(spark):
    from vitrina.operators.facts import asof_bind
    dim = spark.range(50).selectExpr("id as customer_key", "id as customer_id", "date'2024-01-01' as effective_date",
                                     "date'9999-12-31' as expiration_date")
    facts = spark.range(9000).selectExpr("id as order_id", "if(id % 3 = 0, 7, id % 50) as customer_id",
                                         "date'2024-05-05' as order_date")
    out = asof_bind(facts, dim, "customer_id", "order_date", "customer_id", "customer_key")
    assert out.count() == 9000 and out.where("customer_key <> customer_id or customer_key is null").count() == 0


def test_insert_if_absent_shuffles_source_rows_as_they_are(spark):
    """Rows whose key is there are gone before rows are hashed and reduced; null keys are one new key."""
    from vitrina.operators import merge
    t = spark.createDataFrame([(1, "old"), (2, "old")], "id long, mark string")
    s = spark.createDataFrame([(1, "a", 0), (3, "late", 1), (3, "first", 0), (None, "y", 1), (None, "x", 0)] + [(2, "hot", i) for i in range(50)],
                              "id long, mark string, seq int")
    got = merge.insert_if_absent(t, s, "id", ["seq"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftAnti")  # the join lies below
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "old"), (2, "old"), (3, "first"), (None, "x")]
