"""Plan properties that matter at scale: predicates and projections reach the
parquet scan; no query plans a cartesian product or Python evaluation."""

import re

import __spark_entry__ as entry_mod


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_projection_reach_the_scan(spark, sf):
    qs = entry_mod.queries()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # show the whole filter list
    plan = _plan(qs["scan_filter_project"](spark, sf))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "o_orderpriority" not in scan  # pruned column
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderstatus,F\)", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_totalprice", plan)
    # the look-back window on a derived date becomes a pushed range filter on the raw column
    plan = _plan(qs["lookback_window"](spark, sf))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_no_cartesian_or_python_operators(spark, sf):
    qs = entry_mod.queries()
    bad = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython")
    for name in ("daily_kpis_simple", "daily_kpis_final", "declared_kpis", "dedupe_keep_last", "upsert_full",
                 "insert_if_absent", "title_case", "quality_metrics"):
        assert not bad.search(_plan(qs[name](spark, sf))), name
