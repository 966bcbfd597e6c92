from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.quality_suite import QualityError, QualitySuite, warehouse_suite
from plans import plan_of

NOW = datetime(2024, 1, 3)


@pytest.fixture
def tables(spark):
    people = spark.createDataFrame(
        [("a", 1, NOW - timedelta(hours=30)), ("b", 5, None), ("b", None, None), (None, 9, None)],
        "k string, v int, at timestamp_ntz",
    )
    orders = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    empty = people.limit(0)
    broken = people.select("k", F.raise_error(F.lit("broken")).cast("int").alias("v"))
    return {"people": people, "orders": orders, "empty": empty, "broken": broken}.__getitem__


@pytest.fixture
def suite(spark, tables):
    return QualitySuite(spark, tables, "Test Suite", NOW)


def only(suite):
    (result,) = suite.run().results
    return result


def test_row_count(suite):
    result = only(suite.expect_row_count("people", 1, 3))
    assert not result.passed and result.actual == "4"
    assert result.message == "Found 4 rows (expected >= 1 and <= 3)"


def test_upper_bound_of_zero_is_enforced_but_not_named(suite):
    result = only(suite.expect_row_count("people", max_count=0))
    assert not result.passed and result.expected == ">= 1"


def test_null_rate_is_over_cells(suite):
    result = only(suite.expect_null_rate("people", ["k", "v"], 25.0))
    assert result.passed and result.actual == "25.00%"
    assert result.message == "Columns ['k', 'v']: 25.00% null (expected <= 25.0%)"


def test_no_nulls_in_an_empty_table_is_information(suite):
    result = only(suite.expect_no_nulls("empty", ["k"]))
    assert (result.passed, result.severity, result.actual) == (True, "info", "0%")


def test_null_rate_fails_as_a_warning(suite):
    run = suite.expect_null_rate("people", ["v"], 10.0).run()
    assert run.success and run.warning_checks == 1 and run.passed_checks == 0


def test_uniqueness_takes_null_as_a_value_and_reports_ten_groups_at_most(suite, spark):
    assert only(suite.expect_unique("people", ["k"])).message == "Columns ['k']: 1+ duplicate groups"
    many = spark.range(40).select((F.col("id") % 20).alias("k"))
    result = only(QualitySuite(spark, lambda _: many).expect_unique("t", ["k"]))
    assert result.actual == "10 duplicate groups found"


def test_reference_counts_distinct_values_and_exempts_null(suite):
    result = only(suite.expect_referential_integrity("orders", "k", "people", "k"))
    assert not result.passed and result.message == "orders.k -> people.k: 1 orphaned"


def test_reference_is_an_anti_join_of_distinct_values(suite):
    plan = plan_of(suite.expect_referential_integrity("orders", "k", "people", "k").results())
    assert "LeftAnti" in plan and "LeftOuter" not in plan


def test_values(suite):
    run = (
        suite.expect_values_in_set("people", "k", ["a"])
        .expect_values_in_set("people", "k", ["a", "b"])
        .expect_value_range("people", "v", 1, 9)
        .expect_value_range("people", "v", max_value=8)
        .expect_value_range("people", "v")
        .expect_values_in_set("people", "v", [])
        .run()
    )
    assert [r.passed for r in run.results] == [False, True, True, False, True, True]
    assert run.results[0].message == "k: 2 values outside allowed set"
    assert run.results[2].expected == "1 <= v <= 9"
    assert run.results[3].expected == "None <= v <= 8"
    assert run.results[4].severity == "info" and run.results[5].severity == "info"


def test_freshness(suite):
    run = (
        suite.expect_freshness("people", "at", 24)
        .expect_freshness("people", "at", 48)
        .expect_freshness("empty", "at", 48, severity="error")
        .run()
    )
    assert [r.passed for r in run.results] == [False, True, False]
    assert run.results[0].actual == "30.0 hours old" and run.results[0].severity == "warning"
    assert run.results[2].message == "No timestamps found in table"
    assert run.failed_checks == 1 and run.warning_checks == 1


def test_future_timestamps_are_fresh(spark, tables):
    early = QualitySuite(spark, tables, now=datetime(2023, 1, 1)).expect_freshness("people", "at", 1)
    assert only(early).passed


def test_checks_that_cannot_run_fail_by_themselves(suite):
    run = (
        suite.expect_row_count("people")
        .expect_no_nulls("people", ["missing"])
        .expect_unique("nowhere", ["k"])
        .expect_value_range("broken", "v", 0)
        .expect_row_count("orders")
        .run()
    )
    assert [r.passed for r in run.results] == [True, False, False, False, True]
    assert [r.check_name for r in run.results[1:4]] == [
        "check_null_values", "check_duplicates", "check_value_range",
    ]
    assert all(r.expected == "Check to execute" and r.severity == "error" for r in run.results[1:4])


def test_failed_information_counts_as_neither(suite):
    run = suite.expect_row_count("empty", severity="info").run()
    assert (run.passed_checks, run.failed_checks, run.warning_checks) == (0, 0, 0) and run.success


def test_report(suite):
    run = suite.expect_row_count("people").expect_unique("people", ["k"]).run()
    lines = run.summary().splitlines()
    assert lines[1:3] == ["Data Quality Suite: Test Suite", f"Run at: {NOW}"]
    assert "Total: 2 | Passed: 1 | Failed: 1 | Warnings: 0" in lines
    assert "[OK] row_count: people" in lines and "[X] no_duplicates: people" in lines
    assert lines[-2] == "Suite Result: FAILED"
    with pytest.raises(QualityError, match="1 error"):
        run.raise_if_failed()
    assert str(run.results[0]) == "[PASS] row_count on people: Found 4 rows (expected >= 1)"


def test_an_empty_suite_passes(suite):
    assert suite.run().success and suite.results().count() == 0


def test_aggregate_checks_of_a_table_share_one_scan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    suite = (
        QualitySuite(spark, lambda _: orders, now=NOW)
        .expect_row_count("orders")
        .expect_no_nulls("orders", ["o_orderkey", "o_custkey"])
        .expect_value_range("orders", "o_totalprice", 0)
        .expect_values_in_set("orders", "o_orderstatus", ["O", "F", "P"])
        .expect_freshness("orders", "o_orderdate")
    )
    plan = plan_of(suite.results())
    assert plan.count("FileScan parquet") == 1
    assert "o_orderpriority" not in plan


def test_warehouse_suite_has_its_17_checks(spark, sf):
    from workload.queries import Tables

    run = warehouse_suite(spark, Tables(spark, sf), NOW).run()
    names = [r.check_name for r in run.results]
    assert [names.count(n) for n in ("row_count", "null_values", "no_duplicates", "referential_integrity", "value_range", "freshness")] == [4, 4, 4, 3, 1, 1]


def test_all_duplicate_groups_are_counted(spark):
    from ledgerline.operators.quality import duplicate_groups

    df = spark.createDataFrame([(i % 30, i) for i in range(60)] + [(99, 0)], "k int, v int")
    assert duplicate_groups(df, ["k"]).first()[0] == 30 and duplicate_groups(df, ["k", "v"]).first()[0] == 0
