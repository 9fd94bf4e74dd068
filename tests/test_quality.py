"""Check suites: passing, failing, broken and empty."""

import pytest
from pyspark.sql import functions as F

from ledgerstrata.operators import quality as q


def table(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "cik string, concept string, value double, fiscal_year int, data_quality_passed boolean",
    )


GOOD = [("1", "A", 1.0, 2020, True), ("2", "A", 2.0, 2030, True)]


def outcome(df):
    return {r.check_name: (r.passed, r.observed, r.error) for r in df.collect()}


def test_passing_suite(spark):
    df = table(spark, *GOOD)
    checks = [
        q.min_rows("rows", 2),
        q.no_nulls("nulls", ["cik", "value"]),
        q.years_within("years"),
        q.pass_rate("rate"),
        q.unique_key("unique", "cik"),
    ]
    results = q.run_checks(df, checks)
    assert all(passed for passed, _, error in outcome(results).values())
    assert len(q.require(results)) == 5
    (summary,) = q.summarize(results).collect()
    assert tuple(summary) == (5, 5, 0)


def test_failures_are_all_named(spark):
    df = table(spark, *GOOD, ("1", None, None, 1999, False))
    checks = [
        q.min_rows("rows", 10),
        q.no_nulls("nulls", ["cik", "value"]),
        q.years_within("years"),
        q.pass_rate("rate"),
        q.unique_key("unique", "cik"),
    ]
    results = q.run_checks(df, checks)
    got = outcome(results)
    assert got["rows"] == (False, 3.0, "Check condition not met")
    assert got["nulls"][1] == 1.0 and got["years"][1] == 1.0 and got["unique"][1] == 1.0
    assert got["rate"][1] == pytest.approx(200 / 3)
    with pytest.raises(q.QualityError) as error:
        q.require(results)
    assert str(error.value).endswith("nulls, rate, rows, unique, years")


def test_no_value_is_a_failure(spark):
    empty = table(spark)
    assert outcome(q.run_checks(empty, [q.pass_rate("rate")]))["rate"] == (
        False,
        None,
        "No results returned",
    )
    assert outcome(q.run_checks(empty, [q.min_rows("rows", 1)]))["rows"][0] is False


def test_broken_check_is_reported(spark):
    broken = q.Check("broken", F.max("no_such_column"), 1)
    got = outcome(q.run_checks(table(spark, *GOOD), [q.min_rows("rows", 1), broken]))
    assert got["rows"][0] is True
    assert got["broken"][0] is False and "no_such_column" in got["broken"][2]
    only = q.run_checks(table(spark, *GOOD), [broken])
    with pytest.raises(q.QualityError, match="broken"):
        q.require(only)


def test_check_that_fails_while_running_is_one_failed_row(spark):
    raising = q.Check("raising", F.max(F.when(F.col("value") > 0, F.raise_error(F.lit("broken value")))), 1)
    got = outcome(q.run_checks(table(spark, *GOOD), [q.min_rows("rows", 1), raising, q.years_within("years")]))
    assert got["rows"][0] is True and got["years"][0] is True
    assert got["raising"][0] is False and got["raising"][2]


def test_checks_of_a_table_share_one_scan(spark, scratch):
    table(spark, *GOOD).write.parquet(f"{scratch}/t")
    stored = spark.read.parquet(f"{scratch}/t")
    checks = [q.min_rows("a", 1), q.no_nulls("b", ["cik"]), q.years_within("c"), q.pass_rate("d")]
    spark.sparkContext.setJobGroup("one-scan", "a suite")
    try:
        assert q.run_checks(stored, checks).count() == 4
        tracker = spark.sparkContext.statusTracker()
        jobs = tracker.getJobIdsForGroup("one-scan")
        # The fold (a stage before and after its exchange) and the count of four local rows.
        assert len(jobs) <= 4
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
