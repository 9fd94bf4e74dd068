"""Data checks folded into one aggregation per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstrata.schemas import TABLE_YEAR_RANGE

RESULT = "check_name string, passed boolean, observed double, threshold double, error string"


class QualityError(Exception):
    """At least one check did not pass; the message names them all."""


@dataclass(frozen=True)
class Check:
    """``observed`` is an aggregate; the check passes when it compares to ``threshold``."""

    name: str
    observed: Column
    threshold: float
    at_least: bool = True

    def columns(self) -> Column:
        observed = self.observed.cast("double")
        limit = F.lit(float(self.threshold))
        hit = observed >= limit if self.at_least else observed <= limit
        return F.struct(
            F.lit(self.name).alias("check_name"),
            # No value to compare is a failure, not an unknown.
            F.coalesce(hit, F.lit(False)).alias("passed"),
            observed.alias("observed"),
            limit.alias("threshold"),
            F.when(observed.isNull(), F.lit("No results returned"))
            .when(~hit, F.lit("Check condition not met"))
            .alias("error"),
        )


def min_rows(name: str, rows: int) -> Check:
    return Check(name, F.count("*"), rows)


def no_nulls(name: str, columns: Sequence[str]) -> Check:
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return Check(name, F.count_if(missing), 0, at_least=False)


def years_within(name: str, bounds: tuple[int, int] = TABLE_YEAR_RANGE) -> Check:
    outside = ~F.col("fiscal_year").between(*bounds)
    return Check(name, F.count_if(outside), 0, at_least=False)


def pass_rate(name: str, flag: str = "data_quality_passed", percent: float = 95.0) -> Check:
    rate = F.try_divide(F.count_if(flag).cast("double"), F.count("*").cast("double")) * 100
    return Check(name, rate, percent)


def unique_key(name: str, column: str) -> Check:
    """Rows beyond one per key (an exact distinct count, two-phase)."""
    return Check(name, F.count(column) - F.count_distinct(column), 0, at_least=False)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: (check_name, passed, observed, threshold, error).

    The checks run here, all of a table in one scan. If that scan fails, every
    check runs alone, so one that cannot be analysed on this table (say, for a
    missing column) or that fails while it runs is one failed row and the others
    still report. There is one row per check, so bringing them here is bounded.
    """

    def results(some: Sequence[Check]) -> list:
        folded = df.agg(F.array(*[c.columns() for c in some]).alias("results"))
        return [tuple(row) for row in folded.select(F.inline("results")).collect()]

    rows = []
    if checks:
        try:
            rows = results(checks)
        except (PySparkException, Py4JJavaError):
            for check in checks:
                try:
                    rows += results([check])
                except (PySparkException, Py4JJavaError) as error:
                    reason = str(error).strip().split("\n")[0]
                    rows.append((check.name, False, None, float(check.threshold), reason))
    return df.sparkSession.createDataFrame(rows, RESULT)


def warehouse_checks(
    *,
    min_companies: int = 100,
    min_facts: int = 1000,
    percent: float = 95.0,
    year_bounds: tuple[int, int] = TABLE_YEAR_RANGE,
) -> dict[str, list[Check]]:
    """The standing checks per stored table."""
    return {
        "dim_companies": [
            min_rows("check_companies_count", min_companies),
            unique_key("unique_company_id", "cik"),
        ],
        "fact_financials": [
            min_rows("check_financials_count", min_facts),
            no_nulls("null_check_critical_fields", ["cik", "concept", "value"]),
            years_within("valid_fiscal_years", year_bounds),
        ],
        "raw_financials": [pass_rate("data_quality_flag_check", percent=percent)],
    }


def run_suite(tables: dict[str, DataFrame], suite: dict[str, list[Check]]) -> DataFrame:
    """All checks over all tables in one frame."""
    return reduce(
        DataFrame.unionByName, [run_checks(tables[name], checks) for name, checks in suite.items()]
    )


def summarize(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


def require(results: DataFrame) -> list:
    """Run the checks now; raise :class:`QualityError` naming every failure.

    The result has one row per check, so collecting it is bounded.
    """
    rows = results.collect()
    failed = sorted(r.check_name for r in rows if not r.passed)
    if failed:
        raise QualityError(f"Data quality checks failed: {', '.join(failed)}")
    return rows


__all__ = [
    "Check",
    "QualityError",
    "min_rows",
    "no_nulls",
    "pass_rate",
    "require",
    "run_checks",
    "run_suite",
    "summarize",
    "unique_key",
    "warehouse_checks",
    "years_within",
]
