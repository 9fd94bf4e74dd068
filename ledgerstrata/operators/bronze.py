"""Documents to long fact rows with quality flags. Narrow transforms only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.functions import statement_type
from ledgerstrata.schemas import (
    CRITICAL_COLUMNS,
    FACT_FIELDS,
    PARSE_YEAR_RANGE,
    STATEMENTS,
    TABLE_YEAR_RANGE,
    VALID_FORMS,
    VALID_UNITS,
    YEAR_BUCKET,
)
from ledgerstrata.sources.documents import CORRUPT, valid_documents


def pad_cik(cik: Column | str = "cik") -> Column:
    """Company id left-padded with zeros to ten characters."""
    return F.lpad(cik, 10, "0")


def year_quarter() -> Column:
    """``2023-Q1``; NULL when either part is."""
    return F.concat(F.col("fiscal_year").cast("string"), F.lit("-"), F.col("fiscal_period"))


def extract_companies(documents: DataFrame) -> DataFrame:
    """One row per document: ids, name, first ticker, first exchange.

    Documents that could not be parsed are left out.
    """
    if CORRUPT in documents.columns:
        documents = valid_documents(documents)
    return documents.select(
        "cik",
        pad_cik().alias("cik_padded"),
        F.col("entityName").alias("company_name"),
        F.try_element_at("tickers", F.lit(1)).alias("ticker"),
        F.try_element_at("exchanges", F.lit(1)).alias("exchange"),
    )


def extract_submission_info(submissions: DataFrame) -> DataFrame:
    """Company attributes from the attribute documents, one row per company."""
    return submissions.select(
        pad_cik().alias("cik"),
        F.col("sic").alias("sic_code"),
        F.col("sicDescription").alias("sic_description"),
        F.try_element_at("tickers", F.lit(1)).alias("ticker"),
        F.try_element_at("exchanges", F.lit(1)).alias("exchange"),
    )


def _reported_columns() -> list[Column]:
    """The fields of a reported fact as typed columns; what cannot be cast is NULL."""
    columns = []
    for name, (field, kind) in FACT_FIELDS.items():
        value = F.col("fact").getField(field)
        columns.append((value if kind == "string" else value.try_cast(kind)).alias(name))
    return columns


def year_bucket(year: str = "fiscal_year") -> Column:
    """The year where it lies in the range of the tables, else NULL."""
    return F.when(F.col(year).between(*TABLE_YEAR_RANGE), F.col(year)).alias(YEAR_BUCKET)


def flatten_facts(documents: DataFrame) -> DataFrame:
    """concept -> units -> facts[] to one row per reported value.

    Exploding a map hands over key and value together, so the three levels are
    three generators in a row with no lookup and no shuffle.
    """
    return (
        documents.select(
            "cik",
            F.col("entityName").alias("company_name"),
            F.explode(F.col("facts").getField("us-gaap")).alias("concept", "body"),
        )
        .select("cik", "company_name", "concept", F.explode("body.units").alias("unit", "reported"))
        .select("cik", "company_name", "concept", "unit", F.explode("reported").alias("fact"))
        .select("cik", "company_name", "concept", "unit", *_reported_columns())
    )


def keep_units(facts: DataFrame, units: Sequence[str] = VALID_UNITS) -> DataFrame:
    return facts.where(F.col("unit").isin(*units))


def keep_forms(facts: DataFrame, forms: Sequence[str] = VALID_FORMS) -> DataFrame:
    return facts.where(F.col("form").isin(*forms))


def add_derived_keys(facts: DataFrame) -> DataFrame:
    return facts.withColumns({"cik_padded": pad_cik(), "year_quarter": year_quarter()})


def categorize_concepts(
    facts: DataFrame, statements: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    return facts.withColumn("statement_type", statement_type("concept", statements))


def null_critical() -> Column:
    """Any of the columns that a fact is nothing without is missing."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in CRITICAL_COLUMNS])


def flag_null_critical(facts: DataFrame) -> DataFrame:
    return facts.withColumn("has_null_critical", null_critical())


def flag_invalid_year(facts: DataFrame, bounds: tuple[int, int] = PARSE_YEAR_RANGE) -> DataFrame:
    """Year outside the bounds; a missing year is not flagged here."""
    outside = ~F.col("fiscal_year").between(*bounds)
    return facts.withColumn("invalid_fiscal_year", F.coalesce(outside, F.lit(False)))


def flag_quality(facts: DataFrame, bounds: tuple[int, int] = PARSE_YEAR_RANGE) -> DataFrame:
    """Both flags and their combination ``data_quality_passed``."""
    flagged = facts.transform(flag_null_critical).transform(flag_invalid_year, bounds)
    return flagged.withColumn(
        "data_quality_passed", ~F.col("has_null_critical") & ~F.col("invalid_fiscal_year")
    )


def quality_metrics(flagged: DataFrame) -> DataFrame:
    """Total and passed rows with the pass rate, in one aggregation."""
    total, passed = F.count("*"), F.count_if("data_quality_passed")
    return flagged.agg(
        total.alias("total_count"),
        passed.alias("passed_count"),
        F.round(F.try_divide(passed, total) * 100, 4).alias("pass_rate_pct"),
    )


def observe_quality(flagged: DataFrame, observation: Observation) -> DataFrame:
    """The same counts taken in passing while the rows are written: no extra pass."""
    return flagged.observe(
        observation,
        F.count(F.lit(1)).alias("total_count"),
        F.count_if("data_quality_passed").alias("passed_count"),
    )


def _together_by_year(facts: DataFrame) -> DataFrame:
    return facts.withColumn(YEAR_BUCKET, year_bucket()).hint("rebalance", F.col(YEAR_BUCKET)).drop(YEAR_BUCKET)


def extract_financials(
    documents: DataFrame,
    *,
    units: Sequence[str] = VALID_UNITS,
    forms: Sequence[str] = VALID_FORMS,
    statements: dict[str, tuple[str, ...]] | None = None,
    year_bounds: tuple[int, int] = PARSE_YEAR_RANGE,
    by_year: bool = False,
) -> DataFrame:
    """The bronze fact table: flatten, filter, derive, categorise, flag.

    ``by_year`` brings the rows of a year bucket together, a large one over several tasks,
    as they are to be stored. What is derived is added where they have arrived, so it does
    not cross the network.
    """
    return (
        flatten_facts(documents)
        .transform(keep_units, units)
        .transform(keep_forms, forms)
        .transform(lambda rows: _together_by_year(rows) if by_year else rows)
        .transform(add_derived_keys)
        .transform(categorize_concepts, statements)
        .transform(flag_quality, year_bounds)
    )


def concept_map(spark: SparkSession) -> DataFrame:
    """The taxonomy lists as a table ``(concept, statement_type)``."""
    rows = [(c, name) for name, concepts in STATEMENTS.items() for c in concepts]
    return spark.createDataFrame(rows, "concept string, statement_type string")
