"""Silver facts: de-duplicated values and per-filing summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# What a fact is about: of several filings of it the last one counts.
FACT_KEY = ("fiscal_year", "cik", "concept", "end_date", "fiscal_period")
# The keys that cut the two tables into ranges, the first ones of what they group by.
FACT_RANGES = FACT_KEY[:4]
SUBMISSION_RANGES = FACT_KEY[:2]
# Tasks that sort one range: some 300,000 rows each, which need no disk.
TASKS_PER_RANGE = 8


def passed_only(raw_financials: DataFrame) -> DataFrame:
    return raw_financials.where("data_quality_passed")


def shape_facts(financials: DataFrame) -> DataFrame:
    """Rename and type the columns; an unreadable date becomes NULL."""
    return financials.select(
        F.col("cik_padded").alias("cik"),
        "concept",
        F.col("end_date").try_cast("date").alias("end_date"),
        F.col("filed_date").try_cast("date").alias("filing_date"),
        "fiscal_year",
        "fiscal_period",
        "year_quarter",
        "form",
        "accession_number",
        "value",
        "unit",
        "statement_type",
        "frame",
        "start_date",
    )


def add_fact_id(facts: DataFrame) -> DataFrame:
    key = F.concat("cik", "concept", F.col("end_date").cast("string"), "accession_number")
    return facts.withColumn("fact_id", F.md5(key))


def latest_filing(facts: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """One row per (company, concept, period end, fiscal year and period): the last filed.

    Same-day ties fall to the later accession, then the shorter period (later
    start), unit and larger value, so a rerun keeps the same row. Spark limits
    each key to one row per task before the shuffle, so a key that holds a
    large share of the rows sends one row per task and not all of them.
    ``extra_keys=["unit"]`` keeps different units apart. Rows that lie in ranges of
    ``FACT_RANGES`` are not shuffled again, and leave in that order.
    """
    keys = [*FACT_KEY, *extra_keys]
    order = [
        F.desc_nulls_last("filing_date"),
        F.desc_nulls_last("accession_number"),
        F.desc_nulls_last("start_date"),
        F.asc_nulls_last("unit"),
        F.desc_nulls_last("value"),
    ]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return facts.withColumn("row_num", rank).where("row_num = 1").drop("row_num")


def in_ranges(df: DataFrame, ranges: bool | int, keys: Sequence[str]) -> DataFrame:
    """``df`` cut by value, see ``ranges`` of ``sinks.write_table``; with ``False`` as it is.

    A number of ranges is cut further, into ``TASKS_PER_RANGE`` times as many.
    """
    if not ranges:
        return df
    return df.repartitionByRange(*([] if ranges is True else [TASKS_PER_RANGE * int(ranges)]), *keys)


def build_fact_financials(
    raw_financials: DataFrame, extra_keys: Sequence[str] = (), ranges: bool | int = False
) -> DataFrame:
    """The last filing of every fact with its surrogate key.

    ``ranges`` cuts the rows by value first, as they are to be stored. They then cross
    the network once, without the key and, coming from a stored table, as runs of
    neighbours that compress well; nothing is sorted before that. The filings of one
    fact meet in one task, which sorts them on disk if they are very many.
    """
    return (
        passed_only(raw_financials)
        .transform(shape_facts)
        .transform(in_ranges, ranges, FACT_RANGES)
        .transform(latest_filing, extra_keys)
        .transform(add_fact_id)
        .select(
            "fact_id",
            "cik",
            "concept",
            "end_date",
            "filing_date",
            "fiscal_year",
            "fiscal_period",
            "year_quarter",
            "form",
            "accession_number",
            "value",
            "unit",
            "statement_type",
            "frame",
        )
    )


def upsert_facts(
    stored: DataFrame, raw_financials: DataFrame, batch: DataFrame, extra_keys: Sequence[str] = ()
) -> DataFrame:
    """The facts after ``batch`` has arrived, for the years that it touches.

    ``stored`` are the facts and ``raw_financials`` the unchecked rows, the batch
    included, both of those years only. Keys that the batch does not name keep their
    stored fact; the others are decided again among all of their filings. The result
    equals a rebuild of these years.
    """
    key = [*FACT_KEY, *extra_keys]
    named = shape_facts(passed_only(batch)).select(*key).distinct()

    def same(left: DataFrame):
        return reduce(lambda a, b: a & b, [left[c].eqNullSafe(named[c]) for c in key])

    kept = stored.join(named, same(stored), "left_anti")
    shaped = shape_facts(passed_only(raw_financials))
    again = shaped.join(named, same(shaped), "left_semi")
    decided = add_fact_id(latest_filing(again, extra_keys)).select(*stored.columns)
    return kept.unionByName(decided)


def build_fact_submissions(raw_financials: DataFrame, ranges: bool | int = False) -> DataFrame:
    """Filing summaries over all bronze rows, flagged ones included.

    ``ranges`` cuts the rows by year and company first, which are parts of the key, so
    that the distinct count and the summaries need no shuffle of their own.
    """

    def of(statement: str):
        return F.count_if(F.col("statement_type") == statement).alias(f"{statement}_facts")

    filed = raw_financials.select(
        F.col("cik_padded").alias("cik"),
        "accession_number",
        "form",
        F.col("filed_date").try_cast("date").alias("filing_date"),
        "fiscal_year",
        "fiscal_period",
        "concept",
        "statement_type",
    )
    return in_ranges(filed, ranges, SUBMISSION_RANGES).groupBy(*filed.columns[:6]).agg(
        F.count_distinct("concept").alias("concepts_reported"),
        F.count("*").alias("total_facts"),
        of("income_statement"),
        of("balance_sheet"),
        of("cash_flow"),
    )
