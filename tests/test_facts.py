"""Silver layer on hand-made rows."""

import hashlib

from conftest import plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerstrata.operators import dimensions, facts
from ledgerstrata.schemas import RAW_FINANCIALS


def raw_row(**changes):
    base = dict(
        cik="1",
        cik_padded="0000000001",
        company_name="One",
        concept="Assets",
        unit="USD",
        start_date=None,
        end_date="2023-12-31",
        value=100.0,
        accession_number="a-1",
        fiscal_year=2023,
        fiscal_period="FY",
        form="10-K",
        filed_date="2024-02-01",
        frame=None,
        statement_type="balance_sheet",
        year_quarter="2023-FY",
        has_null_critical=False,
        invalid_fiscal_year=False,
        data_quality_passed=True,
    )
    return {**base, **changes}


def raw(spark, *rows):
    names = RAW_FINANCIALS.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], RAW_FINANCIALS)


def values(df):
    return sorted(r.value for r in df.collect())


def test_latest_filing_wins(spark):
    df = raw(
        spark,
        raw_row(value=1.0, filed_date="2024-02-01"),
        raw_row(value=2.0, filed_date="2024-05-01", accession_number="a-2"),
        raw_row(value=3.0, filed_date=None, accession_number="a-3"),
        raw_row(value=4.0, filed_date="not a date", accession_number="a-4"),
    )
    (row,) = facts.build_fact_financials(df).collect()
    assert row.value == 2.0
    key = "0000000001" + "Assets" + "2023-12-31" + "a-2"
    assert row.fact_id == hashlib.md5(key.encode()).hexdigest()


def test_same_day_ties_are_settled(spark):
    rows = [
        raw_row(value=1.0, accession_number="a-1"),
        raw_row(value=2.0, accession_number="a-2", start_date="2023-01-01"),
        raw_row(value=3.0, accession_number="a-2", start_date="2023-10-01"),
        raw_row(value=4.0, accession_number="a-2", start_date="2023-10-01", unit="shares"),
        raw_row(value=5.0, accession_number="a-2", start_date="2023-10-01"),
    ]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        assert values(facts.build_fact_financials(raw(spark, *order))) == [5.0]
    per_unit = facts.build_fact_financials(raw(spark, *rows), extra_keys=["unit"])
    assert values(per_unit) == [4.0, 5.0]


def test_flagged_rows_stay_out_of_facts_but_not_of_submissions(spark):
    df = raw(
        spark,
        raw_row(),
        raw_row(value=None, has_null_critical=True, data_quality_passed=False),
        raw_row(concept="Cash", statement_type="other"),
        raw_row(fiscal_year=1800, invalid_fiscal_year=True, data_quality_passed=False),
    )
    assert facts.build_fact_financials(df).count() == 2
    rows = {r.fiscal_year: r for r in facts.build_fact_submissions(df).collect()}
    assert (rows[2023].concepts_reported, rows[2023].total_facts) == (2, 3)
    assert rows[2023].balance_sheet_facts == 2 and rows[2023].cash_flow_facts == 0
    assert rows[1800].total_facts == 1


def test_missing_period_end_gives_no_surrogate_key(spark):
    (row,) = facts.build_fact_financials(raw(spark, raw_row(end_date=None))).collect()
    assert row.fact_id is None and row.end_date is None


def test_deduplication_limits_rows_before_the_shuffle(spark):
    text = plan(facts.build_fact_financials(raw(spark, raw_row())))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange hashpartitioning") == 1
    lines = text.splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert "Partial" in lines[shuffle + 1]


def test_rows_in_ranges_are_shuffled_once(spark):
    rows = [
        raw_row(cik=str(i % 7), concept=("Assets", "Cash")[i % 2], fiscal_year=2020 + i % 3, value=float(i),
                accession_number=f"a{i % 11}", filed_date=f"2024-01-{i % 5 + 1:02d}")
        for i in range(200)
    ]
    df = raw(spark, *rows, *rows[:50], raw_row(end_date=None), raw_row(filed_date=None))
    for build in (facts.build_fact_financials, facts.build_fact_submissions):
        ranged = build(df, ranges=5)
        text = plan(ranged)
        exchanges = [line for line in text.splitlines() if "Exchange " in line]
        assert len(exchanges) == 1 and "rangepartitioning" in exchanges[0]
        assert "md5" not in text.split("Exchange ")[1]
        assert sorted(map(str, build(df).collect())) == sorted(map(str, ranged.collect()))
    # The deduplication leaves the rows in the order of the files.
    stored = facts.build_fact_financials(df, ranges=5).sortWithinPartitions(*facts.FACT_RANGES)
    assert plan(stored).count("Sort [") == 1


def test_company_dimension_keeps_companies_without_facts(spark):
    companies = spark.createDataFrame(
        [("1", "0000000001", "One", "ON", "NYSE"), ("2", "0000000002", "Two", None, None)],
        "cik string, cik_padded string, company_name string, ticker string, exchange string",
    )
    companies = companies.unionAll(companies)
    df = raw(
        spark,
        raw_row(),
        raw_row(fiscal_year=2020),
        raw_row(fiscal_year=2021, accession_number="a-2"),
    )
    rows = {r.cik: r for r in dimensions.build_dim_companies(companies, df).collect()}
    assert len(rows) == 2
    one, two = rows["0000000001"], rows["0000000002"]
    assert (one.first_filing_year, one.last_filing_year, one.total_filings) == (2020, 2023, 2)
    assert two.total_filings is None and two.sector is None

    info = spark.createDataFrame(
        [("0000000002", "6021", "National Banks", "TW", "CBOE")] * 2,
        "cik string, sic_code string, sic_description string, ticker string, exchange string",
    )
    rows = dimensions.build_dim_companies(companies, df, info).collect()
    assert len(rows) == 2
    two = next(r for r in rows if r.cik == "0000000002")
    assert (two.ticker, two.exchange) == ("TW", "CBOE")
    assert (two.sector, two.industry) == ("Finance, Insurance and Real Estate", "National Banks")

    sectors = spark.createDataFrame(
        [("6021", "Banks", "Money")], "sic_code string, industry string, sector string"
    )
    rows = dimensions.build_dim_companies(companies, df, info, sectors).collect()
    assert {(r.cik, r.sector) for r in rows} == {("0000000001", None), ("0000000002", "Money")}


def test_labels_and_dates(spark):
    df = raw(
        spark,
        raw_row(concept="NetIncomeLoss", end_date="2023-12-31"),
        raw_row(end_date="2024-02-29"),
        raw_row(end_date="2024-13-01"),
        raw_row(end_date=None),
    )
    labels = {r.concept: r.concept_label for r in dimensions.build_dim_taxonomy(df).collect()}
    assert labels == {"NetIncomeLoss": " Net Income Loss", "Assets": " Assets"}
    days = {str(r.date): r for r in dimensions.build_dim_dates(df).collect()}
    assert set(days) == {"2023-12-31", "2024-02-29"}
    sunday = days["2023-12-31"]
    assert (sunday.day_of_week, sunday.week_of_year, sunday.year_quarter) == (1, 52, "2023-Q4")
    assert days["2024-02-29"].year_month == "2024-02"


def test_hot_concept_is_counted_in_two_phases(spark):
    df = raw(spark, *[raw_row(cik=str(i % 5)) for i in range(50)])
    usage = dimensions.concept_usage(df)
    (row,) = usage.collect()
    assert (row.companies_using, row.total_usage_count) == (5, 50)
    text = plan(usage.select("companies_using"))
    # First by (concept, company), only then by concept.
    assert "hashpartitioning(concept" in text
    first = [line for line in text.splitlines() if "Exchange hashpartitioning(concept" in line][-1]
    assert "cik" in first


def test_dates_are_distinct_before_parsing(spark):
    df = raw(spark, *[raw_row() for _ in range(10)]).withColumn("x", F.lit(1))
    assert dimensions.build_dim_dates(df).count() == 1


reported = st.fixed_dictionaries(
    {
        "cik_padded": st.sampled_from(["1", "2"]),
        "concept": st.sampled_from(["Assets", "Revenues"]),
        "end_date": st.sampled_from(["2023-12-31", "2022-12-31", "bad", None]),
        "filed_date": st.sampled_from(["2024-02-01", "2024-05-01", None]),
        "accession_number": st.sampled_from(["a", "b"]),
        "start_date": st.sampled_from(["2023-01-01", "2023-10-01", None]),
        "unit": st.sampled_from(["USD", "shares"]),
        "value": st.integers(0, 3).map(float),
        "data_quality_passed": st.sampled_from([True, True, False]),
    }
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reported, min_size=1, max_size=40))
def test_latest_filing_matches_brute_force(spark, rows):
    def day(text):
        return None if text in (None, "bad") else text

    def rank(r):
        # Later is better; a missing date is worst. Unit ascending, value descending.
        late = lambda v: v or ""
        return (
            late(day(r["filed_date"])),
            r["accession_number"],
            late(r["start_date"]),
            r["unit"] == "USD",  # "USD" sorts before "shares"
            r["value"],
        )

    best = {}
    for r in rows:
        key = (r["cik_padded"], r["concept"], day(r["end_date"]))
        if r["data_quality_passed"] and (key not in best or rank(r) > rank(best[key])):
            best[key] = r
    df = raw(spark, *[raw_row(**r) for r in rows])
    got = facts.build_fact_financials(df).collect()
    assert len(got) == len(best)
    for row in got:
        want = best[row.cik, row.concept, row.end_date and str(row.end_date)]
        assert (row.value, row.unit, row.accession_number) == (
            want["value"],
            want["unit"],
            want["accession_number"],
        )
