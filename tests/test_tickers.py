import pytest

from ledgerstrata.plans import dashboards
from ledgerstrata.sources import with_tickers


def test_companies_that_share_a_ticker_all_stay(spark):
    companies = spark.createDataFrame(
        [("01", "A"), ("02", "B"), ("03", "C"), ("07", "A"), ("09", "D"), ("10", None)],
        "cik string, ticker string",
    )
    rows = companies.crossJoin(spark.range(2))
    for tickers in (["A"], ["A", "D"], ["C", "none"], ["none"], ["B", "A"]):
        got = with_tickers(rows, tickers, companies).collect()
        want = with_tickers(rows, tickers).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert {r.cik for r in with_tickers(rows, ["A"], companies).collect()} == {"01", "07"}


def test_pages_of_one_company_refuse_a_shared_ticker(spark):
    companies = spark.createDataFrame([("01", "A"), ("02", "B"), ("03", "A"), ("02", "B")], "cik string, ticker string")
    assert [r.cik for r in companies.where("cik = '02'").distinct().collect()] == ["02"]
    one = companies.where(companies.cik == dashboards.company_id(companies, "B"))
    assert {r.cik for r in one.collect()} == {"02"}
    none = companies.where(companies.cik == dashboards.company_id(companies, "Z"))
    assert none.collect() == []
    with pytest.raises(Exception, match="several companies; give a cik"):
        companies.where(companies.cik == dashboards.company_id(companies, "A")).collect()
