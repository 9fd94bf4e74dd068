"""Gold layer on hand-made rows and its invariants on the given tables."""

import datetime

import pytest
from conftest import plan
from pyspark.sql import functions as F

from ledgerstrata.operators import gold
from ledgerstrata.plans import dashboards, ratios, series
from ledgerstrata.schemas import (
    COMPANY_METRICS,
    DIM_COMPANIES,
    FACT_FINANCIALS,
    FINANCIAL_RATIOS,
    METRIC_CONCEPTS,
    TIMESERIES,
)
from ledgerstrata.testbed.workspace import workspace

SF = "/root/testdata/sf0.01"


def rows(spark, schema, *records):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def day(text):
    return datetime.date.fromisoformat(text) if text else None


def fact(concept="Assets", value=1.0, year=2023, period="FY", end="2023-12-31", filed="2024-02-01", **more):
    return dict(
        cik="1",
        concept=concept,
        value=value,
        fiscal_year=year,
        fiscal_period=period,
        end_date=day(end),
        filing_date=day(filed),
        unit="USD",
        accession_number="a",
        statement_type="balance_sheet",
        **more,
    )


def company(cik="1", name="One", **more):
    return dict(cik=cik, company_name=name, ticker="ON", sector="S", industry="I", **more)


def metrics_of(spark, facts, companies=None):
    return gold.company_metrics(
        rows(spark, FACT_FINANCIALS, *facts),
        rows(spark, DIM_COMPANIES, *(companies or [company()])),
    )


def test_latest_value_then_pivot(spark):
    (row,) = metrics_of(
        spark,
        [
            fact("Revenues", 10.0),
            fact("RevenueFromContractWithCustomerExcludingAssessedTax", 12.0),
            fact("Assets", 1.0, end="2022-12-31"),  # comparative in the same filing
            fact("Assets", 2.0, end="2023-12-31"),
            fact("Assets", 9.0, end="2021-12-31", filed="2023-02-01"),
            fact("Liabilities", 5.0, filed=None),
            fact("Liabilities", 4.0, filed="2020-01-01", end=None),
            fact("SomethingElse", 7.0),
        ],
    ).collect()
    assert row.revenue == 12.0  # the larger of the two revenue concepts
    assert row.total_assets == 2.0
    assert row.total_liabilities == 4.0  # any filing date beats none
    assert row.net_income is None


def test_period_with_unlisted_concepts_only_keeps_its_row(spark):
    (row,) = metrics_of(spark, [fact("SomethingElse", 7.0)]).collect()
    assert all(row[m] is None for m in METRIC_CONCEPTS)


def test_other_units_and_unknown_companies_drop_out(spark):
    other = {**fact("Assets", 3.0), "unit": "shares"}
    stranger = {**fact("Assets", 3.0), "cik": "2"}
    assert metrics_of(spark, [other, stranger]).count() == 0


def test_repeated_company_does_not_multiply_rows(spark):
    twice = [company(name="One"), company(name="One Inc")]
    (row,) = metrics_of(spark, [fact("Assets", 3.0)], twice).collect()
    assert row.company_name == "One"


def test_metrics_cross_the_network_once(spark):
    ws = workspace(spark, SF)
    text = plan(gold.company_metrics(ws.table("fact_financials"), ws.table("dim_companies")))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    by_facts = [e for e in exchanges if "fiscal_period" in e]
    assert len(by_facts) == 1
    # Number buffers keep the wide aggregation in the hash path.
    assert "HashAggregate(keys=[cik" in text
    assert not [x for x in text.splitlines() if "SortAggregate" in x and "fiscal_period" in x]
    assert "concept" not in by_facts[0]
    scan = next(line for line in text.splitlines() if "FileScan" in line and "concept" in line)
    assert "EqualTo(unit,USD)" in scan
    assert "fact_id" not in scan and "frame" not in scan


def test_zero_denominators_are_null(spark):
    one = dict(
        cik="1", fiscal_year=2023, fiscal_period="FY", revenue=0.0, net_income=0.0, gross_profit=5.0
    )
    one |= dict(current_assets=4.0, current_liabilities=0.0, total_assets=10.0)
    quarter = {**one, "fiscal_period": "Q4"}
    (row,) = gold.financial_ratios(rows(spark, COMPANY_METRICS, one, quarter)).collect()
    assert row.gross_margin_pct is None and row.net_profit_margin_pct is None
    assert row.current_ratio is None and row.quick_ratio is None
    assert row.return_on_assets_pct == 0.0 and row.asset_turnover == 0.0


def ratio_row(cik, sector, revenue, margin=None, year=2023):
    return dict(
        cik=cik, sector=sector, fiscal_year=year, revenue=revenue, net_profit_margin_pct=margin
    )


def test_peers(spark):
    df = rows(
        spark,
        FINANCIAL_RATIOS,
        ratio_row("a", "S", 1.0, 5.0),
        ratio_row("b", "S", 2.0, None),
        ratio_row("c", "S", 2.0, 7.0),
        ratio_row("d", "S", 9.0, 9.0),
        ratio_row("e", "T", 9.0, 1.0),
        ratio_row("f", None, 9.0, 1.0),
        ratio_row("a", "S", 1.0, 5.0, year=2022),
    )
    out = {(r.cik, r.fiscal_year): r for r in gold.peer_comparison(df).collect()}
    assert len(out) == 6 and ("f", 2023) not in out
    assert out["a", 2023].peer_count == 4 and out["a", 2022].peer_count == 1
    assert out["e", 2023].revenue_percentile == 0.0
    ranks = [out[c, 2023].revenue_percentile for c in "abcd"]
    assert ranks == pytest.approx([0, 100 / 3, 100 / 3, 100])
    margins = [out[c, 2023].net_margin_percentile for c in "abcd"]
    assert margins == pytest.approx([100 / 3, 0, 200 / 3, 100])  # NULL ranks lowest
    assert out["a", 2023].sector_avg_net_margin == pytest.approx(7.0)


def metric_row(year, period, revenue, cik="1", **more):
    return dict(cik=cik, fiscal_year=year, fiscal_period=period, revenue=revenue, **more)


def test_period_scopes(spark):
    history = [metric_row(2022, p, float(i)) for i, p in enumerate(["Q1", "Q2", "Q3", "Q4"], 1)]
    history += [metric_row(2022, "FY", 10.0), metric_row(2023, "FY", 20.0)]
    history += [metric_row(2023, p, i * 2.0) for i, p in enumerate(["Q1", "Q2", "Q3", "Q4"], 1)]
    df = rows(spark, COMPANY_METRICS, *history, metric_row(2023, "H1", 99.0))
    mixed = {(r.fiscal_year, r.fiscal_period): r for r in gold.timeseries(df).collect()}
    quarterly = {
        (r.fiscal_year, r.fiscal_period): r
        for r in gold.timeseries(df, period_scope="quarterly").collect()
    }
    assert len(mixed) == 10 and len(quarterly) == 8
    assert mixed[2023, "Q4"].ttm_revenue == quarterly[2023, "Q4"].ttm_revenue == 20.0
    assert mixed[2023, "Q1"].ttm_revenue == 2 + 20 + 4 + 3  # the full year is in the frame
    assert quarterly[2023, "Q1"].ttm_revenue == 2 + 4 + 3 + 2
    assert mixed[2022, "Q4"].revenue_yoy_prior == 10.0
    assert quarterly[2023, "Q2"].revenue_yoy_growth_pct == 100.0
    with pytest.raises(KeyError):
        gold.timeseries(df, period_scope="monthly")


def test_comparison_needs_the_exact_period(spark):
    df = rows(
        spark,
        COMPANY_METRICS,
        metric_row(2022, "Q1", 10.0),
        metric_row(2022, "Q4", 40.0),
        metric_row(2023, "Q1", 15.0),
        metric_row(2023, "Q3", 30.0),
    )

    def change(kind):
        out = dashboards.period_comparison(df, compare=kind).collect()
        return {(r.fiscal_year, r.fiscal_period): r.change_pct for r in out}

    assert change("QoQ")[2023, "Q1"] == -62.5 and change("QoQ")[2023, "Q3"] is None
    assert change("YoY")[2023, "Q1"] == 50.0 and change("YoY")[2022, "Q4"] is None


def test_negative_growth_base_has_no_rate(spark):
    def one(cik, a, b):
        base = dict(cik=cik, company_name=cik, ticker=cik, fiscal_period="FY")
        return [
            {**base, "fiscal_year": 2020, "revenue": 1e9, "net_income": a},
            {**base, "fiscal_year": 2023, "revenue": 8e9, "net_income": b},
        ]

    data = rows(spark, TIMESERIES, *one("up", 1e9, 8e9), *one("loss", -1e9, 8e9), *one("zero", 0.0, 1.0))
    out = {r.ticker: r for r in series.compound_growth(data).collect()}
    assert out["up"].net_income_cagr_3yr_pct == 100.0 == out["up"].revenue_cagr_3yr_pct
    assert out["loss"].net_income_cagr_3yr_pct is None
    assert out["zero"].net_income_cagr_3yr_pct is None


def test_recovery_status(spark):
    def one(cik, *revenues):
        return [
            dict(cik=cik, ticker=cik, fiscal_period="FY", fiscal_year=2019 + i, revenue=v)
            for i, v in enumerate(revenues)
        ]

    data = rows(
        spark,
        TIMESERIES,
        *one("plus", 1e9, 5e8, 6e8, 7e8, 2e9),
        *one("back", 1e9, 5e8, 6e8, 7e8, 1.05e9),
        *one("under", 1e9, 5e8, 6e8, 7e8, 9e8),
        *one("low", 1e9, 5e8, 6e8, 7e8, 4e8),
        *one("tiny", 1e7, 1e7, 1e7, 1e7, 1e7),
    )
    out = {r.ticker: r.recovery_status for r in series.recovery(data).collect()}
    assert out == {
        "plus": "Recovered+",
        "back": "Recovered",
        "under": "Recovering",
        "low": "Still Below Trough",
    }


# --- invariants on the given tables -----------------------------------------------


def test_trailing_sum_on_q4_is_the_full_year(spark):
    table = workspace(spark, SF).table("timeseries")
    q4 = table.where("fiscal_period = 'Q4'").select("cik", "fiscal_year", "ttm_revenue")
    full = table.where("fiscal_period = 'FY'").select("cik", "fiscal_year", "revenue")
    # Every fifth company amended each period by the same amount, the full year included.
    clean = F.col("cik").cast("int") % 5 != 0
    off = q4.where(clean).join(full, ["cik", "fiscal_year"]).where("ttm_revenue <> revenue")
    assert q4.count() > 0 and off.count() == 0


def test_percentiles_and_shares_are_bounded(spark):
    ws = workspace(spark, SF)
    peers = ws.table("peer_comparison")
    for name in gold.PERCENTILES:
        assert peers.where(~F.col(name).between(0, 100)).count() == 0
    shares = dashboards.market_share_stack(peers).groupBy("sector").agg(F.sum("share_pct").alias("s"))
    assert all(r.s == pytest.approx(100, abs=0.01) for r in shares.collect())


def test_latest_year_prunes_directories(spark):
    ws = workspace(spark, SF)
    text = plan(ratios.top_profit_margin(ws.table("financial_ratios")))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "fiscal_year" in scan.split("PartitionFilters:")[1].split("]")[0]
    assert "TakeOrderedAndProject" in text


def test_no_query_uses_a_cross_join(spark):
    from ledgerstrata.testbed import queries as registry

    for name, query in registry.queries().items():
        text = plan(query(spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
