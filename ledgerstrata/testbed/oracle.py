"""The same results in plain DuckDB SQL, written independently of the Spark code.

Shared steps are common table expressions; a query gets those it needs.
Engine differences handled here: NULL order is always explicit, division
guards its zero, rounding goes through a decimal, and concatenation uses
``||`` so that NULL propagates.
"""

from __future__ import annotations

import re

from ledgerstrata.schemas import METRIC_CONCEPTS, STATEMENTS, VALID_FORMS, VALID_UNITS
from ledgerstrata.testbed.filings import TICKERS, YEAR_SHIFT


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def rnd(x: str, digits: int) -> str:
    """Round the shortest decimal text of a double, half up, as Spark does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,16)), {digits}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF({b}, 0))"


def pct(a: str, b: str) -> str:
    return f"({div(a, b)} * 100)"


def _cell(concept: str, value: str, unit: str = "USD") -> str:
    return f"struct_pack(concept := '{concept}', unit := '{unit}', value := CAST({value} AS DOUBLE))"


_NET = "(60*c - 3*cd - 10*c - 2*ct - 2*opened - 60*returned)"
_CELLS = ",\n    ".join(
    [
        _cell("Revenues", "CASE WHEN k % 3 <> 0 THEN 100*c END"),
        _cell(
            "RevenueFromContractWithCustomerExcludingAssessedTax",
            "CASE WHEN k % 3 = 0 THEN 100*c END",
        ),
        _cell("CostOfRevenue", "40*c + 3*cd"),
        _cell("GrossProfit", "CASE WHEN k % 13 <> 0 THEN 60*c - 3*cd END"),
        _cell("OperatingExpenses", "10*c + 2*ct"),
        _cell("ResearchAndDevelopmentExpense", "ct"),
        _cell("SellingGeneralAndAdministrativeExpense", "5*c"),
        _cell("OperatingIncomeLoss", "60*c - 3*cd - 10*c - 2*ct"),
        _cell("InterestExpense", "2*opened"),
        _cell("IncomeTaxExpenseBenefit", "cd"),
        _cell("NetIncomeLoss", _NET),
        _cell("Assets", "150*c"),
        _cell("AssetsCurrent", "cq"),
        _cell("CashAndCashEquivalentsAtCarryingValue", "2*cd"),
        _cell("AccountsReceivableNetCurrent", "20*filled"),
        _cell("InventoryNet", "CASE WHEN k % 7 <> 0 THEN 20*fresh END"),
        _cell("Liabilities", "60*c + 8*cd"),
        _cell("LiabilitiesCurrent", "CASE WHEN k % 17 = 0 THEN 0 ELSE 60*accepted END"),
        _cell("LongTermDebtNoncurrent", "10*c + cd"),
        _cell("StockholdersEquity", "150*c - 60*c - 8*cd - 60*returned"),
        _cell("NetCashProvidedByUsedInOperatingActivities", f"{_NET} + ct + cd"),
        _cell("NetCashProvidedByUsedInInvestingActivities", "-cd"),
        _cell("NetCashProvidedByUsedInFinancingActivities", "-ct"),
        _cell("PaymentsToAcquirePropertyPlantAndEquipment", "cd"),
        _cell("OtherThing", "q", "shares"),
    ]
)
_SUMS = ("c", "cd", "ct", "cq", "q", "returned", "accepted", "fresh", "opened", "filled")
_TICKER_CASE = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TICKERS))


def _copy(n: int, concepts, suffix: str, **changes: str) -> str:
    columns = {
        "unit": "unit",
        "value": "value",
        "fiscal_year": "fiscal_year",
        "form": "form",
        "filed_date": "filed_date",
        **changes,
    }
    return f"""SELECT cik, company_name, concept, {columns['unit']} AS unit, end_date,
      CAST({columns['value']} AS DOUBLE) AS value, accession_number || '{suffix}' AS accession_number,
      CAST({columns['fiscal_year']} AS INTEGER) AS fiscal_year, fiscal_period, {columns['form']} AS form,
      {columns['filed_date']} AS filed_date, frame
    FROM clean WHERE k % {n} = 0 AND concept IN {_in(concepts)}"""


_AMENDED = (
    "Revenues",
    "RevenueFromContractWithCustomerExcludingAssessedTax",
    "Assets",
)
_STATEMENT_CASE = " ".join(
    f"WHEN concept IN {_in(concepts)} THEN '{name}'" for name, concepts in STATEMENTS.items()
)
_PIVOT = ",\n    ".join(
    f"max(CASE WHEN concept IN {_in(concepts)} THEN value END) AS {name}"
    for name, concepts in METRIC_CONCEPTS.items()
)
_IDS = "cik, company_name, ticker, sector, industry"

PROFITABILITY = {
    "gross_margin_pct": pct("gross_profit", "revenue"),
    "operating_margin_pct": pct("operating_income", "revenue"),
    "net_profit_margin_pct": pct("net_income", "revenue"),
    "return_on_assets_pct": pct("net_income", "total_assets"),
    "return_on_equity_pct": pct("net_income", "stockholders_equity"),
}
LIQUIDITY = {
    "current_ratio": div("current_assets", "current_liabilities"),
    "quick_ratio": div("current_assets - inventory", "current_liabilities"),
    "cash_ratio": div("cash_and_equivalents", "current_liabilities"),
}
LEVERAGE = {
    "debt_to_assets_pct": pct("total_liabilities", "total_assets"),
    "debt_to_equity_ratio": div("total_liabilities", "stockholders_equity"),
    "long_term_debt_to_equity": div("long_term_debt", "stockholders_equity"),
}
EFFICIENCY = {
    "asset_turnover": div("revenue", "total_assets"),
    "receivables_turnover": div("revenue", "accounts_receivable"),
}
OPERATING = {
    "operating_expense_ratio_pct": pct("operating_expenses", "revenue"),
    "rd_intensity_pct": pct("research_and_development", "revenue"),
}
CASH_FLOW = {
    "operating_cash_flow_ratio": div("operating_cash_flow", "net_income"),
    "free_cash_flow_ratio": div("operating_cash_flow - capital_expenditures", "net_income"),
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


_AVERAGES = {
    "sector_avg_gross_margin": "gross_margin_pct",
    "sector_avg_operating_margin": "operating_margin_pct",
    "sector_avg_net_margin": "net_profit_margin_pct",
    "sector_avg_roe": "return_on_equity_pct",
}
_PERCENTILES = {
    "gross_margin_percentile": "gross_margin_pct",
    "operating_margin_percentile": "operating_margin_pct",
    "net_margin_percentile": "net_profit_margin_pct",
    "roe_percentile": "return_on_equity_pct",
    "revenue_percentile": "revenue",
}
_AVG_SQL = ", ".join(
    f"avg({src}) OVER (PARTITION BY sector, fiscal_year) AS {name}" for name, src in _AVERAGES.items()
)
_RANK_SQL = ", ".join(
    f"percent_rank() OVER (PARTITION BY sector, fiscal_year ORDER BY {src} NULLS FIRST) * 100 AS {name}"
    for name, src in _PERCENTILES.items()
)
_W = "(PARTITION BY cik ORDER BY fiscal_year, fiscal_period)"
_W4 = "(PARTITION BY cik ORDER BY fiscal_year, fiscal_period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
TRAILING = {
    "ttm_revenue": f"sum(revenue) OVER {_W4}",
    "ttm_net_income": f"sum(net_income) OVER {_W4}",
}
GROWTH = {
    "revenue_yoy_prior": f"lag(revenue, 4) OVER {_W}",
    "revenue_yoy_growth_pct": pct(
        f"revenue - lag(revenue, 4) OVER {_W}", f"lag(revenue, 4) OVER {_W}"
    ),
    "net_income_yoy_growth_pct": pct(
        f"net_income - lag(net_income, 4) OVER {_W}", f"lag(net_income, 4) OVER {_W}"
    ),
}
MOVING = {
    "revenue_4q_avg": f"avg(revenue) OVER {_W4}",
    "net_income_4q_avg": f"avg(net_income) OVER {_W4}",
}


def _series(periods: str) -> str:
    return f"""SELECT cik, company_name, ticker, fiscal_year, fiscal_period, revenue, net_income,
      operating_cash_flow, total_assets, {_select({**TRAILING, **GROWTH, **MOVING})}
    FROM metrics WHERE fiscal_period IN {periods}"""


_Q = "('Q1', 'Q2', 'Q3', 'Q4')"

CTES = {
    "item": f"""SELECT l_suppkey AS k, CAST(year(l_shipdate) + {YEAR_SHIFT} AS INTEGER) AS fiscal_year,
      'Q' || quarter(l_shipdate) AS fiscal_period,
      CAST(round(l_extendedprice * 100) AS BIGINT) AS c, CAST(round(l_discount * 100) AS BIGINT) AS d,
      CAST(round(l_tax * 100) AS BIGINT) AS t, CAST(l_quantity AS BIGINT) AS q,
      l_returnflag AS rf, l_linestatus AS ls
    FROM lineitem""",
    "quarter_sums": """SELECT k, fiscal_year, fiscal_period, sum(c) AS c, sum(c*d) AS cd, sum(c*t) AS ct,
      sum(c*q) AS cq, sum(q) AS q,
      sum(CASE WHEN rf = 'R' THEN c ELSE 0 END) AS returned,
      sum(CASE WHEN rf = 'A' THEN c ELSE 0 END) AS accepted,
      sum(CASE WHEN rf = 'N' THEN c ELSE 0 END) AS fresh,
      sum(CASE WHEN ls = 'O' THEN c ELSE 0 END) AS opened,
      sum(CASE WHEN ls = 'F' THEN c ELSE 0 END) AS filled
    FROM item GROUP BY k, fiscal_year, fiscal_period""",
    "period_sums": f"""SELECT k, fiscal_year, fiscal_period, {', '.join(_SUMS)} FROM quarter_sums
    UNION ALL SELECT k, fiscal_year, 'FY', {', '.join(f'sum({s})' for s in _SUMS)}
    FROM quarter_sums GROUP BY k, fiscal_year""",
    "company": f"""SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS cik, s_name AS company_name,
      CASE s_suppkey {_TICKER_CASE} ELSE 'S' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') END AS ticker,
      r_name AS exchange, lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS sic_code,
      n_name AS industry, r_name AS sector
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dated": """SELECT p.*, co.cik, co.company_name,
      last_day(make_date(p.fiscal_year,
        CASE WHEN fiscal_period = 'FY' THEN 12 ELSE 3 * CAST(substr(fiscal_period, 2, 1) AS INTEGER) END, 1)) AS closing
    FROM period_sums p JOIN company co USING (k)""",
    "clean": f"""SELECT k, cik, company_name, cell.concept AS concept, cell.unit AS unit,
      CAST(closing AS VARCHAR) AS end_date, cell.value AS value,
      lpad(cik, 10, '0') || '-' || fiscal_year || '-' || fiscal_period AS accession_number,
      fiscal_year, fiscal_period,
      CASE WHEN fiscal_period IN ('Q4', 'FY') THEN '10-K' ELSE '10-Q' END AS form,
      CAST(CAST(closing + CAST(30 + k % 20 AS INTEGER) AS DATE) AS VARCHAR) AS filed_date,
      CASE WHEN fiscal_period <> 'FY' THEN 'CY' || fiscal_year || fiscal_period END AS frame
    FROM (SELECT *, unnest([{_CELLS}]) AS cell FROM dated) WHERE cell.value IS NOT NULL""",
    "reported": "SELECT * EXCLUDE (k) FROM clean UNION ALL "
    + " UNION ALL ".join(
        [
            _copy(
                5,
                _AMENDED,
                "-A",
                value="value + 1000000",
                filed_date="CAST(CAST(CAST(filed_date AS DATE) + 90 AS DATE) AS VARCHAR)",
            ),
            _copy(11, ["Assets"], "-E", unit="'EUR'"),
            _copy(6, ["Assets"], "-S", form="'S-1'"),
            _copy(9, ["Liabilities"], "-N", fiscal_year="NULL"),
            _copy(10, ["Liabilities"], "-Y", fiscal_year="1800"),
            _copy(8, ["InterestExpense"], "-V", value="NULL"),
        ]
    ),
    "flagged": f"""SELECT *, lpad(cik, 10, '0') AS cik_padded,
      fiscal_year || '-' || fiscal_period AS year_quarter,
      CASE {_STATEMENT_CASE} ELSE 'other' END AS statement_type,
      (cik IS NULL OR concept IS NULL OR value IS NULL OR fiscal_year IS NULL) AS has_null_critical,
      coalesce(fiscal_year < 1900 OR fiscal_year > 2100, false) AS invalid_fiscal_year
    FROM reported""",
    "raw": f"""SELECT *, NOT has_null_critical AND NOT invalid_fiscal_year AS data_quality_passed
    FROM flagged WHERE unit IN {_in(VALID_UNITS)} AND form IN {_in(VALID_FORMS)}""",
    "passed": "SELECT * FROM raw WHERE data_quality_passed",
    "stats": """SELECT cik_padded AS cik, min(fiscal_year) AS first_filing_year,
      max(fiscal_year) AS last_filing_year, count(DISTINCT accession_number) AS total_filings
    FROM passed GROUP BY cik_padded""",
    "companies": """SELECT lpad(co.cik, 10, '0') AS cik, company_name, ticker, exchange, sic_code, industry, sector,
      first_filing_year, last_filing_year, total_filings
    FROM company co LEFT JOIN stats s ON s.cik = lpad(co.cik, 10, '0')
    WHERE co.cik IN (SELECT cik FROM reported)""",
    "taxonomy": r"""SELECT b.*, companies_using, total_usage_count, first_used_year, last_used_year FROM
      (SELECT DISTINCT concept, statement_type, regexp_replace(concept, '([A-Z])', ' \1', 'g') AS concept_label,
         'monetary' AS data_type, 'duration' AS period_type, CAST(NULL AS VARCHAR) AS balance_type FROM passed) b
      LEFT JOIN (SELECT concept, count(DISTINCT cik) AS companies_using, count(*) AS total_usage_count,
         min(fiscal_year) AS first_used_year, max(fiscal_year) AS last_used_year FROM passed GROUP BY concept) u
      USING (concept)""",
    "dates": """SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
      CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
      CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
      year(date) || '-Q' || quarter(date) AS year_quarter, strftime(date, '%Y-%m') AS year_month
    FROM (SELECT DISTINCT CAST(end_date AS DATE) AS date FROM passed WHERE end_date IS NOT NULL)""",
    "shaped": """SELECT md5(cik_padded || concept || end_date || accession_number) AS fact_id, cik_padded AS cik,
      concept, CAST(end_date AS DATE) AS end_date, CAST(filed_date AS DATE) AS filing_date, fiscal_year,
      fiscal_period, year_quarter, form, accession_number, value, unit, statement_type, frame
    FROM passed""",
    "facts": """SELECT * FROM shaped QUALIFY row_number() OVER (
      PARTITION BY cik, concept, end_date, fiscal_year, fiscal_period
      ORDER BY filing_date DESC NULLS LAST, accession_number DESC NULLS LAST, unit, value DESC NULLS LAST) = 1""",
    "submissions": """SELECT cik_padded AS cik, accession_number, form, CAST(filed_date AS DATE) AS filing_date,
      fiscal_year, fiscal_period, count(DISTINCT concept) AS concepts_reported, count(*) AS total_facts,
      count(*) FILTER (WHERE statement_type = 'income_statement') AS income_statement_facts,
      count(*) FILTER (WHERE statement_type = 'balance_sheet') AS balance_sheet_facts,
      count(*) FILTER (WHERE statement_type = 'cash_flow') AS cash_flow_facts
    FROM raw GROUP BY ALL""",
    "latest": f"""SELECT {_IDS.replace('cik', 'f.cik', 1)}, f.fiscal_year, f.fiscal_period, f.concept, f.value, f.unit,
      f.statement_type
    FROM facts f JOIN companies c ON f.cik = c.cik WHERE f.unit = 'USD'
    QUALIFY row_number() OVER (PARTITION BY f.cik, f.concept, f.fiscal_year, f.fiscal_period
      ORDER BY f.filing_date DESC NULLS LAST, f.end_date DESC NULLS LAST, f.accession_number DESC NULLS LAST) = 1""",
    "metrics": f"""SELECT {_IDS}, fiscal_year, fiscal_period, {_PIVOT}
    FROM latest GROUP BY {_IDS}, fiscal_year, fiscal_period""",
    "annual": "SELECT * FROM metrics WHERE fiscal_period = 'FY'",
    "ratios": f"""SELECT {_IDS}, fiscal_year, fiscal_period,
      {_select({**PROFITABILITY, **LIQUIDITY, **LEVERAGE, **EFFICIENCY, **OPERATING, **CASH_FLOW})},
      revenue, net_income, total_assets, stockholders_equity, operating_cash_flow, current_liabilities
    FROM annual""",
    "peers": f"""SELECT {_IDS}, fiscal_year, gross_margin_pct, operating_margin_pct, net_profit_margin_pct,
      return_on_assets_pct, return_on_equity_pct, current_ratio, debt_to_equity_ratio, revenue,
      {_AVG_SQL}, {_RANK_SQL}, count(*) OVER (PARTITION BY sector, fiscal_year) AS peer_count
    FROM ratios WHERE sector IS NOT NULL""",
    "series": _series("('Q1', 'Q2', 'Q3', 'Q4', 'FY')"),
    "series_q": _series(_Q),
    "grown": f"""SELECT r.*, {pct('r.revenue - p.revenue', 'p.revenue')} AS revenue_growth_pct
    FROM ratios r LEFT JOIN ratios p ON p.cik = r.cik AND p.fiscal_year = r.fiscal_year - 1""",
}


def with_ctes(sql: str) -> str:
    """Prefix the common table expressions a statement uses, directly or not."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS (\n    {CTES[name]})" for name in CTES if name in needed)
    return f"WITH {parts}\n{sql}"


def _all_but(table: str, columns, digits: int = 6) -> str:
    changed = ", ".join(f"{rnd(c, digits)} AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changed}) FROM {table}"


_ORACLE: dict[str, str] = {}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in _ORACLE.items()}


# --- A ---------------------------------------------------------------------------
_DOCS = """SELECT cik, company_name, CAST(count(DISTINCT concept) AS INTEGER) AS concepts,
  CAST(count(DISTINCT CASE WHEN concept = 'Assets' THEN unit END) AS INTEGER) AS asset_units
FROM reported GROUP BY cik, company_name"""
_ORACLE["a1_read_documents"] = _DOCS
_ORACLE["a2_read_archive"] = _DOCS
# Every seventh document comes again, cut off; of the archives one is damaged as a whole.
_BROKEN = "count(DISTINCT CASE WHEN CAST(cik AS BIGINT) % 7 = 3 THEN cik END)"
_ORACLE["a2_archive_members"] = f"SELECT count(DISTINCT cik) + {_BROKEN} AS members FROM reported"
_ORACLE["a1_rejected_documents"] = f"""SELECT count(DISTINCT cik) + {_BROKEN} AS documents,
  count(DISTINCT cik) AS with_id, {_BROKEN} AS rejected FROM reported"""
_ORACLE["a2_rejected_members"] = f"""SELECT count(DISTINCT cik) + {_BROKEN} + 1 AS documents,
  count(DISTINCT cik) AS with_id, {_BROKEN} + 1 AS rejected FROM reported"""
_ORACLE["a3_flatten_facts"] = "SELECT * FROM reported"
_ORACLE["a4_company_info"] = """SELECT cik, lpad(cik, 10, '0') AS cik_padded, company_name, ticker, exchange
FROM company WHERE cik IN (SELECT cik FROM reported)"""
_ORACLE["a4_submission_info"] = (
    "SELECT lpad(cik, 10, '0') AS cik, sic_code, ticker, exchange FROM company "
    "UNION ALL SELECT lpad(cik, 10, '0'), NULL, NULL, NULL FROM company WHERE CAST(cik AS BIGINT) % 4 = 1"
)
_ORACLE["a5_table_scan"] = """SELECT cik, fiscal_period, end_date, value FROM facts
WHERE fiscal_year = 2023 AND concept = 'Assets'"""
_ORACLE["a6_bulk_layout"] = """SELECT 'bulk' AS layout, CAST(2024 AS INTEGER) AS layout_year,
  count(DISTINCT cik) AS documents FROM reported"""
_ORACLE["a6_filing_paths"] = """SELECT DISTINCT 'lake/filings/' || cik || '/' || accession_number || '/facts.json' AS path,
  'filings' AS layout, CAST(NULL AS INTEGER) AS layout_year, CAST(NULL AS DATE) AS index_date,
  cik AS layout_cik, accession_number AS layout_accession, 'facts.json' AS file_name FROM submissions
UNION ALL SELECT DISTINCT 'lake/daily-index/' || strftime(filing_date, '%Y/%m/%d') || '/form.idx',
  'daily-index', CAST(year(filing_date) AS INTEGER), filing_date, NULL, NULL, 'form.idx' FROM submissions"""

_ORACLE["a6_daily_index"] = """SELECT 'daily-index' AS layout, CAST(year(filing_date) AS INTEGER) AS layout_year,
  filing_date AS index_date, 'form.idx' AS file_name, count(*) AS filings,
  min(cik || '|' || accession_number) AS first_line
FROM submissions WHERE filing_date IS NOT NULL GROUP BY filing_date"""

# --- B ---------------------------------------------------------------------------
_ORACLE["b1_write_append"] = (
    "SELECT cik, ticker FROM companies UNION ALL SELECT cik, ticker FROM companies"
)
_ORACLE["b2_partitioned_clustered_write"] = """SELECT fiscal_year AS directory, fiscal_year, concept,
  count(*) AS n, sum(value) AS total, CAST(0 AS BIGINT) AS out_of_order FROM facts GROUP BY ALL"""
_ORACLE["b2_files_by_range"] = """SELECT CAST(fiscal_year AS INTEGER) AS fiscal_year, count(*) AS n,
  true AS several_files, CAST(0 AS BIGINT) AS overlapping FROM facts GROUP BY 1"""
_ORACLE["b3_year_buckets"] = """SELECT CASE WHEN fiscal_year BETWEEN 2000 AND 2030
    THEN CAST(fiscal_year AS VARCHAR) ELSE '__HIVE_DEFAULT_PARTITION__' END AS directory,
  count(*) AS rows, count(DISTINCT fiscal_year) AS years FROM raw GROUP BY ALL"""


def _refreshed(view: str, cte: str, fresh: str, kept: str) -> str:
    """Rows of the refreshed years are true, the others still one too high; the emptied year is gone."""
    return f"""SELECT *, '{view}' AS view_id, sum(row_count) OVER () AS reported_rows,
  'success' AS refresh_status FROM (
  SELECT CAST(fiscal_year AS INTEGER) AS fiscal_year, count(*) AS row_count,
    sum(CASE WHEN {fresh} THEN revenue ELSE revenue + 1 END) AS revenue
  FROM {cte} WHERE {kept} GROUP BY 1
  {{extra}})"""


_ORACLE["b4_refresh_company_metrics"] = _refreshed(
    "company_metrics", "metrics", "fiscal_year IN (2022, 2023)", "true"
).format(extra="")
# The emptied year lies before the first refreshed one, so the time series keeps it.
_ORACLE["b4_refresh_timeseries"] = _refreshed("timeseries", "series", "fiscal_year >= 2022", "true").format(
    extra="""UNION ALL SELECT CAST(2009 AS INTEGER), count(*), sum(revenue)
  FROM series WHERE fiscal_year = 2022"""
)
_ORACLE["b4_published_refresh"] = """SELECT CAST(fiscal_year AS INTEGER) AS fiscal_year,
  fiscal_year = 2020 OR fiscal_year IN (SELECT fiscal_year FROM (
    SELECT fiscal_year, row_number() OVER (PARTITION BY cik ORDER BY fiscal_year, fiscal_period) AS place
    FROM metrics WHERE fiscal_year > 2020 AND cik IN (
      SELECT cik FROM facts WHERE fiscal_year = 2020 AND cik LIKE '%3')) WHERE place <= 4) AS switched,
  count(*) AS n, sum(revenue) AS revenue, sum(ttm_revenue) AS ttm_revenue FROM (
  SELECT fiscal_year, revenue, sum(revenue) OVER (PARTITION BY cik ORDER BY fiscal_year, fiscal_period
    ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS ttm_revenue FROM (
    SELECT * REPLACE (CASE WHEN cik LIKE '%3' AND fiscal_year = 2020 THEN revenue * 3 ELSE revenue END AS revenue)
    FROM metrics)) GROUP BY 1, 2"""
_ORACLE["e5_late_filings"] = """SELECT concept, fiscal_year, count(*) AS n,
  sum(CASE WHEN fiscal_year = 2022 AND concept = 'Assets' THEN value + 1 ELSE value END) AS total
FROM facts GROUP BY concept, fiscal_year"""
_ORACLE["b5_table_sizes"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
    for name, cte in {
        "raw_financials": "raw",
        "dim_companies": "companies",
        "dim_taxonomy": "taxonomy",
        "dim_dates": "dates",
        "fact_financials": "facts",
        "fact_submissions": "submissions",
        "company_metrics": "metrics",
        "financial_ratios": "ratios",
        "peer_comparison": "peers",
        "timeseries": "series",
    }.items()
) + " UNION ALL SELECT 'raw_companies', count(DISTINCT cik) FROM reported"

# --- C ---------------------------------------------------------------------------
_ORACLE["c1_valid_units"] = (
    f"SELECT unit, count(*) AS n FROM reported WHERE unit IN {_in(VALID_UNITS)} GROUP BY unit"
)
_ORACLE["c2_valid_forms"] = (
    f"SELECT form, count(*) AS n FROM reported WHERE form IN {_in(VALID_FORMS)} GROUP BY form"
)
_ORACLE["c3_padded_cik"] = "SELECT cik, cik_padded, count(*) AS n FROM flagged GROUP BY ALL"
_ORACLE["c4_year_quarter"] = (
    "SELECT fiscal_year, fiscal_period, year_quarter, count(*) AS n FROM flagged GROUP BY ALL"
)
_ORACLE["c5_categorize_concepts"] = (
    "SELECT concept, statement_type, count(*) AS n FROM flagged GROUP BY ALL"
)
_ORACLE["c6_null_critical"] = (
    "SELECT concept, has_null_critical, count(*) AS n FROM flagged GROUP BY ALL"
)
_ORACLE["c7_invalid_year"] = (
    "SELECT fiscal_year, invalid_fiscal_year, count(*) AS n FROM flagged GROUP BY ALL"
)
_ORACLE["c8_quality_passed"] = """SELECT has_null_critical, invalid_fiscal_year,
  NOT has_null_critical AND NOT invalid_fiscal_year AS data_quality_passed, count(*) AS n FROM flagged GROUP BY ALL"""
_ORACLE["c9_quality_metrics"] = f"""SELECT count(*) AS total_count,
  count(*) FILTER (WHERE data_quality_passed) AS passed_count,
  {rnd('count(*) FILTER (WHERE data_quality_passed) * 100.0 / count(*)', 4)} AS pass_rate_pct FROM raw"""
_LISTED = ", ".join(
    f"('{c}', '{name}')" for name, concepts in STATEMENTS.items() for c in concepts
)
_ORACLE["c10_taxonomy_concepts"] = f"""SELECT l.concept, l.statement_type, count(r.concept) AS uses
FROM (VALUES {_LISTED}) l(concept, statement_type) LEFT JOIN raw r ON r.concept = l.concept GROUP BY ALL"""
_ORACLE["c_raw_financials"] = "SELECT * FROM raw"

# --- D ---------------------------------------------------------------------------
_ORACLE["d1_company_base"] = "SELECT cik, company_name, ticker, exchange FROM companies"
_ORACLE["d2_filing_stats"] = "SELECT * FROM stats"
_ORACLE["d3_dim_companies"] = """SELECT cik, company_name, ticker, exchange, CAST(NULL AS VARCHAR) AS sic_code,
  CAST(NULL AS VARCHAR) AS industry, CAST(NULL AS VARCHAR) AS sector, first_filing_year, last_filing_year,
  total_filings FROM companies"""
_ORACLE["d4_sector_enrichment"] = "SELECT * FROM companies"
_ORACLE["d4_sic_division"] = """SELECT cik, code AS sic_code, CASE
  WHEN CAST(code AS INTEGER) BETWEEN 100 AND 999 THEN 'Agriculture, Forestry and Fishing'
  WHEN CAST(code AS INTEGER) BETWEEN 1000 AND 1499 THEN 'Mining'
  WHEN CAST(code AS INTEGER) BETWEEN 1500 AND 1799 THEN 'Construction'
  WHEN CAST(code AS INTEGER) BETWEEN 2000 AND 3999 THEN 'Manufacturing'
  WHEN CAST(code AS INTEGER) BETWEEN 4000 AND 4999 THEN 'Transportation and Public Utilities'
  WHEN CAST(code AS INTEGER) BETWEEN 5000 AND 5199 THEN 'Wholesale Trade'
  WHEN CAST(code AS INTEGER) BETWEEN 5200 AND 5999 THEN 'Retail Trade'
  WHEN CAST(code AS INTEGER) BETWEEN 6000 AND 6799 THEN 'Finance, Insurance and Real Estate'
  WHEN CAST(code AS INTEGER) BETWEEN 7000 AND 8999 THEN 'Services'
  WHEN CAST(code AS INTEGER) BETWEEN 9100 AND 9729 THEN 'Public Administration' END AS sector
FROM (SELECT cik, lpad(CAST(CAST(sic_code AS INTEGER) * 400 AS VARCHAR), 4, '0') AS code FROM companies)"""
_ORACLE["d5_taxonomy_base"] = """SELECT concept, statement_type, concept_label, data_type, period_type, balance_type
FROM taxonomy"""
_ORACLE["d6_dim_taxonomy"] = "SELECT * FROM taxonomy"
_ORACLE["d7_dim_dates"] = "SELECT * FROM dates"

# --- E ---------------------------------------------------------------------------
_ORACLE["e1_passed_only"] = "SELECT concept, count(*) AS n, sum(value) AS total FROM passed GROUP BY ALL"
_ORACLE["e2_shape_facts"] = (
    "SELECT end_date, filing_date, count(*) AS n, sum(value) AS total FROM shaped GROUP BY ALL"
)
_ORACLE["e3_fact_ids"] = """SELECT cik, count(DISTINCT fact_id) AS ids, min(fact_id) AS first_id,
  max(fact_id) AS last_id FROM shaped GROUP BY cik"""
_ORACLE["e4_latest_filing"] = """SELECT concept, fiscal_year, fiscal_period, count(*) AS n, sum(value) AS total
FROM facts GROUP BY ALL"""
_ORACLE["e4_latest_filing_per_unit"] = """SELECT concept, unit, count(*) AS n, sum(value) AS total FROM (
  SELECT * FROM shaped QUALIFY row_number() OVER (
    PARTITION BY cik, concept, end_date, fiscal_year, fiscal_period, unit
    ORDER BY filing_date DESC, accession_number DESC, value DESC) = 1) GROUP BY ALL"""
_ORACLE["e5_fact_financials"] = "SELECT * FROM facts"
_ORACLE["e6_fact_submissions"] = "SELECT * FROM submissions"

# --- F ---------------------------------------------------------------------------
_ORACLE["f1_latest_facts"] = """SELECT sector, concept, fiscal_year, fiscal_period, count(*) AS n, sum(value) AS total
FROM latest GROUP BY ALL"""
_ORACLE["f2_company_metrics"] = "SELECT * FROM metrics"
for _name, _group in {
    "f3_profitability": PROFITABILITY,
    "f4_liquidity": LIQUIDITY,
    "f5_leverage": LEVERAGE,
    "f6_efficiency": EFFICIENCY,
    "f7_operating": OPERATING,
    "f8_cash_flow": CASH_FLOW,
}.items():
    _ORACLE[_name] = f"SELECT cik, fiscal_year, {_select(_group)} FROM annual"
_ORACLE["f9_financial_ratios"] = "SELECT * FROM ratios"
_ORACLE["f10_sector_averages"] = "SELECT cik, fiscal_year, " + ", ".join(
    f"{rnd(c, 6)} AS {c}" for c in _AVERAGES
) + " FROM peers"
_ORACLE["f11_sector_percentiles"] = (
    f"SELECT sector, fiscal_year, cik, {', '.join(_PERCENTILES)} FROM peers"
)
_ORACLE["f12_peer_count"] = "SELECT cik, fiscal_year, peer_count FROM peers"
_ORACLE["f13_peer_comparison"] = _all_but("peers", _AVERAGES)
for _name, _group in {
    "f14_trailing_sums": TRAILING,
    "f15_yearly_growth": GROWTH,
    "f16_moving_averages": MOVING,
}.items():
    _ORACLE[_name] = f"SELECT cik, fiscal_year, fiscal_period, {', '.join(_group)} FROM series"
_ORACLE["f17_timeseries"] = "SELECT * FROM series"
_ORACLE["f2_metrics_from_buckets"] = "SELECT * FROM metrics"
_ORACLE["f17_timeseries_from_buckets"] = "SELECT * FROM series"
_ORACLE["f17_timeseries_quarterly"] = "SELECT * FROM series_q"


# --- G ---------------------------------------------------------------------------
def _g1(min_revenue: str) -> str:
    return f"""SELECT company_name, ticker, fiscal_year, net_profit_margin_pct, revenue, net_income,
  return_on_equity_pct FROM ratios
WHERE fiscal_year = (SELECT max(fiscal_year) FROM ratios) AND revenue > {min_revenue}
  AND net_profit_margin_pct IS NOT NULL
ORDER BY net_profit_margin_pct DESC, cik LIMIT 25"""


_ORACLE["g1_top_profit_margin"] = _g1("1e9")
_ORACLE["g1_top_profit_margin_selective"] = _g1("4.5e10")
_ORACLE["g2_top_roe_by_sector"] = """SELECT sector, company_name, ticker, fiscal_year, return_on_equity_pct,
  net_profit_margin_pct, debt_to_equity_ratio FROM ratios
WHERE fiscal_year = 2023 AND sector IS NOT NULL AND return_on_equity_pct > 0
QUALIFY row_number() OVER (PARTITION BY sector ORDER BY return_on_equity_pct DESC, cik) <= 5"""
_ORACLE["g3_weak_liquidity"] = """SELECT company_name, ticker, sector, fiscal_year, current_ratio, quick_ratio,
  cash_ratio, current_liabilities AS current_liabilities_usd FROM ratios
WHERE fiscal_year >= 2020 AND current_ratio < 1.0
QUALIFY row_number() OVER (ORDER BY current_ratio, fiscal_year DESC, cik) <= 100"""
_ORACLE["g4_revenue_cagr"] = f"""SELECT company_name, ticker, a AS revenue_2020, b AS revenue_2023,
  b - a AS revenue_growth_absolute, rate AS revenue_cagr_3yr_pct FROM (
  SELECT *, {rnd('pow(b / a, CAST(1 AS DOUBLE) / 3) - 1', 4)} * 100 AS rate FROM (
    SELECT cik, company_name, ticker, min(CASE WHEN fiscal_year = 2020 THEN revenue END) AS a,
      max(CASE WHEN fiscal_year = 2023 THEN revenue END) AS b, count(DISTINCT fiscal_year) AS years
    FROM ratios WHERE fiscal_year BETWEEN 2020 AND 2023 GROUP BY cik, company_name, ticker)
  WHERE years >= 3 AND a > 0 AND b > a)
ORDER BY rate DESC, cik LIMIT 50"""


def _g5(equity: str, assets: str) -> str:
    return f"""SELECT company_name, ticker, sector, fiscal_year, debt_to_equity_ratio, debt_to_assets_pct,
  long_term_debt_to_equity, total_assets, stockholders_equity FROM ratios
WHERE fiscal_year = 2023 AND debt_to_equity_ratio > {equity} AND total_assets > {assets}
QUALIFY row_number() OVER (ORDER BY debt_to_equity_ratio DESC, cik) <= 50"""


_ORACLE["g5_high_leverage"] = _g5("2.0", "1e9")
_ORACLE["g5_high_leverage_selective"] = _g5("3.3", "6e10")
_ORACLE["g6_profitability_trend"] = """SELECT company_name, ticker, fiscal_year, gross_margin_pct,
  operating_margin_pct, net_profit_margin_pct, return_on_assets_pct, return_on_equity_pct FROM ratios
WHERE fiscal_year >= 2020 AND cik IN (SELECT cik FROM ratios WHERE fiscal_year = 2023
  ORDER BY revenue DESC NULLS LAST, cik LIMIT 10)"""
_ORACLE["g7_sector_comparison"] = f"""SELECT sector, fiscal_year, count(DISTINCT cik) AS company_count,
  {rnd('avg(gross_margin_pct)', 2)} AS avg_gross_margin_pct,
  {rnd('avg(operating_margin_pct)', 2)} AS avg_operating_margin_pct,
  {rnd('avg(net_profit_margin_pct)', 2)} AS avg_net_margin_pct,
  {rnd('avg(return_on_equity_pct)', 2)} AS avg_roe_pct, {rnd('avg(current_ratio)', 2)} AS avg_current_ratio
FROM ratios WHERE fiscal_year >= 2020 AND sector IS NOT NULL GROUP BY sector, fiscal_year"""

# --- H ---------------------------------------------------------------------------
_ORACLE["h1_company_vs_sector"] = f"""SELECT company_name, ticker, sector, fiscal_year,
  gross_margin_pct AS company_gross_margin, operating_margin_pct AS company_operating_margin,
  net_profit_margin_pct AS company_net_margin, return_on_equity_pct AS company_roe,
  {', '.join(f'{rnd(c, 6)} AS {c}' for c in _AVERAGES)},
  {rnd('gross_margin_pct - sector_avg_gross_margin', 2)} AS gross_margin_vs_sector,
  {rnd('operating_margin_pct - sector_avg_operating_margin', 2)} AS operating_margin_vs_sector,
  {rnd('net_profit_margin_pct - sector_avg_net_margin', 2)} AS net_margin_vs_sector,
  {rnd('gross_margin_percentile', 0)} AS gross_margin_percentile,
  {rnd('operating_margin_percentile', 0)} AS operating_margin_percentile,
  {rnd('net_margin_percentile', 0)} AS net_margin_percentile, peer_count
FROM peers WHERE ticker IS NOT NULL AND fiscal_year = 2023"""
_ORACLE["h2_top_quartile"] = """SELECT sector, company_name, ticker, fiscal_year, net_profit_margin_pct,
  return_on_equity_pct, revenue, net_margin_percentile, roe_percentile
FROM peers WHERE net_margin_percentile >= 75 AND fiscal_year = 2023"""


def _h3(revenue: str) -> str:
    return f"""SELECT sector, company_name, ticker, fiscal_year, net_profit_margin_pct,
  {rnd('sector_avg_net_margin', 6)} AS sector_avg_net_margin,
  {rnd('net_profit_margin_pct - sector_avg_net_margin', 6)} AS margin_gap,
  net_margin_percentile, current_ratio, debt_to_equity_ratio
FROM peers WHERE net_margin_percentile <= 25 AND fiscal_year = 2023 AND revenue > {revenue}"""


_ORACLE["h3_bottom_quartile"] = _h3("1e8")
_ORACLE["h3_bottom_quartile_selective"] = _h3("4.5e10")


def _h4(revenue: str) -> str:
    return f"""SELECT sector, sector_rank, company_name, ticker, {rnd('score', 1)} AS overall_score,
  {', '.join(f'{rnd(m, 2)} AS {m}' for m in ('gross_margin_pct', 'operating_margin_pct', 'net_profit_margin_pct', 'return_on_equity_pct'))}
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sector ORDER BY score DESC, cik) AS INTEGER) AS sector_rank
  FROM (SELECT *, (gross_margin_percentile + operating_margin_percentile + net_margin_percentile
    + roe_percentile) / 4 AS score FROM peers WHERE fiscal_year = 2023 AND revenue > {revenue}))
WHERE sector_rank <= 3"""


_ORACLE["h4_sector_leaders"] = _h4("5e8")
_ORACLE["h4_sector_leaders_selective"] = _h4("4.5e10")


def _h5(revenue: str) -> str:
    return f"""SELECT CASE WHEN ticker = 'AAPL' THEN '>>> TARGET <<<' ELSE '' END AS target_flag, company_name, ticker,
  {rnd('revenue / 1e9', 2)} AS revenue_billions, {rnd('gross_margin_pct', 2)} AS gross_margin_pct,
  {rnd('operating_margin_pct', 2)} AS operating_margin_pct, {rnd('net_profit_margin_pct', 2)} AS net_profit_margin_pct,
  {rnd('return_on_equity_pct', 2)} AS roe_pct, {rnd('net_margin_percentile', 0)} AS net_margin_percentile
FROM peers WHERE fiscal_year = 2023 AND revenue > {revenue}
  AND sector = (SELECT sector FROM peers WHERE ticker = 'AAPL' AND fiscal_year = 2023)"""


_ORACLE["h5_peer_group"] = _h5("1e10")
_ORACLE["h5_peer_group_selective"] = _h5("4.5e10")
_ORACLE["h6_market_share"] = f"""SELECT p.sector, company_name, ticker, {rnd('revenue / 1e9', 2)} AS revenue_billions,
  {rnd('total / 1e9', 2)} AS sector_revenue_billions, {rnd('revenue / NULLIF(total, 0) * 100', 2)} AS market_share_pct,
  {rnd('revenue_percentile', 0)} AS revenue_percentile
FROM peers p JOIN (SELECT sector, sum(revenue) AS total FROM peers WHERE fiscal_year = 2023 GROUP BY sector) s
  ON p.sector = s.sector WHERE p.fiscal_year = 2023 AND revenue_percentile >= 90"""

# --- I ---------------------------------------------------------------------------
_ORACLE["i1_growth_trend"] = f"""SELECT company_name, ticker, fiscal_year, fiscal_period,
  {rnd('revenue / 1e6', 2)} AS revenue_millions, {rnd('ttm_revenue / 1e6', 2)} AS ttm_revenue_millions,
  {rnd('revenue_yoy_growth_pct', 2)} AS yoy_growth_pct, {rnd('revenue_4q_avg / 1e6', 2)} AS avg_4q_revenue_millions
FROM series WHERE ticker IN ('AAPL', 'MSFT', 'GOOGL', 'AMZN', 'META') AND fiscal_year >= 2020
  AND fiscal_period <> 'FY'"""


def _i2(table: str, revenue: str) -> str:
    return f"""SELECT company_name, ticker, fiscal_year, fiscal_period,
  {rnd('g', 2)} AS current_yoy_growth_pct, {rnd('prior', 2)} AS prior_qtr_growth_pct,
  {rnd('g - prior', 2)} AS qoq_acceleration_pct
FROM (SELECT *, revenue_yoy_growth_pct AS g, lag(revenue_yoy_growth_pct, 1) OVER {_W} AS prior
  FROM {table} WHERE fiscal_period IN {_Q} AND revenue > {revenue})
WHERE g > prior AND g > 20 AND fiscal_year = 2023
ORDER BY qoq_acceleration_pct DESC, cik, fiscal_period LIMIT 50"""


_ORACLE["i2_accelerating_growth"] = _i2("series", "1e8")
_ORACLE["i2_accelerating_growth_quarterly"] = _i2("series_q", "1e10")


def _i3(table: str, since: int, ttm: str, back: int) -> str:
    return f"""SELECT company_name, ticker, fiscal_year, fiscal_period,
  {rnd('ttm_revenue / 1e9', 2)} AS ttm_revenue_billions, {rnd('ttm_net_income / 1e9', 2)} AS ttm_net_income_billions,
  {rnd('ttm_net_income / NULLIF(ttm_revenue, 0) * 100', 2)} AS ttm_profit_margin_pct,
  before AS ttm_revenue_yoy_prior,
  {rnd('(ttm_revenue - before) / NULLIF(before, 0) * 100', 2)} AS ttm_revenue_yoy_growth_pct
FROM (SELECT *, lag(ttm_revenue, {back}) OVER {_W} AS before FROM {table}
  WHERE fiscal_year >= {since} AND ttm_revenue > {ttm} AND fiscal_period = 'Q4')
ORDER BY ttm_revenue_yoy_growth_pct DESC NULLS LAST, cik, fiscal_year LIMIT 100"""


_ORACLE["i3_trailing_year"] = _i3("series", 2022, "1e9", 4)
_ORACLE["i3_trailing_year_yearly"] = _i3("series_q", 2020, "4.5e10", 1)


def _i4(table: str, growth: str, spread: str) -> str:
    return f"""SELECT company_name, ticker, {rnd('m', 2)} AS avg_yoy_growth_pct,
  {rnd('s', 2)} AS growth_volatility_stddev, {rnd('m / NULLIF(s, 0)', 2)} AS consistency_score, n AS quarters_of_data
FROM (SELECT cik, company_name, ticker, stddev_samp(revenue_yoy_growth_pct) AS s,
    avg(revenue_yoy_growth_pct) AS m, count(*) AS n
  FROM {table} WHERE fiscal_year >= 2020 AND fiscal_period IN {_Q} AND revenue_yoy_growth_pct IS NOT NULL
  GROUP BY cik, company_name, ticker)
WHERE n >= 12 AND m > {growth} AND s < {spread}
ORDER BY consistency_score DESC NULLS LAST, cik LIMIT 50"""


_ORACLE["i4_steady_growth"] = _i4("series", "5", "15")
_ORACLE["i4_steady_growth_selective"] = _i4("series_q", "0", "45")
_ORACLE["i5_seasonality"] = f"""SELECT company_name, ticker, fiscal_period, count(*) AS years_analyzed,
  {rnd('avg(revenue) / 1e6', 2)} AS avg_revenue_millions,
  {rnd('stddev_samp(revenue) / 1e6', 2)} AS revenue_stddev_millions,
  {rnd('min(revenue) / 1e6', 2)} AS min_revenue_millions, {rnd('max(revenue) / 1e6', 2)} AS max_revenue_millions,
  {rnd('stddev_samp(revenue) / NULLIF(avg(revenue), 0) * 100', 2)} AS coefficient_of_variation_pct
FROM series WHERE ticker IN ('AAPL', 'NKE', 'HD', 'TGT', 'WMT') AND fiscal_year BETWEEN 2020 AND 2023
  AND fiscal_period IN {_Q} GROUP BY company_name, ticker, fiscal_period"""
_ORACLE["i6_compound_growth"] = f"""SELECT company_name, ticker, {rnd('a / 1e9', 2)} AS revenue_2020_billions,
  {rnd('b / 1e9', 2)} AS revenue_2023_billions, rate AS revenue_cagr_3yr_pct,
  {rnd('na / 1e9', 2)} AS net_income_2020_billions, {rnd('nb / 1e9', 2)} AS net_income_2023_billions,
  CASE WHEN nb / NULLIF(na, 0) >= 0 THEN {rnd('(pow(nb / NULLIF(na, 0), CAST(1 AS DOUBLE) / 3) - 1) * 100', 2)} END
    AS net_income_cagr_3yr_pct
FROM (SELECT *, {rnd('(pow(b / a, CAST(1 AS DOUBLE) / 3) - 1) * 100', 2)} AS rate FROM (
  SELECT cik, company_name, ticker, min(CASE WHEN fiscal_year = 2020 THEN revenue END) AS a,
    max(CASE WHEN fiscal_year = 2023 THEN revenue END) AS b,
    min(CASE WHEN fiscal_year = 2020 THEN net_income END) AS na,
    max(CASE WHEN fiscal_year = 2023 THEN net_income END) AS nb
  FROM series WHERE fiscal_period = 'FY' GROUP BY cik, company_name, ticker)
  WHERE a > 0 AND b > a) ORDER BY rate DESC, cik LIMIT 100"""


def _i7(revenue: str) -> str:
    return f"""SELECT company_name, ticker, {rnd('p / 1e9', 2)} AS pre_pandemic_revenue_billions,
  {rnd('t / 1e9', 2)} AS trough_revenue_billions, {rnd('n / 1e9', 2)} AS current_revenue_billions,
  {rnd('(t - p) / p * 100', 2)} AS pandemic_decline_pct, {rnd('(n - p) / p * 100', 2)} AS recovery_vs_2019_pct,
  CASE WHEN n > p * 1.1 THEN 'Recovered+' WHEN n > p THEN 'Recovered' WHEN n > t THEN 'Recovering'
    ELSE 'Still Below Trough' END AS recovery_status
FROM (SELECT cik, company_name, ticker, max(CASE WHEN fiscal_year = 2019 THEN revenue END) AS p, min(revenue) AS t,
    max(CASE WHEN fiscal_year = 2023 THEN revenue END) AS n
  FROM series WHERE fiscal_period = 'FY' AND fiscal_year BETWEEN 2019 AND 2023 GROUP BY cik, company_name, ticker)
WHERE p > {revenue} ORDER BY recovery_vs_2019_pct DESC NULLS LAST, cik LIMIT 100"""


_ORACLE["i7_recovery"] = _i7("1e8")
_ORACLE["i7_recovery_selective"] = _i7("4.5e10")


# --- J ---------------------------------------------------------------------------
def _check(name: str, observed: str, threshold: str, table: str, at_least: bool = True) -> str:
    sign = ">=" if at_least else "<="
    return f"""SELECT '{name}' AS check_name, coalesce(({observed}) {sign} {threshold}, false) AS passed,
  CAST({observed} AS DOUBLE) AS observed, CAST({threshold} AS DOUBLE) AS threshold FROM {table}"""


_NULLS = "count(*) FILTER (WHERE cik IS NULL OR concept IS NULL OR value IS NULL)"
_YEARS = "count(*) FILTER (WHERE fiscal_year < 2000 OR fiscal_year > 2030)"
_RATE = rnd("count(*) FILTER (WHERE data_quality_passed) * CAST(100 AS DOUBLE) / count(*)", 6)
_J1 = _check("check_companies_count", "count(*)", "100", "companies")
_J2 = _check("check_financials_count", "count(*)", "1000", "facts")
_J5 = _check("data_quality_flag_check", _RATE, "95", "raw")
_ORACLE["j1_minimum_companies"] = _J1
_ORACLE["j2_minimum_facts"] = _J2
_ORACLE["j3_no_nulls"] = _check("null_check_critical_fields", _NULLS, "0", "raw", False)
_ORACLE["j4_years_within"] = _check("valid_fiscal_years", _YEARS, "0", "raw", False)
_ORACLE["j5_pass_rate"] = _J5
_ORACLE["j6_check_suite"] = " UNION ALL ".join(
    [
        _J1,
        _check("unique_company_id", "count(cik) - count(DISTINCT cik)", "0", "companies", False),
        _J2,
        _check("null_check_critical_fields", _NULLS, "0", "facts", False),
        _check("valid_fiscal_years", _YEARS, "0", "facts", False),
        _J5,
    ]
)

# --- K ---------------------------------------------------------------------------
_LATEST_FY = "(SELECT max(fiscal_year) FROM ratios)"
_NOW = f"""(SELECT fiscal_year * 10 + CAST(substr(fiscal_period, 2, 1) AS INTEGER) FROM series
  WHERE fiscal_period IN {_Q} ORDER BY 1 DESC LIMIT 1)"""
_AT_NOW = f"""FROM series WHERE fiscal_period IN {_Q}
  AND fiscal_year * 10 + CAST(substr(fiscal_period, 2, 1) AS INTEGER) = {_NOW}"""
_ORACLE["k1_executive_scorecards"] = f"""SELECT count(DISTINCT cik) AS total_companies,
  (SELECT {rnd('sum(ttm_revenue) / 1e9', 2)} {_AT_NOW}) AS ttm_revenue_billions,
  (SELECT {rnd('avg(net_profit_margin_pct)', 2)} FROM ratios WHERE fiscal_year = {_LATEST_FY}) AS avg_profit_margin_pct,
  (SELECT count(DISTINCT cik) {_AT_NOW} AND revenue_yoy_growth_pct > 0) AS positive_growth_companies
FROM metrics"""
_ORACLE["k2_margin_of_sums"] = f"""SELECT fiscal_year,
  {rnd('sum(net_income) / NULLIF(sum(revenue), 0) * 100', 4)} AS avg_profit_margin_pct FROM annual GROUP BY fiscal_year"""
_ORACLE["k3_revenue_trend"] = f"""SELECT fiscal_year, fiscal_period, {rnd('sum(ttm_revenue) / 1e9', 2)} AS ttm_revenue_billions,
  {rnd('avg(revenue_yoy_growth_pct)', 2)} AS avg_yoy_growth_pct FROM series WHERE fiscal_period IN {_Q}
GROUP BY fiscal_year, fiscal_period ORDER BY fiscal_year DESC, fiscal_period DESC LIMIT 12"""
_ORACLE["k4_top_companies"] = """SELECT company_name, ticker, fiscal_year, revenue FROM annual
WHERE fiscal_year = (SELECT max(fiscal_year) FROM annual) ORDER BY revenue DESC NULLS LAST, cik LIMIT 25"""
_ORACLE["k5_sector_distribution"] = f"""SELECT sector, count(DISTINCT cik) AS company_count,
  {rnd('count(DISTINCT cik) * CAST(100 AS DOUBLE) / sum(count(DISTINCT cik)) OVER ()', 2)} AS share_pct
FROM ratios WHERE fiscal_year = {_LATEST_FY} GROUP BY sector"""
_MEANS = {
    "avg_gross_margin": "gross_margin_pct",
    "avg_operating_margin": "operating_margin_pct",
    "avg_net_margin": "net_profit_margin_pct",
    "avg_roe": "return_on_equity_pct",
}
_BANDS = ", ".join(
    f"""CASE WHEN {m} > (SELECT quantile_cont({m}, 0.75) FROM means) THEN 'high'
   WHEN {m} < (SELECT quantile_cont({m}, 0.25) FROM means) THEN 'low' ELSE 'mid' END AS {m}_band"""
    for m in _MEANS
)
CTES["means"] = f"""SELECT sector, {', '.join(f'{rnd(f"avg({src})", 6)} AS {m}' for m, src in _MEANS.items())}
    FROM ratios WHERE fiscal_year = {_LATEST_FY} AND sector IS NOT NULL GROUP BY sector"""
_ORACLE["k6_profitability_heatmap"] = f"SELECT *, {_BANDS} FROM means"
_ORACLE["k7_recent_filings"] = """SELECT m.company_name, m.ticker, m.fiscal_year, m.fiscal_period, m.revenue,
  m.net_income, s.filing_date FROM metrics m JOIN submissions s ON s.cik = m.cik AND s.fiscal_year = m.fiscal_year
  AND s.fiscal_period = m.fiscal_period ORDER BY s.filing_date DESC, m.cik, s.accession_number LIMIT 50"""
_ORACLE["k8_global_filters"] = """SELECT cik, sector, fiscal_year, revenue FROM ratios
WHERE fiscal_year IN (SELECT DISTINCT fiscal_year FROM ratios ORDER BY fiscal_year DESC LIMIT 2)
  AND sector IN ('ASIA', 'EUROPE') AND revenue >= 2e10"""
_ORACLE["k8_size_classes"] = """SELECT fiscal_year, CASE WHEN revenue >= 4.5e10 THEN 'Large'
  WHEN revenue >= 3.5e10 THEN 'Medium' WHEN revenue IS NOT NULL THEN 'Small' END AS size, count(*) AS n
FROM ratios GROUP BY ALL"""
_ORACLE["k9_company_header"] = """SELECT company_name, ticker, sector, industry, fiscal_year, fiscal_period,
  revenue AS latest_revenue, net_income AS latest_net_income FROM metrics WHERE ticker = 'AAPL'
ORDER BY fiscal_year DESC, fiscal_period DESC LIMIT 1"""


def _k10(lines) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS line_no, '{line}' AS line_item, "
        + ", ".join(f"max(CASE WHEN fiscal_year = {y} THEN {line} END) AS fy_{y}" for y in range(2020, 2024))
        + " FROM annual WHERE ticker = 'MSFT'"
        for i, line in enumerate(lines, 1)
    )


_ORACLE["k10_income_statement"] = _k10(
    ["revenue", "cost_of_revenue", "gross_profit", "operating_expenses", "operating_income", "net_income"]
)
_ORACLE["k10_balance_sheet"] = _k10(
    [
        "total_assets",
        "current_assets",
        "cash_and_equivalents",
        "total_liabilities",
        "current_liabilities",
        "long_term_debt",
        "stockholders_equity",
    ]
)
_ORACLE["k10_cash_flow"] = _k10(
    ["operating_cash_flow", "investing_cash_flow", "financing_cash_flow", "capital_expenditures"]
)
_CARDS = (
    "gross_margin_pct",
    "operating_margin_pct",
    "net_profit_margin_pct",
    "return_on_equity_pct",
    "return_on_assets_pct",
    "current_ratio",
    "quick_ratio",
    "debt_to_equity_ratio",
    "debt_to_assets_pct",
    "asset_turnover",
    "receivables_turnover",
)
_ORACLE["k11_ratio_cards"] = " UNION ALL ".join(
    f"""SELECT '{r}' AS ratio, {rnd(f't.{r}', 4)} AS value, {rnd(f't.{r} - p.{r}', 4)} AS yoy_change,
  (SELECT {rnd(f'avg({r})', 4)} FROM ratios s WHERE s.fiscal_year = 2023 AND s.sector = t.sector) AS sector_avg
FROM ratios t LEFT JOIN ratios p ON p.cik = t.cik AND p.fiscal_year = 2022
WHERE t.ticker = 'MSFT' AND t.fiscal_year = 2023"""
    for r in _CARDS
)
_ORACLE["k12_quarterly_trends"] = f"""SELECT fiscal_year, fiscal_period, revenue, net_income, operating_cash_flow,
  operating_cash_flow - capital_expenditures AS free_cash_flow FROM metrics
WHERE ticker = 'MSFT' AND fiscal_period IN {_Q} ORDER BY fiscal_year DESC, fiscal_period DESC LIMIT 12"""
_ORACLE["k13_ttm_vs_annual"] = " UNION ALL ".join(
    f"""SELECT a.cik, a.company_name, a.ticker, '{m}' AS metric, t.v AS ttm_value, a.v AS annual_value
FROM (SELECT cik, company_name, ticker, {m} AS v FROM annual
  QUALIFY row_number() OVER (PARTITION BY cik ORDER BY fiscal_year DESC) = 1) a
FULL JOIN (SELECT cik, sum({m}) AS v FROM (SELECT cik, {m} FROM metrics WHERE fiscal_period IN {_Q}
  QUALIFY row_number() OVER (PARTITION BY cik ORDER BY fiscal_year DESC, fiscal_period DESC) <= 4) GROUP BY cik) t
ON a.cik = t.cik"""
    for m in ("revenue", "net_income", "operating_income")
)
_K14 = (
    ("gross_margin_pct", "sector_avg_gross_margin", "gross_margin_percentile"),
    ("operating_margin_pct", "sector_avg_operating_margin", "operating_margin_percentile"),
    ("net_profit_margin_pct", "sector_avg_net_margin", "net_margin_percentile"),
    ("return_on_equity_pct", "sector_avg_roe", "roe_percentile"),
    ("return_on_assets_pct", None, None),
    ("current_ratio", None, None),
    ("debt_to_equity_ratio", None, None),
    ("revenue", None, "revenue_percentile"),
)
_ORACLE["k14_peer_table"] = " UNION ALL ".join(
    f"""SELECT '{m}' AS metric, {rnd(m, 4)} AS company_value,
  {rnd(a, 4) if a else 'CAST(NULL AS DOUBLE)'} AS sector_avg,
  {rnd(p, 2) if p else 'CAST(NULL AS DOUBLE)'} AS percentile_rank,
  {f'{m} > {a}' if a else 'CAST(NULL AS BOOLEAN)'} AS outperforms
FROM peers WHERE ticker = 'MSFT' AND fiscal_year = 2023"""
    for m, a, p in _K14
)


def _k15(metric: str, steps: int) -> str:
    number = "{0}.fiscal_year * 4 + CAST(substr({0}.fiscal_period, 2, 1) AS INTEGER)"
    return f"""SELECT a.cik, a.ticker, a.fiscal_year, a.fiscal_period, a.{metric} AS value, b.{metric} AS prior_value,
  {rnd(pct(f'a.{metric} - b.{metric}', f'b.{metric}'), 4)} AS change_pct
FROM (SELECT * FROM metrics WHERE fiscal_period IN {_Q}) a
LEFT JOIN (SELECT * FROM metrics WHERE fiscal_period IN {_Q}) b
  ON b.cik = a.cik AND {number.format('b')} = {number.format('a')} - {steps}"""


_ORACLE["k15_compare_qoq"] = _k15("revenue", 1)
_ORACLE["k15_compare_yoy"] = _k15("net_income", 4)
_ORACLE["k15_compare_3_year"] = _k15("revenue", 12)
_HEAT = (
    "gross_margin_pct",
    "operating_margin_pct",
    "net_profit_margin_pct",
    "return_on_equity_pct",
    "return_on_assets_pct",
    "current_ratio",
    "debt_to_equity_ratio",
    "revenue_growth_pct",
)
_ORACLE["k16_metrics_heatmap"] = f"""SELECT cik, company_name, ticker, revenue,
  {', '.join(f'{rnd(m, 4)} AS {m}' for m in _HEAT)},
  {', '.join(f'{rnd(f"p_{m}", 2)} AS {m}_percentile' for m in _HEAT)}
FROM (SELECT *, {', '.join(f'percent_rank() OVER (ORDER BY {m} NULLS FIRST) * 100 AS p_{m}' for m in _HEAT)}
  FROM grown WHERE sector = 'ASIA' AND fiscal_year = 2023)
ORDER BY revenue DESC NULLS LAST, cik LIMIT 50"""


def _fit(function: str) -> str:
    # Undefined for points on one x; DuckDB says NaN there, the SQL standard NULL.
    value = f"{function}(net_profit_margin_pct, return_on_equity_pct)"
    return rnd(f"CASE WHEN NOT isnan({value}) THEN {value} END", 6)


_FIT = f"""count(*) AS points, {_fit('regr_slope')} AS slope, {_fit('regr_intercept')} AS intercept,
  {_fit('regr_r2')} AS r2"""
_BOTH = "net_profit_margin_pct IS NOT NULL AND return_on_equity_pct IS NOT NULL"
_ORACLE["k17_trendline_by_sector"] = (
    f"SELECT sector, {_FIT} FROM ratios WHERE fiscal_year = {_LATEST_FY} AND {_BOTH} GROUP BY sector"
)
_ORACLE["k17_trendline_all"] = f"SELECT {_FIT} FROM ratios WHERE fiscal_year = 2023 AND {_BOTH}"
_ORACLE["k18_percentile_bands"] = " UNION ALL ".join(
    f"""SELECT cik, ticker, '{p}' AS metric, {rnd(p, 4)} AS percentile,
  CASE WHEN {p} > 75 THEN 'high' WHEN {p} < 25 THEN 'low' WHEN {p} IS NOT NULL THEN 'mid' END AS band
FROM peers WHERE ticker = 'MSFT' AND fiscal_year = 2023"""
    for p in _PERCENTILES
)
_ORACLE["k19_leaderboards"] = " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{m}' AS metric, CAST(row_number() OVER (ORDER BY {m} DESC, cik) AS INTEGER) AS rank,
  company_name, ticker, {rnd(m, 4)} AS value,
  {rnd(f'avg({m}) OVER (PARTITION BY sector)', 4)} AS sector_avg
FROM grown WHERE fiscal_year = 2023 AND sector IS NOT NULL AND {m} IS NOT NULL) WHERE rank <= 10"""
    for m in ("net_profit_margin_pct", "return_on_equity_pct", "revenue_growth_pct", "current_ratio")
)


def _k20(metric: str, width: str, year: str, ticker: str) -> str:
    return f"""SELECT sector, bin, count(*) AS companies, bool_or(hit) AS has_selected,
  bin * {width} AS bin_low, (bin + 1) * {width} AS bin_high
FROM (SELECT sector, CAST(floor({metric} / {width}) AS BIGINT) AS bin, {ticker} AS hit FROM ratios
  WHERE fiscal_year = {year} AND {metric} IS NOT NULL) GROUP BY sector, bin"""


_ORACLE["k20_histogram"] = _k20(
    "net_profit_margin_pct", "CAST(5 AS DOUBLE)", "2023", "coalesce(ticker = 'MSFT', false)"
)
_ORACLE["k20_histogram_roe"] = _k20("return_on_equity_pct", "CAST(10 AS DOUBLE)", _LATEST_FY, "false")
_ORACLE["k21_market_overview"] = f"""SELECT count(DISTINCT cik) AS total_companies,
  count(DISTINCT sector) AS total_sectors,
  (SELECT {rnd('sum(revenue) / 1e9', 2)} FROM annual WHERE fiscal_year = (SELECT max(fiscal_year) FROM annual))
    AS aggregate_revenue_billions,
  (SELECT {rnd('avg(revenue_yoy_growth_pct)', 2)} FROM series) AS avg_revenue_growth_pct FROM metrics"""
_ORACLE["k22_sector_performance"] = f"""SELECT sector, {', '.join(f'{rnd(f"avg({src})", 2)} AS {m}' for m, src in _MEANS.items())}
FROM ratios WHERE fiscal_year = {_LATEST_FY} AND sector IS NOT NULL GROUP BY sector"""
_ORACLE["k23_revenue_treemap"] = f"""SELECT sector, company_name,
  CAST(grouping(sector, company_name) AS INTEGER) AS level, sum(revenue) AS revenue,
  {rnd('sum(net_income) / NULLIF(sum(revenue), 0) * 100', 4)} AS profit_margin_pct
FROM annual WHERE fiscal_year = {_LATEST_FY} AND sector IS NOT NULL GROUP BY ROLLUP (sector, company_name)"""
CTES["growths"] = f"""SELECT c.sector, s.revenue_yoy_growth_pct AS g FROM series s JOIN companies c ON c.cik = s.cik
    WHERE s.fiscal_period IN {_Q} AND s.revenue_yoy_growth_pct IS NOT NULL AND c.sector IS NOT NULL"""
CTES["boxes"] = """SELECT sector, quantile_cont(g, 0.25) AS q1, quantile_cont(g, 0.5) AS median,
      quantile_cont(g, 0.75) AS q3 FROM growths GROUP BY sector"""
_ORACLE["k24_growth_boxplot"] = f"""SELECT sector, count(*) AS observations, {rnd('min(g)', 4)} AS min_growth,
  {', '.join(f'{rnd(f"any_value({q})", 4)} AS {q}' for q in ('q1', 'median', 'q3'))},
  {rnd('max(g)', 4)} AS max_growth,
  count(*) FILTER (WHERE g < q1 - 1.5 * (q3 - q1) OR g > q3 + 1.5 * (q3 - q1)) AS outliers
FROM growths JOIN boxes USING (sector) GROUP BY sector"""
_ORACLE["k25_sector_revenue_trend"] = f"""SELECT sector, fiscal_year, fiscal_period,
  {rnd('sum(revenue) / 1e9', 4)} AS revenue_billions FROM metrics
WHERE fiscal_period IN {_Q} AND sector IS NOT NULL AND fiscal_year > (SELECT max(fiscal_year) FROM metrics) - 3
GROUP BY sector, fiscal_year, fiscal_period"""
_PAIRED = (
    "revenue",
    "net_income",
    "net_profit_margin_pct",
    "revenue_growth_pct",
    "debt_to_equity_ratio",
    "return_on_equity_pct",
)
_ORACLE["k26_correlation_matrix"] = " UNION ALL ".join(
    f"SELECT '{a}' AS metric_x, '{b}' AS metric_y, {rnd(f'corr({a}, {b})', 6)} AS correlation FROM grown"
    for a in _PAIRED
    for b in _PAIRED
)
_ORACLE["k27_market_share_stack"] = f"""SELECT sector, position, company_name, revenue,
  {rnd('revenue / NULLIF(sum(revenue) OVER (PARTITION BY sector), 0) * 100', 4)} AS share_pct
FROM (SELECT sector, CAST(least(place, 11) AS INTEGER) AS position,
    CASE WHEN place <= 10 THEN company_name ELSE 'Others' END AS company_name, sum(revenue) AS revenue
  FROM (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY revenue DESC, cik) AS place FROM peers
    WHERE fiscal_year = 2023 AND revenue IS NOT NULL) GROUP BY ALL)"""
_ORACLE["k28_blend_external"] = """SELECT m.cik, m.ticker, m.revenue, x.s_acctbal AS balance FROM annual m
LEFT JOIN (SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, s_acctbal FROM supplier WHERE s_acctbal > 0) x
  ON x.cik = m.cik WHERE m.fiscal_year = 2023"""
_EBITDA = "revenue - cost_of_revenue - operating_expenses + capital_expenditures"
_ORACLE["k29_calculated_fields"] = f"""SELECT cik, fiscal_year, fiscal_period, {_EBITDA} AS ebitda,
  operating_cash_flow - capital_expenditures AS free_cash_flow,
  {rnd(pct(_EBITDA, 'revenue'), 4)} AS ebitda_margin_pct FROM metrics"""

# --- L ---------------------------------------------------------------------------
_ORACLE["l1_company_profile"] = "SELECT * FROM metrics WHERE ticker = 'AAPL' AND fiscal_year = 2023"
_ORACLE["l2_sector_listing"] = _all_but("peers", _AVERAGES) + " WHERE sector = 'ASIA' AND fiscal_year = 2023"
_ORACLE["l3_ticker_trend"] = "SELECT * FROM series WHERE ticker = 'MSFT' AND fiscal_year >= 2020"
_ORACLE["l4_ticker_ratios"] = """SELECT * FROM ratios WHERE ticker IN ('AAPL', 'MSFT', 'GOOGL')
  AND fiscal_year = 2023"""
