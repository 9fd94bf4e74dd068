"""Explicit schemas, taxonomy lists and default parameters.

Nothing on the read path is inferred: documents are read with
``DOCUMENT_SCHEMA`` so that concepts and units arrive as maps, whatever a
single file happens to contain.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# The taxonomy, unit and form lists that decide the results.
# --------------------------------------------------------------------------
INCOME_STATEMENT_CONCEPTS = (
    "Revenues",
    "RevenueFromContractWithCustomerExcludingAssessedTax",
    "CostOfRevenue",
    "GrossProfit",
    "OperatingIncomeLoss",
    "NetIncomeLoss",
    "EarningsPerShareBasic",
    "EarningsPerShareDiluted",
    "OperatingExpenses",
    "ResearchAndDevelopmentExpense",
    "SellingGeneralAndAdministrativeExpense",
    "InterestExpense",
    "IncomeTaxExpenseBenefit",
)
BALANCE_SHEET_CONCEPTS = (
    "Assets",
    "AssetsCurrent",
    "AssetsNoncurrent",
    "CashAndCashEquivalentsAtCarryingValue",
    "AccountsReceivableNetCurrent",
    "InventoryNet",
    "Liabilities",
    "LiabilitiesCurrent",
    "LiabilitiesNoncurrent",
    "AccountsPayableCurrent",
    "LongTermDebtNoncurrent",
    "StockholdersEquity",
    "RetainedEarningsAccumulatedDeficit",
    "CommonStockValue",
)
CASH_FLOW_CONCEPTS = (
    "NetCashProvidedByUsedInOperatingActivities",
    "NetCashProvidedByUsedInInvestingActivities",
    "NetCashProvidedByUsedInFinancingActivities",
    "PaymentsToAcquirePropertyPlantAndEquipment",
    "PaymentsOfDividends",
    "ProceedsFromIssuanceOfLongTermDebt",
    "RepaymentsOfLongTermDebt",
)
STATEMENTS = {
    "income_statement": INCOME_STATEMENT_CONCEPTS,
    "balance_sheet": BALANCE_SHEET_CONCEPTS,
    "cash_flow": CASH_FLOW_CONCEPTS,
}
VALID_UNITS = ("USD", "shares", "pure")
VALID_FORMS = ("10-K", "10-Q", "8-K", "20-F", "40-F")

# Which concepts feed which wide metric column (the larger one wins when a
# company reports several).
METRIC_CONCEPTS = {
    "revenue": ("Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax"),
    "cost_of_revenue": ("CostOfRevenue",),
    "gross_profit": ("GrossProfit",),
    "operating_income": ("OperatingIncomeLoss",),
    "net_income": ("NetIncomeLoss",),
    "operating_expenses": ("OperatingExpenses",),
    "research_and_development": ("ResearchAndDevelopmentExpense",),
    "sg_and_a": ("SellingGeneralAndAdministrativeExpense",),
    "interest_expense": ("InterestExpense",),
    "income_tax_expense": ("IncomeTaxExpenseBenefit",),
    "total_assets": ("Assets",),
    "current_assets": ("AssetsCurrent",),
    "cash_and_equivalents": ("CashAndCashEquivalentsAtCarryingValue",),
    "accounts_receivable": ("AccountsReceivableNetCurrent",),
    "inventory": ("InventoryNet",),
    "total_liabilities": ("Liabilities",),
    "current_liabilities": ("LiabilitiesCurrent",),
    "long_term_debt": ("LongTermDebtNoncurrent",),
    "stockholders_equity": ("StockholdersEquity",),
    "operating_cash_flow": ("NetCashProvidedByUsedInOperatingActivities",),
    "investing_cash_flow": ("NetCashProvidedByUsedInInvestingActivities",),
    "financing_cash_flow": ("NetCashProvidedByUsedInFinancingActivities",),
    "capital_expenditures": ("PaymentsToAcquirePropertyPlantAndEquipment",),
}
QUARTERS = ("Q1", "Q2", "Q3", "Q4")
PERIODS = QUARTERS + ("FY",)

# Columns of a flat fact: the field of the document that each is read from, and its type.
FACT_FIELDS = {
    "start_date": ("start", "string"),
    "end_date": ("end", "string"),
    "value": ("val", "double"),
    "accession_number": ("accn", "string"),
    "fiscal_year": ("fy", "int"),
    "fiscal_period": ("fp", "string"),
    "form": ("form", "string"),
    "filed_date": ("filed", "string"),
    "frame": ("frame", "string"),
}
CRITICAL_COLUMNS = ("cik", "concept", "value", "fiscal_year")

# Bounds of the two year checks: parse-time flag, and the stored-table check.
PARSE_YEAR_RANGE = (1900, 2100)
TABLE_YEAR_RANGE = (2000, 2030)
# -------------------------------------------------------- end of fixed values

COMPANY_KEYS = ("cik", "company_name", "ticker", "sector", "industry")


def all_concepts() -> list[str]:
    """Every concept of the three statement lists."""
    return [c for concepts in STATEMENTS.values() for c in concepts]


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in pairs])


_S, _D, _I, _L, _B = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
)

# ``val`` and ``fy`` are read as text and cast with try_cast later, so that a
# malformed number becomes a flagged row rather than a failed or lost document.
FACT_STRUCT = _fields(
    ("start", _S),
    ("end", _S),
    ("val", _S),
    ("accn", _S),
    ("fy", _S),
    ("fp", _S),
    ("form", _S),
    ("filed", _S),
    ("frame", _S),
)
CONCEPT_STRUCT = _fields(("units", T.MapType(_S, T.ArrayType(FACT_STRUCT))))
DOCUMENT_SCHEMA = _fields(
    ("cik", _S),
    ("entityName", _S),
    ("tickers", T.ArrayType(_S)),
    ("exchanges", T.ArrayType(_S)),
    ("facts", _fields(("us-gaap", T.MapType(_S, CONCEPT_STRUCT)))),
)
SUBMISSION_SCHEMA = _fields(
    ("cik", _S),
    ("name", _S),
    ("sic", _S),
    ("sicDescription", _S),
    ("tickers", T.ArrayType(_S)),
    ("exchanges", T.ArrayType(_S)),
)

RAW_COMPANIES = _fields(
    ("cik", _S),
    ("cik_padded", _S),
    ("company_name", _S),
    ("ticker", _S),
    ("exchange", _S),
)
RAW_FINANCIALS = _fields(
    ("cik", _S),
    ("cik_padded", _S),
    ("company_name", _S),
    ("concept", _S),
    ("unit", _S),
    ("start_date", _S),
    ("end_date", _S),
    ("value", _D),
    ("accession_number", _S),
    ("fiscal_year", _I),
    ("fiscal_period", _S),
    ("form", _S),
    ("filed_date", _S),
    ("frame", _S),
    ("statement_type", _S),
    ("year_quarter", _S),
    ("has_null_critical", _B),
    ("invalid_fiscal_year", _B),
    ("data_quality_passed", _B),
)
DIM_COMPANIES = _fields(
    ("cik", _S),
    ("company_name", _S),
    ("ticker", _S),
    ("exchange", _S),
    ("sic_code", _S),
    ("industry", _S),
    ("sector", _S),
    ("first_filing_year", _I),
    ("last_filing_year", _I),
    ("total_filings", _L),
)
DIM_TAXONOMY = _fields(
    ("concept", _S),
    ("statement_type", _S),
    ("concept_label", _S),
    ("data_type", _S),
    ("period_type", _S),
    ("balance_type", _S),
    ("companies_using", _L),
    ("total_usage_count", _L),
    ("first_used_year", _I),
    ("last_used_year", _I),
)
DIM_DATES = _fields(
    ("date", T.DateType()),
    ("year", _I),
    ("quarter", _I),
    ("month", _I),
    ("day", _I),
    ("day_of_week", _I),
    ("week_of_year", _I),
    ("year_quarter", _S),
    ("year_month", _S),
)
FACT_FINANCIALS = _fields(
    ("fact_id", _S),
    ("cik", _S),
    ("concept", _S),
    ("end_date", T.DateType()),
    ("filing_date", T.DateType()),
    ("fiscal_year", _I),
    ("fiscal_period", _S),
    ("year_quarter", _S),
    ("form", _S),
    ("accession_number", _S),
    ("value", _D),
    ("unit", _S),
    ("statement_type", _S),
    ("frame", _S),
)
FACT_SUBMISSIONS = _fields(
    ("cik", _S),
    ("accession_number", _S),
    ("form", _S),
    ("filing_date", T.DateType()),
    ("fiscal_year", _I),
    ("fiscal_period", _S),
    ("concepts_reported", _L),
    ("total_facts", _L),
    ("income_statement_facts", _L),
    ("balance_sheet_facts", _L),
    ("cash_flow_facts", _L),
)
COMPANY_METRICS = _fields(
    *[(c, _S) for c in COMPANY_KEYS],
    ("fiscal_year", _I),
    ("fiscal_period", _S),
    *[(m, _D) for m in METRIC_CONCEPTS],
)
RATIO_COLUMNS = (
    "gross_margin_pct",
    "operating_margin_pct",
    "net_profit_margin_pct",
    "return_on_assets_pct",
    "return_on_equity_pct",
    "current_ratio",
    "quick_ratio",
    "cash_ratio",
    "debt_to_assets_pct",
    "debt_to_equity_ratio",
    "long_term_debt_to_equity",
    "asset_turnover",
    "receivables_turnover",
    "operating_expense_ratio_pct",
    "rd_intensity_pct",
    "operating_cash_flow_ratio",
    "free_cash_flow_ratio",
)
FINANCIAL_RATIOS = _fields(
    *[(c, _S) for c in COMPANY_KEYS],
    ("fiscal_year", _I),
    ("fiscal_period", _S),
    *[(r, _D) for r in RATIO_COLUMNS],
    *[
        (c, _D)
        for c in (
            "revenue",
            "net_income",
            "total_assets",
            "stockholders_equity",
            "operating_cash_flow",
            "current_liabilities",
        )
    ],
)
PEER_COMPARISON = _fields(
    *[(c, _S) for c in COMPANY_KEYS],
    ("fiscal_year", _I),
    *[
        (c, _D)
        for c in (
            "gross_margin_pct",
            "operating_margin_pct",
            "net_profit_margin_pct",
            "return_on_assets_pct",
            "return_on_equity_pct",
            "current_ratio",
            "debt_to_equity_ratio",
            "revenue",
            "sector_avg_gross_margin",
            "sector_avg_operating_margin",
            "sector_avg_net_margin",
            "sector_avg_roe",
            "gross_margin_percentile",
            "operating_margin_percentile",
            "net_margin_percentile",
            "roe_percentile",
            "revenue_percentile",
        )
    ],
    ("peer_count", _L),
)
TIMESERIES = _fields(
    ("cik", _S),
    ("company_name", _S),
    ("ticker", _S),
    ("fiscal_year", _I),
    ("fiscal_period", _S),
    *[
        (c, _D)
        for c in (
            "revenue",
            "net_income",
            "operating_cash_flow",
            "total_assets",
            "ttm_revenue",
            "ttm_net_income",
            "revenue_yoy_prior",
            "revenue_yoy_growth_pct",
            "net_income_yoy_growth_pct",
            "revenue_4q_avg",
            "net_income_4q_avg",
        )
    ],
)

# Load timestamps that the writer adds to a stored table. They are stored but not
# part of its declared columns, so a plain read of the table does not show them.
AUDIT = {
    "raw_companies": ("created_at",),
    "raw_financials": ("created_at",),
    "dim_companies": ("created_at", "updated_at"),
    "dim_taxonomy": ("created_at", "updated_at"),
    "fact_financials": ("created_at",),
    "fact_submissions": ("created_at",),
    "company_metrics": ("last_updated",),
    "financial_ratios": ("last_updated",),
    "peer_comparison": ("last_updated",),
    "timeseries": ("last_updated",),
}

# Unchecked rows may name any year. Their table has one directory per year of
# TABLE_YEAR_RANGE and one for all others, and keeps the year itself as a column.
YEAR_BUCKET = "year_bucket"

# Stored tables: layer, schema, partition column, clustering columns.
TABLES = {
    "raw_companies": ("bronze", RAW_COMPANIES, None, ("cik_padded",)),
    "raw_financials": ("bronze", RAW_FINANCIALS, YEAR_BUCKET, ("cik_padded", "concept")),
    "dim_companies": ("silver", DIM_COMPANIES, None, ("cik",)),
    "dim_taxonomy": ("silver", DIM_TAXONOMY, None, ("concept",)),
    "dim_dates": ("silver", DIM_DATES, None, ("date",)),
    "fact_financials": (
        "silver",
        FACT_FINANCIALS,
        "fiscal_year",
        ("cik", "concept", "end_date"),
    ),
    "fact_submissions": ("silver", FACT_SUBMISSIONS, "fiscal_year", ("cik", "filing_date")),
    "company_metrics": ("gold", COMPANY_METRICS, "fiscal_year", ("cik",)),
    "financial_ratios": ("gold", FINANCIAL_RATIOS, "fiscal_year", ("cik",)),
    "peer_comparison": ("gold", PEER_COMPARISON, "fiscal_year", ("sector", "cik")),
    "timeseries": ("gold", TIMESERIES, "fiscal_year", ("cik",)),
}

# Columns that lookups name but no table is clustered by: they get Bloom filters.
BLOOM = {
    "raw_companies": ("ticker",),
    "dim_companies": ("ticker",),
    "fact_financials": ("accession_number",),
    "fact_submissions": ("accession_number",),
    "company_metrics": ("ticker",),
    "financial_ratios": ("ticker",),
    "peer_comparison": ("ticker",),
    "timeseries": ("ticker",),
}
