"""Gold frames: company metrics, ratios, peer comparison, time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.functions import growth_pct, pct
from ledgerstrata.operators.ranking import percent_ranks
from ledgerstrata.schemas import COMPANY_KEYS, METRIC_CONCEPTS, PERIODS, QUARTERS

SECTOR_YEAR = ("sector", "fiscal_year")


def _one_row_per_company(companies: DataFrame) -> DataFrame:
    """Attributes per company id; a repeated id keeps one row, always the same.

    Rows with a sector, ticker and industry go before rows without; then the
    least values decide.
    """
    names = ("company_name", "ticker", "sector", "industry")
    missing = [F.col(c).isNull().alias(f"no_{c}") for c in ("sector", "ticker", "industry", "company_name")]
    first = F.min(F.struct(*missing, *names)).alias("c")
    return companies.groupBy("cik").agg(first).select("cik", *[f"c.{name}" for name in names])


def _recency() -> Column:
    """Filing date, then period end, in one number: the later pair is the larger.

    Facts hold one row per (company, concept, period end, fiscal year, period),
    so within a company, concept and period no two rows share this number. A
    plain number lets the aggregation stay in the generated hash path, which a
    struct key would leave. A missing date ranks lowest; it is far below any
    date, yet both parts together stay inside a long.
    """
    lowest = F.lit(-(1 << 30)).cast("long")

    def days(name: str) -> Column:
        return F.coalesce(F.unix_date(name).cast("long"), lowest)

    return days("filing_date") * F.lit(1 << 32) + days("end_date")


def latest_facts(facts: DataFrame, companies: DataFrame, unit: str = "USD") -> DataFrame:
    """Last filed value per (company, concept, fiscal year, period) with company columns.

    Ties on the filing date go to the later period end. The facts are reduced
    before they meet the companies. The statement type follows from the concept.
    """
    latest = (
        facts.where(F.col("unit") == unit)
        .groupBy("cik", "concept", "statement_type", "fiscal_year", "fiscal_period")
        .agg(F.max_by("value", _recency()).alias("value"))
    )
    return latest.join(_one_row_per_company(companies), "cik").select(
        *COMPANY_KEYS,
        "fiscal_year",
        "fiscal_period",
        "concept",
        "value",
        F.lit(unit).alias("unit"),
        "statement_type",
    )


def company_metrics(facts: DataFrame, companies: DataFrame, unit: str = "USD") -> DataFrame:
    """One wide row per company and period.

    Picking the latest value of each concept and pivoting the concepts is a
    single aggregation here: each metric takes the value with the greatest
    recency among its concept's rows. The facts therefore cross the network
    once, already reduced per task, and a company with very many rows sends one
    row per task and period. Companies are joined afterwards, on company-period
    rows; Spark chooses the join by the size it sees.
    """

    def latest(concept: str) -> Column:
        # Rows of other concepts have no recency and are passed over.
        return F.max_by("value", F.when(F.col("concept") == concept, F.col("recency")))

    def metric(concepts: tuple[str, ...]) -> Column:
        values = [latest(c) for c in concepts]
        return values[0] if len(values) == 1 else F.greatest(*values)

    wide = (
        facts.where(F.col("unit") == unit)
        .withColumn("recency", _recency())
        .groupBy("cik", "fiscal_year", "fiscal_period")
        .agg(*[metric(concepts).alias(name) for name, concepts in METRIC_CONCEPTS.items()])
    )
    return wide.join(_one_row_per_company(companies), "cik").select(
        *COMPANY_KEYS, "fiscal_year", "fiscal_period", *METRIC_CONCEPTS
    )


# --- ratio groups: name -> column -----------------------------------------


def profitability_ratios() -> dict[str, Column]:
    return {
        "gross_margin_pct": pct("gross_profit", "revenue"),
        "operating_margin_pct": pct("operating_income", "revenue"),
        "net_profit_margin_pct": pct("net_income", "revenue"),
        "return_on_assets_pct": pct("net_income", "total_assets"),
        "return_on_equity_pct": pct("net_income", "stockholders_equity"),
    }


def liquidity_ratios() -> dict[str, Column]:
    owed = F.col("current_liabilities")
    return {
        "current_ratio": F.try_divide(F.col("current_assets"), owed),
        "quick_ratio": F.try_divide(F.col("current_assets") - F.col("inventory"), owed),
        "cash_ratio": F.try_divide(F.col("cash_and_equivalents"), owed),
    }


def leverage_ratios() -> dict[str, Column]:
    equity = F.col("stockholders_equity")
    return {
        "debt_to_assets_pct": pct("total_liabilities", "total_assets"),
        "debt_to_equity_ratio": F.try_divide(F.col("total_liabilities"), equity),
        "long_term_debt_to_equity": F.try_divide(F.col("long_term_debt"), equity),
    }


def efficiency_ratios() -> dict[str, Column]:
    return {
        "asset_turnover": F.try_divide(F.col("revenue"), F.col("total_assets")),
        "receivables_turnover": F.try_divide(F.col("revenue"), F.col("accounts_receivable")),
    }


def operating_ratios() -> dict[str, Column]:
    return {
        "operating_expense_ratio_pct": pct("operating_expenses", "revenue"),
        "rd_intensity_pct": pct("research_and_development", "revenue"),
    }


def cash_flow_ratios() -> dict[str, Column]:
    return {
        "operating_cash_flow_ratio": F.try_divide(F.col("operating_cash_flow"), F.col("net_income")),
        "free_cash_flow_ratio": F.try_divide(free_cash_flow(), F.col("net_income")),
    }


def free_cash_flow() -> Column:
    return F.col("operating_cash_flow") - F.col("capital_expenditures")


def financial_ratios(metrics: DataFrame) -> DataFrame:
    """All ratios on full-year rows. Sector, industry and current liabilities ride along."""
    ratios: dict[str, Column] = {}
    for group in (
        profitability_ratios,
        liquidity_ratios,
        leverage_ratios,
        efficiency_ratios,
        operating_ratios,
        cash_flow_ratios,
    ):
        ratios.update(group())
    return metrics.where("fiscal_period = 'FY'").select(
        *COMPANY_KEYS,
        "fiscal_year",
        "fiscal_period",
        *[column.alias(name) for name, column in ratios.items()],
        "revenue",
        "net_income",
        "total_assets",
        "stockholders_equity",
        "operating_cash_flow",
        "current_liabilities",
    )


# --- peers -----------------------------------------------------------------

SECTOR_AVERAGES = {
    "sector_avg_gross_margin": "gross_margin_pct",
    "sector_avg_operating_margin": "operating_margin_pct",
    "sector_avg_net_margin": "net_profit_margin_pct",
    "sector_avg_roe": "return_on_equity_pct",
}
PERCENTILES = {
    "gross_margin_percentile": "gross_margin_pct",
    "operating_margin_percentile": "operating_margin_pct",
    "net_margin_percentile": "net_profit_margin_pct",
    "roe_percentile": "return_on_equity_pct",
    "revenue_percentile": "revenue",
}


def sector_benchmarks(ratios: DataFrame) -> DataFrame:
    """Average metrics and company count per sector and year (small)."""
    return ratios.groupBy(*SECTOR_YEAR).agg(
        *[F.avg(source).alias(name) for name, source in SECTOR_AVERAGES.items()],
        F.count("*").alias("peer_count"),
    )


def with_sector_averages(ratios: DataFrame) -> DataFrame:
    """Attach the benchmarks: aggregate and join back, so no sector is gathered in one task."""
    return ratios.join(sector_benchmarks(ratios), list(SECTOR_YEAR))


def sector_percentiles(ratios: DataFrame) -> DataFrame:
    """Percent ranks (0-100) within sector and year, NULL ranked lowest."""
    return percent_ranks(ratios, SECTOR_YEAR, ("cik", "fiscal_year"), PERCENTILES)


def peer_comparison(ratios: DataFrame) -> DataFrame:
    """Ratios next to sector averages, percentiles and peer count; companies with a sector only."""
    rated = ratios.where("sector IS NOT NULL")
    ranks = sector_percentiles(rated).drop("sector")
    return with_sector_averages(rated).join(ranks, ["cik", "fiscal_year"]).select(
        *COMPANY_KEYS,
        "fiscal_year",
        "gross_margin_pct",
        "operating_margin_pct",
        "net_profit_margin_pct",
        "return_on_assets_pct",
        "return_on_equity_pct",
        "current_ratio",
        "debt_to_equity_ratio",
        "revenue",
        *SECTOR_AVERAGES,
        *PERCENTILES,
        "peer_count",
    )


# --- time series -------------------------------------------------------------


def company_timeline():
    """Rows of one company in period order. (company, year, period) is unique in
    the metrics and years are range-checked, so a window partition is small."""
    return Window.partitionBy("cik").orderBy(F.asc("fiscal_year"), F.asc("fiscal_period"))


def trailing_sums() -> dict[str, Column]:
    last4 = company_timeline().rowsBetween(-3, 0)
    return {
        "ttm_revenue": F.sum("revenue").over(last4),
        "ttm_net_income": F.sum("net_income").over(last4),
    }


def yearly_growth() -> dict[str, Column]:
    def prior(name: str) -> Column:
        return F.lag(name, 4).over(company_timeline())

    return {
        "revenue_yoy_prior": prior("revenue"),
        "revenue_yoy_growth_pct": growth_pct("revenue", prior("revenue")),
        "net_income_yoy_growth_pct": growth_pct("net_income", prior("net_income")),
    }


def moving_averages() -> dict[str, Column]:
    last4 = company_timeline().rowsBetween(-3, 0)
    return {
        "revenue_4q_avg": F.avg("revenue").over(last4),
        "net_income_4q_avg": F.avg("net_income").over(last4),
    }


def timeseries(metrics: DataFrame, period_scope: str = "mixed") -> DataFrame:
    """Trailing sums, change against four rows earlier and moving averages.

    ``mixed`` keeps full-year rows in the sequence (FY sorts before Q1), so a
    trailing sum is a true twelve-month value on Q4 rows only. ``quarterly``
    leaves the full-year rows out, and then four rows are four quarters.
    """
    periods = {"mixed": PERIODS, "quarterly": QUARTERS}[period_scope]
    return (
        metrics.where(F.col("fiscal_period").isin(*periods))
        .select(
            "cik",
            "company_name",
            "ticker",
            "fiscal_year",
            "fiscal_period",
            "revenue",
            "net_income",
            "operating_cash_flow",
            "total_assets",
        )
        .withColumns({**trailing_sums(), **yearly_growth(), **moving_averages()})
    )


LOOK_BACK = 4  # rows before its own that a row of the time series depends on


def changed_series_years(metrics: DataFrame, changed: DataFrame, period_scope: str = "mixed") -> DataFrame:
    """Years of the time series in which rows change when ``changed`` (cik, fiscal_year) did.

    These are the changed years themselves and the years of the next rows of the same
    company, which may lie beyond a gap. One row per year.
    """
    periods = {"mixed": PERIODS, "quarterly": QUARTERS}[period_scope]
    changed = changed.select("cik", F.col("fiscal_year").alias("changed_year")).distinct()
    rows = metrics.where(F.col("fiscal_period").isin(*periods)).select("cik", "fiscal_year", "fiscal_period")
    order = Window.partitionBy("cik", "changed_year").orderBy("fiscal_year", "fiscal_period")
    later = (
        rows.join(changed, "cik")
        .where("fiscal_year > changed_year")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= LOOK_BACK)
    )
    return later.select("fiscal_year").union(changed.select("changed_year")).distinct()


def timeseries_of_years(metrics: DataFrame, years: list[int], period_scope: str = "mixed") -> DataFrame:
    """The rows of :func:`timeseries` of some years, without windows over the whole history.

    Rows look back at most ``LOOK_BACK`` rows of their company. Two years nearly always
    hold these; only companies that report less are looked up further back.
    """
    periods = {"mixed": PERIODS, "quarterly": QUARTERS}[period_scope]
    reported = metrics.where(F.col("fiscal_period").isin(*periods))
    first, last = min(years), max(years)
    near = reported.where(F.col("fiscal_year").between(first - 2, last))
    enough = F.count_if(F.col("fiscal_year") < first) >= LOOK_BACK
    sparse = near.groupBy("cik").agg(enough.alias("enough")).where(~F.col("enough"))
    far = reported.where(F.col("fiscal_year") < first - 2)
    rows = near.unionByName(far.join(sparse, "cik", "left_semi"))
    return timeseries(rows, period_scope).where(F.col("fiscal_year").isin(years))
