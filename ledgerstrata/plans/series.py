"""Growth and seasonality queries on ``timeseries``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.functions import cagr_ratio, growth_pct, pct, scaled
from ledgerstrata.schemas import QUARTERS
from ledgerstrata.sources.tables import with_tickers

MILLION = 1_000_000
BILLION = 1_000_000_000

# The ticker lists of the two company-list reports.
GROWTH_TICKERS = ("AAPL", "MSFT", "GOOGL", "AMZN", "META")
SEASONAL_TICKERS = ("AAPL", "NKE", "HD", "TGT", "WMT")


def _timeline():
    return Window.partitionBy("cik").orderBy("fiscal_year", "fiscal_period")


def growth_trend(
    series: DataFrame,
    *,
    tickers: Sequence[str] = GROWTH_TICKERS,
    since: int = 2020,
    companies: DataFrame | None = None,
) -> DataFrame:
    """Quarterly revenue, trailing revenue and growth of a few companies, in millions."""
    return (
        with_tickers(series, tickers, companies)
        .where((F.col("fiscal_year") >= since) & (F.col("fiscal_period") != "FY"))
        .orderBy("ticker", "fiscal_year", "fiscal_period")
        .select(
            "company_name",
            "ticker",
            "fiscal_year",
            "fiscal_period",
            scaled("revenue", MILLION).alias("revenue_millions"),
            scaled("ttm_revenue", MILLION).alias("ttm_revenue_millions"),
            F.round("revenue_yoy_growth_pct", 2).alias("yoy_growth_pct"),
            scaled("revenue_4q_avg", MILLION).alias("avg_4q_revenue_millions"),
        )
    )


def accelerating_growth(
    series: DataFrame,
    *,
    year: int = 2023,
    min_revenue: float = 100 * MILLION,
    min_growth: float = 20,
    limit: int = 50,
) -> DataFrame:
    """Quarters that grew faster than the quarter before. The comparison row may
    lie in the year before, so the year filter comes after the window."""
    prior = F.lag("revenue_yoy_growth_pct", 1).over(_timeline())
    year_ago = F.lag("revenue_yoy_growth_pct", 4).over(_timeline())
    current = F.col("revenue_yoy_growth_pct")
    return (
        series.where(F.col("fiscal_period").isin(*QUARTERS) & (F.col("revenue") > min_revenue))
        .withColumns({"prior_quarter_growth": prior, "prior_year_growth": year_ago})
        .where(
            (current > F.col("prior_quarter_growth"))
            & (current > min_growth)
            & (F.col("fiscal_year") == year)
        )
        .withColumn("qoq_acceleration_pct", F.round(current - F.col("prior_quarter_growth"), 2))
        .orderBy(F.desc("qoq_acceleration_pct"), "cik", "fiscal_period")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            "fiscal_year",
            "fiscal_period",
            F.round(current, 2).alias("current_yoy_growth_pct"),
            F.round("prior_quarter_growth", 2).alias("prior_qtr_growth_pct"),
            "qoq_acceleration_pct",
        )
    )


def trailing_year(
    series: DataFrame,
    *,
    since: int = 2022,
    min_ttm: float = BILLION,
    limit: int = 100,
    lag_rows: int = 4,
) -> DataFrame:
    """Trailing-year totals on Q4 rows with margin and growth.

    After the Q4 filter one row is one year: ``lag_rows=4`` compares with four
    years earlier, as the report is written; ``lag_rows=1`` with the year before.
    """
    before = F.lag("ttm_revenue", lag_rows).over(_timeline())
    return (
        series.where(
            (F.col("fiscal_year") >= since)
            & (F.col("ttm_revenue") > min_ttm)
            & (F.col("fiscal_period") == "Q4")
        )
        .withColumn("ttm_revenue_yoy_prior", before)
        .withColumn(
            "ttm_revenue_yoy_growth_pct",
            F.round(growth_pct("ttm_revenue", "ttm_revenue_yoy_prior"), 2),
        )
        .orderBy(F.desc_nulls_last("ttm_revenue_yoy_growth_pct"), "cik", "fiscal_year")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            "fiscal_year",
            "fiscal_period",
            scaled("ttm_revenue", BILLION).alias("ttm_revenue_billions"),
            scaled("ttm_net_income", BILLION).alias("ttm_net_income_billions"),
            F.round(pct("ttm_net_income", "ttm_revenue"), 2).alias("ttm_profit_margin_pct"),
            "ttm_revenue_yoy_prior",
            "ttm_revenue_yoy_growth_pct",
        )
    )


def steady_growth(
    series: DataFrame,
    *,
    since: int = 2020,
    min_quarters: int = 12,
    min_growth: float = 5,
    max_stddev: float = 15,
    limit: int = 50,
) -> DataFrame:
    """Companies whose growth varies little; score is mean over deviation."""
    growth = F.col("revenue_yoy_growth_pct")
    return (
        series.where(
            (F.col("fiscal_year") >= since)
            & F.col("fiscal_period").isin(*QUARTERS)
            & growth.isNotNull()
        )
        .groupBy("cik", "company_name", "ticker")
        .agg(
            F.stddev_samp(growth).alias("stddev"),
            F.avg(growth).alias("mean"),
            F.count("*").alias("quarters_of_data"),
        )
        .where(
            (F.col("quarters_of_data") >= min_quarters)
            & (F.col("mean") > min_growth)
            & (F.col("stddev") < max_stddev)
        )
        .withColumn("consistency_score", F.round(F.try_divide("mean", "stddev"), 2))
        .orderBy(F.desc_nulls_last("consistency_score"), "cik")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            F.round("mean", 2).alias("avg_yoy_growth_pct"),
            F.round("stddev", 2).alias("growth_volatility_stddev"),
            "consistency_score",
            "quarters_of_data",
        )
    )


def seasonality(
    series: DataFrame,
    *,
    tickers: Sequence[str] = SEASONAL_TICKERS,
    first: int = 2020,
    last: int = 2023,
    companies: DataFrame | None = None,
) -> DataFrame:
    """Revenue spread per company and quarter over several years."""
    revenue = F.col("revenue")
    return (
        with_tickers(series, tickers, companies)
        .where(F.col("fiscal_year").between(first, last) & F.col("fiscal_period").isin(*QUARTERS))
        .groupBy("company_name", "ticker", "fiscal_period")
        .agg(
            F.count("*").alias("years_analyzed"),
            scaled(F.avg(revenue), MILLION).alias("avg_revenue_millions"),
            scaled(F.stddev_samp(revenue), MILLION).alias("revenue_stddev_millions"),
            scaled(F.min(revenue), MILLION).alias("min_revenue_millions"),
            scaled(F.max(revenue), MILLION).alias("max_revenue_millions"),
            F.round(pct(F.stddev_samp(revenue), F.avg(revenue)), 2).alias(
                "coefficient_of_variation_pct"
            ),
        )
        .orderBy("ticker", "fiscal_period")
    )


def compound_growth(
    series: DataFrame, *, first: int = 2020, last: int = 2023, limit: int = 100
) -> DataFrame:
    """Compound growth of revenue and net income between two full years."""
    year = F.col("fiscal_year")

    def at(metric: str, when: int, pick) -> Column:
        return pick(F.when(year == when, F.col(metric))).alias(f"{metric}_{when}")

    span = last - first
    begin, end = F.col(f"revenue_{first}"), F.col(f"revenue_{last}")
    rate = f"revenue_cagr_{span}yr_pct"
    return (
        series.where((F.col("fiscal_period") == "FY") & year.isin(first, last))
        .groupBy("cik", "company_name", "ticker")
        .agg(
            at("revenue", first, F.min),
            at("revenue", last, F.max),
            at("net_income", first, F.min),
            at("net_income", last, F.max),
        )
        .where(begin.isNotNull() & end.isNotNull() & (begin > 0) & (end > begin))
        .withColumn(rate, F.round(cagr_ratio(end, begin, span) * 100, 2))
        .orderBy(F.desc(rate), "cik")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            scaled(begin, BILLION).alias(f"revenue_{first}_billions"),
            scaled(end, BILLION).alias(f"revenue_{last}_billions"),
            rate,
            scaled(f"net_income_{first}", BILLION).alias(f"net_income_{first}_billions"),
            scaled(f"net_income_{last}", BILLION).alias(f"net_income_{last}_billions"),
            F.round(
                cagr_ratio(f"net_income_{last}", f"net_income_{first}", span) * 100, 2
            ).alias(f"net_income_cagr_{span}yr_pct"),
        )
    )


def recovery(
    series: DataFrame,
    *,
    before: int = 2019,
    now: int = 2023,
    min_revenue: float = 100 * MILLION,
    limit: int = 100,
) -> DataFrame:
    """Full-year revenue now against a base year and the low point between them."""
    year, revenue = F.col("fiscal_year"), F.col("revenue")
    base, trough, current = F.col("base"), F.col("trough"), F.col("current")
    return (
        series.where((F.col("fiscal_period") == "FY") & year.between(before, now))
        .groupBy("cik", "company_name", "ticker")
        .agg(
            F.max(F.when(year == before, revenue)).alias("base"),
            F.min(revenue).alias("trough"),
            F.max(F.when(year == now, revenue)).alias("current"),
        )
        .where(base > min_revenue)
        .withColumn(f"recovery_vs_{before}_pct", F.round(growth_pct("current", "base"), 2))
        .orderBy(F.desc_nulls_last(f"recovery_vs_{before}_pct"), "cik")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            scaled(base, BILLION).alias("pre_pandemic_revenue_billions"),
            scaled(trough, BILLION).alias("trough_revenue_billions"),
            scaled(current, BILLION).alias("current_revenue_billions"),
            F.round(growth_pct("trough", "base"), 2).alias("pandemic_decline_pct"),
            f"recovery_vs_{before}_pct",
            F.when(current > base * 1.1, "Recovered+")
            .when(current > base, "Recovered")
            .when(current > trough, "Recovering")
            .otherwise("Still Below Trough")
            .alias("recovery_status"),
        )
    )
