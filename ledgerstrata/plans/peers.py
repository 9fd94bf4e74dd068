"""Benchmark queries on ``peer_comparison``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.functions import pct, scaled

BILLION = 1_000_000_000


def company_vs_sector(peers: DataFrame, *, year: int = 2023) -> DataFrame:
    """Company metrics beside the sector averages, with gaps and percentiles."""

    def gap(metric: str, average: str, name: str):
        return F.round(F.col(metric) - F.col(average), 2).alias(name)

    return (
        peers.where(F.col("ticker").isNotNull() & (F.col("fiscal_year") == year))
        .orderBy("sector", F.desc("net_margin_percentile"), "cik")
        .select(
            "company_name",
            "ticker",
            "sector",
            "fiscal_year",
            F.col("gross_margin_pct").alias("company_gross_margin"),
            F.col("operating_margin_pct").alias("company_operating_margin"),
            F.col("net_profit_margin_pct").alias("company_net_margin"),
            F.col("return_on_equity_pct").alias("company_roe"),
            "sector_avg_gross_margin",
            "sector_avg_operating_margin",
            "sector_avg_net_margin",
            "sector_avg_roe",
            gap("gross_margin_pct", "sector_avg_gross_margin", "gross_margin_vs_sector"),
            gap("operating_margin_pct", "sector_avg_operating_margin", "operating_margin_vs_sector"),
            gap("net_profit_margin_pct", "sector_avg_net_margin", "net_margin_vs_sector"),
            *[
                F.round(p, 0).alias(p)
                for p in (
                    "gross_margin_percentile",
                    "operating_margin_percentile",
                    "net_margin_percentile",
                )
            ],
            "peer_count",
        )
    )


def top_quartile(peers: DataFrame, *, year: int = 2023, percentile: float = 75) -> DataFrame:
    return (
        peers.where(
            (F.col("net_margin_percentile") >= percentile)
            & (F.col("fiscal_year") == year)
            & F.col("sector").isNotNull()
        )
        .orderBy("sector", F.desc("net_margin_percentile"), "cik")
        .select(
            "sector",
            "company_name",
            "ticker",
            "fiscal_year",
            "net_profit_margin_pct",
            "return_on_equity_pct",
            "revenue",
            "net_margin_percentile",
            "roe_percentile",
        )
    )


def bottom_quartile(
    peers: DataFrame, *, year: int = 2023, percentile: float = 25, min_revenue: float = 100_000_000
) -> DataFrame:
    return (
        peers.where(
            (F.col("net_margin_percentile") <= percentile)
            & (F.col("fiscal_year") == year)
            & (F.col("revenue") > min_revenue)
        )
        .orderBy("net_margin_percentile", "cik")
        .select(
            "sector",
            "company_name",
            "ticker",
            "fiscal_year",
            "net_profit_margin_pct",
            "sector_avg_net_margin",
            (F.col("net_profit_margin_pct") - F.col("sector_avg_net_margin")).alias("margin_gap"),
            "net_margin_percentile",
            "current_ratio",
            "debt_to_equity_ratio",
        )
    )


def sector_leaders(
    peers: DataFrame, *, year: int = 2023, min_revenue: float = 500_000_000, per_sector: int = 3
) -> DataFrame:
    """Best companies per sector by the mean of four percentiles."""
    parts = [
        "gross_margin_percentile",
        "operating_margin_percentile",
        "net_margin_percentile",
        "roe_percentile",
    ]
    score = sum((F.col(p) for p in parts[1:]), F.col(parts[0])) / F.lit(len(parts))
    rank = F.row_number().over(
        Window.partitionBy("sector").orderBy(F.desc("composite_score"), "cik")
    )
    return (
        peers.where(
            (F.col("fiscal_year") == year)
            & F.col("sector").isNotNull()
            & (F.col("revenue") > min_revenue)
        )
        .withColumn("composite_score", score)
        .withColumn("sector_rank", rank)
        .where(F.col("sector_rank") <= per_sector)
        .orderBy("sector", "sector_rank")
        .select(
            "sector",
            "sector_rank",
            "company_name",
            "ticker",
            F.round("composite_score", 1).alias("overall_score"),
            *[
                F.round(m, 2).alias(m)
                for m in (
                    "gross_margin_pct",
                    "operating_margin_pct",
                    "net_profit_margin_pct",
                    "return_on_equity_pct",
                )
            ],
        )
    )


def peer_group(
    peers: DataFrame, *, ticker: str = "AAPL", year: int = 2023, min_revenue: float = 10 * BILLION
) -> DataFrame:
    """Peers of one company: same sector and year, the company itself marked."""
    target = (
        peers.where((F.col("ticker") == ticker) & (F.col("fiscal_year") == year))
        .select("sector", "fiscal_year")
        .limit(1)
    )
    # The target is one row, so it is sent to the peers and no sector is moved.
    return (
        peers.where((F.col("fiscal_year") == year) & (F.col("revenue") > min_revenue))
        .join(F.broadcast(target), ["sector", "fiscal_year"])
        .orderBy(F.desc("net_margin_percentile"), "cik")
        .select(
            F.when(F.col("ticker") == ticker, F.lit(">>> TARGET <<<"))
            .otherwise(F.lit(""))
            .alias("target_flag"),
            "company_name",
            "ticker",
            scaled("revenue", BILLION).alias("revenue_billions"),
            F.round("gross_margin_pct", 2).alias("gross_margin_pct"),
            F.round("operating_margin_pct", 2).alias("operating_margin_pct"),
            F.round("net_profit_margin_pct", 2).alias("net_profit_margin_pct"),
            F.round("return_on_equity_pct", 2).alias("roe_pct"),
            F.round("net_margin_percentile", 0).alias("net_margin_percentile"),
        )
    )


def market_share(peers: DataFrame, *, year: int = 2023, percentile: float = 90) -> DataFrame:
    """Share of sector revenue of the largest companies.

    Totals are aggregated and joined back; a window over the sector would pull
    each sector into one task.
    """
    of_year = peers.where(F.col("fiscal_year") == year)
    totals = (
        of_year.where(F.col("sector").isNotNull())
        .groupBy("sector", "fiscal_year")
        .agg(F.sum("revenue").alias("total_sector_revenue"))
    )
    share = F.round(pct("revenue", "total_sector_revenue"), 2)
    return (
        of_year.where(F.col("revenue_percentile") >= percentile)
        .join(totals, ["sector", "fiscal_year"])
        .withColumn("market_share_pct", share)
        .orderBy("sector", F.desc("market_share_pct"), "cik")
        .select(
            "sector",
            "company_name",
            "ticker",
            scaled("revenue", BILLION).alias("revenue_billions"),
            scaled("total_sector_revenue", BILLION).alias("sector_revenue_billions"),
            "market_share_pct",
            F.round("revenue_percentile", 0).alias("revenue_percentile"),
        )
    )
