"""The data behind the dashboard components. Drawing is left to a BI tool.

"Latest" values are scalar subqueries: one small aggregation decides the year
or quarter at run time and the main scan then reads only those directories.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.functions import band, growth_pct, pct, period_index, scaled
from ledgerstrata.operators.gold import free_cash_flow
from ledgerstrata.operators.ranking import group_quantiles, percent_ranks
from ledgerstrata.plans.ratios import latest_year
from ledgerstrata.schemas import QUARTERS

BILLION = 1_000_000_000

MARGIN_MEANS = {
    "avg_gross_margin": "gross_margin_pct",
    "avg_operating_margin": "operating_margin_pct",
    "avg_net_margin": "net_profit_margin_pct",
    "avg_roe": "return_on_equity_pct",
}
STATEMENT_LINES = {
    "income_statement": (
        "revenue",
        "cost_of_revenue",
        "gross_profit",
        "operating_expenses",
        "operating_income",
        "net_income",
    ),
    "balance_sheet": (
        "total_assets",
        "current_assets",
        "cash_and_equivalents",
        "total_liabilities",
        "current_liabilities",
        "long_term_debt",
        "stockholders_equity",
    ),
    "cash_flow": (
        "operating_cash_flow",
        "investing_cash_flow",
        "financing_cash_flow",
        "capital_expenditures",
    ),
}
CARD_RATIOS = (
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
HEATMAP_METRICS = (
    "gross_margin_pct",
    "operating_margin_pct",
    "net_profit_margin_pct",
    "return_on_equity_pct",
    "return_on_assets_pct",
    "current_ratio",
    "debt_to_equity_ratio",
    "revenue_growth_pct",
)
COMPARISONS = {"QoQ": 1, "YoY": 4, "3-Year": 12}


def _quarters(df: DataFrame) -> DataFrame:
    return df.where(F.col("fiscal_period").isin(*QUARTERS))


def _year(df: DataFrame, year: int | None) -> DataFrame:
    return df.where(F.col("fiscal_year") == (latest_year(df) if year is None else F.lit(year)))


def with_annual_growth(ratios: DataFrame, name: str = "revenue_growth_pct") -> DataFrame:
    """Full-year revenue against exactly the year before (NULL across a gap)."""
    year_ago = Window.partitionBy("cik").orderBy("fiscal_year").rangeBetween(-1, -1)
    return ratios.withColumn(name, growth_pct("revenue", F.max("revenue").over(year_ago)))


# --- executive summary -------------------------------------------------------


def executive_scorecards(metrics: DataFrame, series: DataFrame, ratios: DataFrame) -> DataFrame:
    """Companies, trailing revenue of the latest quarter, latest mean margin and
    the number of companies growing in the latest quarter. One row."""
    # The year on its own prunes directories; the period is then sought in that year.
    in_year = _year(_quarters(series), None)
    latest = in_year.where(F.col("fiscal_period") == in_year.agg(F.max("fiscal_period")).scalar())
    growing = F.when(F.col("revenue_yoy_growth_pct") > 0, F.col("cik"))
    # Both figures of the quarter come from one aggregation.
    quarter = latest.agg(
        F.struct(
            scaled(F.sum("ttm_revenue"), BILLION).alias("ttm"), F.count_distinct(growing).alias("growing")
        )
    ).scalar()
    return metrics.agg(F.count_distinct("cik").alias("total_companies")).select(
        "total_companies",
        quarter["ttm"].alias("ttm_revenue_billions"),
        _year(ratios, None)
        .agg(F.round(F.avg("net_profit_margin_pct"), 2))
        .scalar()
        .alias("avg_profit_margin_pct"),
        quarter["growing"].alias("positive_growth_companies"),
    )


def margin_of_sums(metrics: DataFrame, by: Sequence[str] = ("fiscal_year",)) -> DataFrame:
    """Ratio of totals, not mean of ratios, on full-year rows."""
    margin = pct(F.sum("net_income"), F.sum("revenue"))
    return (
        metrics.where("fiscal_period = 'FY'")
        .groupBy(*by)
        .agg(F.round(margin, 4).alias("avg_profit_margin_pct"))
    )


def revenue_trend(series: DataFrame, quarters: int = 12) -> DataFrame:
    """Market-wide trailing revenue and mean growth of the last quarters."""
    return (
        _quarters(series)
        .groupBy("fiscal_year", "fiscal_period")
        .agg(
            scaled(F.sum("ttm_revenue"), BILLION).alias("ttm_revenue_billions"),
            F.round(F.avg("revenue_yoy_growth_pct"), 2).alias("avg_yoy_growth_pct"),
        )
        .orderBy(F.desc("fiscal_year"), F.desc("fiscal_period"))
        .limit(quarters)
        .orderBy("fiscal_year", "fiscal_period")
    )


def top_companies(metrics: DataFrame, limit: int = 25) -> DataFrame:
    """Largest companies by revenue in the latest full year."""
    return (
        _year(metrics.where("fiscal_period = 'FY'"), None)
        .orderBy(F.desc_nulls_last("revenue"), "cik")
        .limit(limit)
        .select("company_name", "ticker", "fiscal_year", "revenue")
    )


def sector_distribution(ratios: DataFrame, year: int | None = None) -> DataFrame:
    """Companies per sector with their share of all."""
    counts = (
        _year(ratios, year).groupBy("sector").agg(F.count_distinct("cik").alias("company_count"))
    )
    total = counts.agg(F.sum("company_count")).scalar()
    return counts.withColumn("share_pct", F.round(pct("company_count", total), 2))


def profitability_heatmap(ratios: DataFrame, year: int | None = None, digits: int = 6) -> DataFrame:
    """Mean margins per sector, each banded against the quartiles of the sector means.

    Means are rounded before they are compared, so a mean that sits on a cut
    point falls on the same side in every run.
    """
    means = (
        _year(ratios, year)
        .where(F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(*[F.round(F.avg(src), digits).alias(name) for name, src in MARGIN_MEANS.items()])
    )
    cuts = means.agg(
        F.struct(
            *[
                F.percentile(name, F.array(F.lit(0.25), F.lit(0.75))).alias(name)
                for name in MARGIN_MEANS
            ]
        )
    ).scalar()
    with_cuts = means.withColumn("cuts", cuts)
    return with_cuts.select(
        "sector",
        *MARGIN_MEANS,
        *[
            band(name, F.col(f"cuts.{name}")[0], F.col(f"cuts.{name}")[1]).alias(f"{name}_band")
            for name in MARGIN_MEANS
        ],
    )


def recent_filings(metrics: DataFrame, submissions: DataFrame, limit: int = 50) -> DataFrame:
    """Newest filings with the figures of their period.

    The filings of the newest two years that have figures give a date that
    ``limit`` of them reach. Whatever is among the newest overall was filed then
    or later, so older filings are left out before the tables are joined.
    """
    keys = ["cik", "fiscal_year", "fiscal_period"]
    filed = submissions.where(F.col("filing_date").isNotNull()).select(
        *keys, "filing_date", "accession_number"
    )
    newest_year = latest_year(metrics)
    sample = (
        filed.where(F.col("fiscal_year") >= newest_year - 1)
        .join(metrics.where(F.col("fiscal_year") >= newest_year - 1).select(*keys), keys)
        .orderBy(F.desc("filing_date"))
        .limit(limit)
    )
    enough = F.when(F.count("*") >= limit, F.min("filing_date"))
    bound = sample.agg(F.coalesce(enough, F.lit("0001-01-01").cast("date"))).scalar()
    return (
        metrics.join(filed.where(F.col("filing_date") >= bound), keys)
        .orderBy(F.desc("filing_date"), "cik", "accession_number")
        .limit(limit)
        .select(
            "company_name",
            "ticker",
            "fiscal_year",
            "fiscal_period",
            "revenue",
            "net_income",
            "filing_date",
        )
    )


def global_filters(
    df: DataFrame,
    *,
    years: Sequence[int] | None = None,
    latest_years: int = 2,
    sectors: Sequence[str] | None = None,
    min_revenue: float | None = None,
) -> DataFrame:
    """Year (default: the latest two present), sector and revenue filters."""
    if years is None:
        newest = df.select("fiscal_year").distinct().orderBy(F.desc("fiscal_year")).limit(latest_years)
        df = df.where(F.col("fiscal_year") >= newest.agg(F.min("fiscal_year")).scalar())
    else:
        df = df.where(F.col("fiscal_year").isin(*years))
    if sectors is not None:
        df = df.where(F.col("sector").isin(*sectors))
    if min_revenue is not None:
        df = df.where(F.col("revenue") >= min_revenue)
    return df


def size_class(
    revenue: Column | str = "revenue", medium: float = BILLION, large: float = 10 * BILLION
) -> Column:
    """Small / Medium / Large by revenue bracket."""
    revenue = F.col(revenue) if isinstance(revenue, str) else revenue
    return (
        F.when(revenue >= large, "Large")
        .when(revenue >= medium, "Medium")
        .when(revenue.isNotNull(), "Small")
    )


# --- one company -------------------------------------------------------------


def company_id(companies: DataFrame, ticker: str) -> Column:
    """Id of a ticker as a scalar subquery on the company dimension.

    Tables are clustered by company id, not by ticker: a lookup by id skips the
    row groups of all other companies, and this turns a ticker into one. These
    pages show one company: a ticker that several share is an error, which asks for
    an id.
    """
    several = F.raise_error(F.lit(f"ticker {ticker} names several companies; give a cik")).cast("string")
    only = F.when(F.min("cik") < F.max("cik"), several).otherwise(F.min("cik"))
    return companies.where(F.col("ticker") == ticker).agg(only).scalar()


def select_company(
    df: DataFrame, *, ticker: str | None = None, cik: str | Column | None = None
) -> DataFrame:
    """Rows of one company by ticker or id."""
    if (ticker is None) == (cik is None):
        raise ValueError("give either a ticker or a cik")
    return df.where(F.col("ticker") == ticker if cik is None else F.col("cik") == cik)


def company_header(metrics: DataFrame, **company: str | Column) -> DataFrame:
    """Name, sector and newest figures of a company."""
    return (
        select_company(metrics, **company)
        .orderBy(F.desc("fiscal_year"), F.desc("fiscal_period"), "cik")
        .limit(1)
        .select(
            "company_name",
            "ticker",
            "sector",
            "industry",
            "fiscal_year",
            "fiscal_period",
            F.col("revenue").alias("latest_revenue"),
            F.col("net_income").alias("latest_net_income"),
        )
    )


def statement_table(
    metrics: DataFrame,
    statement: str = "income_statement",
    years: Sequence[int] = (2020, 2021, 2022, 2023),
    **company: str | Column,
) -> DataFrame:
    """Line items down, fiscal years across. The years are given, so the pivot
    needs no pass to find them."""
    lines = STATEMENT_LINES[statement]
    long = (
        select_company(metrics, **company)
        .where((F.col("fiscal_period") == "FY") & F.col("fiscal_year").isin(*years))
        .unpivot(["fiscal_year"], list(lines), "line_item", "amount")
    )
    order = F.array_position(F.array(*[F.lit(line) for line in lines]), F.col("line_item"))
    return (
        long.groupBy("line_item")
        .pivot("fiscal_year", list(years))
        .agg(F.max("amount"))
        .select(
            order.cast("int").alias("line_no"),
            "line_item",
            *[F.col(str(y)).alias(f"fy_{y}") for y in years],
        )
        .orderBy("line_no")
    )


def ratio_cards(ratios: DataFrame, year: int, **company: str | Column) -> DataFrame:
    """Key ratios of a company: value, change on the year before, sector mean."""
    this, before = F.col("fiscal_year") == year, F.col("fiscal_year") == year - 1
    own = (
        select_company(ratios, **company)
        .where(this | before)
        .groupBy("cik")
        .agg(
            F.max(F.when(this, F.col("sector"))).alias("sector"),
            *[F.max(F.when(this, F.col(r))).alias(r) for r in CARD_RATIOS],
            *[F.max(F.when(before, F.col(r))).alias(f"prior_{r}") for r in CARD_RATIOS],
        )
    )
    sector = (
        ratios.where(this & F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(*[F.avg(r).alias(f"mean_{r}") for r in CARD_RATIOS])
    )
    cards = F.array(
        *[
            F.struct(
                F.lit(r).alias("ratio"),
                F.round(F.col(r), 4).alias("value"),
                F.round(F.col(r) - F.col(f"prior_{r}"), 4).alias("yoy_change"),
                F.round(F.col(f"mean_{r}"), 4).alias("sector_avg"),
            )
            for r in CARD_RATIOS
        ]
    )
    return own.join(sector, "sector", "left").select(F.inline(cards))


def quarterly_trends(metrics: DataFrame, quarters: int = 12, **company: str | Column) -> DataFrame:
    """Last quarters of a company with free cash flow, oldest first."""
    return (
        _quarters(select_company(metrics, **company))
        .orderBy(F.desc("fiscal_year"), F.desc("fiscal_period"), "cik")
        .limit(quarters)
        .orderBy("fiscal_year", "fiscal_period")
        .select(
            "fiscal_year",
            "fiscal_period",
            "revenue",
            "net_income",
            "operating_cash_flow",
            free_cash_flow().alias("free_cash_flow"),
        )
    )


def ttm_vs_annual(metrics: DataFrame) -> DataFrame:
    """Per company and metric: last four quarters against the last full year."""
    names = ("revenue", "net_income", "operating_income")
    annual = F.col("fiscal_period") == "FY"
    timeline = Window.partitionBy("cik", "annual").orderBy("fiscal_year", "fiscal_period")
    last4 = timeline.rowsBetween(-3, 0)
    rows = (
        metrics.where(F.col("fiscal_period").isin(*QUARTERS, "FY"))
        .withColumn("annual", annual)
        .withColumns({f"ttm_{n}": F.sum(n).over(last4) for n in names})
    )
    when = F.struct("fiscal_year", "fiscal_period")
    quarter_row, annual_row = F.when(~F.col("annual"), when), F.when(F.col("annual"), when)
    both = F.array(
        *[
            F.struct(
                F.lit(n).alias("metric"),
                F.max_by(f"ttm_{n}", quarter_row).alias("ttm_value"),
                F.max_by(n, annual_row).alias("annual_value"),
            )
            for n in names
        ]
    )
    return (
        rows.groupBy("cik", "company_name", "ticker")
        .agg(both.alias("pairs"))
        .select("cik", "company_name", "ticker", F.inline("pairs"))
    )


def peer_table(peers: DataFrame, year: int, **company: str | Column) -> DataFrame:
    """Metrics of a company against sector mean and percentile."""
    rows = (
        ("gross_margin_pct", "sector_avg_gross_margin", "gross_margin_percentile"),
        ("operating_margin_pct", "sector_avg_operating_margin", "operating_margin_percentile"),
        ("net_profit_margin_pct", "sector_avg_net_margin", "net_margin_percentile"),
        ("return_on_equity_pct", "sector_avg_roe", "roe_percentile"),
        ("return_on_assets_pct", None, None),
        ("current_ratio", None, None),
        ("debt_to_equity_ratio", None, None),
        ("revenue", None, "revenue_percentile"),
    )
    none = F.lit(None).cast("double")
    table = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                F.round(F.col(metric), 4).alias("company_value"),
                (F.round(F.col(mean), 4) if mean else none).alias("sector_avg"),
                (F.round(F.col(rank), 2) if rank else none).alias("percentile_rank"),
                ((F.col(metric) > F.col(mean)) if mean else F.lit(None).cast("boolean")).alias(
                    "outperforms"
                ),
            )
            for metric, mean, rank in rows
        ]
    )
    return (
        select_company(peers, **company).where(F.col("fiscal_year") == year).select(F.inline(table))
    )


def period_comparison(metrics: DataFrame, metric: str = "revenue", compare: str = "YoY") -> DataFrame:
    """Each quarter against the quarter exactly one, four or twelve before.

    A RANGE frame on the running quarter number finds the very period, so a
    missing quarter gives NULL instead of a neighbour, in one pass per company.
    """
    steps = COMPARISONS[compare]
    exact = Window.partitionBy("cik").orderBy("period_no").rangeBetween(-steps, -steps)
    return (
        _quarters(metrics)
        .select("cik", "ticker", "fiscal_year", "fiscal_period", F.col(metric).alias("value"))
        .withColumn("period_no", period_index("fiscal_year", "fiscal_period"))
        .withColumn("prior_value", F.max("value").over(exact))
        .withColumn("change_pct", F.round(growth_pct("value", "prior_value"), 4))
        .drop("period_no")
    )


# --- peers -------------------------------------------------------------------


def metrics_heatmap(
    ratios: DataFrame, sector: str = "Technology", year: int = 2023, top: int = 50
) -> DataFrame:
    """Largest companies of a sector: metrics and their percentile in the whole sector."""
    in_sector = F.col("sector") == sector
    before = ratios.where((F.col("fiscal_year") == year - 1) & in_sector).select(
        "cik", F.col("revenue").alias("prior_revenue")
    )
    rows = (
        ratios.where((F.col("fiscal_year") == year) & in_sector)
        .join(before, "cik", "left")
        .withColumn("revenue_growth_pct", growth_pct("revenue", "prior_revenue"))
    )
    ranks = percent_ranks(
        rows, ["sector"], ["cik"], {f"{m}_percentile": m for m in HEATMAP_METRICS}
    ).drop("sector")
    largest = rows.orderBy(F.desc_nulls_last("revenue"), "cik").limit(top)
    # ``largest`` has at most ``top`` rows by construction.
    return (
        ranks.join(F.broadcast(largest), "cik")
        .orderBy(F.desc_nulls_last("revenue"), "cik")
        .select(
            "cik",
            "company_name",
            "ticker",
            "revenue",
            *[F.round(m, 4).alias(m) for m in HEATMAP_METRICS],
            *[F.round(f"{m}_percentile", 2).alias(f"{m}_percentile") for m in HEATMAP_METRICS],
        )
    )


def trendline(
    ratios: DataFrame,
    x: str = "return_on_equity_pct",
    y: str = "net_profit_margin_pct",
    *,
    year: int | None = None,
    by_sector: bool = True,
) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` with the number of points."""
    points = _year(ratios, year).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = [
        F.count("*").alias("points"),
        F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_intercept(y, x), 6).alias("intercept"),
        F.round(F.regr_r2(y, x), 6).alias("r2"),
    ]
    return points.groupBy("sector").agg(*fit) if by_sector else points.agg(*fit)


def percentile_bands(peers: DataFrame, year: int, **company: str | Column) -> DataFrame:
    """Percentiles of a company in three bands (below 25, 25-75, above 75)."""
    names = [
        "gross_margin_percentile",
        "operating_margin_percentile",
        "net_margin_percentile",
        "roe_percentile",
        "revenue_percentile",
    ]
    return (
        select_company(peers, **company)
        .where(F.col("fiscal_year") == year)
        .unpivot(["cik", "ticker"], names, "metric", "percentile")
        .select(
            "cik",
            "ticker",
            "metric",
            F.round("percentile", 4).alias("percentile"),
            band("percentile", 25.0, 75.0).alias("band"),
        )
    )


def leaderboards(ratios: DataFrame, year: int = 2023, top: int = 10) -> DataFrame:
    """Best companies by margin, return, growth and liquidity with the sector mean."""
    boards = [
        "net_profit_margin_pct",
        "return_on_equity_pct",
        "revenue_growth_pct",
        "current_ratio",
    ]
    rows = (
        with_annual_growth(ratios.where(F.col("fiscal_year").between(year - 1, year)))
        .where((F.col("fiscal_year") == year) & F.col("sector").isNotNull())
        .unpivot(["cik", "company_name", "ticker", "sector"], boards, "metric", "value")
        .where(F.col("value").isNotNull())
    )
    means = rows.groupBy("metric", "sector").agg(F.round(F.avg("value"), 4).alias("sector_avg"))
    # Limited per task before the shuffle on the few metric names.
    place = F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("value"), "cik"))
    leaders = rows.withColumn("rank", place).where(F.col("rank") <= top)
    # At most ``top`` rows per board: four boards.
    return (
        means.join(F.broadcast(leaders), ["metric", "sector"])
        .select(
            "metric",
            "rank",
            "company_name",
            "ticker",
            F.round("value", 4).alias("value"),
            "sector_avg",
        )
        .orderBy("metric", "rank")
    )


def histogram(
    ratios: DataFrame,
    metric: str = "net_profit_margin_pct",
    *,
    width: float = 5.0,
    year: int | None = None,
    ticker: str | None = None,
) -> DataFrame:
    """Companies per fixed-width bin and sector; the bin of ``ticker`` is marked."""
    bin_no = F.floor(F.col(metric) / F.lit(float(width)))
    selected = F.lit(False) if ticker is None else F.coalesce(F.col("ticker") == ticker, F.lit(False))
    return (
        _year(ratios, year)
        .where(F.col(metric).isNotNull())
        .groupBy("sector", bin_no.cast("long").alias("bin"))
        .agg(F.count("*").alias("companies"), F.bool_or(selected).alias("has_selected"))
        .withColumns(
            {
                "bin_low": F.col("bin") * F.lit(float(width)),
                "bin_high": (F.col("bin") + 1) * F.lit(float(width)),
            }
        )
    )


# --- industry ----------------------------------------------------------------


def market_overview(metrics: DataFrame, series: DataFrame) -> DataFrame:
    """Companies, sectors, latest full-year revenue and mean growth. One row."""
    latest = _year(metrics.where("fiscal_period = 'FY'"), None)
    return metrics.agg(F.count_distinct("cik").alias("total_companies")).select(
        "total_companies",
        metrics.agg(F.count_distinct("sector")).scalar().alias("total_sectors"),
        latest.agg(scaled(F.sum("revenue"), BILLION)).scalar().alias("aggregate_revenue_billions"),
        series.agg(F.round(F.avg("revenue_yoy_growth_pct"), 2))
        .scalar()
        .alias("avg_revenue_growth_pct"),
    )


def sector_performance(ratios: DataFrame, year: int | None = None, digits: int = 2) -> DataFrame:
    return (
        _year(ratios, year)
        .where(F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(*[F.round(F.avg(src), digits).alias(name) for name, src in MARGIN_MEANS.items()])
        .orderBy("sector")
    )


def revenue_treemap(metrics: DataFrame, year: int | None = None) -> DataFrame:
    """Revenue and margin per company with sector subtotals and the grand total."""
    return (
        _year(metrics.where("fiscal_period = 'FY'"), year)
        .where(F.col("sector").isNotNull())
        .rollup("sector", "company_name")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("revenue").alias("revenue"),
            F.round(pct(F.sum("net_income"), F.sum("revenue")), 4).alias("profit_margin_pct"),
        )
    )


def growth_boxplot(series: DataFrame, companies: DataFrame) -> DataFrame:
    """Quartiles, extremes and 1.5-IQR outliers of quarterly growth per sector."""
    sectors = companies.where(F.col("sector").isNotNull()).select("cik", "sector")
    growth = F.col("revenue_yoy_growth_pct")
    rows = (
        _quarters(series)
        .where(growth.isNotNull())
        .select("cik", "fiscal_year", "fiscal_period", growth.alias("growth"))
        .join(sectors, "cik")
    )
    box = group_quantiles(rows, ["sector"], "growth", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    outside = (F.col("growth") < F.col("q1") - reach) | (F.col("growth") > F.col("q3") + reach)
    # The box is constant per sector; aggregating it along keeps one shuffle.
    return (
        rows.join(box, "sector")
        .groupBy("sector")
        .agg(
            F.count("*").alias("observations"),
            F.round(F.min("growth"), 4).alias("min_growth"),
            *[F.round(F.max(q), 4).alias(q) for q in ("q1", "median", "q3")],
            F.round(F.max("growth"), 4).alias("max_growth"),
            F.count_if(outside).alias("outliers"),
        )
    )


def sector_revenue_trend(metrics: DataFrame, years: int = 3) -> DataFrame:
    """Quarterly revenue per sector over the last years."""
    return (
        _quarters(metrics)
        .where(F.col("sector").isNotNull() & (F.col("fiscal_year") > latest_year(metrics) - years))
        .groupBy("sector", "fiscal_year", "fiscal_period")
        .agg(scaled(F.sum("revenue"), BILLION, 4).alias("revenue_billions"))
        .orderBy("sector", "fiscal_year", "fiscal_period")
    )


def correlation_matrix(ratios: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, all pairs in one aggregation."""
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("metric_x"),
                F.lit(b).alias("metric_y"),
                F.round(F.corr(a, b), 6).alias("correlation"),
            )
            for i, a in enumerate(metrics)
            for b in metrics[i:]
        ]
    )
    pairs = ratios.agg(cells.alias("cells")).select(F.inline("cells"))
    mirrored = F.array(
        F.struct("metric_x", "metric_y", "correlation"),
        F.struct(
            F.col("metric_y").alias("metric_x"), F.col("metric_x").alias("metric_y"), "correlation"
        ),
    )
    one = F.slice(mirrored, 1, 1)
    return pairs.select(
        F.inline(F.when(F.col("metric_x") == F.col("metric_y"), one).otherwise(mirrored))
    )


def market_share_stack(peers: DataFrame, year: int = 2023, top: int = 10) -> DataFrame:
    """Largest companies per sector plus one row for all others.

    The others are the sector total less the leaders, so only leaders are ever
    ranked and the long tail is just summed.
    """
    rows = peers.where((F.col("fiscal_year") == year) & F.col("revenue").isNotNull())
    place = F.row_number().over(Window.partitionBy("sector").orderBy(F.desc("revenue"), "cik"))
    leaders = (
        rows.withColumn("position", place)
        .where(F.col("position") <= top)
        .select("sector", "position", "company_name", "revenue")
    )
    totals = rows.groupBy("sector").agg(
        F.sum("revenue").alias("sector_revenue"), F.count("*").alias("companies")
    )
    # One row per sector on both sides of this join.
    led = leaders.groupBy("sector").agg(
        F.sum("revenue").alias("led_revenue"), F.count("*").alias("led")
    )
    both = totals.join(led, "sector")
    others = both.where(F.col("companies") > F.col("led")).select(
        "sector",
        F.lit(top + 1).alias("position"),
        F.lit("Others").alias("company_name"),
        (F.col("sector_revenue") - F.col("led_revenue")).alias("revenue"),
    )
    share = F.round(pct("revenue", "sector_revenue"), 4)
    return (
        leaders.unionByName(others)
        .join(totals.drop("companies"), "sector")
        .select("sector", "position", "company_name", "revenue", share.alias("share_pct"))
        .orderBy("sector", "position")
    )


# --- data blending -------------------------------------------------------------


def blend(df: DataFrame, external: DataFrame, on: str = "cik") -> DataFrame:
    """Attach external per-company columns; companies without any keep NULLs."""
    return df.join(external, on, "left")


def ebitda(depreciation: Column | str) -> Column:
    """Revenue less cost and operating expenses plus the given depreciation and amortisation."""
    extra = F.col(depreciation) if isinstance(depreciation, str) else depreciation
    return reduce(
        lambda total, cost: total - F.col(cost),
        ("cost_of_revenue", "operating_expenses"),
        F.col("revenue"),
    ) + extra
