"""Every operator as a query over one data directory.

Keys start with the operator id of the inventory. A query takes the workspace
of the directory and returns a frame; unrounded means are rounded here (not in
the operators) because the last bit of a mean depends on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerstrata import sinks, sources
from ledgerstrata.functions import pct
from ledgerstrata.operators import bronze, dimensions, facts, gold, quality
from ledgerstrata.plans import dashboards, lookups, medallion, peers, ratios, series
from ledgerstrata.schemas import TABLES
from ledgerstrata.sources.tables import read_table, table_path
from ledgerstrata.testbed import filings
from ledgerstrata.testbed.workspace import Workspace, workspace

_QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}
SECTOR = "ASIA"


def query(name: str):
    def register(build: Callable[[Workspace], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = build
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build):
        return lambda spark, sf_dir: build(workspace(spark, sf_dir))

    return {name: bound(build) for name, build in _QUERIES.items()}


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def money_by(df: DataFrame, *keys: str) -> DataFrame:
    """Row count and total value per key: a compact image of a long table."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


# --- A: sources ----------------------------------------------------------------


def _document_shape(documents: DataFrame) -> DataFrame:
    concepts = F.col("facts").getField("us-gaap")
    return documents.select(
        "cik",
        F.col("entityName").alias("company_name"),
        F.size(concepts).cast("int").alias("concepts"),
        F.size(F.map_keys(concepts["Assets"]["units"])).cast("int").alias("asset_units"),
    )


@query("a1_read_documents")
def _(ws):
    return _document_shape(ws.documents())


@query("a2_read_archive")
def _(ws):
    members = sources.read_archive(ws.spark, ws.archives_folder())
    return _document_shape(sources.valid_documents(sources.parse_documents(members)))


@query("a1_rejected_documents")
def _(ws):
    return sources.count_documents(ws.landed_documents())


@query("a2_rejected_members")
def _(ws):
    members = sources.read_archive(ws.spark, ws.archives_folder())
    return sources.count_documents(sources.parse_documents(members))


@query("a2_archive_members")
def _(ws):
    chunks = sources.list_members(ws.spark, ws.archives_folder())
    return chunks.agg(F.sum("members").cast("long").alias("members"))


@query("a3_flatten_facts")
def _(ws):
    return bronze.flatten_facts(ws.documents()).drop("start_date")


@query("a4_company_info")
def _(ws):
    return bronze.extract_companies(ws.documents())


@query("a4_submission_info")
def _(ws):
    return bronze.extract_submission_info(ws.submissions()).drop("sic_description")


@query("a5_table_scan")
def _(ws):
    scanned = ws.table("fact_financials").where("fiscal_year = 2023 AND concept = 'Assets'")
    return scanned.select("cik", "fiscal_period", "end_date", "value")


@query("a6_bulk_layout")
def _(ws):
    return (
        sources.with_layout(ws.documents().select("cik", "_metadata.file_path"), "file_path")
        .groupBy("layout", "layout_year")
        .agg(F.count("*").alias("documents"))
    )


@query("a6_filing_paths")
def _(ws):
    filed = ws.table("fact_submissions").where("filing_date IS NOT NULL").select(
        F.concat(F.lit("lake/filings/"), "cik", F.lit("/"), "accession_number", F.lit("/facts.json")).alias("path")
    )
    daily = ws.table("fact_submissions").where("filing_date IS NOT NULL").select(
        F.concat(F.lit("lake/daily-index/"), F.date_format("filing_date", "yyyy/MM/dd"), F.lit("/form.idx")).alias("path")
    )
    paths = filed.unionByName(daily).distinct()
    return sources.with_layout(paths, "path")


@query("a6_daily_index")
def _(ws):
    """The index files of every day, found by their layout and read."""
    path = f"{ws.daily_index_folder()}/{sources.layout_glob('daily-index')}"
    lines = ws.spark.read.text(path).select("value", "_metadata.file_path")
    return (
        sources.with_layout(lines, "file_path")
        .groupBy("layout", "layout_year", "index_date", "file_name")
        .agg(F.count("*").alias("filings"), F.min("value").alias("first_line"))
    )


# --- B: sinks --------------------------------------------------------------------


@query("b1_write_append")
def _(ws):
    path = f"{ws.root}/scratch/companies"

    def build():
        companies = ws.table("dim_companies").select("cik", "ticker")
        sinks.write_table(companies, path, mode="overwrite")
        sinks.write_table(companies, path, mode="append")

    ws._once("b1", build)
    return ws.spark.read.schema("cik string, ticker string").parquet(path)


@query("b2_partitioned_clustered_write")
def _(ws):
    """Whole table as stored: rows and values per directory, and rows out of cluster order."""
    ws.layer("silver")
    stored = ws.spark.read.parquet(table_path(ws.root, "fact_financials")).select(
        "*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    before = Window.partitionBy("file").orderBy("at")
    key = F.struct("cik", "concept", "end_date")
    directory = F.regexp_extract("file", "fiscal_year=([0-9]+)/", 1).cast("int")
    return (
        stored.withColumn("disorder", F.lag(key).over(before) > key)
        .groupBy(directory.alias("directory"), "fiscal_year", "concept")
        .agg(
            F.count("*").alias("n"),
            F.sum("value").alias("total"),
            F.count_if("disorder").alias("out_of_order"),
        )
    )


@query("b2_files_by_range")
def _(ws):
    """The facts in 40 ranges: per year, files whose ids overlap and rows in them."""
    ws.layer("silver")
    path = f"{ws.root}/scratch/facts-by-range"

    def build():
        facts_ = ws.table("fact_financials")
        sinks.write_table(
            facts_, path, partition_by="fiscal_year", cluster_by=["cik", "concept", "end_date"], ranges=40
        )

    ws._once("b2_ranges", build)
    files = (
        read_like(ws, "fact_financials", path)
        .groupBy("fiscal_year", F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("n"), *[f(F.struct("cik", "concept", "end_date")).alias(f.__name__) for f in (F.min, F.max)])
    )
    before = Window.partitionBy("fiscal_year").orderBy("min", "max")
    return (
        files.withColumn("overlaps", F.lag("max").over(before) >= F.col("min"))
        .groupBy("fiscal_year")
        .agg(
            F.sum("n").alias("n"),
            (F.count("*") >= 3).alias("several_files"),
            F.count_if("overlaps").alias("overlapping"),
        )
    )


def read_like(ws, name, path):
    return ws.spark.read.schema(TABLES[name][1]).parquet(path)


@query("b3_year_buckets")
def _(ws):
    """Rows per directory of the unchecked facts; years outside the range share one."""
    ws.layer("bronze")
    stored = ws.spark.read.parquet(table_path(ws.root, "raw_financials"))
    folder = F.regexp_extract("_metadata.file_path", "year_bucket=([^/]+)/", 1)
    return stored.groupBy(folder.alias("directory")).agg(
        F.count("*").alias("rows"), F.count_distinct("fiscal_year").alias("years")
    )


EMPTIED = 2019  # a year that the stale copy still has and the true table has not


def _refreshed(ws, name, years):
    """A stale copy of a gold table, refreshed in some years; returns its content."""
    root = f"{ws.root}/scratch/refresh"

    def build():
        true = gold_rows(ws, name)
        stale = true.withColumn("revenue", F.col("revenue") + 1)
        gone = true.where(F.col("fiscal_year") == 2022).withColumn("fiscal_year", F.lit(EMPTIED - 10))
        medallion.save(stale.unionByName(gone), root, name)
        report = medallion.refresh_view(ws.spark, true, root, name, years=years)
        report.write.mode("overwrite").parquet(f"{root}/report/{name}")

    ws._once(f"refresh_{name}", build)
    reported = ws.spark.read.parquet(f"{root}/report/{name}")
    stored = read_table(ws.spark, root, name)
    by_year = stored.groupBy("fiscal_year").agg(
        F.count("*").alias("row_count"), F.sum("revenue").alias("revenue")
    )
    return by_year.withColumns(
        {
            "view_id": reported.select("view_id").scalar(),
            "reported_rows": reported.select("row_count").scalar(),
            "refresh_status": reported.select("refresh_status").scalar(),
        }
    )


def gold_rows(ws, name):
    ws.layer("silver")
    return medallion.gold_frame(ws.spark, ws.root, name) if name == "company_metrics" else ws.table(name)


@query("b4_refresh_company_metrics")
def _(ws):
    return _refreshed(ws, "company_metrics", [EMPTIED - 10, 2022, 2023])


@query("b4_refresh_timeseries")
def _(ws):
    return _refreshed(ws, "timeseries", [2022])


def _published(ws, tag):
    """A copy of the lake under catalog names; its folder and database."""
    root, database = f"{ws.root}/scratch/{tag}", f"{tag}_{ws.tag}"

    def build():
        ws.layer("gold")
        for name in TABLES:
            medallion.save(ws.table(name), root, name)
        medallion.publish(ws.spark, root, database)

    ws._once(f"publish_{tag}", build)
    return root, database


@query("b4_published_refresh")
def _(ws):
    """One company restates 2020 with three times its values; only changed years are switched."""
    root, database = _published(ws, "restated")
    mine = F.col("cik").endswith("3") & (F.col("fiscal_year") == 2020)

    def build():
        facts_ = ws.table("fact_financials")
        restated = facts_.withColumn("value", F.when(mine, F.col("value") * 3).otherwise(F.col("value")))
        sinks.switch_years(ws.spark, restated, root, "fact_financials", database, [2020])
        medallion.refresh_published(ws.spark, root, database, facts_.where(mine))

    ws._once("refresh_published", build)
    series_ = sinks.read_published(ws.spark, database, "timeseries")
    loaded = F.col("_metadata.file_path").contains(".loads/")
    return series_.groupBy("fiscal_year", loaded.alias("switched")).agg(
        F.count("*").alias("n"), F.sum("revenue").alias("revenue"), F.sum("ttm_revenue").alias("ttm_revenue")
    )


@query("e5_late_filings")
def _(ws):
    """Filings of 2022 that arrive later are taken in without the rows of other years."""
    root, database = _published(ws, "late")

    def build():
        rows = ws.table("raw_financials").where("fiscal_year = 2022 AND concept IN ('Assets', 'Liabilities')")
        restated = F.col("concept") == "Assets"
        later = rows.withColumns(
            {
                "value": F.col("value") + 1,
                # Only the assets are filed after what is stored.
                "accession_number": F.when(restated, F.concat("accession_number", F.lit("-A"))).otherwise(""),
                "filed_date": F.when(
                    restated, F.date_add(F.col("filed_date").try_cast("date"), 7300).cast("string")
                ),
            }
        )
        path = f"{root}/batch"
        later.write.mode("overwrite").parquet(path)
        batch = ws.spark.read.schema(TABLES["raw_financials"][1]).parquet(path)
        medallion.save(batch, root, "raw_financials", mode="append")
        medallion.upsert_published(ws.spark, root, database, batch)

    ws._once("upsert_published", build)
    return money_by(sinks.read_published(ws.spark, database, "fact_financials"), "concept", "fiscal_year")


def _bucketed(ws, name, partition_by=None):
    database = f"bucketed_{ws.tag}"

    def build():
        ws.layer("gold")
        count = sinks.bucket_count(ws.spark, table_path(ws.root, "fact_financials"))
        path = f"{ws.root}/scratch/bucketed/{name}"
        sinks.save_bucketed(
            ws.table(name), database, name, path, key="cik", buckets=count, partition_by=partition_by
        )

    ws._once(f"bucketed_{name}", build)
    return sinks.read_published(ws.spark, database, name)


@query("f2_metrics_from_buckets")
def _(ws):
    return gold.company_metrics(_bucketed(ws, "fact_financials", "fiscal_year"), _bucketed(ws, "dim_companies"))


@query("f17_timeseries_from_buckets")
def _(ws):
    return gold.timeseries(_bucketed(ws, "company_metrics", "fiscal_year"))


@query("b5_table_sizes")
def _(ws):
    ws.layer("gold")
    paths = {name: table_path(ws.root, name) for name in TABLES}
    return sinks.table_sizes(ws.spark, paths).select("table_name", "row_count")


# --- C: bronze ---------------------------------------------------------------------


def _flat(ws):
    return bronze.flatten_facts(ws.documents())


@query("c1_valid_units")
def _(ws):
    return bronze.keep_units(_flat(ws)).groupBy("unit").agg(F.count("*").alias("n"))


@query("c2_valid_forms")
def _(ws):
    return bronze.keep_forms(_flat(ws)).groupBy("form").agg(F.count("*").alias("n"))


@query("c3_padded_cik")
def _(ws):
    return bronze.add_derived_keys(_flat(ws)).groupBy("cik", "cik_padded").agg(F.count("*").alias("n"))


@query("c4_year_quarter")
def _(ws):
    rows = bronze.add_derived_keys(_flat(ws))
    return rows.groupBy("fiscal_year", "fiscal_period", "year_quarter").agg(F.count("*").alias("n"))


@query("c5_categorize_concepts")
def _(ws):
    rows = bronze.categorize_concepts(_flat(ws))
    return rows.groupBy("concept", "statement_type").agg(F.count("*").alias("n"))


@query("c6_null_critical")
def _(ws):
    rows = bronze.flag_null_critical(_flat(ws))
    return rows.groupBy("concept", "has_null_critical").agg(F.count("*").alias("n"))


@query("c7_invalid_year")
def _(ws):
    rows = bronze.flag_invalid_year(_flat(ws))
    return rows.groupBy("fiscal_year", "invalid_fiscal_year").agg(F.count("*").alias("n"))


@query("c8_quality_passed")
def _(ws):
    rows = bronze.flag_quality(_flat(ws))
    flags = ["has_null_critical", "invalid_fiscal_year", "data_quality_passed"]
    return rows.groupBy(*flags).agg(F.count("*").alias("n"))


@query("c9_quality_metrics")
def _(ws):
    return bronze.quality_metrics(ws.table("raw_financials"))


@query("c10_taxonomy_concepts")
def _(ws):
    used = ws.table("raw_financials").groupBy("concept").agg(F.count("*").alias("uses"))
    listed = bronze.concept_map(ws.spark)
    return listed.join(used, "concept", "left").select(
        "concept", "statement_type", F.coalesce("uses", F.lit(0)).alias("uses")
    )


@query("c_raw_financials")
def _(ws):
    return ws.table("raw_financials").drop("start_date")


# --- D: dimensions -----------------------------------------------------------------


def _passed(ws):
    return facts.passed_only(ws.table("raw_financials"))


@query("d1_company_base")
def _(ws):
    return dimensions.company_base(ws.table("raw_companies"))


@query("d2_filing_stats")
def _(ws):
    return dimensions.filing_stats(_passed(ws))


@query("d3_dim_companies")
def _(ws):
    return dimensions.build_dim_companies(ws.table("raw_companies"), _passed(ws))


@query("d4_sector_enrichment")
def _(ws):
    return ws.table("dim_companies")


@query("d4_sic_division")
def _(ws):
    # Codes here are four-digit stand-ins, spread over the division bounds.
    info = bronze.extract_submission_info(ws.submissions())
    spread = info.withColumn("sic_code", F.lpad((F.col("sic_code").cast("int") * 400).cast("string"), 4, "0"))
    enriched = dimensions.enrich_sector(dimensions.company_base(ws.table("raw_companies")), spread)
    return enriched.select("cik", "sic_code", "sector")


@query("d5_taxonomy_base")
def _(ws):
    return dimensions.taxonomy_base(_passed(ws))


@query("d6_dim_taxonomy")
def _(ws):
    return ws.table("dim_taxonomy")


@query("d7_dim_dates")
def _(ws):
    return ws.table("dim_dates")


# --- E: facts -------------------------------------------------------------------------


@query("e1_passed_only")
def _(ws):
    return money_by(_passed(ws), "concept")


@query("e2_shape_facts")
def _(ws):
    shaped = facts.shape_facts(_passed(ws))
    return money_by(shaped, "end_date", "filing_date")


@query("e3_fact_ids")
def _(ws):
    keyed = facts.add_fact_id(facts.shape_facts(_passed(ws)))
    return keyed.groupBy("cik").agg(
        F.count_distinct("fact_id").alias("ids"),
        F.min("fact_id").alias("first_id"),
        F.max("fact_id").alias("last_id"),
    )


@query("e4_latest_filing")
def _(ws):
    latest = facts.latest_filing(facts.shape_facts(_passed(ws)))
    return money_by(latest, "concept", "fiscal_year", "fiscal_period")


@query("e4_latest_filing_per_unit")
def _(ws):
    latest = facts.latest_filing(facts.shape_facts(_passed(ws)), extra_keys=["unit"])
    return money_by(latest, "concept", "unit")


@query("e5_fact_financials")
def _(ws):
    return ws.table("fact_financials")


@query("e6_fact_submissions")
def _(ws):
    return ws.table("fact_submissions")


# --- F: gold ----------------------------------------------------------------------------


@query("f1_latest_facts")
def _(ws):
    latest = gold.latest_facts(ws.table("fact_financials"), ws.table("dim_companies"))
    return money_by(latest, "sector", "concept", "fiscal_year", "fiscal_period")


@query("f2_company_metrics")
def _(ws):
    return gold.company_metrics(ws.table("fact_financials"), ws.table("dim_companies"))


def _ratio_group(group):
    def build(ws):
        annual = ws.table("company_metrics").where("fiscal_period = 'FY'")
        return annual.select("cik", "fiscal_year", *[c.alias(n) for n, c in group().items()])

    return build


for _name, _group in {
    "f3_profitability": gold.profitability_ratios,
    "f4_liquidity": gold.liquidity_ratios,
    "f5_leverage": gold.leverage_ratios,
    "f6_efficiency": gold.efficiency_ratios,
    "f7_operating": gold.operating_ratios,
    "f8_cash_flow": gold.cash_flow_ratios,
}.items():
    query(_name)(_ratio_group(_group))


@query("f9_financial_ratios")
def _(ws):
    return gold.financial_ratios(ws.table("company_metrics"))


@query("f10_sector_averages")
def _(ws):
    rows = gold.with_sector_averages(ws.table("financial_ratios"))
    return rounded(rows.select("cik", "fiscal_year", *gold.SECTOR_AVERAGES), list(gold.SECTOR_AVERAGES))


@query("f11_sector_percentiles")
def _(ws):
    return gold.sector_percentiles(ws.table("financial_ratios").where("sector IS NOT NULL"))


@query("f12_peer_count")
def _(ws):
    return gold.with_sector_averages(ws.table("financial_ratios")).select("cik", "fiscal_year", "peer_count")


@query("f13_peer_comparison")
def _(ws):
    return rounded(ws.table("peer_comparison"), list(gold.SECTOR_AVERAGES))


def _timeline_columns(columns):
    def build(ws):
        rows = ws.table("company_metrics").withColumns(columns())
        return rows.select("cik", "fiscal_year", "fiscal_period", *columns())

    return build


for _name, _columns in {
    "f14_trailing_sums": gold.trailing_sums,
    "f15_yearly_growth": gold.yearly_growth,
    "f16_moving_averages": gold.moving_averages,
}.items():
    query(_name)(_timeline_columns(_columns))


@query("f17_timeseries")
def _(ws):
    return gold.timeseries(ws.table("company_metrics"))


@query("f17_timeseries_quarterly")
def _(ws):
    return gold.timeseries(ws.table("company_metrics"), period_scope="quarterly")


# --- G: ratio reports ---------------------------------------------------------------------


@query("g1_top_profit_margin")
def _(ws):
    return ratios.top_profit_margin(ws.table("financial_ratios"))


@query("g1_top_profit_margin_selective")
def _(ws):
    return ratios.top_profit_margin(ws.table("financial_ratios"), min_revenue=4.5e10)


@query("g2_top_roe_by_sector")
def _(ws):
    return ratios.top_roe_by_sector(ws.table("financial_ratios"))


@query("g3_weak_liquidity")
def _(ws):
    return ratios.weak_liquidity(ws.table("financial_ratios"))


@query("g4_revenue_cagr")
def _(ws):
    return ratios.revenue_cagr(ws.table("financial_ratios"))


@query("g5_high_leverage")
def _(ws):
    return ratios.high_leverage(ws.table("financial_ratios"))


@query("g5_high_leverage_selective")
def _(ws):
    return ratios.high_leverage(ws.table("financial_ratios"), min_debt_to_equity=3.3, min_assets=6e10)


@query("g6_profitability_trend")
def _(ws):
    return ratios.profitability_trend(ws.table("financial_ratios"))


@query("g7_sector_comparison")
def _(ws):
    return ratios.sector_comparison(ws.table("financial_ratios"))


# --- H: peer reports --------------------------------------------------------------------------


@query("h1_company_vs_sector")
def _(ws):
    averages = [c for c in gold.SECTOR_AVERAGES]
    return rounded(peers.company_vs_sector(ws.table("peer_comparison")), averages)


@query("h2_top_quartile")
def _(ws):
    return peers.top_quartile(ws.table("peer_comparison"))


@query("h3_bottom_quartile")
def _(ws):
    out = peers.bottom_quartile(ws.table("peer_comparison"))
    return rounded(out, ["sector_avg_net_margin", "margin_gap"])


@query("h3_bottom_quartile_selective")
def _(ws):
    out = peers.bottom_quartile(ws.table("peer_comparison"), min_revenue=4.5e10)
    return rounded(out, ["sector_avg_net_margin", "margin_gap"])


@query("h4_sector_leaders")
def _(ws):
    return peers.sector_leaders(ws.table("peer_comparison"))


@query("h4_sector_leaders_selective")
def _(ws):
    return peers.sector_leaders(ws.table("peer_comparison"), min_revenue=4.5e10)


@query("h5_peer_group")
def _(ws):
    return peers.peer_group(ws.table("peer_comparison"))


@query("h5_peer_group_selective")
def _(ws):
    return peers.peer_group(ws.table("peer_comparison"), min_revenue=4.5e10)


@query("h6_market_share")
def _(ws):
    return peers.market_share(ws.table("peer_comparison"))


# --- I: growth reports ------------------------------------------------------------------------


@query("i1_growth_trend")
def _(ws):
    return series.growth_trend(ws.table("timeseries"), companies=ws.table("dim_companies"))


@query("i2_accelerating_growth")
def _(ws):
    return series.accelerating_growth(ws.table("timeseries"))


@query("i2_accelerating_growth_quarterly")
def _(ws):
    quarterly = gold.timeseries(ws.table("company_metrics"), period_scope="quarterly")
    return series.accelerating_growth(quarterly, min_revenue=1e10)


@query("i3_trailing_year")
def _(ws):
    return series.trailing_year(ws.table("timeseries"))


@query("i3_trailing_year_yearly")
def _(ws):
    quarterly = gold.timeseries(ws.table("company_metrics"), period_scope="quarterly")
    return series.trailing_year(quarterly, since=2020, min_ttm=4.5e10, lag_rows=1)


@query("i4_steady_growth")
def _(ws):
    return series.steady_growth(ws.table("timeseries"))


@query("i4_steady_growth_selective")
def _(ws):
    quarterly = gold.timeseries(ws.table("company_metrics"), period_scope="quarterly")
    return series.steady_growth(quarterly, min_growth=0, max_stddev=45)


@query("i5_seasonality")
def _(ws):
    return series.seasonality(ws.table("timeseries"), companies=ws.table("dim_companies"))


@query("i6_compound_growth")
def _(ws):
    return series.compound_growth(ws.table("timeseries"))


@query("i7_recovery")
def _(ws):
    return series.recovery(ws.table("timeseries"))


@query("i7_recovery_selective")
def _(ws):
    return series.recovery(ws.table("timeseries"), min_revenue=4.5e10)


# --- J: checks ------------------------------------------------------------------------------------


def _results(df, checks):
    return quality.run_checks(df, checks).select("check_name", "passed", "observed", "threshold")


@query("j1_minimum_companies")
def _(ws):
    return _results(ws.table("dim_companies"), [quality.min_rows("check_companies_count", 100)])


@query("j2_minimum_facts")
def _(ws):
    return _results(ws.table("fact_financials"), [quality.min_rows("check_financials_count", 1000)])


@query("j3_no_nulls")
def _(ws):
    check = quality.no_nulls("null_check_critical_fields", ["cik", "concept", "value"])
    return _results(ws.table("raw_financials"), [check])


@query("j4_years_within")
def _(ws):
    return _results(ws.table("raw_financials"), [quality.years_within("valid_fiscal_years")])


@query("j5_pass_rate")
def _(ws):
    return rounded(
        _results(ws.table("raw_financials"), [quality.pass_rate("data_quality_flag_check")]), ["observed"]
    )


@query("j6_check_suite")
def _(ws):
    suite = quality.warehouse_checks()
    out = quality.run_suite({name: ws.table(name) for name in suite}, suite)
    return rounded(out.select("check_name", "passed", "observed", "threshold"), ["observed"])


def _id(ws, ticker):
    return dashboards.company_id(ws.table("dim_companies"), ticker)


# --- K: dashboards -----------------------------------------------------------------------------------


@query("k1_executive_scorecards")
def _(ws):
    return dashboards.executive_scorecards(
        ws.table("company_metrics"), ws.table("timeseries"), ws.table("financial_ratios")
    )


@query("k2_margin_of_sums")
def _(ws):
    return dashboards.margin_of_sums(ws.table("company_metrics"))


@query("k3_revenue_trend")
def _(ws):
    return dashboards.revenue_trend(ws.table("timeseries"))


@query("k4_top_companies")
def _(ws):
    return dashboards.top_companies(ws.table("company_metrics"))


@query("k5_sector_distribution")
def _(ws):
    return dashboards.sector_distribution(ws.table("financial_ratios"))


@query("k6_profitability_heatmap")
def _(ws):
    return dashboards.profitability_heatmap(ws.table("financial_ratios"))


@query("k7_recent_filings")
def _(ws):
    return dashboards.recent_filings(ws.table("company_metrics"), ws.table("fact_submissions"))


@query("k8_global_filters")
def _(ws):
    chosen = dashboards.global_filters(
        ws.table("financial_ratios"), sectors=["ASIA", "EUROPE"], min_revenue=2e10
    )
    return chosen.select("cik", "sector", "fiscal_year", "revenue")


@query("k8_size_classes")
def _(ws):
    sized = ws.table("financial_ratios").withColumn(
        "size", dashboards.size_class(medium=3.5e10, large=4.5e10)
    )
    return sized.groupBy("fiscal_year", "size").agg(F.count("*").alias("n"))


@query("k9_company_header")
def _(ws):
    cik = dashboards.company_id(ws.table("dim_companies"), "AAPL")
    return dashboards.company_header(ws.table("company_metrics"), cik=cik)


@query("k10_income_statement")
def _(ws):
    return dashboards.statement_table(ws.table("company_metrics"), "income_statement", cik=_id(ws, "MSFT"))


@query("k10_balance_sheet")
def _(ws):
    return dashboards.statement_table(ws.table("company_metrics"), "balance_sheet", cik=_id(ws, "MSFT"))


@query("k10_cash_flow")
def _(ws):
    return dashboards.statement_table(ws.table("company_metrics"), "cash_flow", cik=_id(ws, "MSFT"))


@query("k11_ratio_cards")
def _(ws):
    return dashboards.ratio_cards(ws.table("financial_ratios"), 2023, cik=_id(ws, "MSFT"))


@query("k12_quarterly_trends")
def _(ws):
    cik = dashboards.company_id(ws.table("dim_companies"), "MSFT")
    return dashboards.quarterly_trends(ws.table("company_metrics"), cik=cik)


@query("k13_ttm_vs_annual")
def _(ws):
    return dashboards.ttm_vs_annual(ws.table("company_metrics"))


@query("k14_peer_table")
def _(ws):
    return dashboards.peer_table(ws.table("peer_comparison"), 2023, cik=_id(ws, "MSFT"))


@query("k15_compare_qoq")
def _(ws):
    return dashboards.period_comparison(ws.table("company_metrics"), compare="QoQ")


@query("k15_compare_yoy")
def _(ws):
    return dashboards.period_comparison(ws.table("company_metrics"), "net_income", compare="YoY")


@query("k15_compare_3_year")
def _(ws):
    return dashboards.period_comparison(ws.table("company_metrics"), compare="3-Year")


@query("k16_metrics_heatmap")
def _(ws):
    return dashboards.metrics_heatmap(ws.table("financial_ratios"), sector=SECTOR)


@query("k17_trendline_by_sector")
def _(ws):
    return dashboards.trendline(ws.table("financial_ratios"))


@query("k17_trendline_all")
def _(ws):
    return dashboards.trendline(ws.table("financial_ratios"), year=2023, by_sector=False)


@query("k18_percentile_bands")
def _(ws):
    return dashboards.percentile_bands(ws.table("peer_comparison"), 2023, cik=_id(ws, "MSFT"))


@query("k19_leaderboards")
def _(ws):
    return dashboards.leaderboards(ws.table("financial_ratios"))


@query("k20_histogram")
def _(ws):
    return dashboards.histogram(ws.table("financial_ratios"), year=2023, ticker="MSFT")


@query("k20_histogram_roe")
def _(ws):
    return dashboards.histogram(ws.table("financial_ratios"), "return_on_equity_pct", width=10.0)


@query("k21_market_overview")
def _(ws):
    return dashboards.market_overview(ws.table("company_metrics"), ws.table("timeseries"))


@query("k22_sector_performance")
def _(ws):
    return dashboards.sector_performance(ws.table("financial_ratios"))


@query("k23_revenue_treemap")
def _(ws):
    return dashboards.revenue_treemap(ws.table("company_metrics"))


@query("k24_growth_boxplot")
def _(ws):
    return dashboards.growth_boxplot(ws.table("timeseries"), ws.table("dim_companies"))


@query("k25_sector_revenue_trend")
def _(ws):
    return dashboards.sector_revenue_trend(ws.table("company_metrics"))


@query("k26_correlation_matrix")
def _(ws):
    grown = dashboards.with_annual_growth(ws.table("financial_ratios"))
    return dashboards.correlation_matrix(
        grown,
        [
            "revenue",
            "net_income",
            "net_profit_margin_pct",
            "revenue_growth_pct",
            "debt_to_equity_ratio",
            "return_on_equity_pct",
        ],
    )


@query("k27_market_share_stack")
def _(ws):
    return dashboards.market_share_stack(ws.table("peer_comparison"))


@query("k28_blend_external")
def _(ws):
    supplier = ws.spark.read.parquet(f"{ws.sf_dir.rstrip('/')}/supplier.parquet")
    external = supplier.where("s_acctbal > 0").select(
        bronze.pad_cik(F.col("s_suppkey").cast("string")).alias("cik"),
        F.col("s_acctbal").alias("balance"),
    )
    latest = ws.table("company_metrics").where("fiscal_year = 2023 AND fiscal_period = 'FY'")
    return dashboards.blend(latest.select("cik", "ticker", "revenue"), external)


@query("k29_calculated_fields")
def _(ws):
    # Capital spending stands in for the depreciation input, which is no listed concept.
    earned = dashboards.ebitda("capital_expenditures")
    return ws.table("company_metrics").select(
        "cik",
        "fiscal_year",
        "fiscal_period",
        earned.alias("ebitda"),
        gold.free_cash_flow().alias("free_cash_flow"),
        F.round(pct(earned, "revenue"), 4).alias("ebitda_margin_pct"),
    )


# --- L: lookups -----------------------------------------------------------------------------------------


@query("l1_company_profile")
def _(ws):
    return lookups.company_profile(ws.table("company_metrics"), companies=ws.table("dim_companies"))


@query("l2_sector_listing")
def _(ws):
    return rounded(
        lookups.sector_listing(ws.table("peer_comparison"), sector=SECTOR), list(gold.SECTOR_AVERAGES)
    )


@query("l3_ticker_trend")
def _(ws):
    return lookups.ticker_trend(ws.table("timeseries"), companies=ws.table("dim_companies"))


@query("l4_ticker_ratios")
def _(ws):
    return lookups.ticker_ratios(ws.table("financial_ratios"), companies=ws.table("dim_companies"))
