"""Table writes, refresh and reports."""

import glob
import os

import pytest
from conftest import plan
from pyspark.sql import functions as F

from ledgerstrata import jobs, sinks, sources
from ledgerstrata.operators import quality
from ledgerstrata.plans import dashboards, medallion
from ledgerstrata.schemas import TABLES
from ledgerstrata.sources.tables import table_path
from ledgerstrata.testbed.workspace import workspace

SF = "/root/testdata/sf0.001"


def years(path):
    return sorted(os.path.basename(p).split("=")[1] for p in glob.glob(f"{path}/fiscal_year=*"))


def test_partition_and_row_group_pruning(spark):
    ws = workspace(spark, SF)
    ws.layer("silver")
    path = table_path(ws.root, "fact_financials")
    assert years(path) == [str(y) for y in range(2018, 2025)]
    hit = ws.table("fact_financials").where("fiscal_year = 2023 AND cik = '0000000003'").select("value")
    scan = next(line for line in plan(hit).splitlines() if "FileScan" in line)
    assert "(fiscal_year" in scan.split("PartitionFilters:")[1]
    assert "EqualTo(cik,0000000003)" in scan
    assert "ReadSchema: struct<cik:string,value:double>" in scan


def test_files_are_sorted_by_cluster_columns(spark):
    ws = workspace(spark, SF)
    ws.layer("silver")
    for file in glob.glob(table_path(ws.root, "fact_financials") + "/fiscal_year=2023/*.parquet"):
        rows = spark.read.parquet(file).select("cik", "concept", "end_date").toPandas()
        keys = list(rows.itertuples(index=False, name=None))
        assert keys == sorted(keys)


def test_large_partition_is_written_by_several_tasks(spark, scratch):
    """One year holds nearly all rows; the rebalance cuts it into several files."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 50 == 0, 2020).otherwise(2021).alias("fiscal_year"),
        F.sha2(F.col("id").cast("string"), 256).alias("cik"),
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sinks.write_table(df, f"{scratch}/t", partition_by="fiscal_year", cluster_by=["cik"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{scratch}/t/fiscal_year=2021/*.parquet")) > 3
    assert len(glob.glob(f"{scratch}/t/fiscal_year=2020/*.parquet")) <= 2
    assert spark.read.parquet(f"{scratch}/t").count() == 200_000


def test_audit_columns_come_from_the_writer(spark, scratch):
    df = sinks.with_audit(spark.range(3), "created_at", "updated_at")
    sinks.write_table(df, f"{scratch}/t", max_records_per_file=1)
    back = spark.read.parquet(f"{scratch}/t")
    assert back.columns == ["id", "created_at", "updated_at"]
    assert back.where("created_at IS NULL").count() == 0


def test_catalog_table(spark, scratch):
    df = spark.range(10).selectExpr("id", "2020 + id % 2 AS fiscal_year")
    for mode, rows in [("overwrite", 10), ("append", 20), ("overwrite", 10)]:
        sinks.write_table(
            df, f"{scratch}/t", mode=mode, partition_by="fiscal_year", table="catalog_test"
        )
        assert spark.table("catalog_test").count() == rows
    assert spark.read.parquet(f"{scratch}/t").count() == 10
    spark.sql("DROP TABLE catalog_test")


def test_ticker_lookup_goes_by_clustered_id(spark):
    ws = workspace(spark, SF)
    cik = dashboards.company_id(ws.table("dim_companies"), "MSFT")
    found = dashboards.select_company(ws.table("company_metrics"), cik=cik)
    by_ticker = dashboards.select_company(ws.table("company_metrics"), ticker="MSFT")
    assert found.count() == by_ticker.count() > 0
    assert found.exceptAll(by_ticker).count() == 0
    scan = next(x for x in plan(found).splitlines() if "FileScan" in x and "revenue" in x)
    assert "subquery" in scan.split("DataFilters:")[1].lower()
    with pytest.raises(ValueError):
        dashboards.select_company(by_ticker)


def copy_lake(spark, ws, root):
    for name in TABLES:
        medallion.save(ws.table(name), root, name)


def stamps(root, name):
    files = glob.glob(table_path(root, name) + "/fiscal_year=*/*.parquet")
    return {os.path.relpath(f, root): os.path.getmtime(f) for f in files}


def test_restated_year_is_refreshed_alone(spark, scratch):
    ws = workspace(spark, SF)
    copy_lake(spark, ws, scratch)
    facts_path = table_path(scratch, "fact_financials")
    stored = sources.read_table(spark, scratch, "fact_financials")
    changed = stored.where("fiscal_year = 2022").withColumn("value", F.col("value") * 2)
    sinks.write_table(changed, f"{scratch}/new", cluster_by=["cik"])
    new = spark.read.parquet(f"{scratch}/new")
    sinks.write_table(
        new.select(*stored.columns), facts_path, partition_by="fiscal_year", partition_overwrite="dynamic"
    )
    before = {name: stamps(scratch, name) for name in medallion.GOLD_ORDER}
    reports = [r.first() for r in medallion.refresh_touched(spark, scratch, new)]
    assert [r.view_id for r in reports] == list(medallion.GOLD_ORDER)
    assert all(r.refresh_status == "success" and r.row_count > 0 and r.size_bytes > 0 for r in reports)

    def untouched(name):
        after = stamps(scratch, name)
        kept = {f for f in after if before[name].get(f) == after[f]}
        return sorted({f.split("fiscal_year=")[1][:4] for f in kept})

    others = ["2018", "2019", "2020", "2021", "2023", "2024"]
    assert untouched("company_metrics") == untouched("peer_comparison") == others
    assert untouched("timeseries") == ["2018", "2019", "2020", "2021"]
    for name in medallion.GOLD_ORDER:
        stored = sources.read_table(spark, scratch, name)
        full = medallion.gold_frame(spark, scratch, name)
        averages = [c for c in stored.columns if c.startswith("sector_avg")]
        cut = {c: F.round(c, 6) for c in averages}
        assert stored.withColumns(cut).exceptAll(full.withColumns(cut)).count() == 0, name
        assert stored.count() == full.count()


def test_table_sizes(spark, scratch):
    sinks.write_table(spark.range(1000), f"{scratch}/big")
    sinks.write_table(spark.range(10), f"{scratch}/small")
    sinks.write_table(spark.range(0), f"{scratch}/none")
    paths = {n: f"{scratch}/{n}" for n in ("small", "big", "none")}
    rows = sinks.table_sizes(spark, paths).collect()
    assert rows[0].table_name == "big"
    counts = {r.table_name: (r.row_count, r.size_bytes > 0) for r in rows}
    assert counts["big"] == (1000, True) and counts["small"] == (10, True)
    assert counts["none"][0] == 0


def test_jobs_run_from_archive_to_gold(spark, scratch):
    ws = workspace(spark, SF)
    lake = f"{scratch}/lake"

    def step(*argv):
        jobs.run(spark, jobs.parser().parse_args(list(argv)))

    step("parse", ws.archives_folder(), lake, "--zipped")
    step("dimensions", lake, "--submissions", ws.submissions_path)
    step("facts", lake)
    with pytest.raises(quality.QualityError, match="check_companies_count"):
        step("checks", lake)  # ten companies only
    step("gold", lake)
    for name in ("raw_financials", "fact_financials", "fact_submissions"):
        a, b = sources.read_table(spark, lake, name), ws.table(name)
        assert a.exceptAll(b).count() == 0 and a.count() == b.count(), name
    sectors = sources.read_table(spark, lake, "company_metrics").select("sector").distinct()
    assert sectors.count() == 1  # codes below 100 are in no SIC division


def test_batch_stops_before_gold_when_checks_fail(spark, scratch):
    ws = workspace(spark, SF)
    with pytest.raises(quality.QualityError):
        medallion.run(spark, ws.documents(), scratch)
    assert not os.path.exists(table_path(scratch, "company_metrics"))
    assert len(medallion.run(spark, ws.documents(), scratch, checks={})) == 4


def test_unchecked_years_share_one_directory(spark, scratch):
    ws = workspace(spark, SF)
    stored = ws.table("raw_financials").where("concept = 'Assets' AND cik IN ('1', '2')")
    wild = stored.withColumn("fiscal_year", (F.crc32(F.col("accession_number").cast("binary")) % 9000).cast("int"))
    medallion.save(stored.unionByName(wild), scratch, "raw_financials")
    path = table_path(scratch, "raw_financials")
    folders = {os.path.basename(p) for p in glob.glob(f"{path}/year_bucket=*")}
    assert len(folders) <= 32 and "year_bucket=__HIVE_DEFAULT_PARTITION__" in folders
    back = sources.read_table(spark, scratch, "raw_financials")
    assert back.columns == ws.table("raw_financials").columns and back.count() == 2 * stored.count()
    some = sources.read_table(spark, scratch, "raw_financials", years=(2019, 2021))
    assert some.count() == back.where("fiscal_year BETWEEN 2019 AND 2021").count() > 0
    scan = next(line for line in plan(some).splitlines() if "FileScan" in line)
    assert "year_bucket" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    outside = sources.read_table(spark, scratch, "raw_financials", years=(1700, 9000))
    assert outside.count() == back.where("fiscal_year BETWEEN 1700 AND 9000").count()


def test_stored_tables_carry_load_times(spark):
    ws = workspace(spark, SF)
    ws.layer("gold")
    for name, columns in (("raw_companies", ["created_at"]), ("timeseries", ["last_updated"])):
        audited = sources.read_table(spark, ws.root, name, audit=True)
        assert audited.columns == ws.table(name).columns + columns
        assert audited.where(f"{columns[0]} IS NULL").count() == 0


def scans(df, *names):
    return [line for line in plan(df).splitlines() if "FileScan" in line and all(n in line for n in names)]


def test_scorecards_prune_every_scan_of_the_series(spark):
    ws = workspace(spark, SF)
    tables = [ws.table(name) for name in ("company_metrics", "timeseries", "financial_ratios")]
    read = scans(dashboards.executive_scorecards(*tables), "ttm_revenue")
    assert read and all("fiscal_year" in r.split("PartitionFilters:")[1].split("]")[0] for r in read)


def test_recent_filings_are_bounded_by_date(spark):
    ws = workspace(spark, SF)
    metrics, filed = ws.table("company_metrics"), ws.table("fact_submissions")
    out = dashboards.recent_filings(metrics, filed, limit=20)
    assert any("Subquery" in s or "subquery" in s for s in scans(out, "accession_number"))
    keys = ["cik", "fiscal_year", "fiscal_period"]
    whole = (
        metrics.join(filed.select(*keys, "filing_date", "accession_number"), keys)
        .orderBy(F.desc("filing_date"), "cik", "accession_number")
        .limit(20)
    )
    assert sorted(r.filing_date for r in out.collect()) == sorted(r.filing_date for r in whole.collect())


def test_ticker_lists_go_by_id(spark):
    from ledgerstrata.plans import lookups, series

    ws = workspace(spark, SF)
    companies, frames = ws.table("dim_companies"), ws.table("timeseries")
    pairs = [
        (lookups.ticker_ratios, ws.table("financial_ratios")),
        (lookups.ticker_trend, frames),
        (lookups.company_profile, ws.table("company_metrics")),
        (series.growth_trend, frames),
        (series.seasonality, frames),
    ]
    for function, table in pairs:
        found = function(table, companies=companies)
        assert sorted(map(str, found.collect())) == sorted(map(str, function(table).collect()))
        wide = max(scans(found, "company_name"), key=len)
        assert "cik" in wide.split("DataFilters:")[1].split("Format:")[0]
