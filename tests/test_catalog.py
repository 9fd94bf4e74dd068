"""Published tables: switched years, upserts, incremental series; bucketed tables."""

import glob
import os
import re
import threading
import uuid

import pytest
from conftest import plan
from pyspark.sql import functions as F

from ledgerstrata import sinks, sources
from ledgerstrata.operators import facts, gold
from ledgerstrata.plans import medallion
from ledgerstrata.schemas import TABLES
from ledgerstrata.sinks import catalog
from ledgerstrata.sources.tables import table_path
from ledgerstrata.testbed.workspace import workspace

SF = "/root/testdata/sf0.001"


def lake(spark, scratch, names=tuple(TABLES)):
    ws = workspace(spark, SF)
    ws.layer("gold")
    for name in names:
        medallion.save(ws.table(name), scratch, name)
    database = f"lake_{uuid.uuid4().hex[:8]}"
    for name in names:
        sinks.publish_table(spark, scratch, name, database)
    return ws, database


def same(a, b):
    """Equal rows; averages of a sector depend on the order of addition in the last bits."""
    columns = [F.round(c, 6).alias(c) if c.startswith("sector_avg") else F.col(c) for c in a.columns]
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_a_reader_sees_the_old_or_the_new_year(spark, scratch):
    ws, database = lake(spark, scratch, ["timeseries"])
    old = ws.table("timeseries")
    sums = {}
    for year in (2021, 2022):
        rows = old.where(F.col("fiscal_year") == year)
        sums[year] = {rows.agg(F.sum("revenue")).first()[0] * (1 + n) for n in (0, 1)}
    seen, stop, errors = [], threading.Event(), []

    def watch():
        try:
            while not stop.is_set():
                table = sinks.read_published(spark, database, "timeseries").where("fiscal_year IN (2021, 2022)")
                seen.append({r[0]: r[1] for r in table.groupBy("fiscal_year").agg(F.sum("revenue")).collect()})
        except Exception as error:  # shown by the test below
            errors.append(error)

    reader = threading.Thread(target=watch)
    reader.start()
    doubled = old.withColumn("revenue", F.col("revenue") * 2)
    report = sinks.switch_years(spark, doubled, scratch, "timeseries", database, [2021, 2022]).first()
    stop.set()
    reader.join()
    assert not errors and len(seen) > 1
    for found in seen:
        assert all(found[year] == pytest.approx(min(sums[year])) or found[year] == pytest.approx(max(sums[year])) for year in (2021, 2022))
    assert report.refresh_status == "success" and report.row_count == old.where("fiscal_year IN (2021, 2022)").count()
    fresh = sinks.read_published(spark, database, "timeseries").where("fiscal_year = 2022")
    assert fresh.agg(F.sum("revenue")).first()[0] == pytest.approx(max(sums[2022]))


def test_a_failed_refresh_leaves_the_old_rows(spark, scratch):
    ws, database = lake(spark, scratch, ["company_metrics", "financial_ratios", "peer_comparison", "timeseries"])
    old = ws.table("timeseries")
    broken = old.withColumn("revenue", F.raise_error(F.lit("no more rows")).cast("double"))
    with pytest.raises(Exception, match="no more rows"):
        sinks.switch_years(spark, broken, scratch, "timeseries", database, [2022])
    assert same(sinks.read_published(spark, database, "timeseries"), old)
    report = catalog.failed_report(spark, database, "timeseries", ValueError("why\nat length")).first()
    assert (report.row_count, report.refresh_status) == (old.count(), "failed: why")
    # Without the facts the metrics cannot be computed: all views are reported and stay.
    changed = old.select("cik", "fiscal_year").where("fiscal_year = 2022")
    reports = [r.first() for r in medallion.refresh_published(spark, scratch, database, changed)]
    assert [r.view_id for r in reports] == list(medallion.GOLD_ORDER)
    assert all(r.refresh_status.startswith("failed: ") and r.row_count > 0 for r in reports)
    assert same(sinks.read_published(spark, database, "company_metrics"), ws.table("company_metrics"))


def test_emptied_and_new_years(spark, scratch):
    ws, database = lake(spark, scratch, ["company_metrics"])
    rows = ws.table("company_metrics")
    moved = rows.where("fiscal_year = 2022").withColumn("fiscal_year", F.lit(2027))
    sinks.switch_years(spark, moved, scratch, "company_metrics", database, [2022, 2027])
    found = sinks.read_published(spark, database, "company_metrics")
    assert found.where("fiscal_year = 2022").count() == 0
    assert found.where("fiscal_year = 2027").count() == moved.count()
    with pytest.raises(ValueError):
        sinks.switch_years(spark, rows, scratch, "dim_companies", database, [2022])


def test_late_filings_are_taken_in_by_year(spark, scratch):
    ws, database = lake(spark, scratch)
    raw = sources.read_table(spark, scratch, "raw_financials")
    base = raw.where("fiscal_year = 2022 AND data_quality_passed")
    restated = base.where("concept = 'Assets'").withColumns(
        {"value": F.col("value") + 1, "filed_date": F.lit("2029-01-01"), "accession_number": F.lit("late")}
    )
    earlier = base.where("concept = 'Liabilities'").withColumn("filed_date", F.lit("2001-01-01"))
    fresh = base.where("concept = 'Revenues'").withColumns(
        {"cik": F.lit("99"), "cik_padded": F.lit("0000000099"), "accession_number": F.lit("first")}
    )
    flawed = base.limit(1).withColumn("data_quality_passed", F.lit(False))
    batch = restated.unionByName(earlier).unionByName(fresh).unionByName(flawed)
    batch.write.parquet(f"{scratch}/batch")
    batch = spark.read.schema(raw.schema).parquet(f"{scratch}/batch")
    medallion.save(batch, scratch, "raw_financials", mode="append")
    assert medallion.upsert_published(spark, scratch, database, batch) == [2022]
    found = sinks.read_published(spark, database, "fact_financials")
    assert same(found, facts.build_fact_financials(sources.read_table(spark, scratch, "raw_financials")))
    assert found.where("accession_number = 'late'").count() > 0
    # The other years are read from where they were, the touched year from its load.
    files = {r[0] for r in found.select("_metadata.file_path").distinct().collect()}
    loads = {f for f in files if ".loads/" in f}
    assert loads and all("fiscal_year=2022" in f for f in loads)
    assert not any("fiscal_year=2022" in f for f in files - loads)


def test_one_late_fact_rewrites_only_changed_series_years(spark, scratch):
    ws, database = lake(spark, scratch)
    stored = ws.table("fact_financials")
    late = stored.where("cik = '0000000003' AND fiscal_year = 2020 AND concept = 'NetIncomeLoss'")
    changed = stored.withColumn(
        "value", F.when(F.expr("cik = '0000000003' AND fiscal_year = 2020"), F.col("value") * 3).otherwise(F.col("value"))
    )
    sinks.switch_years(spark, changed, scratch, "fact_financials", database, [2020])
    reports = [r.first() for r in medallion.refresh_published(spark, scratch, database, late)]
    assert all(r.refresh_status == "success" and r.row_count > 0 for r in reports)

    def loaded(name):
        files = glob.glob(f"{table_path(scratch, name)}.loads/*/fiscal_year=*/*.parquet")
        return sorted({int(re.search(r"fiscal_year=(\d+)", f).group(1)) for f in files})

    assert loaded("company_metrics") == loaded("financial_ratios") == [2020]
    assert loaded("timeseries") == [2020, 2021]
    for name in medallion.GOLD_ORDER:
        read = lambda table: sinks.read_published(spark, database, table)
        assert same(read(name), medallion.gold_frame(spark, scratch, name, read)), name


def test_series_of_years_over_gaps(spark):
    ws = workspace(spark, SF)
    metrics = ws.table("company_metrics")
    # Company 3 reports one period a year, company 4 nothing between 2018 and 2022.
    sparse = metrics.where(
        "(cik <> '0000000003' OR fiscal_period = 'Q2') AND (cik <> '0000000004' OR fiscal_year NOT BETWEEN 2019 AND 2022)"
    )
    for scope in ("mixed", "quarterly"):
        full = gold.timeseries(sparse, scope)
        for years in ([2021], [2020, 2023], [2018], [2024]):
            some = gold.timeseries_of_years(sparse, years, scope)
            assert same(some, full.where(F.col("fiscal_year").isin(years))), (scope, years)

    def after(cik, year):
        changed = spark.createDataFrame([(cik, year)], "cik string, fiscal_year int")
        return sorted(r.fiscal_year for r in gold.changed_series_years(sparse, changed).collect())

    assert after("0000000003", 2019) == [2019, 2020, 2021, 2022, 2023]
    assert after("0000000004", 2018) == [2018, 2023]
    assert after("0000000005", 2019) == [2019, 2020]


def test_bucketed_tables_need_no_exchange(spark, scratch):
    ws = workspace(spark, SF)
    ws.layer("gold")
    database = f"buckets_{uuid.uuid4().hex[:8]}"
    buckets = sinks.bucket_count(spark, table_path(ws.root, "fact_financials"))
    assert buckets >= 8

    def bucketed(name, partition_by=None):
        return sinks.save_bucketed(
            ws.table(name), database, name, f"{scratch}/{name}", key="cik", buckets=buckets, partition_by=partition_by
        )

    stored = bucketed("fact_financials", "fiscal_year")
    companies = bucketed("dim_companies")
    metrics = gold.company_metrics(stored, companies)
    assert "hashpartitioning(cik" not in plan(metrics) and "Bucketed: true" in plan(metrics)
    assert same(metrics.select(*ws.table("company_metrics").columns), ws.table("company_metrics"))
    series = gold.timeseries(bucketed("company_metrics", "fiscal_year"))
    assert "Exchange" not in plan(series)
    assert same(series.select(*ws.table("timeseries").columns), ws.table("timeseries"))
    files = glob.glob(f"{scratch}/fact_financials/fiscal_year=2022/*.parquet")
    assert 0 < len(files) <= buckets and os.path.isdir(f"{scratch}/dim_companies")
