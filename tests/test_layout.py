"""Files cut by value, and what lookups read of them."""

import glob
import hashlib

from conftest import plan
from pyspark.sql import functions as F

from ledgerstrata import sinks
from ledgerstrata.sinks import tables
from ledgerstrata.sources import read_table, with_tickers
from ledgerstrata.testbed.workspace import workspace

SF = "/root/testdata/sf0.001"


def metrics(df) -> dict[str, int]:
    """Files, and rows that left the first file scan of an executed frame."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while "FileScan" not in node.nodeName() and "Scan parquet" not in node.nodeName():
        inner = getattr(node, "executedPlan", None)
        if node.nodeName() == "AdaptiveSparkPlan":
            node = inner()
        elif "QueryStage" in node.nodeName():
            node = node.plan()
        else:
            node = node.children().apply(0)
    found = node.metrics()
    return {name: found.apply(name).value() for name in ("numFiles", "numOutputRows")}


def companies(spark, rows=200_000):
    """One row per company, tickers in no order; two distant companies share one."""
    return spark.range(rows, numPartitions=8).select(
        F.lpad(F.col("id").cast("string"), 10, "0").alias("cik"),
        F.substring(F.sha1(F.when(F.col("id") == rows - 5, 5).otherwise(F.col("id")).cast("string")), 1, 12).alias("ticker"),
        (2020 + F.col("id") % 2).cast("int").alias("fiscal_year"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )


def test_a_lookup_opens_one_file_of_forty(spark, scratch):
    df = companies(spark)
    sinks.write_table(df, f"{scratch}/t", partition_by="fiscal_year", cluster_by=["cik"], ranges=80)
    for year in (2020, 2021):
        files = glob.glob(f"{scratch}/t/fiscal_year={year}/*.parquet")
        assert len(files) >= 40
        bounds = sorted(
            tuple(spark.read.parquet(f).agg(F.min("cik"), F.max("cik")).first()) for f in files
        )
        assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    stored = spark.read.schema(df.schema).parquet(f"{scratch}/t")
    # Files are skipped by the ranges in their footers: only rows of one file leave the scan.
    hit = stored.where("fiscal_year = 2021 AND cik = '0000077777'")
    sizes = [r["count"] for r in stored.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert hit.count() == 1 and metrics(hit)["numOutputRows"] in sizes and max(sizes) < 5_000


def test_small_ranges_are_joined_and_bronze_stays(spark, scratch):
    df = companies(spark, 2_000)
    sinks.write_table(df, f"{scratch}/t", partition_by="fiscal_year", cluster_by=["cik"], ranges=True)
    assert len(glob.glob(f"{scratch}/t/*/*.parquet")) <= 4
    assert spark.read.parquet(f"{scratch}/t").count() == 2_000
    assert tables.by_range("raw_financials", 1 << 50, spark) is False
    assert tables.by_range("dim_companies", None, spark) is False
    assert tables.by_range("fact_financials", 1 << 20, spark) is True
    assert tables.by_range("fact_financials", 100 << 40, spark) == 409_600
    assert tables.stored_bytes(spark, f"{scratch}/t") > 0


def test_shared_ticker_reads_as_few_row_groups_as_any(spark, scratch):
    # Values that do not fit the dictionary of a row group, as in row groups of full size.
    small = {"parquet.block.size": 1 << 20, "parquet.page.size": 1 << 16, "parquet.dictionary.page.size": 1 << 12}
    twin, alone = (hashlib.sha1(n).hexdigest()[:12] for n in (b"5", b"100"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in small.items():
        conf.set(key, str(value))
    try:
        df = companies(spark)
        for name, bloom in (("with", ["ticker"]), ("without", [])):
            sinks.write_table(df, f"{scratch}/{name}", cluster_by=["cik"], ranges=4, bloom=bloom)
    finally:
        for key in small:
            conf.unset(key)
    read = {}
    for name in ("with", "without"):
        stored = spark.read.schema(df.schema).parquet(f"{scratch}/{name}")
        assert sorted(r.cik for r in stored.where(F.col("ticker") == twin).collect()) == ["0000000005", "0000199995"]
        read[name] = [metrics(stored.where(F.col("ticker") == t))["numOutputRows"] for t in (twin, alone)]
        by_id = with_tickers(stored, [twin], stored.select("cik", "ticker"))
        assert by_id.count() == 2
    # One row group for a ticker of its own, two for one that distant companies share.
    one = read["with"][1]
    assert read["without"][0] == 200_000 and one < 20_000 and read["with"][0] <= 2.5 * one


def test_stored_tables_have_the_layout(spark):
    ws = workspace(spark, SF)
    ws.layer("gold")
    hit = read_table(spark, ws.root, "timeseries").where("ticker = 'MSFT' AND fiscal_year = 2023")
    assert "EqualTo(ticker,MSFT)" in plan(hit)
