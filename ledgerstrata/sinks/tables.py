"""Partitioned, clustered table writes, view refresh and table reports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.operators.bronze import year_bucket
from ledgerstrata.schemas import AUDIT, BLOOM, TABLES, YEAR_BUCKET
from ledgerstrata.sources.tables import table_path

# Stored bytes of the input for one range of the output.
RANGE_BYTES = 256 << 20
# Codec of the declared tables; their ids are digests, which only an entropy coder shrinks.
CODEC = "zstd"


def with_audit(df: DataFrame, *names: str) -> DataFrame:
    """Append load timestamps; only writers do this, so operators stay repeatable."""
    return df.withColumns({name: F.current_timestamp() for name in names}) if names else df


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: str | None = None,
    cluster_by: Iterable[str] = (),
    partition_overwrite: str = "static",
    max_records_per_file: int = 0,
    table: str | None = None,
    ranges: bool | int = False,
    placed: bool = False,
    bloom: Iterable[str] = (),
    compression: str | None = None,
) -> None:
    """Write Parquet, one directory per partition value, sorted inside each file.

    A rebalance on the partition column keeps a directory from getting one file
    per task; adaptive execution cuts a directory that is much larger than the
    advisory partition size over several tasks, so a year that holds most rows
    is not written by one task. Sorting by the clustering columns gives row
    groups narrow min/max ranges, which lets point and range filters skip them.

    ``ranges`` cuts the rows by value instead, along the partition column and then the
    clustering columns: the files of a directory do not overlap, so a filter on the
    first clustering column opens one or two of them, however many there are. Spark
    samples the rows for the cuts, which computes ``df`` once more. With ``True``
    there are as many ranges as shuffle partitions, and adaptive execution joins
    neighbours that are small; a number is taken as it is.

    ``placed`` says that the rows already lie in such ranges: they stay there and are
    only sorted, unless they are.

    ``bloom`` names columns whose values get Bloom filters, for equality lookups on
    values that no clustering keeps together. A row group whose values fit its
    dictionary needs none: there the dictionary tells the same.

    ``compression`` is a Parquet codec, by default that of the session.

    ``table`` also enters the files in the session catalog under that name.
    """
    cluster_by = list(cluster_by)
    if placed:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *cluster_by)
    elif ranges and cluster_by:
        keys = [partition_by, *cluster_by] if partition_by else cluster_by
        count = [] if ranges is True else [int(ranges)]
        df = df.repartitionByRange(*count, *keys).sortWithinPartitions(*keys)
    elif partition_by:
        df = df.hint("rebalance", F.col(partition_by))
        df = df.sortWithinPartitions(partition_by, *cluster_by)
    elif cluster_by:
        df = df.hint("rebalance").sortWithinPartitions(*cluster_by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", partition_overwrite)
    if compression:
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if table:
        writer.format("parquet").option("path", path).saveAsTable(table)
    else:
        writer.parquet(path)


def _stored_columns(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a table with its bucket and audit columns."""
    _, schema, partition_by, _ = TABLES[name]
    bucket = [year_bucket()] if partition_by == YEAR_BUCKET else []
    return with_audit(df.select(*schema.fieldNames(), *bucket), *AUDIT.get(name, ()))


def by_range(name: str, input_bytes: int | None, spark: SparkSession) -> bool | int:
    """How a declared table is cut into files, see :func:`write_table`.

    Unchecked rows stay as they arrive, since they are counted while they are
    written and must not be computed twice. Every other partitioned table is cut by
    value, into more ranges than there are shuffle partitions where its input would
    otherwise give ranges of more than ``RANGE_BYTES``.
    """
    layer, _, partition_by, _ = TABLES[name]
    if layer == "bronze" or not partition_by:
        return False
    wanted = ceil((input_bytes or 0) / RANGE_BYTES)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else True


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the data files under ``paths``, from their listing."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(list(paths))
    )
    return files.agg(F.sum("length")).first()[0] or 0


def save(
    df: DataFrame,
    root: str,
    name: str,
    *,
    mode: str = "overwrite",
    input_bytes: int | None = None,
    placed: bool = False,
) -> None:
    """Write one of the declared tables with its own partitioning, clustering and filters.

    ``input_bytes`` is the stored size of what ``df`` is computed from, if known;
    ``placed`` rows already lie in the ranges that :func:`by_range` tells, or unchecked
    ones by year bucket.
    """
    _, _, partition_by, cluster_by = TABLES[name]
    write_table(
        _stored_columns(df, name),
        table_path(root, name),
        mode=mode,
        partition_by=partition_by,
        cluster_by=cluster_by,
        ranges=by_range(name, input_bytes, df.sparkSession),
        placed=placed,
        bloom=BLOOM.get(name, ()),
        compression=CODEC,
    )


def touched_years(new_facts: DataFrame) -> DataFrame:
    """Fiscal years a batch of new or restated facts changes (one row per year)."""
    return new_facts.select("fiscal_year").where("fiscal_year IS NOT NULL").distinct()


def _drop_stale_years(spark: SparkSession, path: str, refreshed, started) -> None:
    """Remove the directories of refreshed years that the refresh wrote no row of.

    What it wrote carries a later load time than its start. Years are checked
    values, so their list is short.
    """
    stored = spark.read.parquet(path)
    newest = stored.groupBy("fiscal_year").agg(F.max("last_updated").alias("at")).collect()
    stale = [r.fiscal_year for r in newest if refreshed(r.fiscal_year) and r["at"] < started]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for year in stale:
        folder = hadoop.Path(f"{path}/fiscal_year={year}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def refresh_view(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    name: str,
    *,
    years: Iterable[int] | None = None,
    input_bytes: int | None = None,
) -> DataFrame:
    """Recompute a stored gold table, or only some fiscal years of it.

    With ``years`` just those directories are replaced. A row of ``timeseries``
    looks back four rows of its company, which can reach over any gap, so there
    every year from the first touched one on is rewritten; the frame itself is
    computed over the full history first and cut to the years afterwards.

    A year that lost all its rows loses its directory as well.

    Returns one row: view, rows, bytes, last modification, status.
    """
    _, _, partition_by, cluster_by = TABLES[name]
    path = table_path(root, name)
    out = _stored_columns(df, name)
    started = None
    if years is not None:
        years = sorted(set(years))
        if name == "timeseries":
            out = out.where(F.col("fiscal_year") >= years[0])
        else:
            out = out.where(F.col("fiscal_year").isin(years))
        started = spark.range(1).select(F.current_timestamp()).first()[0]
    write_table(
        out,
        path,
        partition_by=partition_by,
        cluster_by=cluster_by,
        partition_overwrite="static" if years is None else "dynamic",
        ranges=by_range(name, input_bytes, spark),
        bloom=BLOOM.get(name, ()),
        compression=CODEC,
    )
    if years is not None:
        _drop_stale_years(spark, path, lambda y: y >= years[0] if name == "timeseries" else y in years, started)
    return table_sizes(spark, {name: table_path(root, name)}).select(
        F.col("table_name").alias("view_id"),
        "row_count",
        "size_bytes",
        "last_modified",
        F.lit("success").alias("refresh_status"),
    )


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows, files, bytes and last modification per stored table, largest first.

    No row is read: files are listed with their sizes, and their footers, read
    side by side, tell the row counts.
    """

    def footers(batches):
        import pandas as pd
        from pyarrow import fs, parquet

        for batch in batches:
            counts = []
            for address in batch["path"]:
                filesystem, file = fs.FileSystem.from_uri(address)
                with filesystem.open_input_file(file) as handle:
                    counts.append(parquet.read_metadata(handle).num_rows)
            yield pd.DataFrame(
                {"rows": counts, "bytes": batch["length"], "modified": batch["modificationTime"]}
            )

    def one(name: str, path: str) -> DataFrame:
        # Only path, length and time are selected, so no content is loaded.
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True)
            .load(path)
            .select("path", "length", "modificationTime")
            .mapInPandas(footers, "rows long, bytes long, modified timestamp")
        )
        return files.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
            F.count("*").alias("file_count"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"),
            F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / F.lit(1e9), 2).alias("size_gb"),
            F.max("modified").alias("last_modified"),
        )

    sizes = [one(name, path) for name, path in paths.items()]
    return reduce(DataFrame.unionByName, sizes).orderBy(F.desc("size_bytes"), "table_name")
