"""Stored tables under catalog names: years that are switched, and bucketed tables.

A published table is an external table whose years may lie in different folders. A
refresh writes the new rows of its years into a folder of its own and then points the
catalog's partitions there, one statement per year. A reader therefore sees the old or
the new rows of a year and never a mixture; queries that run while it is switched go on
reading the old files, which stay where they are. A refresh that fails while it writes
has switched nothing.

A bucketed table is cut by a hash of its key into a fixed number of files, which the
catalog knows. Aggregations, windows and joins on that key then need no shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.schemas import AUDIT, BLOOM, TABLES
from ledgerstrata.sinks.tables import (
    CODEC,
    _stored_columns,
    by_range,
    stored_bytes,
    table_sizes,
    write_table,
)
from ledgerstrata.sources.tables import table_path

YEAR = "fiscal_year"
# Stored bytes of one bucket.
BUCKET_BYTES = 256 << 20


def _named(database: str, name: str) -> str:
    return f"`{database}`.`{name}`"


def publish_table(spark: SparkSession, root: str, name: str, database: str) -> None:
    """Enter a declared table, as it is stored under ``root``, in the catalog."""
    _, schema, partition_by, _ = TABLES[name]
    columns = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    columns += [(c, "timestamp") for c in AUDIT.get(name, ())]
    if partition_by and partition_by not in schema.fieldNames():
        columns.append((partition_by, "int"))
    listed = ", ".join(f"`{column}` {kind}" for column, kind in columns)
    folders = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS {_named(database, name)}")
    spark.sql(
        f"CREATE TABLE {_named(database, name)} ({listed}) USING parquet {folders} "
        f"LOCATION '{table_path(root, name)}'"
    )
    if partition_by:
        spark.sql(f"ALTER TABLE {_named(database, name)} RECOVER PARTITIONS")


def read_published(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A published table with its declared columns; years are pruned as in a plain scan."""
    return spark.table(_named(database, name)).select(*TABLES[name][1].fieldNames())


def _years_in(spark: SparkSession, folder: str) -> set[int]:
    """Years that a load wrote rows of, from its directories."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    year = F.regexp_extract("path", rf"/{YEAR}=(\d+)/", 1)
    return {int(row.year) for row in files.select(year.alias("year")).distinct().collect() if row.year}


def switch_years(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    name: str,
    database: str,
    years: Iterable[int],
    *,
    input_bytes: int | None = None,
) -> DataFrame:
    """Replace ``years`` of a published table by the rows that ``df`` has of them.

    A year without rows loses its partition. Returns the report of
    :func:`~ledgerstrata.sinks.tables.refresh_view` for the rows of this load.
    """
    years = sorted(set(years))
    _, _, partition_by, cluster_by = TABLES[name]
    if partition_by != YEAR:
        raise ValueError(f"{name} is not partitioned by {YEAR}")
    load = f"{table_path(root, name)}.loads/{uuid.uuid4().hex}"
    write_table(
        _stored_columns(df, name).where(F.col(YEAR).isin(years)),
        load,
        partition_by=partition_by,
        cluster_by=cluster_by,
        ranges=by_range(name, input_bytes, spark),
        bloom=BLOOM.get(name, ()),
        compression=CODEC,
    )
    written = _years_in(spark, load)
    table = _named(database, name)
    for year in years:
        place = f"PARTITION ({YEAR} = {year})"
        if year in written:
            folder = f"{load}/{YEAR}={year}"
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {place} LOCATION '{folder}'")
            spark.sql(f"ALTER TABLE {table} {place} SET LOCATION '{folder}'")
        else:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {place}")
    return table_sizes(spark, {name: load}).select(
        F.col("table_name").alias("view_id"),
        "row_count",
        "size_bytes",
        "last_modified",
        F.lit("success").alias("refresh_status"),
    )


def failed_report(spark: SparkSession, database: str, name: str, error: Exception) -> DataFrame:
    """The report of a view whose refresh failed: what is still published, and why."""
    files = read_published(spark, database, name).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    reason = str(error).strip().split("\n")[0]
    by_file = files.groupBy("file", "bytes", "modified").agg(F.count("*").alias("rows"))
    return by_file.agg(
        F.lit(name).alias("view_id"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"),
        F.max("modified").alias("last_modified"),
        F.lit(f"failed: {reason}").alias("refresh_status"),
    )


def bucket_count(spark: SparkSession, *paths: str) -> int:
    """Buckets for tables stored under ``paths``, by their bytes; at least one per shuffle partition."""
    wanted = ceil(stored_bytes(spark, *paths) / BUCKET_BYTES)
    return max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


def save_bucketed(
    df: DataFrame,
    database: str,
    name: str,
    path: str,
    *,
    key: str,
    buckets: int,
    partition_by: str | None = None,
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` in ``buckets`` by a hash of ``key`` and return it as a bucketed table.

    Rows move once, by the hash that also names the bucket, so a task writes one bucket
    and a directory has at most one file per bucket.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS {_named(database, name)}")
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer = writer.bucketBy(buckets, key).sortBy(key, *sort_by)
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(f"{database}.{name}")
    return spark.table(_named(database, name))
