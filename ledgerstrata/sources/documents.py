"""Company documents: one nested JSON object per company.

A document that cannot be parsed keeps its text in ``CORRUPT`` and has NULL
everywhere else. ``valid_documents`` and ``rejected_documents`` tell the two
kinds apart; nothing is lost without a row that says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerstrata.schemas import DOCUMENT_SCHEMA, SUBMISSION_SCHEMA

CORRUPT = "corrupt_document"


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def _read_json(spark: SparkSession, path, schema, multiline: bool, glob: str | None) -> DataFrame:
    reader = (
        spark.read.schema(_with_corrupt(schema))
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.json(path)


def read_documents(
    spark: SparkSession, path: str | list[str], *, multiline: bool = False, glob: str | None = None
) -> DataFrame:
    """Fact documents as JSON lines, or one document per file with ``multiline``.

    The schema is given, so there is no inference pass, and a projection that
    needs only the company attributes never materialises the facts.
    """
    return _read_json(spark, path, DOCUMENT_SCHEMA, multiline, glob)


def read_submissions(
    spark: SparkSession, path: str | list[str], *, multiline: bool = False, glob: str | None = None
) -> DataFrame:
    """Company attribute documents (tickers, exchanges, SIC code)."""
    return _read_json(spark, path, SUBMISSION_SCHEMA, multiline, glob)


def _parse(df: DataFrame, json_col: Column | str, schema: StructType) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.select(
        F.from_json(json_col, _with_corrupt(schema), options).alias("doc"),
        *([F.col("error").alias("_error")] if "error" in df.columns else []),
    )
    if "_error" not in parsed.columns:
        return parsed.select("doc.*")
    # A member that could not be read counts as a corrupt document.
    fields = [F.col(f"doc.{field.name}").alias(field.name) for field in schema.fields]
    return parsed.select(*fields, F.coalesce(f"doc.{CORRUPT}", "_error").alias(CORRUPT))


def parse_documents(df: DataFrame, json_col: Column | str = "doc_json") -> DataFrame:
    """JSON text (for instance archive members) to the columns of :func:`read_documents`."""
    return _parse(df, json_col, DOCUMENT_SCHEMA)


def parse_submissions(df: DataFrame, json_col: Column | str = "doc_json") -> DataFrame:
    """JSON text to the columns of :func:`read_submissions`."""
    return _parse(df, json_col, SUBMISSION_SCHEMA)


def valid_documents(documents: DataFrame) -> DataFrame:
    """The documents that could be parsed, without the column of corrupt text."""
    # The id is looked at, always with success, because Spark refuses to scan the
    # corrupt text alone, as a mere count of these rows would.
    has_id_field = F.length(F.coalesce("cik", F.lit(""))) >= 0
    return documents.where(F.col(CORRUPT).isNull() & has_id_field).drop(CORRUPT)


def rejected_documents(documents: DataFrame) -> DataFrame:
    """``(cik, corrupt_document)`` of the documents that could not be parsed."""
    return documents.where(F.col(CORRUPT).isNotNull()).select("cik", CORRUPT)


def count_documents(documents: DataFrame) -> DataFrame:
    """One row: documents, those with an id, and those that were rejected."""
    return documents.agg(
        F.count("*").alias("documents"),
        # Read as well because a scan of the corrupt text alone is not allowed.
        F.count("cik").alias("with_id"),
        F.count(CORRUPT).alias("rejected"),
    )
