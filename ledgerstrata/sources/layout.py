"""Landing-zone layout: where a document lies says what it is.

``bulk/[{year}/]{file}``, ``daily-index/{year}/{month}/{day}/{file}`` and
``filings/{cik}/{accession}/{file}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BULK = r"(?:^|/)bulk/(?:(\d{4})/)?([^/]+)$"
DAILY = r"(?:^|/)daily-index/(\d{4})/(\d{2})/(\d{2})/([^/]+)$"
FILINGS = r"(?:^|/)filings/([^/]+)/([^/]+)/([^/]+)$"


def bulk_path(filename: str, year: int | None = None) -> str:
    return f"bulk/{year}/{filename}" if year else f"bulk/{filename}"


def daily_index_path(year: int, month: int, day: int, filename: str) -> str:
    return f"daily-index/{year}/{month:02d}/{day:02d}/{filename}"


def filings_path(cik: str, accession: str, filename: str) -> str:
    return f"filings/{cik}/{accession}/{filename}"


def layout_glob(
    layout: str,
    *,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    cik: str | None = None,
    accession: str | None = None,
    filename: str = "*",
) -> str:
    """Path pattern for a part of the landing zone.

    Handing it to a reader limits the listing itself, so files of other years
    or companies are never looked at.
    """
    if layout == "bulk":
        parts = ["bulk", f"{year:04d}" if year else "*", filename]
    elif layout == "daily-index":
        two = ["*" if n is None else f"{n:02d}" for n in (month, day)]
        parts = ["daily-index", f"{year:04d}" if year else "*", *two, filename]
    elif layout == "filings":
        parts = ["filings", cik or "*", accession or "*", filename]
    else:
        raise ValueError(f"unknown layout {layout}")
    return "/".join(parts)


def layout_columns(path: Column | str) -> list[Column]:
    """Kind, year, index date, cik, accession and file name read off a path."""
    path = F.col(path) if isinstance(path, str) else path

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))

    kind = (
        F.when(path.rlike(BULK), "bulk").when(path.rlike(DAILY), "daily-index").when(path.rlike(FILINGS), "filings")
    )
    day = F.concat_ws("-", part(DAILY, 1), part(DAILY, 2), part(DAILY, 3))
    return [
        kind.alias("layout"),
        F.coalesce(part(BULK, 1), part(DAILY, 1)).try_cast("int").alias("layout_year"),
        day.try_cast("date").alias("index_date"),
        part(FILINGS, 1).alias("layout_cik"),
        part(FILINGS, 2).alias("layout_accession"),
        F.coalesce(part(BULK, 2), part(DAILY, 4), part(FILINGS, 3)).alias("file_name"),
    ]


def with_layout(df: DataFrame, path: Column | str = "_metadata.file_path") -> DataFrame:
    """Append the layout columns of the file each row was read from."""
    return df.select("*", *layout_columns(path))
