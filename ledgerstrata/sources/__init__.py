from ledgerstrata.sources.archive import list_members, read_archive
from ledgerstrata.sources.documents import (
    CORRUPT,
    count_documents,
    parse_documents,
    parse_submissions,
    read_documents,
    read_submissions,
    rejected_documents,
    valid_documents,
)
from ledgerstrata.sources.layout import (
    bulk_path,
    daily_index_path,
    filings_path,
    layout_columns,
    layout_glob,
    with_layout,
)
from ledgerstrata.sources.tables import read_table, with_tickers

__all__ = [
    "CORRUPT",
    "bulk_path",
    "count_documents",
    "daily_index_path",
    "filings_path",
    "layout_columns",
    "layout_glob",
    "list_members",
    "parse_documents",
    "parse_submissions",
    "read_archive",
    "read_documents",
    "read_submissions",
    "read_table",
    "rejected_documents",
    "valid_documents",
    "with_layout",
    "with_tickers",
]
