from ledgerstrata.sinks.catalog import (
    bucket_count,
    publish_table,
    read_published,
    save_bucketed,
    switch_years,
)
from ledgerstrata.sinks.tables import (
    refresh_view,
    table_sizes,
    touched_years,
    with_audit,
    write_table,
)

__all__ = [
    "bucket_count",
    "publish_table",
    "read_published",
    "refresh_view",
    "save_bucketed",
    "switch_years",
    "table_sizes",
    "touched_years",
    "with_audit",
    "write_table",
]
