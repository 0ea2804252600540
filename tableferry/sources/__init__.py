from tableferry.sources.base import (
    Source,
    count_rows,
    discover_tables,
    introspect_columns,
    open_counts,
    table_names,
)
from tableferry.sources.files import CatalogSource, FrameSource, ParquetSource
from tableferry.sources.jdbc import JdbcSource, Split

__all__ = [
    "CatalogSource",
    "FrameSource",
    "JdbcSource",
    "ParquetSource",
    "Source",
    "Split",
    "count_rows",
    "discover_tables",
    "introspect_columns",
    "open_counts",
    "table_names",
]
