"""Sources and sinks: extract files, stored layers, test-table views."""

from tillroll.sources.extracts import (
    concat_extracts,
    read_csv,
    read_latin1_csv,
    split_extracts,
    split_lines,
    split_orders,
    split_products,
)
from tillroll.sources.sinks import write_csv, write_jdbc, write_parquet, write_table
from tillroll.sources.tables import read_jdbc, read_parquet, read_table

__all__ = [
    "concat_extracts",
    "read_csv",
    "read_jdbc",
    "read_latin1_csv",
    "read_parquet",
    "read_table",
    "split_extracts",
    "split_lines",
    "split_orders",
    "split_products",
    "write_csv",
    "write_jdbc",
    "write_parquet",
    "write_table",
]
