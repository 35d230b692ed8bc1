"""Sources: Parquet tables, CSV, driver-held rows, JDBC."""

from tallyframe.sources.csv import read_csv_text, read_csv_typed, write_csv
from tallyframe.sources.jdbc import read_jdbc
from tallyframe.sources.memory import replicate, rows_frame
from tallyframe.sources.tables import read_parquet, read_table, table_path

__all__ = [
    "read_csv_text",
    "read_csv_typed",
    "read_jdbc",
    "read_parquet",
    "read_table",
    "replicate",
    "rows_frame",
    "table_path",
    "write_csv",
]
