"""Sinks: Parquet files, the null sink, staged JDBC table replace."""

from tallyframe.sinks.files import load_table, write_counted, write_noop, write_parquet
from tallyframe.sinks.jdbc import replace_table

__all__ = ["load_table", "replace_table", "write_counted", "write_noop", "write_parquet"]
