"""Sources and sinks: CSV and TSV with the usual data-frame reading rules, Parquet, and stored artefacts."""

from .delimited import read_delimited, read_header, write_delimited
from .tables import read_table

__all__ = ["read_delimited", "read_header", "read_table", "write_delimited"]
