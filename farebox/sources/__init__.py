"""Readers: CSV (fixed / inferred schema), Parquet, raw text; driver-table views."""

from farebox.sources.csv import read_csv_inferred, read_csv_with_schema
from farebox.sources.merged import read_merged
from farebox.sources.parquet import read_parquet
from farebox.sources.schema_store import read_csv_remembered
from farebox.sources.text import first_line, line_counts, parse_lines, read_lines, strip_header

__all__ = ["first_line", "line_counts", "parse_lines", "read_csv_inferred", "read_csv_remembered", "read_csv_with_schema",
           "read_lines", "read_merged", "read_parquet", "strip_header"]
