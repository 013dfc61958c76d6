"""Writers (CSV, Parquet, text) and the CSV -> Parquet job."""

from farebox.sinks.etl import csv_to_parquet
from farebox.sinks.writers import run_scoped_path, write_csv, write_csv_single, write_parquet, write_text

__all__ = ["csv_to_parquet", "run_scoped_path", "write_csv", "write_csv_single", "write_parquet", "write_text"]
