"""Sinks: Parquet snapshots (K1, K3) and CSV results (K2)."""

from flightlake.sinks.results import write_csv_result  # noqa: F401
from flightlake.sinks.snapshots import add_layout_columns, write_parquet_snapshot  # noqa: F401
