"""Composite plans: driver-table fixtures, the seven reports, the query
catalog, the DuckDB oracle and the end-to-end ETL (etl.py)."""
