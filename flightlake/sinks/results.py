"""K2: a report answer as CSV without header.

A bounded answer (a LIMIT, one row a continent) is one file. An answer that grows with the data,
such as the ranking of models by airline and country, is written by all tasks; a sorted answer keeps
its order from file to file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv_result(df: DataFrame, path: str, bounded: bool = False, mode: str = "append") -> None:
    """``bounded``: the answer has a fixed number of rows at any scale, and goes to one file in its order."""
    out = df.coalesce(1) if bounded else df
    out.write.mode(mode).csv(path)
