"""Time expressions: epoch seconds and the snapshot folder layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def epoch_seconds(ts) -> Column:
    """Seconds since 1970 as long; a timestamp without zone counts as UTC."""
    return F.unix_timestamp(_c(ts)).cast("long")


def utc_wall_clock(ts) -> Column:
    """A timestamp (with zone semantics) as its UTC wall-clock time without
    zone, so labels derived from it do not depend on the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))


def run_label(ts) -> Column:
    """A run's name, from its time to the microsecond in UTC; names sort in time order."""
    return F.date_format(utc_wall_clock(ts), "yyyyMMdd'T'HHmmssSSSSSS")


def layout_columns(ts) -> dict[str, Column]:
    """Partition values of a snapshot taken at ``ts``.

    Every value sorts in time order (the month and day labels of the old
    layout did not); ``tech_month_label`` keeps the readable month name.
    """
    ts = _c(ts)
    return {
        "tech_year": F.date_format(ts, "yyyy"),
        "tech_month": F.date_format(ts, "yyyy-MM"),
        "tech_day": F.date_format(ts, "yyyy-MM-dd"),
        "tech_hour": F.date_format(ts, "HH"),
        "tech_month_label": F.date_format(ts, "MMMM-yyyy"),
    }
