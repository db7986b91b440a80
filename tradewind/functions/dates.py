"""Date expressions. All of them keep TIMESTAMP_NTZ and DATE free of time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(moment: Column | str) -> Column:
    return F.trunc(moment, "month")


def month_end(moment: Column | str) -> Column:
    return F.last_day(moment)


def week_end(moment: Column | str) -> Column:
    """The Sunday that closes the week of `moment`."""
    return F.date_add(F.trunc(moment, "week"), 6)


def year_month(moment: Column | str) -> Column:
    return F.date_format(moment, "yyyy-MM")


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour days between two moments; a calendar difference would count midnights."""
    return F.timestamp_diff("DAY", start, end).cast("int")
