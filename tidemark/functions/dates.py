"""Look-back dates and dated folder names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day: str | dt.date) -> dt.date:
    if isinstance(day, dt.datetime):
        return day.date()
    return day if isinstance(day, dt.date) else dt.datetime.strptime(day, "%Y-%m-%d").date()


def since_date(run_date: str | dt.date, days_ago: int | str | None) -> str | None:
    """Lower bound of an incremental read, or None for a full one.

    Blank and zero both mean a full read.
    """
    days = int(days_ago) if days_ago else 0
    if days < 0:
        raise ValueError(f"a look-back cannot be negative: {days}")
    if not days:
        return None
    return (as_date(run_date) - dt.timedelta(days=days)).isoformat()


def since_column(run_date: Column, days_ago: int) -> Column:
    """``since_date`` for a text column of run dates."""
    day = F.to_date(run_date, "yyyy-MM-dd")
    return F.date_format(F.date_sub(day, days_ago), "yyyy-MM-dd")


def landing_path(root: str, name: str, run_date: str | dt.date) -> str:
    """Folder of one source and day; month and day carry no leading zero."""
    day = as_date(run_date)
    return f"{root.rstrip('/')}/{name}/{day.year}/{day.month}/{day.day}"


def landing_path_column(root: str, name: str, run_date: Column) -> Column:
    """``landing_path`` for a date or timestamp column."""
    return F.format_string(
        f"{root.rstrip('/')}/{name}/%d/%d/%d",
        F.year(run_date),
        F.month(run_date),
        F.dayofmonth(run_date),
    )
