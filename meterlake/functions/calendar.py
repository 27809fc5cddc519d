"""Month arithmetic."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_YEAR_MONTH = re.compile(r"(\d{4})-(0?[1-9]|1[0-2])")


def parse_month(text: str) -> date:
    match = _YEAR_MONTH.fullmatch(text or "")
    if match is None or int(match[1]) == 0:
        raise ValueError(f"'{text}' is no month of the form YYYY-MM")
    return date(int(match[1]), int(match[2]), 1)


def month_before(day: date) -> str:
    """The month before that of ``day``: the latest whose file can be complete."""
    month = day.year * 12 + day.month - 2
    return f"{month // 12:04d}-{month % 12 + 1:02d}"


def month_range(start_month: str, end_month: str) -> list[str]:
    """All months from start to end, both included."""
    start, end = parse_month(start_month), parse_month(end_month)
    if start > end:
        raise ValueError("the range ends before it starts")
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [f"{month // 12:04d}-{month % 12 + 1:02d}" for month in range(first, last + 1)]


def months_between(start: Column, end: Column) -> Column:
    """The same range as an array of ``yyyy-MM`` texts, for use inside a plan."""
    months = F.sequence(
        F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month")
    )
    return F.transform(months, lambda month: F.date_format(month, "yyyy-MM"))


def resolve_months(
    run_month: str,
    year_month: str | None = None,
    start_month: str | None = None,
    end_month: str | None = None,
) -> list[str]:
    """The months of a run: one month or a range, never both; ``run_month`` by default."""
    if year_month and (start_month or end_month):
        raise ValueError("give one month or a range of months, not both")
    if bool(start_month) != bool(end_month):
        raise ValueError("a range needs its first and its last month")
    if start_month and end_month:
        return month_range(start_month, end_month)
    return [year_month or run_month]
