"""Partial dates: precision, first, last and middle day, free-text dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.values import within


def safe_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where the parts make none (30 February)."""
    text = F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def precision(year: Column, month: Column, day: Column) -> Column:
    """day, month or year: what is left of the parts after the check of their ranges; null without a year."""
    m, d = within(month, 1, 12), within(day, 1, 31)
    return F.when(year.isNull(), None).when(m.isNull(), "year").when(d.isNull(), "month").otherwise("day")


def event_span(year: Column, month: Column, day: Column) -> tuple[Column, Column, Column]:
    """Epoch days of the first, last and middle day an event can have; the middle is half the sum, rounded down."""
    kind = precision(year, month, day)
    exact = F.unix_date(safe_date(year, month, day))
    first_of_month = safe_date(year, month, F.lit(1))
    start = F.when(kind == "day", exact).when(kind == "month", F.unix_date(first_of_month)).when(kind == "year", F.unix_date(safe_date(year, F.lit(1), F.lit(1))))
    end = F.when(kind == "day", exact).when(kind == "month", F.unix_date(F.last_day(first_of_month))).when(kind == "year", F.unix_date(safe_date(year, F.lit(12), F.lit(31))))
    return start, end, F.floor((start + end) / 2).cast("double")


def text_date(c: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of free text: a full date, a month and year, or a year."""
    s = F.trim(F.regexp_replace(c, r"[,.]", " "))
    s = F.regexp_replace(s, r"\s+", " ")
    full = F.coalesce(*[F.try_to_date(s, f) for f in ("yyyy-MM-dd", "yyyyMMdd", "MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "M/d/yyyy")])
    month = F.coalesce(*[F.try_to_date(F.concat(F.lit("1 "), s), f) for f in ("d MMMM yyyy", "d MMM yyyy", "d yyyy-MM", "d M/yyyy")])
    year = F.when(s.rlike(r"^\d{4}$"), s.cast("int"))
    return F.coalesce(F.year(full), F.year(month), year), F.coalesce(F.month(full), F.month(month)), F.day(full)


def spread_in_month(year_month: Column, rank: Column, count: Column) -> Column:
    """A day for a row known to the month only: the rank-th of ``count`` equal steps through the month YYYY-MM."""
    first = F.try_to_date(F.concat(year_month, F.lit("-01")), "yyyy-MM-dd")
    return F.round(F.unix_date(first) - 1 + rank * F.day(F.last_day(first)) / count)
