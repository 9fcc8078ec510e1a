"""Date functions: strict text parsing, month starts and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_date_strict(text, fmt: str = ISO_DATE) -> Column:
    """Parse ``yyyy-MM-dd`` text; a non-null text that does not parse fails the
    query whatever the session's ANSI setting is."""
    t = _c(text)
    parsed = F.try_to_date(t, fmt)
    return F.when(t.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("unparseable date: "), t))
                  .cast("date")).otherwise(parsed)


def parse_date_lenient(text, fmt: str = ISO_DATE) -> Column:
    """Opt-in lenient parse: bad text becomes null."""
    return F.try_to_date(_c(text), fmt)


def month_start(d) -> Column:
    """First day of the month of a date or timestamp (NTZ-safe, no zone cast)."""
    return F.trunc(F.to_date(_c(d)), "MM")


def month_of(d) -> Column:
    """extract(month) as a 64-bit integer."""
    return F.month(_c(d)).cast("long")


def year_of(d) -> Column:
    """extract(year) as a 64-bit integer."""
    return F.year(_c(d)).cast("long")


def first_month_start_on_or_after(d) -> Column:
    """``d`` if it is a month's first day, else the next month's first day."""
    d = F.to_date(_c(d))
    return F.when(F.dayofmonth(d) == 1, d).otherwise(F.add_months(F.trunc(d, "MM"), 1))


def month_starts_between(start, end) -> Column:
    """Array of every month start in ``[start, end]`` (both inclusive), empty
    when there is none."""
    first = first_month_start_on_or_after(start)
    last = F.to_date(_c(end))
    return F.when(
        first <= last,
        F.sequence(first, last, F.expr("INTERVAL 1 MONTH")),
    ).otherwise(F.array().cast("array<date>"))


def format_iso(d) -> Column:
    return F.date_format(_c(d), ISO_DATE)
