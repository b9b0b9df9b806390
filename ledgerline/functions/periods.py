"""Months, quarters and their spines, all on ``DateType``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def month_end(c: Column) -> Column:
    return F.last_day(c)


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def quarter_start(c: Column) -> Column:
    return F.trunc(c, "quarter")


def quarter_end(c: Column) -> Column:
    return F.date_sub(F.add_months(quarter_start(c), 3), 1)


def month_number(c: Column) -> Column:
    """Running month count; the difference of two is the months between them."""
    return F.year(c) * 12 + F.month(c)


def fiscal_year(c: Column, first_month: int = 4) -> Column:
    return F.year(F.add_months(c, (13 - first_month) % 12))


def quarter_starts(first: Column, last: Column) -> Column:
    return F.sequence(quarter_start(first), quarter_start(last), F.expr("interval 3 months"))


def future_month_ends(start: Column, horizon: int) -> Column:
    """Array of the ``horizon`` month ends that follow the month of ``start``."""
    steps = F.sequence(F.lit(1), F.lit(horizon))
    return F.transform(steps, lambda i: F.last_day(F.add_months(start, i)))


def any_date(c: Column) -> Column:
    """Date of a date or time column, or of text in the first of ``DATE_FORMATS`` that fits."""
    text = F.btrim(c.cast("string"))
    iso = F.when(text.rlike(fixed.ISO_START), text.try_cast("date"))
    return F.coalesce(iso, *[date_like(text, f) for f in fixed.DATE_FORMATS])


def date_like(text: Column, form: str) -> Column:
    """Date of text in one of ``DATE_FORMATS``, else null."""
    return F.when(text.rlike(fixed.DATE_SHAPES[form]), F.try_to_timestamp(text, F.lit(form)).cast("date"))


def iso_date(c: Column) -> Column:
    """Date of ``yyyy-MM-dd`` text, null for any other shape or an impossible date."""
    text = F.btrim(c)
    return F.when(text.rlike(fixed.ISO_DATE), text.try_cast("date"))
