"""Numeric columns: tolerant casts, null-keeping clips and safe ratios."""

from __future__ import annotations

from decimal import Decimal
from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def to_number(c: Column) -> Column:
    """Text to double; whatever does not parse becomes null."""
    return F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))


def number_or_zero(c: Column) -> Column:
    return F.coalesce(to_number(c), F.lit(0.0))


def clip_negative(c: Column) -> Column:
    """Negative values become 0, null stays null (``greatest`` alone would give 0)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0).cast("int")))


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` in double, null where ``b`` is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def mean(total: Column, count: Column) -> Column:
    """Mean from an exact decimal sum and a count."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def finite(c: Column) -> Column:
    """Null, not-a-number and infinite values become 0."""
    infinite = c.isin(float("inf"), float("-inf"))
    return F.when(c.isNull() | F.isnan(c) | infinite, 0.0).otherwise(c)


def plain_decimal(c: Column, kind: str = "decimal(28,8)") -> Column:
    """Text to decimal when it looks like a plain number, not below 0, else null."""
    text = F.btrim(c)
    return F.when(text.rlike(fixed.PLAIN_NUMBER), F.greatest(text.try_cast(kind), F.lit(0).cast(kind)))


def exchange_rate(currency: Column, rates: Mapping[str, str] = fixed.EXCHANGE_RATES) -> Column:
    """Rate to US dollars; unknown and missing currencies take the mean of all rates.

    The rates are a literal map in the plan, so no join is needed.
    """
    values = {k: Decimal(str(v)) for k, v in rates.items()}
    default = sum(values.values()) / len(values)
    # two digits more than the finest rate has, for the mean; six before the point
    scale = min(16, 2 + max(0, *(-v.normalize().as_tuple().exponent for v in values.values())))
    kind = f"decimal({scale + 6},{scale})"
    table = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(str(v)).cast(kind))])
    known = F.try_element_at(table, F.coalesce(currency, F.lit("")))
    return F.coalesce(known, F.lit(f"{default:f}").cast(kind))
