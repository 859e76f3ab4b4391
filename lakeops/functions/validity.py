"""OP-126: business validity windows by product family."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def validity_start(sold: Column, start: Column, annual: Column, align_annual: bool = False) -> Column:
    """Start of validity. ``align_annual`` moves annual products to the first of the
    month of the later of sale and start."""
    plain = F.coalesce(start, sold).cast("date")
    if not align_annual:
        return plain
    anchor = F.when(start.isNull() | (start < sold), sold).otherwise(start)
    return F.when(annual, F.trunc(anchor, "month")).otherwise(plain)


def validity_end(
    sold: Column, start: Column, end: Column, annual: Column, monthly: Column, align_annual: bool = False
) -> Column:
    """End of validity: +11 months, last day of the month, or the sale date."""
    if align_annual:
        anchor = F.when(start.isNull() | (start < sold), sold).otherwise(start)
        fixed = F.when(annual, F.last_day(F.add_months(F.trunc(anchor, "month"), 11)))
    else:
        fixed = F.when(end.isNull() & annual, F.add_months(sold, 11))
    return (
        fixed.when(end.isNull() & monthly, F.last_day(sold))
        .when(end.isNull(), sold.cast("date"))
        .otherwise(end.cast("date"))
    )


def unit_price(price: Column, annual: Column) -> Column:
    """Annual products count a twelfth of their price per month."""
    return F.when(annual, price / 12).otherwise(price)


def net_of_tax(amount: Column, rate_percent: Column) -> Column:
    return amount * 100 / (F.lit(100) + rate_percent)


def covers(day: Column, start: Column, end: Column) -> Column:
    """The validity window holds the boundary day strictly inside."""
    return (start < day) & (end > day)
