"""Revenue marts (MART-17..20, 25).

Sales are rows of (product, sold_on, valid_from, valid_to, quantity, price, amount,
vat_rate); products carry account, label, family and trips per unit.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.functions.validity import covers, net_of_tax, unit_price, validity_end, validity_start
from lakeops.operators.joins import first_per_key, with_count
from lakeops.operators.summaries import ordered_text


def sale_lines(
    sales: DataFrame, products: DataFrame, annual: Column, monthly: Column, align_annual: bool = False
) -> DataFrame:
    """MART-19: sale lines with business validity, trips sold and monthly price."""
    s, f, t = F.col("sold_on"), F.col("valid_from"), F.col("valid_to")
    lines = sales.join(products, "product", "left")
    price = unit_price(F.col("price"), annual)
    return lines.withColumns(
        {
            "business_from": validity_start(s, f, annual, align_annual),
            "business_to": validity_end(s, f, t, annual, monthly, align_annual),
            "trips": F.coalesce("trips_per_unit", F.lit(1)) * F.col("quantity"),
            "business_price": price,
            "business_price_net": net_of_tax(price, F.col("vat_rate")),
        }
    )


def _by_account(accounts: DataFrame, kept: DataFrame, vat_percent: float) -> DataFrame:
    totals = kept.groupBy("account").agg(
        F.sum("trips").alias("trips"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount")
    )
    totals = totals.withColumn("amount_net", net_of_tax(F.col("amount").cast("double"), F.lit(vat_percent)))
    return accounts.join(totals, "account", "left")


def revenue_by_account(
    accounts: DataFrame, lines: DataFrame, first: date, before: date, vat_percent: float = 10.0
) -> DataFrame:
    """MART-17: totals of lines valid within a period; accounts without sales stay."""
    kept = lines.filter((F.col("business_from") >= F.lit(first)) & (F.col("business_to") < F.lit(before)))
    return _by_account(accounts, kept, vat_percent)


def active_at_boundaries(
    accounts: DataFrame, lines: DataFrame, boundaries: Sequence[date], vat_percent: float = 10.0
) -> DataFrame:
    """MART-18: totals of lines whose validity covers any of the boundary dates."""
    active = None
    for day in boundaries:
        one = covers(F.lit(day), F.col("business_from"), F.col("business_to"))
        active = one if active is None else active | one
    return _by_account(accounts, lines.filter(active), vat_percent)


def sales_by_period(lines: DataFrame, sold_on: str, keys: Sequence[str]) -> DataFrame:
    """MART-20: quantity and amount by year, month and product attributes."""
    day = F.col(sold_on)
    return lines.groupBy(F.year(day).alias("year"), F.month(day).alias("month"), *keys).agg(
        F.sum("quantity").alias("quantity"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount")
    )


def instalment_export(
    customers: DataFrame, contacts: DataFrame, instalments: DataFrame, plans: DataFrame
) -> DataFrame:
    """MART-25: one row per plan with its payer, first contact, address list and instalment
    counts.

    ``customers(customer_id, …)``, ``contacts(customer_id, contact_id, address, deleted)``,
    ``instalments(instalment_id, plan_id, status, amount)``, ``plans(plan_id, customer_id)``.
    """
    live = contacts.filter(~F.col("deleted"))
    first = first_per_key(live.select("customer_id", "contact_id", "address"), ["customer_id"], ["contact_id"])
    listed = ordered_text(live, ["customer_id"], "address", "addresses", ";")
    counted = with_count(plans, instalments, ["plan_id"], "instalments")
    counted = with_count(counted, instalments.filter(F.col("status") == "paid"), ["plan_id"], "paid")
    # One row per payer first: the plans, where a payer may be frequent, are joined once.
    payers = customers.join(first.select("customer_id", F.col("address").alias("first_address")), "customer_id", "full")
    return counted.join(payers.join(listed, "customer_id", "full"), "customer_id", "left")
