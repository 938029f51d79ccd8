"""Business metrics as column expressions.

Money is decimal from end to end: rounding a binary double at the half cent depends on the engine.
Each result is rounded once, from unrounded operands, and stored as ``decimal(18,2)``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.mapping import flag, value_when

MONEY = "decimal(18,2)"
ONE = Decimal(1)
PERCENT = Decimal("0.01")
NEW_CUSTOMER_DAYS = 90
PAID = "PAID"

# Receivable buckets, each with its last day past due (None: no end).
AGING_BUCKETS = {
    "Current": 0,
    "1-30 days overdue": 30,
    "31-60 days overdue": 60,
    "60+ days overdue": None,
}

AsOf = dt.date | str | Column | None


def as_of_date(as_of: AsOf) -> Column:
    """The reporting date: a given one, else today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


def money(c: Column) -> Column:
    return F.round(c, 2).try_cast(MONEY)


# --- lines and orders -----------------------------------------------------------------------------
def kept_share(fraction: Column) -> Column:
    """What remains of a price after a discount given as 0-1."""
    return F.lit(ONE) - fraction


def percent(c: Column) -> Column:
    """0-100 to 0-1, exact (a decimal division would widen the scale)."""
    return c * F.lit(PERCENT)


def line_amounts(quantity: Column, price: Column, cost: Column, discount: Column) -> dict[str, Column]:
    """Gross, discount, net, cost and profit of a line; ``discount`` is a 0-1 share.

    The five values are rounded separately, so ``gross - discount = net`` holds to the cent only.
    """
    gross = quantity * price
    net = gross * kept_share(discount)
    spent = quantity * cost
    return {
        "revenue": money(net),
        "gross_revenue": money(gross),
        "discount_amount": money(gross * discount),
        "cost": money(spent),
        "gross_profit": money(net - spent),
    }


def line_total(stated: Column, quantity: Column, price: Column, discount_pct: Column) -> Column:
    """The stated total, else recomputed where the price is known."""
    computed = F.round(quantity * price * kept_share(percent(discount_pct)), 2)
    return F.coalesce(stated, computed.try_cast("decimal(14,2)"))


# --- products -------------------------------------------------------------------------------------
def unit_margin(price: Column, cost: Column) -> Column:
    return money(price - cost)


def margin_pct(price: Column, cost: Column) -> Column:
    """Margin in percent of the price; null where the price is null or zero."""
    return money(F.try_divide((price - cost) * F.lit(Decimal(100)), price))


# --- customers ------------------------------------------------------------------------------------
def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def is_new_customer(registered: Column, as_of: AsOf = None) -> Column:
    return flag(days_between(registered, as_of_date(as_of)) <= NEW_CUSTOMER_DAYS)


# --- delivery -------------------------------------------------------------------------------------
def is_on_time(shipped: Column, requested: Column) -> Column:
    """False also where the order has not shipped; rates must look at shipped orders only."""
    return flag(shipped <= requested)


# --- receivables ----------------------------------------------------------------------------------
def is_open(status: Column) -> Column:
    """Unknown for a null status, and so neither open nor overdue."""
    return status != PAID


def outstanding(amount: Column, paid: Column) -> Column:
    """May be negative: overpayments are shown."""
    return (amount - paid).try_cast(MONEY)


def days_outstanding(invoiced: Column, status: Column, as_of: AsOf = None) -> Column:
    return value_when(is_open(status), days_between(invoiced, as_of_date(as_of)))


def is_overdue(due: Column, status: Column, as_of: AsOf = None) -> Column:
    return flag((due < as_of_date(as_of)) & is_open(status))


def aging_bucket(due: Column, as_of: AsOf = None) -> Column:
    """Receivable bucket by days past due; null without a due date."""
    late = days_between(due, as_of_date(as_of))
    chain = None
    for name, last_day in AGING_BUCKETS.items():
        test = late.isNotNull() if last_day is None else late <= last_day
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain


def days_sales_outstanding(receivables: Column, credit_sales: Column, days: int) -> Column:
    """``receivables / credit_sales * days``; null without sales."""
    return money(F.try_divide(receivables * F.lit(Decimal(days)), credit_sales))
