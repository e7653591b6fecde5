"""Amounts: tax-exclusive value and the voucher price book."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tax factor, and list price and half-year divisor per plan title
# and number of supplied resets.
TAX_FACTOR = 1.1
LIST_PRICE = {
    "Starter Plan": 50000,
    "Business Plan": 75000,
    "Premium Plan": 100000,
    "Voucher10": 100000,
    "Voucher20": 200000,
    "Voucher40": 400000,
}
RESETS_SOLD = {
    "Starter Plan": (12, 1),
    "Business Plan": (12, 6, 1),
    "Premium Plan": (12, 1),
    "Voucher10": (12, 1),
    "Voucher20": (12, 1),
    "Voucher40": (12, 1),
}
DIVISOR = {12: 2, 6: 4, 1: 24}
SINGLE_PRICE = {("Premium", 1): 33000}


def tax_exclusive(amount: Column) -> Column:
    """Amount without tax, rounded up in size, sign kept."""
    return F.ceil(F.abs(amount).cast("double") / F.lit(TAX_FACTOR)).cast("double") * F.signum(
        amount.cast("double")
    )


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def _sold_as(title: Column, resets: Column) -> Column:
    return F.concat(title, F.lit("|"), resets.cast("string"))


def unit_price(title: Column, resets: Column) -> Column:
    """Price of one of several invoices of a plan; NULL if not in the book."""
    book = {
        f"{name}|{count}": LIST_PRICE[name] // DIVISOR[count]
        for name, counts in RESETS_SOLD.items()
        for count in counts
    }
    book |= {f"{name}|{count}": price for (name, count), price in SINGLE_PRICE.items()}
    return F.try_element_at(_literal_map(book), _sold_as(title, resets)).cast("bigint")


def full_price(title: Column, resets: Column) -> Column:
    """Price of a plan invoiced once; NULL if not in the book."""
    single = {f"{name}|{count}": price for (name, count), price in SINGLE_PRICE.items()}
    return F.coalesce(
        F.try_element_at(_literal_map(LIST_PRICE), title),
        F.try_element_at(_literal_map(single), _sold_as(title, resets)),
    ).cast("bigint")
