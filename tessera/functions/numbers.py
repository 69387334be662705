"""Numeric functions, grades, prices and money (F-7 to F-10, F-21, F-22, M-12)."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sign_class(x: Column) -> Column:
    """``Positive`` above zero, otherwise ``Negative``."""
    return F.when(x > 0, "Positive").otherwise("Negative")


def grade(score: Column) -> Column:
    """A from 90, B from 80, else C."""
    return F.when(score >= 90, "A").when(score >= 80, "B").otherwise("C")


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def factorial(n: Column) -> Column:
    """Exact up to 33 as a decimal; larger values do not fit 38 digits and give NULL."""
    steps = F.sequence(F.lit(1), F.greatest(n.cast("int"), F.lit(1)))
    product = F.aggregate(steps, F.lit(1).cast("decimal(38,0)"),
                          lambda acc, i: (acc * i.cast("decimal(2,0)")).cast("decimal(38,0)"))
    return F.when((n >= 0) & (n <= 33), product)


PRICING: dict[str, Callable[[Column, Column], Column]] = {
    "standard": lambda base, volume: base,
    "premium": lambda base, volume: base * 0.85,
    "b2b": lambda base, volume: base * (1 - F.least(F.lit(0.30), F.coalesce(volume, F.lit(1)) * 0.001)),
}


def dynamic_pricing(factor: float) -> Callable[[Column, Column], Column]:
    """Strategy with a demand factor, to be registered by the caller."""
    return lambda base, volume: base * factor


def tier_price(tier: Column, base: Column, volume: Column, strategies=None) -> Column:
    """Price by the strategy of the tier; an unknown tier pays the standard price (F-21)."""
    table = PRICING if strategies is None else strategies
    price = table["standard"](base, volume)
    for name, rule in table.items():
        if name != "standard":
            price = F.when(tier == name, rule(base, volume)).otherwise(price)
    return price


def money(json_text: Column) -> Column:
    """Cents and currency from ``{"amount": cents, "currency": c}`` or a plain number (F-22).

    A plain number is truncated to whole cents; anything else gives NULL.
    """
    as_doc = F.from_json(json_text, "amount BIGINT, currency STRING")
    number = F.when(json_text.rlike(r"^\s*-?\d+(\.\d+)?([eE][+-]?\d+)?\s*$"), json_text.try_cast("double"))
    cents = F.when(number >= 0, F.floor(number * 100)).otherwise(F.ceil(number * 100)).cast("bigint")
    return (F.when(number.isNotNull(), F.struct(cents.alias("amount"), F.lit("USD").alias("currency")))
            .when(as_doc["amount"].isNotNull(),
                  F.struct(as_doc["amount"].alias("amount"), F.coalesce(as_doc["currency"], F.lit("USD")).alias("currency"))))


def money_strict(json_text: Column) -> Column:
    """Like :func:`money`, but an unreadable value fails the query."""
    value = money(json_text)
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit("Cannot convert to money: "), json_text)))


def money_text(value: Column) -> Column:
    """``$99.99 USD``."""
    return F.format_string("$%.2f %s", value["amount"] / 100, value["currency"])
