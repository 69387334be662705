"""Calendar functions (F-6)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def age(later: Column, earlier: Column) -> Column:
    """Years, months and days between two dates, counted field by field.

    A missing day is borrowed from the length of the earlier date's month, as
    SQL ``age`` does.
    """
    a, b = later.cast("date"), earlier.cast("date")
    swap = a < b
    hi, lo = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)
    days = F.day(hi) - F.day(lo)
    months = (F.year(hi) - F.year(lo)) * 12 + F.month(hi) - F.month(lo)
    borrow = days < 0
    days = F.when(borrow, days + F.day(F.last_day(lo))).otherwise(days)
    months = F.when(borrow, months - 1).otherwise(months)
    sign = F.when(swap, -1).otherwise(1)
    return F.struct((sign * F.floor(months / 12)).cast("int").alias("years"),
                    (sign * F.pmod(months, F.lit(12))).cast("int").alias("months"),
                    (sign * days).cast("int").alias("days"))
