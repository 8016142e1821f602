"""Yen prices and consumption tax: whole yen, always rounded down, rates as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rates that an inferred one may be, in the order in which they are tried.
TAX_RATES = (0.08, 0.10)


def to_number(value: Column, number: bool = False) -> Column:
    """A double, or null where the text is not a plain number. Java's type letters ('1d') are no numbers here.

    number: the column is one of numbers, not of text, and is only cast.
    """
    if number:
        return value.cast("double")
    text = F.trim(value.cast("string"))
    return F.when(text.rlike("[dDfF]$") & ~text.rlike("(?i)^[+-]?(inf|infinity|nan)$"), F.lit(None)).otherwise(text.try_cast("double"))


def floor_yen(value: Column, number: bool = False) -> Column:
    """Whole yen; null for no number and for NaN. An infinite price is an error in the data: null too."""
    d = to_number(value, number)
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None)).otherwise(F.floor(d)).cast("long")


def tax_included(price_ex_tax: Column, tax_rate: Column, number: bool = False) -> Column:
    """floor(floor(price) * (1 + rate)) in binary doubles."""
    return F.floor(floor_yen(price_ex_tax, number) * (F.lit(1.0) + tax_rate.cast("double"))).cast("long")


def price_pair(price_ex_tax: Column, price_in_tax: Column) -> Column:
    return F.struct(floor_yen(price_ex_tax).alias("ex"), floor_yen(price_in_tax).alias("inc"))


def infer_tax_rate(price_ex_tax: Column, price_in_tax: Column, rates: tuple[float, ...] = TAX_RATES, number: bool = False) -> Column:
    """The first rate that turns the one price into the other, else null."""
    inc = floor_yen(price_in_tax, number)
    return F.coalesce(*[F.when(tax_included(price_ex_tax, F.lit(r), number) == inc, F.lit(r)) for r in rates])


def derived_in_tax(price_ex_tax: Column, price_in_tax: Column, tax_rate: Column, number: bool = False) -> Column:
    """The price with tax: as given, else computed where a rate is given (0 is a rate)."""
    return F.coalesce(floor_yen(price_in_tax, number), tax_included(price_ex_tax, to_number(tax_rate, number), number))
