"""Fixed-point prices: whole numbers of 1e-9 units in a bigint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null price and the price scale.
UNDEF_PRICE = 9223372036854775807
PRICE_SCALE = 1_000_000_000


def known(px: Column) -> Column:
    """The price, or NULL for the null marker."""
    return F.nullif(px, F.lit(UNDEF_PRICE))


def to_float(px: Column) -> Column:
    return known(px) / F.lit(float(PRICE_SCALE))


def to_decimal(px: Column) -> Column:
    """Exact decimal(28,9)."""
    unit = F.lit("0.000000001").cast("decimal(9,9)")
    return (known(px).cast("decimal(19,0)") * unit).cast("decimal(28,9)")


def to_text(px: Column) -> Column:
    """Nine decimals, NULL for the null marker, never in exponent form."""
    p = known(px)
    size = F.abs(p)
    scale = F.lit(PRICE_SCALE)
    frac = F.pmod(size, scale)
    whole = F.call_function("div", size, scale)
    return F.concat(
        F.when(p < 0, F.lit("-")).otherwise(F.lit("")),
        whole.cast("string"),
        F.lit("."),
        F.lpad(frac.cast("string"), 9, "0"),
    )


CONVERSIONS = {"fixed": lambda px: px, "float": to_float, "decimal": to_decimal}


def convert(px: Column, price_type: str) -> Column:
    if price_type not in CONVERSIONS:
        raise ValueError(f"price_type must be one of {sorted(CONVERSIONS)}, not {price_type!r}")
    return CONVERSIONS[price_type](px)
