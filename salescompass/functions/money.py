"""Money rescaling, ratios and display text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(amount: Column, unit: int, digits: int) -> Column:
    """Exact amount / unit, rounded half up."""
    return F.round(amount.cast("decimal(28,4)") / F.lit(unit), digits)


def millions(amount: Column, digits: int) -> Column:
    return scaled(amount, 1_000_000, digits)


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    """part / whole * 100 in decimals, null for a zero whole.

    The operand types leave ten decimals in the quotient, so only the last step rounds.
    """
    ratio = part.cast("decimal(22,2)") / F.nullif(whole.cast("decimal(24,4)"), F.lit(0))
    return F.round(ratio * 100, digits)


def money_text(amount: Column) -> Column:
    """``$1.2B`` from a billion up, ``$3.4M`` below."""

    def text(unit: int, suffix: str) -> Column:
        return F.concat(F.lit("$"), scaled(amount, unit, 1).cast("decimal(20,1)").cast("string"), F.lit(suffix))

    return F.when(F.abs(amount) >= 1_000_000_000, text(1_000_000_000, "B")).otherwise(text(1_000_000, "M"))
