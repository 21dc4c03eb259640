"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of the whole text."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def short_label(text: Column, length: int = 6) -> Column:
    """Trimmed, upper-cased first characters of a classifier's answer."""
    return F.substring(F.upper(F.trim(text)), 1, length)


# fixed value: the wording of a fund's search document
def fund_text(name: Column, category: Column, benchmark: Column, asset_class: Column) -> Column:
    """Search document of a fund."""
    return F.concat(
        name, F.lit(" is a "), category, F.lit(" fund benchmarked against "), F.coalesce(benchmark, F.lit("N/A")),
        F.lit(". Asset class: "), F.coalesce(asset_class, F.lit("Unknown")), F.lit("."),
    )
