"""Column expressions for numbers that arrive as text, rates and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain cast would read '1d' or '1f' as a number.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Suppression codes -666666666, -888888888, -999999999, -222222222,
# -333333333 and -555555555 all lie below this bound, which alone marks a missing value.
MISSING_BELOW = -100_000_000

# Fixed value: above this maximum a column holds counts, not percentages.
PERCENT_LIMIT = 100.5


def to_number(text: Column) -> Column:
    """Text as double; NULL where it is not a number."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_year(text: Column) -> Column:
    """Text as int; NULL where it is not a whole number."""
    number = to_number(text)
    return F.when(number == F.floor(number), number.try_cast("int"))


def census_number(text: Column) -> Column:
    """Text as double; NULL for suppression codes and for text that is no number."""
    number = to_number(text)
    return F.when(number >= MISSING_BELOW, number)


def round_even(number: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even."""
    return F.replace(F.format_number(number, digits), F.lit(","), F.lit("")).cast("double")


def rate(numerator: Column, denominator: Column) -> Column:
    """Ratio; NULL for a zero denominator."""
    return F.try_divide(numerator, denominator)


def percent_of(percent: Column, parent: Column) -> Column:
    """Count behind a percentage; NULL if either side is missing or the parent is 0."""
    return F.when(parent != 0, percent / F.lit(100.0) * parent)


def log_column(col: Column) -> Column:
    """Natural logarithm; NULL for zero and below."""
    return F.when(col > 0, F.ln(col))
