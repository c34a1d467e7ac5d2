"""Reading numbers out of messy text, and averaging them exactly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wareline.functions.text import strip

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITE = r"^[+-]?(?i:inf|infinity)$"


def parse_number(col: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL.

    ``try_cast`` alone would also take Java literals such as ``1.0d``.
    """
    text = strip(col.cast("string"))
    signed_inf = F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(
        F.lit(float("inf"))
    )
    return F.when(text.rlike(NUMBER), text.try_cast("double")).when(
        text.rlike(INFINITE), signed_inf
    )


def clean_currency(col: Column) -> Column:
    """``₹1,099`` to 1099.0."""
    return parse_number(F.translate(col, "₹,", ""))


def clean_percentage(col: Column) -> Column:
    """``64%`` to 64.0."""
    return parse_number(F.translate(col, "%", ""))


def clean_count(col: Column) -> Column:
    """``24,269`` to 24269; fractional and infinite counts become NULL."""
    value = parse_number(F.translate(col, ",", ""))
    return F.when(value % 1 == 0, value.try_cast("bigint"))


def nan_to_null(col: Column) -> Column:
    """One kind of missing: NaN becomes NULL."""
    return F.when(~F.isnan(col), col)


def is_finite(col: Column) -> Column:
    """Present, not NaN, not infinite."""
    value = col.cast("double")
    return F.coalesce(
        ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False)
    )


def public_value(col: Column) -> Column:
    """Double for output; non-finite values are not published."""
    return F.when(is_finite(col), col.cast("double"))


def exact_mean(col: Column, places: int = 2) -> Column:
    """Mean rounded half-up, summed as decimals.

    A double sum depends on the order of the partial sums, which flips
    results lying on a rounding tie; a decimal sum does not. Where a value fits
    no decimal (infinite, or 1e18 and more) the mean is that of doubles.
    """
    fitting = col.try_cast("decimal(28,10)")
    exact = F.round(F.sum(fitting) / F.count(col), places).cast("double")
    return F.when(F.count(fitting) == F.count(col), exact).otherwise(
        F.round(F.avg(col.cast("double")), places)
    )
