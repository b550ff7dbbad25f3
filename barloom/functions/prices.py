"""Ratios, differences and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_factor(split_from: Column, split_to: Column) -> Column:
    """Shares after the split per share before it; null for a zero ``split_from``."""
    return F.try_divide(split_to.cast("double"), split_from.cast("double"))


def pct_diff(price: Column, reference: Column) -> Column:
    """Difference from ``reference`` in percent; infinite against a zero reference."""
    return (
        F.when((reference == 0) & (price != 0), F.lit(float("inf")))
        .when(reference == 0, F.lit(0.0))
        .otherwise(F.try_divide(price - reference, reference) * 100)
    )


def strike_label(strike: Column) -> Column:
    """``145.0`` -> ``$145.00``; halves are rounded as the binary value says."""
    return F.concat(F.lit("$"), F.call_function("format_number", strike, F.lit("0.00")))


def split_label(split_from: Column, split_to: Column) -> Column:
    """``1, 4`` -> ``1:4 (forward split)``; equal sides count as reverse."""
    kind = F.when(split_to > split_from, "forward").otherwise("reverse")
    return F.concat(
        split_from.cast("long").cast("string"),
        F.lit(":"),
        split_to.cast("long").cast("string"),
        F.lit(" ("),
        kind,
        F.lit(" split)"),
    )
