"""Filtering on costly computed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """``df.filter(condition)``, evaluated where it stands.

    A filter on computed columns is pushed below them, with their expressions put into the
    condition once per mention and then computed again above it. A generator of one or no
    row stays where it is. Use it for conditions on parsed text, not for plain columns.
    """
    return df.select("*", F.explode(F.when(condition, F.array(F.lit(1)))).alias("_kept")).drop(
        "_kept"
    )
