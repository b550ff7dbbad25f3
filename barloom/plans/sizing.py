"""Broadcasting behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows here are a symbol and a few numbers, about 100 bytes, so this is some 20 MB.
BROADCAST_ROWS = 200_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reading stops beyond that."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it is small; otherwise leave the join to shuffle.

    The count is needed because the adaptive planner learns the size of a computed side
    only after it has already started to shuffle the other, large side.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df
