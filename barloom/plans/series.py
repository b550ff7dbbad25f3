"""Cutting long series into bounded pieces, so that a window never holds a whole hot key.

A window over ``partitionBy(key)`` puts all rows of a key into one task. That is fine for
daily bars of thousands of tickers and fatal for one ticker with a third of all rows.
Series longer than ``max_rows`` are therefore cut by time into chunks, each of which also
gets the ``halo`` rows before it; the caller computes its windows per chunk and keeps the
rows that are the chunk's own. Values that depend on at most ``halo`` rows are the same by
either way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.plans.sizing import broadcast_if_small
from barloom.session import materialize

MAX_ROWS = 1 << 20
# Bars of one ticker differ in their millisecond, so a slice holds at most this many rows
# and 33 years of a ticker make at most a million slices.
SLICE_MS = 1 << 20


@dataclass(frozen=True)
class Pieces:
    """Rows of a series together with what the windows need.

    ``by`` are the window's partition columns. ``base`` is how many rows of the series lie
    before the piece's first row, ``flagged_before`` whether one of them was flagged and
    ``own`` whether the row belongs to the piece (and not to its halo).
    """

    df: DataFrame
    by: tuple[str, ...]


def series_pieces(
    df: DataFrame,
    key: str,
    ts: str,
    flag: Column,
    halo: int,
    max_rows: int = MAX_ROWS,
    slice_ms: int = SLICE_MS,
) -> list[Pieces]:
    """``df`` as whole series for ordinary keys and as chunks for hot ones."""

    def whole(rows: DataFrame) -> Pieces:
        return Pieces(
            rows.withColumns(
                {
                    "base": F.lit(0).cast("long"),
                    "flagged_before": F.lit(False),
                    "own": F.lit(True),
                }
            ),
            (key,),
        )

    hot = df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > max_rows).select(key)
    if hot.isEmpty():
        return [whole(df)]

    # Null is a key like any other here.
    hot = broadcast_if_small(materialize(hot.select(F.col(key).alias("_hot")), "hot-keys"))
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    cold_rows = df.join(hot, is_hot, "left_anti")
    hot_rows = df.join(hot, is_hot, "left_semi").withColumn(
        "slice", F.floor(F.unix_millis(F.col(ts)) / F.lit(slice_ms))
    )
    before = W.partitionBy(key).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = (
        hot_rows.groupBy(key, "slice")
        .agg(F.count("*").alias("n"), F.max(flag).alias("flagged"))
        .select(
            key,
            "slice",
            "n",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
            F.coalesce(F.max("flagged").over(before), F.lit(False)).alias("flagged_before"),
        )
        # The slice belongs to chunk base/max_rows and is halo of every later chunk k that
        # starts (at k*max_rows or after) less than `halo` rows behind the slice's end.
        .withColumn("own_chunk", F.floor(F.col("base") / max_rows))
        .withColumn("last_chunk", F.floor((F.col("base") + F.col("n") + (halo - 1)) / max_rows))
        .drop("n")
        .withColumnsRenamed({key: "_key", "slice": "_slice"})
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("slice").eqNullSafe(F.col("_slice"))
    chunks = (
        hot_rows.join(broadcast_if_small(slices), same)
        .withColumn("chunk", F.explode(F.sequence("own_chunk", "last_chunk")))
        .withColumn("own", F.col("chunk") == F.col("own_chunk"))
        .drop("slice", "own_chunk", "last_chunk", "_key", "_slice")
    )
    return [whole(cold_rows), Pieces(chunks, (key, "chunk"))]
