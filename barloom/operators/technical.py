"""Lagged moving averages and Wilder's average true range per ticker.

Sliding frames cost as many updates per row as the frame is long (Spark evaluates each frame
anew), and differences of running sums lose the small prices that follow large ones. So sums
over 1, 2, 4, ... rows are built by doubling: the sum over ``2k`` rows is the sum over ``k``
rows plus the one ``k`` rows before. A window of any length is the sum of the powers of two
in it. That adds only, takes a few steps per row, and every step reads the same order, so
the rows are sorted once. The recurrence ``atr = (13*atr' + tr)/14`` doubles likewise, with
the earlier half weighted by ``(13/14)^k``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.plans.series import MAX_ROWS, SLICE_MS, Pieces, series_pieces

INDICATORS = ("sma_20", "sma_50", "sma_200", "volume_sma_20", "atr")
# What the doubled recurrence leaves out weighs less than this.
NEGLIGIBLE = 1e-60


def _memory(atr_length: int) -> int:
    """Rows that the doubled recurrence reaches back: a power of two."""
    rows = math.log(NEGLIGIBLE) / math.log((atr_length - 1) / atr_length)
    return 1 << math.ceil(math.log2(rows))


def technical_indicators(
    bars: DataFrame,
    close_lengths: tuple[int, ...] = (20, 50, 200),
    volume_lengths: tuple[int, ...] = (20,),
    atr_length: int = 14,
    max_rows: int = MAX_ROWS,
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Indicators of the bars *before* each bar, as of its open.

    A moving average is null until its window is full and wherever the window holds a
    missing value; the average true range is null for the first ``atr_length + 1`` bars
    and from a bar on that lacks high, low or close. A number that is not finite is
    missing. Each value depends on the rows of its window alone, so it is the same
    however a series is cut into pieces.
    """
    rows = bars.select(
        "ticker", "window_start", *[F.col(c).cast("double").alias(c) for c in ("high", "low")],
        F.col("close").cast("double").alias("close"), "volume",
    )
    halo = max(*close_lengths, *volume_lengths, _memory(atr_length) + atr_length) + 3
    pieces = series_pieces(
        rows, "ticker", "window_start", _incomplete(), halo, max_rows, slice_ms
    )
    frames = [_indicators(p, close_lengths, volume_lengths, atr_length) for p in pieces]
    return reduce(DataFrame.unionByName, frames)


def continued_indicators(rows: DataFrame) -> DataFrame:
    """The usual indicators of rows that go on from earlier results.

    A series comes with its last rows before the ``own`` ones, ``base`` (how many rows lie before these),
    ``flagged_before`` and ``given``: null in own rows, before them the range of the last row and 0 in others
    (null in all if the whole series is there). No series may have more than ``MAX_ROWS`` rows.
    """
    return _indicators(Pieces(rows, ("ticker",)), (20, 50, 200), (20,), 14)


def _missing(column: str) -> Column:
    return F.col(column).isNull() | F.isnan(column) | (F.abs(F.col(column)) == float("inf"))


def _incomplete() -> Column:
    return _missing("high") | _missing("low") | _missing("close")


def _doubled(rows: DataFrame, over, starts: dict[str, tuple[str, float, int]]) -> DataFrame:
    """Adds ``<name>_<k>``, the weighted sum of ``column`` over the last ``k`` rows, for every power
    of two up to ``most``. ``starts``: name -> (column, decay per row, most). Rows before the first
    count as zero."""
    rows = rows.withColumns({f"{name}_1": F.col(column) for name, (column, _, _) in starts.items()})
    k = 1
    while any(2 * k <= most for _, _, most in starts.values()):
        rows = rows.withColumns(
            {
                f"{name}_{2 * k}": F.col(f"{name}_{k}")
                + F.lag(f"{name}_{k}", k, 0).over(over) * F.lit(decay**k if decay != 1 else 1)
                for name, (_, decay, most) in starts.items()
                if 2 * k <= most
            }
        )
        k *= 2
    return rows


def _sum(name: str, n: int, over) -> Column:
    """The sum over the last ``n`` rows from those over powers of two."""
    total, behind = None, 0
    for bit in reversed(range(n.bit_length())):
        if n >> bit & 1:
            part = F.lag(f"{name}_{1 << bit}", behind, 0).over(over) if behind else F.col(f"{name}_{1 << bit}")
            total, behind = (part if total is None else total + part), behind + (1 << bit)
    return total


def _indicators(
    pieces: Pieces,
    close_lengths: tuple[int, ...],
    volume_lengths: tuple[int, ...],
    atr_length: int,
) -> DataFrame:
    by = pieces.by
    series = W.partitionBy(*by).orderBy("window_start", "close", "high", "low", "volume")
    so_far = series.rowsBetween(W.unboundedPreceding, 0)
    close = F.when(~_missing("close"), F.col("close"))

    # Everything is shifted by one bar here, so no later step has to.
    place = F.row_number().over(series)
    lagged = pieces.df.select(
        *by,
        "window_start", "close", "high", "low", "volume", "own", "flagged_before",
        (place - 1).cast("long").alias("pos"),
        (F.first("base").over(series) + place - 1).alias("age"),
        F.lag(close).over(series).alias("c"),
        F.lag("volume").over(series).alias("v"),
        F.lag("high").over(series).alias("h"),
        F.lag("low").over(series).alias("l"),
        F.lag(close, 2).over(series).alias("c_prev"),
        F.lag(_incomplete(), 1, False).over(series).alias("flag"),
        (F.col("given") if "given" in pieces.df.columns else F.lit(None).cast("double")).alias("given"),
    )
    true_range = F.greatest(
        F.col("h") - F.col("l"), F.abs(F.col("h") - F.col("c_prev")), F.abs(F.col("l") - F.col("c_prev"))
    )
    usable = (F.col("age") >= 2) & F.col("c_prev").isNotNull() & ~F.col("flag")
    filled = lagged.withColumns(
        {
            "c0": F.coalesce("c", F.lit(0.0)),
            "v0": F.coalesce(F.col("v").cast("double"), F.lit(0.0)),
            "tr": F.when(usable, true_range).otherwise(0.0),
            "gap_c": F.max(F.when((F.col("pos") > 0) & F.col("c").isNull(), F.col("pos"))).over(so_far),
            "gap_v": F.max(F.when((F.col("pos") > 0) & F.col("v").isNull(), F.col("pos"))).over(so_far),
            "broken": F.max("flag").over(so_far),
        }
    )
    sums = _doubled(
        filled,
        series,
        {"cs": ("c0", 1, max(close_lengths)), "vs": ("v0", 1, max(volume_lengths)), "rs": ("tr", 1, atr_length)},
    )

    def average(n: int, name: str, gap: str) -> Column:
        full = (F.col("pos") >= n) & (F.coalesce(gap, F.lit(0)) <= F.col("pos") - n)
        return F.when(full, _sum(name, n, series) / F.lit(float(n)))

    # The recurrence begins with a plain mean and goes on with each range's share.
    seed = atr_length + 1
    share = F.when(F.col("age") > seed, F.col("tr") / atr_length)
    share = share.when(F.col("age") == seed, _sum("rs", atr_length, series) / atr_length).otherwise(0.0)
    share = F.coalesce("given", share)
    kept = ("window_start", "close", "high", "low", "volume", "own", "flagged_before", "age", "broken")
    averaged = sums.select(
        *by,
        *kept,
        *[average(n, "cs", "gap_c").alias(f"sma_{n}") for n in close_lengths],
        *[average(n, "vs", "gap_v").alias(f"volume_sma_{n}") for n in volume_lengths],
        share.alias("share"),
    )
    most = _memory(atr_length)
    decayed = _doubled(averaged, series, {"ws": ("share", (atr_length - 1) / atr_length, most)})
    known = (F.col("age") >= seed) & ~F.col("flagged_before") & ~F.col("broken")
    result = decayed.select(
        *by,
        "window_start",
        "own",
        *[f"sma_{n}" for n in close_lengths],
        *[f"volume_sma_{n}" for n in volume_lengths],
        F.when(known, F.col(f"ws_{most}")).alias("atr"),
    )
    return result.filter("own").drop("own", *by[1:])
