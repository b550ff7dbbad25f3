"""Stock splits: preparation, factor intervals and split-adjusted prices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.prices import split_factor
from barloom.plans.sizing import fits_broadcast
from barloom.schemas import PRICES, SPLITS, conform
from barloom.session import materialize


def _valid_ratio() -> Column:
    return (F.col("split_from") > 0) & (F.col("split_to") > 0)


def dedupe_splits(df: DataFrame, order: str | None = None) -> DataFrame:
    """One row per split id: the last one by ``order``, or the largest in column order."""
    rest = [c for c in df.columns if c not in ("id", order)]
    rank = ([F.col(order)] if order else []) + [F.col(c) for c in rest]
    picked = df.groupBy("id").agg(F.max(F.struct(*rank)).alias("split"))
    return picked.select(
        *[F.col("id") if c == "id" else F.col(f"split.{c}").alias(c) for c in df.columns]
    )


def prepare_splits(
    feed: DataFrame, since: dt.date | None = None, order: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Landed splits as (rows for the splits table, rejected rows).

    Rows without id or ticker are dropped; of rows with the same id the last counts; rows
    whose ratio is not positive on both sides are rejected, since their factor would make
    prices infinite or zero.
    """
    rows = feed.dropna(subset=["id", "ticker"])
    if since is not None:
        rows = rows.filter(F.col("execution_date") >= F.lit(since))
    rows = dedupe_splits(rows, order)
    good = rows.filter(_valid_ratio()).withColumn(
        "split_factor", split_factor(F.col("split_from"), F.col("split_to"))
    )
    return conform(good, SPLITS), rows.filter(~F.coalesce(_valid_ratio(), F.lit(False)))


def splits_per_ticker(
    splits: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Number of splits and first and last date per ticker, most splits first."""
    return (
        _between(splits, start, end)
        .groupBy("ticker")
        .agg(
            F.count("*").alias("split_count"),
            F.min("execution_date").alias("first_split_date"),
            F.max("execution_date").alias("last_split_date"),
        )
        .orderBy(F.desc("split_count"), "ticker")
    )


def splits_for(
    splits: DataFrame, ticker: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """One ticker's splits by date."""
    return _between(splits, start, end).filter(F.col("ticker") == ticker).orderBy("execution_date")


def _between(splits: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    if start is not None:
        splits = splits.filter(F.col("execution_date") >= F.lit(start))
    if end is not None:
        splits = splits.filter(F.col("execution_date") <= F.lit(end))
    return splits


def split_intervals(splits: DataFrame, on_execution_day: bool = True) -> DataFrame:
    """Disjoint date intervals ``(after, upto]`` per ticker with their cumulative factor.

    The factor of a bar is the product of all splits executed on or after its date, so it
    is constant between two split dates. ``after`` is null for the first interval; dates
    after the last split have no interval (factor 1). Splits are first multiplied up per
    date: the windows see at most one row per ticker and calendar day. The product runs
    from the last date backwards, so that each row adds one factor.
    """
    last_day = F.col("execution_date") if on_execution_day else F.date_sub("execution_date", 1)
    steps = (
        splits.filter(F.col("execution_date").isNotNull() & (F.col("split_factor") > 0))
        .groupBy("ticker", last_day.alias("upto"))
        .agg(F.product("split_factor").alias("step"))
    )
    backwards = W.partitionBy("ticker").orderBy(F.desc("upto"))
    return steps.select(
        "ticker",
        F.lead("upto").over(backwards).alias("after"),
        "upto",
        F.product("step").over(backwards.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("cumulative_factor"),
    )


def with_split_factor(
    bars: DataFrame, splits: DataFrame, on_execution_day: bool = True
) -> DataFrame:
    """Add ``cumulative_factor`` to every bar; bars are neither dropped nor multiplied.

    Bars up to a ticker's first split date take the whole product by an equi join on the
    ticker. Bars between split dates find their interval by ticker and year, so that a bar
    is compared with at most a year's intervals however many splits a ticker has. Both
    sides are broadcast if they are small, and the bars are then not shuffled at all.
    """
    begin = F.coalesce(F.date_add("after", 1), F.col("upto"))
    by_year = split_intervals(splits, on_execution_day).withColumn(
        "_year", F.explode(F.sequence(F.year(begin), F.year("upto")))
    )
    by_year = materialize(by_year, "intervals")  # counted here and joined twice below
    place = F.broadcast if fits_broadcast(by_year) else (lambda side: side)
    first = by_year.filter(F.col("after").isNull()).select(
        "ticker", F.col("upto").alias("_first"), F.col("cumulative_factor").alias("_whole")
    )
    later = by_year.filter(F.col("after").isNotNull()).select(
        "ticker",
        "_year",
        F.col("after").alias("_after"),
        F.col("upto").alias("_upto"),
        F.col("cumulative_factor").alias("_part"),
    )
    dated = bars.withColumn("_date", F.to_date("window_start")).withColumn(
        "_year", F.year("_date")
    )
    joined = dated.join(place(first), "ticker", "left").alias("b")
    matched = joined.join(
        place(later).alias("s"),
        (F.col("b.ticker") == F.col("s.ticker"))
        & (F.col("b._year") == F.col("s._year"))
        & (F.col("b._date") > F.col("s._after"))
        & (F.col("b._date") <= F.col("s._upto")),
        "left",
    )
    factor = F.when(F.col("_date") <= F.col("_first"), F.col("_whole")).otherwise(
        F.coalesce(F.col("_part"), F.lit(1.0))
    )
    return matched.select(
        *[F.col(f"b.{c}") for c in bars.columns], factor.alias("cumulative_factor")
    )


def adjust_prices(bars: DataFrame, splits: DataFrame, on_execution_day: bool = True) -> DataFrame:
    """Open, close, high and low divided by the cumulative split factor; volume as it is."""
    factored = with_split_factor(bars, splits, on_execution_day)
    return factored.select(
        *[
            (F.col(c).cast("double") / F.col("cumulative_factor")).alias(c)
            if c in PRICES
            else F.col(c)
            for c in bars.columns
        ]
    )
