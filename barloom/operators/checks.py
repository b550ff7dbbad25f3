"""Comparison of adjusted closes with a vendor series around splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.prices import pct_diff
from barloom.operators.bars import sample_keys
from barloom.operators.calendar import split_check_dates
from barloom.operators.splits import splits_per_ticker
from barloom.plans.sizing import broadcast_if_small
from barloom.session import materialize

# Fixed value: largest difference of a close that still passes, in percent.
TOLERANCE_PERCENT = 0.1


class CheckFailure(Exception):
    """Adjusted prices differ from the vendor's by more than the tolerance."""


def _first_close(prices: DataFrame, checks: DataFrame, name: str) -> DataFrame:
    """Close of the first bar per checked ticker and date.

    The checks are the small side: joining them in first leaves of the price table only
    the rows that are asked for, without a shuffle of the table.
    """
    hits = prices.join(checks, ["ticker", "date"], "left_semi")
    return hits.groupBy("ticker", "date").agg(
        F.min_by(F.col("close").cast("double"), F.struct("_order", "close")).alias(name)
    )


def price_checks(
    adjusted: DataFrame,
    splits: DataFrame,
    reference: DataFrame,
    n: int | None = None,
    seed: int = 0,
    start: dt.date | None = None,
    end: dt.date | None = None,
    tolerance: float = TOLERANCE_PERCENT,
) -> DataFrame:
    """One row per ticker and date to check, with ``status`` pass, fail or error.

    ``n`` limits the check to a sample of the tickers that have splits between ``start``
    and ``end``; ``reference`` has (ticker, date, close).
    """
    if start is not None:
        splits = splits.filter(F.col("execution_date") >= F.lit(start))
    if end is not None:
        splits = splits.filter(F.col("execution_date") <= F.lit(end))
    if n is not None:
        chosen = sample_keys(splits_per_ticker(splits), n, seed)
        splits = splits.join(broadcast_if_small(chosen), "ticker", "left_semi")
    checks = materialize(split_check_dates(splits), "check-dates")  # read four times below
    wanted = broadcast_if_small(checks)
    ours = _first_close(
        adjusted.select(
            "ticker", F.to_date("window_start").alias("date"), "close",
            F.col("window_start").alias("_order"),
        ),
        wanted,
        "our_price",
    )
    theirs = _first_close(
        reference.select("ticker", "date", "close", F.lit(0).alias("_order")),
        wanted,
        "reference_price",
    )
    diff = F.abs(pct_diff(F.col("our_price"), F.col("reference_price")))
    return (
        checks.join(ours, ["ticker", "date"], "left")
        .join(theirs, ["ticker", "date"], "left")
        .withColumn("diff_percent", diff)
        .withColumn(
            "status",
            F.when(F.col("our_price").isNull() | F.col("reference_price").isNull(), "error")
            .when(F.col("diff_percent") <= tolerance, "pass")
            .otherwise("fail"),
        )
        .withColumn(
            "message",
            F.when(F.col("our_price").isNull(), "No data in our tables").when(
                F.col("reference_price").isNull(), "No data from the reference series"
            ),
        )
    )


def summarize_checks(checks: DataFrame) -> DataFrame:
    """Counts per ticker and, in the row whose ticker is null, in total."""
    return checks.rollup("ticker").agg(
        F.countDistinct("ticker").alias("tickers_checked"),
        F.count_if(F.col("status") != "error").alias("dates_checked"),
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "fail").alias("failed"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )


def failed_checks(checks: DataFrame) -> DataFrame:
    return checks.filter(F.col("status") == "fail").orderBy("ticker", "date")
