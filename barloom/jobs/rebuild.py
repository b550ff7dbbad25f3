"""Rebuilding the derived tables and syncing the vendor tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.bars import dedupe_bars
from barloom.operators.splits import adjust_prices, prepare_splits
from barloom.operators.technical import technical_indicators
from barloom.operators.tickers import prepare_tickers
from barloom.sources.warehouse import Warehouse


def _rows(wh: Warehouse, table: str) -> int:
    return wh.scan(table).count()


def recalculate_adjusted(wh: Warehouse, tickers: list[str] | None = None) -> int:
    """Rebuild adjusted prices from raw bars, of some tickers or of all; rows of the table."""
    raw = wh.scan("stocks_raw")
    if tickers is not None:
        raw = raw.filter(F.col("ticker").isin(tickers))
    if raw.isEmpty():
        return 0
    adjusted = adjust_prices(dedupe_bars(raw), wh.scan("splits"))
    if tickers is None:
        wh.write(adjusted, "stocks_adjusted", "overwrite")
    else:
        wh.replace_tickers(adjusted, "stocks_adjusted", tickers)
    return _rows(wh, "stocks_adjusted")


def recalculate_technical(wh: Warehouse) -> int:
    """Rebuild the indicators from adjusted prices; rows of the table."""
    adjusted = wh.scan("stocks_adjusted")
    if adjusted.isEmpty():
        return 0
    wh.write(technical_indicators(adjusted), "stocks_technical", "overwrite")
    return _rows(wh, "stocks_technical")


def first_raw_date(wh: Warehouse) -> dt.date | None:
    return wh.scan("stocks_raw").agg(F.to_date(F.min("window_start")).alias("d")).first().d


def sync_splits(wh: Warehouse, feed: DataFrame, ticker: str | None = None) -> int:
    """Replace the splits by the feed's since the first raw bar, of one ticker or of all.

    Without raw bars or without splits in the feed the table stays as it is.
    """
    since = first_raw_date(wh)
    if since is None:
        return 0
    if ticker is not None:
        feed = feed.filter(F.col("ticker") == ticker)
    splits, _ = prepare_splits(feed, since)
    count = splits.count()
    if count == 0:
        return 0
    if ticker is not None:
        wh.replace_tickers(splits, "splits", [ticker])
    else:
        wh.write(splits, "splits", "overwrite")
    return count


def sync_tickers(
    wh: Warehouse, feed: DataFrame, market: str | None = None, active: bool | None = None
) -> int:
    """Replace the ticker metadata; an empty feed leaves the table as it is."""
    if market is not None:
        feed = feed.filter(F.col("market") == market)
    if active is not None:
        feed = feed.filter(F.col("active") == active)
    if feed.isEmpty():
        return 0
    tickers, _ = prepare_tickers(feed)
    wh.write(tickers, "tickers", "overwrite")
    return _rows(wh, "tickers")
