"""Ticker metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.symbols import is_stock_symbol
from barloom.functions.times import iso_to_ts
from barloom.schemas import TICKERS, conform


def prepare_tickers(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed ticker records as (rows for the tickers table, records with a bad symbol)."""
    good = feed.filter(is_stock_symbol(F.col("ticker"))).withColumns(
        {name: iso_to_ts(F.col(name)) for name in ("last_updated_utc", "delisted_utc")}
    )
    return conform(good, TICKERS), feed.filter(~is_stock_symbol(F.col("ticker")))


def active_tickers(tickers: DataFrame, exchange: str | None = None) -> DataFrame:
    """Active tickers, of one exchange if given; unknown activity does not count as active."""
    rows = tickers.filter("active")
    return rows if exchange is None else rows.filter(F.col("primary_exchange") == exchange)
