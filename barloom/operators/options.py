"""Option bars: symbol parsing, rejects and the reports on the options table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.symbols import (
    option_root,
    option_tail,
    strip_prefix,
    tail_expiry,
    tail_strike,
    tail_type,
)
from barloom.plans.filters import keep_where

def parse_option_tickers(df: DataFrame, column: str = "ticker") -> DataFrame:
    """Add the contract fields and ``parse_ok``; the symbol itself stays as it is.

    In steps, so that each regular expression runs once per row however many of the new
    columns depend on it.
    """
    symbol = F.col(column)
    cut = df.withColumns({"_tail": option_tail(symbol), "_root": option_root(symbol)})
    dated = cut.withColumn("_expiry", tail_expiry(F.col("_tail")))
    ok = F.col("_expiry").isNotNull() & F.col("_root").isNotNull()
    return dated.select(
        *df.columns,
        F.when(ok, F.col("_root")).alias("underlying_symbol"),
        F.when(ok, F.col("_expiry")).alias("expiration_date"),
        F.when(ok, tail_type(F.col("_tail"))).alias("option_type"),
        F.when(ok, tail_strike(F.col("_tail"))).alias("strike_price"),
        ok.alias("parse_ok"),
    )


def parsed_options(df: DataFrame, column: str = "ticker") -> DataFrame:
    """Option bars with contract fields and without the symbol prefix; bad symbols left out."""
    parsed = keep_where(parse_option_tickers(df, column), F.col("parse_ok"))
    return parsed.drop("parse_ok").withColumn(column, strip_prefix(F.col(column)))


def option_rejects(df: DataFrame, column: str = "ticker") -> DataFrame:
    """The rows that :func:`parsed_options` leaves out."""
    return keep_where(parse_option_tickers(df, column), ~F.col("parse_ok")).select(*df.columns)


def option_volume_top(
    options: DataFrame, underlying_symbol: str | None = None, k: int = 10
) -> DataFrame:
    """The ``k`` expirations with the largest volume."""
    if underlying_symbol is not None:
        options = options.filter(F.col("underlying_symbol") == underlying_symbol)
    return (
        options.groupBy("expiration_date")
        .agg(F.sum("volume").alias("total_volume"))
        .orderBy(F.desc("total_volume"), "expiration_date")
        .limit(k)
    )


def contracts_by_underlying(options: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` underlyings with the most option rows."""
    return (
        options.groupBy("underlying_symbol")
        .agg(F.count("*").alias("contract_count"))
        .orderBy(F.desc("contract_count"), "underlying_symbol")
        .limit(k)
    )
