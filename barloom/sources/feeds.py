"""Vendor extracts that an earlier step has landed as JSON, CSV or Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barloom.schemas import REFERENCE_PRICES, SPLITS_FEED, TICKERS_FEED


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.load(path)


def read_splits(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Splits as (id, ticker, execution_date, split_from, split_to)."""
    return _read(spark, path, SPLITS_FEED, fmt)


def read_tickers(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Ticker metadata; times are ISO-8601 text."""
    return _read(spark, path, TICKERS_FEED, fmt)


def read_reference_prices(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The vendor's own adjusted daily bars."""
    return _read(spark, path, REFERENCE_PRICES, fmt)
