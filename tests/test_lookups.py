"""Lookups by name skip row groups by their Bloom filters."""

import pytest
from pyspark.sql import functions as F

from barloom.schemas import OPTIONS
from barloom.sources.warehouse import Warehouse

CONTRACTS = 120_000  # more than a dictionary of the writer holds


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    """One day of option bars, even contract numbers only, in an order that has nothing to do with their names."""
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("lookups") / "wh"))
    made = {
        "ticker": F.concat(F.lit("O:AAA240119C"), F.lpad((F.col("id") * 2).cast("string"), 8, "0")),
        "underlying_symbol": F.lit("AAA"),
        "window_start": F.timestamp_seconds(F.lit(1704690000) + F.pmod(F.xxhash64("id"), F.lit(20000))),
        "volume": F.col("id"),
    }
    rows = spark.range(CONTRACTS).select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OPTIONS])
    wh.write(rows, "options", "append")
    return wh


def scanned(df):
    """The rows of the result, and how many rows the scan read for them."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return rows, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture
def no_bloom(spark):
    spark.conf.set("parquet.filter.bloom.enabled", "false")
    yield
    spark.conf.unset("parquet.filter.bloom.enabled")


def contract(number):
    return f"O:AAA240119C{number:08d}"


def test_held_contract_is_found(wh):
    rows, read = scanned(wh.scan("options", ticker=contract(2 * 777)))
    assert [r.volume for r in rows] == [777] and read > 0


def test_absent_contract_reads_nothing(wh):
    assert scanned(wh.scan("options", ticker=contract(777))) == ([], 0)


def test_without_filters_it_would_be_read(wh, no_bloom):
    rows, read = scanned(wh.scan("options", ticker=contract(777)))
    assert rows == [] and read > 0


def test_absent_underlying_reads_nothing(wh):
    assert scanned(wh.scan("options", underlying_symbol="AAB")) == ([], 0)


def test_filters_grow_with_the_values(spark, tmp_path):
    """A file of few contracts does not carry a filter of the largest size."""
    small = Warehouse(spark, str(tmp_path / "wh"))
    few = spark.range(50).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in OPTIONS if f.name != "ticker"], F.col("id").cast("string").alias("ticker"))
    small.write(few.withColumn("window_start", F.timestamp_seconds(F.lit(1704690000))), "options", "append")
    files = list((tmp_path / "wh").rglob("*.parquet"))
    assert files and all(f.stat().st_size < 100_000 for f in files)
