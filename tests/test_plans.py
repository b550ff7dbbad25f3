"""The plans that matter at scale, read from explain output."""

import datetime as dt

import pytest

from barloom.operators import checks, options, splits, technical, validate
from barloom.operators.bars import typed_bars
from barloom.session import materialize
from barloom.sources.warehouse import Warehouse
from barloom.workload.fixtures import Fixtures

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF_DIR)


@pytest.fixture(scope="module")
def daily(fx):
    return materialize(typed_bars(fx.bars_raw()), "plan-bars")


@pytest.fixture(scope="module")
def split(fx):
    return materialize(splits.prepare_splits(fx.splits_raw())[0], "plan-splits")


def branch_of_scan(text, column):
    """Operators above the scan that reads ``column``, up to the first join."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and column in line)
    above = []
    for line in reversed(lines[:at]):
        above.append(line)
        if "Join" in line:
            break
    return "\n".join(above)


def test_adjustment_does_not_shuffle_bars(daily, split):
    text = plan(splits.adjust_prices(daily, split))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    assert "Exchange" not in branch_of_scan(text, "window_start")


def test_large_split_side_shuffles_by_ticker_and_year(daily, split, monkeypatch):
    monkeypatch.setattr(splits, "fits_broadcast", lambda df: False)
    df = splits.adjust_prices(daily, split)
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(splits.adjust_prices(daily, split))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin [ticker" in text and "_year" in text.split("SortMergeJoin", 2)[1]


def test_indicators_shuffle_once(daily):
    text = plan(technical.technical_indicators(daily))
    assert text.count("Exchange") == 1 and "hashpartitioning(ticker" in text
    assert "Python" not in text


def test_parsing_and_validation_are_narrow(fx):
    text = plan(validate.validate(options.parse_option_tickers(typed_bars(fx.options_raw())), validate.option_rules()))
    assert "Exchange" not in text and "Python" not in text


def test_checks_filter_the_price_table_by_broadcast(daily, split):
    reference = daily.selectExpr("ticker", "to_date(window_start) as date", "close")
    text = plan(checks.price_checks(daily, split, reference))
    assert text.count("BroadcastHashJoin [ticker") >= 2
    assert "Exchange" not in branch_of_scan(text, "window_start")


def test_scan_prunes_partitions_and_pushes_filters(spark, daily, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.write(daily, "stocks_adjusted", "overwrite")
    df = wh.scan("stocks_adjusted", "TKB", dt.date(1997, 3, 10), dt.date(1997, 4, 2)).select("window_start", "close")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # the whole filters
    text = plan(df)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    partitions = text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "(trade_year#" in partitions and "(ticker_bucket#" in partitions
    pushed = text.split("PushedFilters: ")[1]
    assert "EqualTo(ticker,TKB)" in pushed and "GreaterThanOrEqual(window_start" in pushed
    schema = text.split("ReadSchema: ")[1]
    assert "volume" not in schema and "high" not in schema
    years = list(tmp_path.glob("stocks_adjusted/v00001/ticker_bucket=*/trade_year=*"))
    assert "trade_year=1997-01-01" in {p.name for p in years}
    assert sum(len(list(p.glob("*.parquet"))) for p in years) < 2 * len(years)


def test_dropping_bad_symbols_does_not_parse_twice(fx):
    text = plan(options.parsed_options(typed_bars(fx.options_raw())))
    assert text.count("RLIKE") == 1 and "Filter" not in text.replace("Filters", "")
