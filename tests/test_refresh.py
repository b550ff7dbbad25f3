"""Refreshing the derived tables against rebuilding them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom.jobs import rebuild
from barloom.jobs.refresh import refresh
from barloom.schemas import SPLITS_FEED, STOCK_BARS
from barloom.sources.warehouse import Warehouse

FIRST = dt.date(2020, 1, 1)
BARS = "ticker string, window_start timestamp, volume long, open double, close double, high double, low double, transactions long"


def bars(spark, tickers, first, last, seed=1, step=1):
    draw, rows = random.Random(seed), []
    for ticker in tickers:
        for n in range(0, (last - first).days + 1, step):
            close = 50 + 100 * draw.random()
            when = dt.datetime.combine(first + dt.timedelta(days=n), dt.time(5), dt.timezone.utc)
            rows.append((ticker, when, draw.randrange(1000), close, close, close + draw.random(), close - draw.random(), 3))
    return spark.createDataFrame(rows, BARS)


def split(spark, *rows):
    return spark.createDataFrame([(f"{t}{d}", t, d, 1.0, r) for t, d, r in rows], SPLITS_FEED)


def tables(wh):
    adjusted = {(r.ticker, r.window_start): tuple(r) for r in wh.scan("stocks_adjusted").collect()}
    technical = {(r.ticker, r.window_start): tuple(r)[2:] for r in wh.scan("stocks_technical").collect()}
    return adjusted, technical


def assert_like_rebuild(spark, wh, path):
    adjusted, technical = tables(wh)
    other = Warehouse(spark, str(path))
    other.write(wh.scan("stocks_raw"), "stocks_raw", "append")
    other.write(wh.scan("splits"), "splits", "overwrite")
    rebuild.recalculate_adjusted(other)
    rebuild.recalculate_technical(other)
    want_adjusted, want_technical = tables(other)
    assert adjusted == want_adjusted
    assert set(technical) == set(want_technical)
    for key, want in want_technical.items():
        got = technical[key]
        assert [v is None for v in got] == [v is None for v in want], key
        assert [v for v in got if v is not None] == pytest.approx([v for v in want if v is not None], rel=1e-6), key


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def test_new_days_and_splits(spark, wh, tmp_path):
    wh.write(bars(spark, ["AAA", "BBB", "CCC"], FIRST, dt.date(2022, 12, 20)), "stocks_raw", "append")
    wh.write(bars(spark, ["SLOW"], FIRST, dt.date(2022, 12, 20), 2, 30), "stocks_raw", "append")
    rebuild.sync_splits(wh, split(spark, ("AAA", dt.date(2021, 5, 5), 4.0)))
    assert refresh(wh)["tickers"] == 4
    assert refresh(wh) == {"tickers": 0, "folders_written": 0, "folders_kept": 0}

    wh.write(bars(spark, ["AAA", "BBB", "NEW", "SLOW"], dt.date(2023, 1, 2), dt.date(2023, 3, 4), 3, 2), "stocks_raw", "append")
    done = refresh(wh)
    # Every folder of earlier years is still the first version's; only 2023 was written.
    assert done["tickers"] == 4 and done["folders_kept"] > done["folders_written"] > 0
    for table in ("stocks_adjusted", "stocks_technical"):
        assert all(("=2023-" in f) != f.startswith("v00001") for f in wh.folders(table) if "trade_year" in f)
    assert_like_rebuild(spark, wh, tmp_path / "b")

    rebuild.sync_splits(wh, split(spark, ("AAA", dt.date(2021, 5, 5), 4.0), ("BBB", dt.date(2023, 1, 20), 2.0)))
    assert refresh(wh)["tickers"] == 1
    wh.drop_old_versions("stocks_technical", 1)
    wh.drop_old_versions("stocks_adjusted", 1)
    assert_like_rebuild(spark, wh, tmp_path / "d")


def test_late_and_corrected_days(spark, wh, tmp_path):
    rows = bars(spark, ["AAA", "BBB"], FIRST, dt.date(2021, 12, 31), step=9)
    rows = rows.withColumn("source", F.date_format("window_start", "yyyy-MM"))
    month = F.col("source") == "2021-03"
    wh.write(rows.filter(~month), "stocks_raw", "replace")
    refresh(wh)
    wh.write(rows.filter(month & (F.col("ticker") == "AAA")), "stocks_raw", "replace")
    assert refresh(wh)["tickers"] == 1
    # The month again, with the other ticker's bars only: the first one's have gone.
    wh.write(rows.filter(month & (F.col("ticker") == "BBB")), "stocks_raw", "replace")
    assert refresh(wh)["tickers"] == 2
    assert_like_rebuild(spark, wh, tmp_path / "b")


def test_missing_prices_stay_broken(spark, wh, tmp_path):
    rows = bars(spark, ["AAA", "BBB"], FIRST, dt.date(2022, 6, 1))
    hole = (F.col("ticker") == "AAA") & (F.to_date("window_start") == F.lit(dt.date(2020, 6, 1)))
    wh.write(rows.withColumn("close", F.when(~hole, F.col("close"))), "stocks_raw", "append")
    refresh(wh)
    wh.write(bars(spark, ["AAA", "BBB"], dt.date(2022, 6, 2), dt.date(2022, 7, 9), 4), "stocks_raw", "append")
    refresh(wh)
    assert_like_rebuild(spark, wh, tmp_path / "a")
    last = {r.ticker: r.atr for r in wh.scan("stocks_technical", start=dt.date(2022, 7, 9)).collect()}
    assert last["AAA"] is None and last["BBB"] > 0


def test_lost_refresh_and_lost_state(spark, wh, tmp_path, monkeypatch):
    wh.write(bars(spark, ["AAA", "BBB"], FIRST, dt.date(2021, 12, 31)), "stocks_raw", "append")
    refresh(wh)
    wh.write(bars(spark, ["AAA"], dt.date(2022, 1, 1), dt.date(2022, 2, 1), 5), "stocks_raw", "append")
    replace = Warehouse.replace_since

    def fails(self, new, table, since):
        if table == "stocks_technical":
            raise RuntimeError("lost")
        return replace(self, new, table, since)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "replace_since", fails)
        with pytest.raises(RuntimeError):
            refresh(wh)
    kept = wh.scan("stocks_technical").filter("ticker = 'BBB' or window_start < '2021-06-01'")
    wh.write(kept, "stocks_technical", "overwrite")  # the year's last indicators of AAA have gone
    assert refresh(wh)["tickers"] == 1
    assert wh.scan("stocks_technical", "AAA", dt.date(2022, 1, 1)).count() == 32
    assert wh.scan("stocks_technical", "AAA", dt.date(2022, 2, 1)).first().sma_200 is not None


def test_empty(spark, wh):
    assert refresh(wh) == {"tickers": 0, "folders_written": 0, "folders_kept": 0}
    assert wh.scan("stocks_adjusted").schema == STOCK_BARS
