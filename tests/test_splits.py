import datetime as dt
import math
import random

import pytest

from barloom.operators import splits as ops
from barloom.operators.bars import dedupe_bars, replace_keys
from barloom.plans import sizing

BARS = "ticker string, window_start timestamp, volume long, open double, close double, high double, low double, transactions long"
SPLITS = "ticker string, execution_date date, split_factor double"


def bar(ticker, day, price, volume=10):
    stamp = dt.datetime.combine(day, dt.time(4))
    return (ticker, f"{stamp:%Y-%m-%d %H:%M:%S}", volume, price, price, price, price, 1)


def bars(spark, rows):
    schema = BARS.replace("window_start timestamp", "window_start string")
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("window_start", df.window_start.cast("timestamp"))


def adjusted(df):
    return {(r.ticker, r.window_start.date()): r.close for r in df.collect()}


def test_split_timeline(spark):
    d = dt.date
    data = bars(spark, [
        bar("AAPL", d(2020, 8, 28), 500.0), bar("AAPL", d(2020, 8, 31), 500.0),
        bar("AAPL", d(2020, 9, 1), 125.0), bar("MSFT", d(2020, 8, 28), 200.0),
        bar("AAPL", d(2014, 6, 6), 2800.0),
    ])
    splits = spark.createDataFrame([("AAPL", d(2020, 8, 31), 4.0), ("AAPL", d(2014, 6, 9), 7.0)], SPLITS)
    got = adjusted(ops.adjust_prices(data, splits))
    assert got == {
        ("AAPL", d(2020, 8, 28)): 125.0, ("AAPL", d(2020, 8, 31)): 125.0,
        ("AAPL", d(2020, 9, 1)): 125.0, ("MSFT", d(2020, 8, 28)): 200.0,
        ("AAPL", d(2014, 6, 6)): 100.0,
    }
    before = adjusted(ops.adjust_prices(data, splits, on_execution_day=False))
    assert before[("AAPL", d(2020, 8, 31))] == 500.0
    assert before[("AAPL", d(2020, 8, 28))] == 125.0


@pytest.mark.parametrize("broadcast", [True, False])
def test_adjustment_against_brute_force(spark, monkeypatch, broadcast):
    """One ticker has most bars and most splits, several of them on one day."""
    if not broadcast:
        monkeypatch.setattr(ops, "fits_broadcast", lambda df: False)
    rng = random.Random(3)
    first = dt.date(2015, 1, 1)
    rows, events = [], []
    for ticker, n_bars, n_splits in (("HOT", 700, 60), ("A", 60, 1), ("B", 60, 0), ("C", 60, 5)):
        days = rng.sample(range(2000), n_bars)
        rows += [bar(ticker, first + dt.timedelta(days=x), 10.0 + x, x) for x in days]
        events += [
            (ticker, first + dt.timedelta(days=rng.randrange(2000)), rng.choice([2.0, 0.5, 3.0, 0.25]))
            for _ in range(n_splits)
        ]
    events += [events[0]]
    data = bars(spark, rows)
    got = ops.with_split_factor(data, spark.createDataFrame(events, SPLITS)).collect()
    assert len(got) == len(rows)
    for r in got:
        day = r.window_start.date()
        expected = math.prod(f for t, d, f in events if t == r.ticker and d >= day)
        assert r.cumulative_factor == pytest.approx(expected, rel=1e-12)


def test_no_splits_leaves_prices(spark):
    data = bars(spark, [bar("A", dt.date(2020, 1, x), 1.0 + x) for x in range(1, 9)])
    got = ops.adjust_prices(data, spark.createDataFrame([], SPLITS))
    assert sorted(got.collect()) == sorted(data.collect())


def test_prepare_splits(spark):
    d = dt.date(2020, 1, 1)
    feed = spark.createDataFrame(
        [("1", "A", d, 1.0, 4.0, 1), ("1", "A", d, 1.0, 5.0, 2), ("2", "B", d, 0.0, 4.0, 3),
         (None, "C", d, 1.0, 2.0, 4), ("3", None, d, 1.0, 2.0, 5), ("4", "D", dt.date(2019, 1, 1), 1.0, 2.0, 6),
         ("5", "E", d, None, 2.0, 7)],
        "id string, ticker string, execution_date date, split_from double, split_to double, seq int",
    )
    good, bad = ops.prepare_splits(feed, dt.date(2019, 6, 1), "seq")
    assert [(r.id, r.split_factor) for r in good.collect()] == [("1", 5.0)]
    assert {r.id for r in bad.collect()} == {"2", "5"}


def test_replace_and_dedupe(spark):
    old = spark.createDataFrame([("A", 1), ("B", 2)], "ticker string, x int")
    new = spark.createDataFrame([("B", 3), ("B", 4), ("C", 5)], "ticker string, x int")
    assert sorted(map(tuple, replace_keys(old, new, ["ticker"]).collect())) == [("A", 1), ("B", 3), ("B", 4), ("C", 5)]
    data = bars(spark, [bar("A", dt.date(2020, 1, 1), p) for p in (3.0, 2.0, 2.0)] + [bar("A", dt.date(2020, 1, 2), 1.0)])
    assert sorted(r.close for r in dedupe_bars(data).collect()) == [1.0, 2.0]


def test_small_sides_are_broadcast_and_large_ones_not(spark):
    assert sizing.fits_broadcast(spark.range(10), 10)
    assert not sizing.fits_broadcast(spark.range(11), 10)
