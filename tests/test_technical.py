import random

import pytest

from barloom.operators.technical import technical_indicators

SCHEMA = "ticker string, ms long, high double, low double, close double, volume long"


def series(rng, ticker, n, step_ms=60_000):
    price, rows, t = 100.0, [], 0
    for _ in range(n):
        t += rng.randrange(1, 2 * step_ms)
        price = max(1.0, price * (1 + rng.uniform(-0.05, 0.05)))
        rows.append((ticker, t, price + rng.random(), price - rng.random(), price, rng.randrange(10_000)))
    return rows


def plain(rows):
    """Textbook definitions, bar by bar."""
    rows = sorted(rows, key=lambda r: r[1])
    high, low, close, volume = ([r[i] for r in rows] for i in (2, 3, 4, 5))
    out, atr, ranges = {}, None, []
    for i, r in enumerate(rows):
        if i >= 2:
            j = i - 1
            tr = max(high[j] - low[j], abs(high[j] - close[j - 1]), abs(low[j] - close[j - 1]))
            ranges.append(tr)
            if len(ranges) == 14:
                atr = sum(ranges) / 14
            elif len(ranges) > 14:
                atr = (13 * atr + tr) / 14
        mean = lambda x, n: sum(x[i - n : i]) / n if i >= n else None
        out[r[0], r[1]] = (mean(close, 20), mean(close, 50), mean(close, 200), mean(volume, 20), atr)
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return df.selectExpr("ticker", "timestamp_millis(ms) as window_start", "high", "low", "close", "volume")


def result(df):
    rows = df.selectExpr("ticker", "unix_millis(window_start) as ms", "sma_20", "sma_50", "sma_200", "volume_sma_20", "atr")
    return {(r.ticker, r.ms): tuple(r)[2:] for r in rows.collect()}


def check(got, rows):
    expected = {}
    for ticker in {r[0] for r in rows}:
        expected |= plain([r for r in rows if r[0] == ticker])
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        for a, b in zip(got[key], values):
            assert (a is None) == (b is None), key
            assert b is None or a == pytest.approx(b, rel=1e-9), key


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    # HOT holds most of the rows; the others end before, at and after the warm-ups.
    sizes = {"HOT": 9000, "A": 1, "B": 14, "C": 16, "D": 201, "E": 513, "F": 1100}
    return [row for t, n in sizes.items() for row in series(rng, t, n)]


def test_whole_series(spark, rows):
    check(result(technical_indicators(frame(spark, rows))), rows)


def test_hot_series_in_chunks(spark, rows):
    """Chunks of some 1500 rows; slices are far smaller or hold many rows."""
    for slice_ms in (200_000, 50_000_000):
        df = technical_indicators(frame(spark, rows), max_rows=1500, slice_ms=slice_ms)
        check(result(df), rows)


def test_chunk_smaller_than_halo(spark, rows):
    some = [r for r in rows if r[0] in ("HOT", "D")][:2500]
    check(result(technical_indicators(frame(spark, some), max_rows=150, slice_ms=1_000_000)), some)


@pytest.mark.parametrize("max_rows", [1 << 20, 1500])
def test_missing_values(spark, rows, max_rows):
    """A missing close empties the averages over it, and the range from there on."""
    hot = sorted((r for r in rows if r[0] == "HOT"), key=lambda r: r[1])[:6000]
    broken = 1000
    data = [(*r[:4], None if i == broken else r[4], r[5]) for i, r in enumerate(hot)]
    got = result(technical_indicators(frame(spark, data), max_rows=max_rows, slice_ms=1_000_000))
    for i, r in enumerate(hot):
        sma_20, sma_50, sma_200, volume, atr = got[r[0], r[1]]
        for n, value in ((20, sma_20), (50, sma_50), (200, sma_200)):
            assert (value is None) == (i < n or broken < i <= broken + n)
        assert (volume is None) == (i < 20)
        assert (atr is None) == (i < 15 or i > broken)


def test_any_length(spark, rows):
    hot = sorted((r for r in rows if r[0] == "HOT"), key=lambda r: r[1])[:2000]
    got = technical_indicators(frame(spark, hot), close_lengths=(777, 1500), volume_lengths=(3,))
    close = [r[4] for r in hot]
    for r in got.selectExpr("unix_millis(window_start) as ms", "sma_777", "sma_1500").collect():
        i = next(k for k, x in enumerate(hot) if x[1] == r.ms)
        for n, value in ((777, r.sma_777), (1500, r.sma_1500)):
            assert (value is None) if i < n else value == pytest.approx(sum(close[i - n : i]) / n, rel=1e-12)


def test_small_prices_after_large_ones(spark):
    """Differences of running sums would leave nothing of the small ones."""
    data = [("X", 60_000 * k, p, p, p, 1) for k in range(400) for p in [1e12 if k < 100 else 0.001]]
    got = result(technical_indicators(frame(spark, data)))
    for k in (121, 150, 200, 399):
        assert got["X", 60_000 * k][0] == pytest.approx(0.001, rel=1e-12)


@pytest.mark.parametrize("value", [float("inf"), float("-inf"), float("nan")])
def test_values_that_are_not_finite_are_missing(spark, value):
    data = [("X", 60_000 * k, 2.0, 1.0, value if k == 30 else 1.5, 1) for k in range(300)]
    got = result(technical_indicators(frame(spark, data)))
    for k in range(300):
        assert (got["X", 60_000 * k][0] is None) == (k < 20 or 30 < k <= 50)
        assert (got["X", 60_000 * k][4] is None) == (k < 15 or k > 30)


def test_pieces_do_not_change_a_bit(spark, rows):
    whole = result(technical_indicators(frame(spark, rows)))
    assert result(technical_indicators(frame(spark, rows), max_rows=1500, slice_ms=200_000)) == whole


def test_rows_without_ticker_are_a_series(spark, rows):
    nulls = [(None, *r[1:]) for r in rows if r[0] == "HOT"][:4000]
    whole = result(technical_indicators(frame(spark, nulls)))
    cut = result(technical_indicators(frame(spark, nulls), max_rows=1500, slice_ms=200_000))
    assert len(whole) == 4000 and cut == whole
