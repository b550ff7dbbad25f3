import pytest

from barloom.operators import validate as v

STOCK = "ticker string, window_start string, volume string, open double, close double, high double, low double"
NAN = float("nan")


def rules_of(df, rules):
    return [[e.rule for e in r.errors] for r in v.validate(df, rules).orderBy("n").collect()]


def test_stock_rules(spark):
    rows = [
        (("A", "t", "10", 2.0, 2.0, 3.0, 1.0), []),
        ((None, "t", "10", 2.0, 2.0, None, -1.0), ["missing ticker", "missing high"]),
        (("", "t", "10", 2.0, 2.0, 3.0, 1.0), ["empty ticker"]),
        (("A", "t", "-1", 2.0, 2.0, 3.0, 1.0), ["volume negative"]),
        (("A", "t", "x", 2.0, 2.0, 3.0, 1.0), ["volume not numeric"]),
        (("A", "t", "1", 0.0, 2.0, 3.0, 1.0), ["open not positive", "low <= open"]),
        (("A", "t", "1", 2.0, 2.0, 1.0, 3.0), ["high >= low", "high >= open", "high >= close", "low <= open", "low <= close"]),
        (("A", "t", "1", NAN, 2.0, 3.0, 1.0), ["open is NaN"]),
        (("A", "t", "1", 2.0, 2.0, 3.0, NAN), ["low is NaN"]),
    ]
    df = spark.createDataFrame([(i, *r) for i, (r, _) in enumerate(rows)], f"n int, {STOCK}")
    assert rules_of(df, v.stock_rules()) == [expected for _, expected in rows]


def test_messages(spark):
    df = spark.createDataFrame([("A", "t", "-1", -2.5, 2.0, 1.5, 1.0)], STOCK)
    assert {r.message for r in v.violations(df, v.stock_rules()).collect()} == {
        "open must be positive, got -2.5",
        "volume must be non-negative, got -1.0",
        "high (1.5) must be >= close (2.0)",
        "low (1.0) must be <= open (-2.5)",
    }
    summary = {r.rule: r.row_count for r in v.violation_summary(df.unionAll(df), v.stock_rules()).collect()}
    assert summary == {"open not positive": 2, "volume negative": 2, "high >= close": 2, "low <= open": 2}


def test_option_rules(spark):
    schema = (
        "n int, original string, underlying_symbol string, expiration_date string, option_type string, "
        "strike_price double, window_start string, open double, close double, high double, low double"
    )
    rows = [
        (("O:A", "A", "d", "C", 1.0, "t", 0.0, 0.0, 0.0, 0.0), []),
        (("O:A", "A", "d", "C", 1.0, "t", None, None, None, None), []),
        (("O:A", None, "d", "C", 1.0, "t", -1.0, 0.0, 0.0, 0.0), ["missing underlying_symbol"]),
        (("O:A", "A", "d", "X", 0.0, "t", 0.0, 0.0, 0.0, 0.0), ["option_type unknown", "strike_price not positive"]),
        (("O:A", "", "d", "P", 1.0, "t", 1.0, 1.0, 1.0, -1.0), ["empty underlying_symbol", "low negative"]),
    ]
    df = spark.createDataFrame([(i, *r) for i, (r, _) in enumerate(rows)], schema)
    assert rules_of(df, v.option_rules("original")) == [expected for _, expected in rows]


@pytest.mark.parametrize(
    "f,t,expected",
    [(1.0, 4.0, []), (0.0, 4.0, ["split_from not positive"]),
     (-1.0, 0.0, ["split_from not positive", "split_to not positive"])],
)
def test_split_rules(spark, f, t, expected):
    df = spark.createDataFrame([(0, f, t)], "n int, split_from double, split_to double")
    assert rules_of(df, v.split_rules()) == [expected]


def test_ticker_rules(spark):
    df = spark.createDataFrame([(0, "AAPL"), (1, "aapl"), (2, None)], "n int, ticker string")
    assert rules_of(df, v.ticker_rules()) == [[], ["ticker malformed"], ["ticker malformed"]]
    assert v.violations(df, v.ticker_rules()).filter("n = 1").first().message == "Invalid ticker: aapl"
