import datetime as dt

from barloom.operators import bars, calendar, checks

D = dt.date


def dates(spark, days):
    return spark.createDataFrame([(d,) for d in days], "date date")


def listed(df):
    return [r.date for r in df.collect()]


def test_spine(spark):
    assert listed(calendar.date_spine(spark, D(2024, 2, 28), D(2024, 3, 1))) == [
        D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1)
    ]
    assert listed(calendar.date_spine(spark, D(2024, 1, 1), D(2024, 1, 1))) == [D(2024, 1, 1)]
    assert listed(calendar.date_spine(spark, D(2024, 1, 3), D(2024, 1, 1))) == []


def test_trading_days_and_gaps(spark):
    holidays = dates(spark, [D(2024, 1, 1), D(2024, 1, 15)])
    days = sorted(listed(calendar.trading_days(spark, D(2023, 12, 29), D(2024, 1, 16), holidays)))
    assert days[:3] == [D(2023, 12, 29), D(2024, 1, 2), D(2024, 1, 3)]
    assert D(2024, 1, 15) not in days and D(2024, 1, 13) not in days and len(days) == 11
    loaded = dates(spark, [D(2024, 1, 2), D(2024, 1, 2), D(2024, 1, 4), D(2024, 1, 16)])
    gaps = listed(calendar.trading_day_gaps(loaded, holidays))
    assert gaps == [d for d in days if D(2024, 1, 2) < d < D(2024, 1, 16) and d != D(2024, 1, 4)]
    assert listed(calendar.trading_day_gaps(dates(spark, []), holidays)) == []


def test_exchange_holidays(spark):
    found = calendar.nyse_holidays(spark, 1990, 2025)
    of = lambda year: sorted(d for d in listed(found) if d.year == year)
    days = lambda *pairs, year: [D(year, m, d) for m, d in pairs]
    assert of(2024) == days((1, 1), (1, 15), (2, 19), (3, 29), (5, 27), (6, 19), (7, 4), (9, 2), (11, 28), (12, 25), year=2024)
    assert of(2021) == days((1, 1), (1, 18), (2, 15), (4, 2), (5, 31), (7, 5), (9, 6), (11, 25), (12, 24), year=2021)
    counts = {1997: 253, 2001: 248, 2008: 253, 2012: 250, 2018: 251, 2021: 252, 2022: 251, 2023: 250, 2024: 252}
    for year, n in counts.items():
        assert calendar.trading_days(spark, D(year, 1, 1), D(year, 12, 31), found).count() == n, year


def test_missing_and_ready(spark):
    available = dates(spark, [D(2024, 1, 4), D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 2)])
    assert listed(calendar.missing_dates(available, dates(spark, [D(2024, 1, 3)]))) == [D(2024, 1, 2), D(2024, 1, 4)]
    options = dates(spark, [D(2024, 1, 3), D(2024, 1, 4), D(2022, 5, 5)])
    assert listed(calendar.ready_dates(available, options)) == [D(2024, 1, 3), D(2024, 1, 4)]
    assert listed(calendar.ready_dates(available, options, D(2024, 1, 3), None)) == [D(2024, 1, 4)]
    assert listed(calendar.ready_dates(available, options, D(2024, 1, 4), D(2024, 1, 1))) == []
    assert listed(calendar.ready_dates(options, options, since_year=2023)) == [D(2024, 1, 3), D(2024, 1, 4)]


def test_price_checks(spark):
    splits = spark.createDataFrame([("A", D(2024, 2, 1)), ("A", D(2024, 2, 2)), ("B", D(2024, 2, 1))], "ticker string, execution_date date")
    assert len(calendar.split_check_dates(splits).collect()) == 6 + 4
    ours = spark.createDataFrame(
        [("A", "2024-02-01 05:00:00", 100.0), ("A", "2024-02-01 06:00:00", 55.0), ("A", "2024-02-02 05:00:00", 100.0),
         ("A", "2024-01-31 05:00:00", 100.0), ("B", "2024-02-01 05:00:00", 7.0), ("C", "2024-02-01 05:00:00", 7.0)],
        "ticker string, window_start string, close double",
    ).selectExpr("ticker", "cast(window_start as timestamp) as window_start", "close")
    reference = spark.createDataFrame(
        [("A", D(2024, 2, 1), 100.05), ("A", D(2024, 2, 2), 100.2), ("A", D(2024, 2, 3), 1.0)],
        "ticker string, date date, close double",
    )
    found = checks.price_checks(ours, splits, reference)
    status = {(r.ticker, r.date): (r.status, r.message) for r in found.collect()}
    assert status[("A", D(2024, 2, 1))] == ("pass", None)
    assert status[("A", D(2024, 2, 2))] == ("fail", None)
    assert status[("A", D(2024, 1, 31))] == ("error", "No data from the reference series")
    assert status[("A", D(2024, 2, 3))] == ("error", "No data in our tables")
    assert len(status) == 10
    total = checks.summarize_checks(found).filter("ticker is null").first().asDict()
    assert total == {"ticker": None, "tickers_checked": 2, "dates_checked": 2, "passed": 1, "failed": 1, "errors": 8}
    assert [(r.ticker, r.date) for r in checks.failed_checks(found).collect()] == [("A", D(2024, 2, 2))]
    one = checks.price_checks(ours, splits, reference, n=1, seed=1)
    assert len({r.ticker for r in one.collect()}) == 1
    assert checks.price_checks(ours, splits, reference, start=D(2024, 2, 2)).count() == 4


def test_sample_is_repeatable(spark):
    keys = spark.range(100).selectExpr("cast(id % 50 as string) as ticker")
    first = [r.ticker for r in bars.sample_keys(keys, 7, 3).collect()]
    assert first == [r.ticker for r in bars.sample_keys(keys.repartition(4), 7, 3).collect()]
    assert len(set(first)) == 7 and first != [r.ticker for r in bars.sample_keys(keys, 7, 4).collect()]
    assert bars.sample_keys(keys, 999).count() == 50
