import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.functions.prices import pct_diff, split_factor, split_label, strike_label
from barloom.functions.symbols import is_stock_symbol, option_underlying
from barloom.functions.times import file_date, iso_to_ts, ms_to_ts, ns_to_ts, ns_to_ts_micros
from barloom.operators.options import option_rejects, parse_option_tickers, parsed_options

# The grammar: "O:", a root with at least one letter (kept without other characters, upper case),
# yymmdd, C or P, eight digits in thousandths.
VALID = {
    "O:F230303P00012345": ("F", dt.date(2023, 3, 3), "P", 12.345),  # shortest root, all strike digits
    "O:NVDA000229C99999999": ("NVDA", dt.date(2000, 2, 29), "C", 99999.999),  # leap day, largest strike
    "O:KO991231P00000000": ("KO", dt.date(2099, 12, 31), "P", 0.0),  # last date, smallest strike
    "O:META1250606C00000001": ("META", dt.date(2025, 6, 6), "C", 0.001),  # adjusted root with a digit
    "O:9Z9250606C00007000": ("Z", dt.date(2025, 6, 6), "C", 7.0),  # digits around the root
    "O:rds/a220114P00033100": ("RDSA", dt.date(2022, 1, 14), "P", 33.1),  # lower case and a mark
    "O:LONGERROOT270115C01234000": ("LONGERROOT", dt.date(2027, 1, 15), "C", 1234.0),
}
INVALID = [
    None,
    "",
    "F230303P00012345",  # no prefix
    "o:F230303P00012345",  # prefix in lower case
    "O:230303P00012345",  # no root
    "O:77230303P00012345",  # a root without letters
    "O:F230303",  # cut after the date
    "O:F230303P0001234",  # seven digits
    "O:F230303Q00012345",  # another type
    "O:F230303p00012345",  # type in lower case
    "O:F230229P00012345",  # no leap day
    "O:F231301P00012345",  # month 13
    "O:F230300P00012345",  # day 0
    "O:F230303P0001234X",  # a letter among the digits
    "O:F230303P00012345 ",  # something behind
    "O:F230303P00012345\n",
]


def test_option_symbols(spark):
    rows = spark.createDataFrame([(t,) for t in [*VALID, *INVALID]], "ticker string")
    for r in parse_option_tickers(rows).collect():
        found = (r.underlying_symbol, r.expiration_date, r.option_type, r.strike_price)
        assert found == VALID.get(r.ticker, (None,) * 4), r.ticker
        assert r.parse_ok == (r.ticker in VALID)
    kept = {r.ticker for r in parsed_options(rows).collect()}
    assert kept == {t.replace("O:", "") for t in VALID}
    assert option_rejects(rows).count() == len(INVALID)


def test_option_underlying(spark):
    """Everything between the prefix and the last fifteen characters, whatever these are."""
    cases = {
        "O:F230303P00012345": "F",
        "O:rds/a220114P00033100": "RDSA",
        "O:ABCD" + "?" * 15: "ABCD",
        "O:A" + "?" * 15: "A",
        "O:" + "?" * 15: None,  # nothing in between
        "O:12" + "?" * 15: None,
        "P:ABCD" + "?" * 15: None,
        "": None,
        "O:": None,
        "short": None,
    }
    rows = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    for r in rows.select("t", option_underlying(F.col("t")).alias("u")).collect():
        assert r.u == cases.get(r.t), r.t


def test_strike_label(spark):
    cases = {
        0.0: "$0.00", 7.0: "$7.00", 33.1: "$33.10", 12.345: "$12.35", 12.344: "$12.34", 0.375: "$0.38",
        1234.0: "$1234.00", 99999.999: "$100000.00",
    }
    rows = spark.createDataFrame([(x,) for x in cases], "x double")
    for r in rows.select("x", strike_label(F.col("x")).alias("label")).collect():
        assert r.label == cases[r.x]


def test_split_label_and_factor(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (4.0, 1.0), (2.0, 2.0), (0.0, 3.0)], "f double, t double")
    got = rows.select(
        split_label(F.col("f"), F.col("t")).alias("label"), split_factor(F.col("f"), F.col("t")).alias("x")
    ).collect()
    assert [r.label for r in got] == [
        "1:4 (forward split)", "4:1 (reverse split)", "2:2 (reverse split)", "0:3 (forward split)",
    ]
    assert [r.x for r in got] == [4.0, 0.25, 1.0, None]


def test_pct_diff(spark):
    rows = spark.createDataFrame([(105.0, 100.0), (95.0, 100.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0)], "a double, b double")
    got = [r.d for r in rows.select(pct_diff(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [5.0, -5.0, float("inf"), float("inf"), 0.0]


def test_times(spark):
    row = spark.range(1).select(
        ns_to_ts(F.lit(951782399987654321)).alias("ns"),
        ns_to_ts_micros(F.lit(951782399987654321)).alias("us"),
        ms_to_ts(F.lit(4102444799999)).alias("ms"),
        iso_to_ts(F.lit("2024-01-05T10:00:00Z")).alias("iso"),
        iso_to_ts(F.lit("2024-01-05T10:00:00+02:00")).alias("offset"),
        iso_to_ts(F.lit("not-a-date")).alias("bad"),
        iso_to_ts(F.lit("")).alias("empty"),
    ).select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("ns", "us", "ms", "iso", "offset", "bad", "empty")]).first()
    assert row.ns == "2000-02-28 23:59:59.987000"
    assert row.us == "2000-02-28 23:59:59.987654"
    assert row.ms == "2099-12-31 23:59:59.999000"
    assert (row.iso, row.offset) == ("2024-01-05 10:00:00.000000", "2024-01-05 08:00:00.000000")
    assert (row.bad, row.empty) == (None, None)


def test_texts_that_are_no_times(spark):
    """Spark would complete some of these by today's date or the first of a month."""
    whole = {"2024-02-29": "2024-02-29 00:00:00", "2024-02-29 07:05": "2024-02-29 07:05:00", "2024-02-29T07:05:09.5-0130": "2024-02-29 08:35:09"}
    none = ["12:30:00", "T10", "2024", "2024-01", "2024-1-5", "2023-02-29", "2024-01-05T", "2024-01-05T25:00:00Z", " 2024-01-05", "2024-01-05Z", "+12024-01-05"]
    rows = spark.createDataFrame([(t,) for t in [*whole, *none]], "t string")
    got = {r.t: r.s for r in rows.select("t", F.date_format(iso_to_ts(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("s")).collect()}
    assert got == whole | dict.fromkeys(none)


@pytest.mark.parametrize(
    "path,expected",
    [
        ("s3a://b/stocks/2019/07/2019-07-03.csv.gz", dt.date(2019, 7, 3)),
        ("file:/x/trade_date=2019-07-03/part-00000-a.csv.gz", dt.date(2019, 7, 3)),
        ("/x/2020-13-14.csv.gz", None),
        ("/x/notes.csv.gz", None),
        ("/x/2019-07-03.parquet", None),
    ],
)
def test_file_date(spark, path, expected):
    assert spark.range(1).select(file_date(F.lit(path)).alias("d")).first().d == expected


def test_stock_symbols(spark):
    cases = {"Q": True, "Q.": True, ".": True, "QRSTUVWXYZ": True, "QRSTU.WXYZZ": False, "q": False,
             "Q7": False, "": False, " Q": False, "Q-R": False, "Q\n": False, None: False}
    rows = spark.createDataFrame([(t,) for t in cases], "t string")
    for r in rows.select("t", is_stock_symbol(F.col("t")).alias("ok")).collect():
        assert r.ok == cases[r.t], r.t
