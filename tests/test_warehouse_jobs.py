import datetime as dt
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barloom.jobs import rebuild, update
from barloom.jobs.ingest import ingest_missing, load_dates, rejected_rows
from barloom.operators.checks import CheckFailure
from barloom.schemas import REFERENCE_PRICES, SPLITS_FEED, TABLES, TICKERS_FEED
from barloom.sources import feeds, flatfiles
from barloom.sources.warehouse import Warehouse
from barloom.streaming.ingest import ingest_stream

D = dt.date
HEADER = "ticker,volume,open,close,high,low,window_start,transactions"
DAYS = [D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5), D(2024, 1, 8)]


def ns(day, hour=5):
    stamp = dt.datetime.combine(day, dt.time(hour), dt.timezone.utc)
    return int(stamp.timestamp()) * 10**9


def land(root: Path, day, lines, header=HEADER):
    path = root / f"{day:%Y/%m/%Y-%m-%d}.csv.gz"
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def stock_lines(day, price=100.0):
    return [
        f"{t},{10 + i},{price},{price + i},{price + 5},{price - 5},{ns(day)},{3 + i}"
        for i, t in enumerate(("AAA", "BBB", "TRUE"))
    ]


def option_lines(day):
    return [
        f"O:AAA240119C00100000,5,1.0,1.5,2.0,0.5,{ns(day)},2",
        f"O:BBB1240119P00050500,7.0,1.0,1.5,2.0,0.5,{ns(day)},3",
        f"BAD,5,1.0,1.5,2.0,0.5,{ns(day)},2",
    ]


@pytest.fixture
def stocks(tmp_path):
    for i, day in enumerate(DAYS):
        land(tmp_path / "stocks", day, stock_lines(day, 100.0 + i))
    return tmp_path / "stocks"


@pytest.fixture
def options(tmp_path):
    for day in DAYS:
        land(tmp_path / "options", day, option_lines(day))
    return tmp_path / "options"


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def test_files(spark, stocks):
    root = str(stocks)
    land(stocks, D(2023, 12, 29), [])
    (stocks / "notes.csv.gz").write_bytes(gzip.compress(b"x\n"))
    (stocks / "readme.txt").write_text("x")
    assert flatfiles.list_files(spark, root).count() == 7
    assert [r.date for r in flatfiles.available_dates(spark, root, D(2024, 1, 3), D(2024, 1, 5)).collect()] == DAYS[1:4]
    assert tuple(flatfiles.date_range(spark, root).first()) == (D(2023, 12, 29), D(2024, 1, 8))
    counts = {r.path.rsplit("/", 1)[1]: r.row_count for r in flatfiles.rows_per_file(spark, root).collect()}
    assert counts["2024-01-02.csv.gz"] == 3 and counts["2023-12-29.csv.gz"] == 0
    files = flatfiles.list_files(spark, root)
    assert flatfiles.new_files(files, files.limit(3)).count() == 4
    assert flatfiles.list_files(spark, root + "/none").count() == 0
    assert tuple(flatfiles.date_range(spark, root + "/none").first()) == (None, None)
    assert flatfiles.read_bars(spark, root, DAYS[:2]).count() == 6
    assert flatfiles.read_bars(spark, root, [D(1999, 1, 1)]).count() == 0
    assert {r.ticker for r in flatfiles.read_bars(spark, root, DAYS[:1]).collect()} == {"AAA", "BBB", "TRUE"}


def test_ingest_is_incremental_and_idempotent(spark, stocks, wh):
    assert wh.scan("stocks_raw").count() == 0
    assert load_dates(wh, "stocks", str(stocks), DAYS[:2])["rows"] == 6
    got = ingest_missing(wh, "stocks", str(stocks))
    assert got == {"files_processed": 3, "errors": 0, "rows": 9, "parse_errors": 0, "bad_rows": 0}
    assert ingest_missing(wh, "stocks", str(stocks))["files_processed"] == 0
    before = sorted(wh.scan("stocks_raw").collect())
    assert len(before) == 15 and wh.scan("stocks_raw").schema == TABLES["stocks_raw"].schema
    load_dates(wh, "stocks", str(stocks), DAYS[1:4])
    assert sorted(wh.scan("stocks_raw").collect()) == before
    assert sorted(r.date for r in wh.loaded_dates("stocks_raw").collect()) == DAYS


def test_bars_after_midnight_stay_with_their_file(spark, tmp_path, wh):
    """A file's late bars fall on the next UTC date and must not replace that date's file."""
    root = tmp_path / "late"
    for day in DAYS[:2]:
        land(root, day, [f"AAA,1,1,1,1,1,{ns(day)},1", f"AAA,2,1,1,1,1,{ns(day + dt.timedelta(days=1), 1)},1"])
    load_dates(wh, "stocks", str(root), DAYS[:1])
    assert ingest_missing(wh, "stocks", str(root))["files_processed"] == 1
    load_dates(wh, "stocks", str(root), DAYS[:1])
    assert wh.scan("stocks_raw").count() == 4
    assert wh.scan("stocks_raw", start=DAYS[1], end=DAYS[1]).count() == 2


def test_bad_rows_and_files(spark, stocks, wh):
    land(stocks, D(2024, 1, 9), [*stock_lines(D(2024, 1, 9)), "AAA,x,1,1,1,1,5,1", f"AAA,-5,1,1,1,1,{ns(DAYS[0])},1", "AAA,1"])
    got = load_dates(wh, "stocks", str(stocks), [D(2024, 1, 9)])
    assert (got["rows"], got["bad_rows"], got["errors"]) == (3, 3, 0)
    assert rejected_rows(wh, "stocks", str(stocks)).filter("reject = 'row'").count() == 3
    whole = land(stocks, D(2024, 1, 10), stock_lines(D(2024, 1, 10)) * 2000)
    whole.write_bytes(whole.read_bytes()[:-200])
    land(stocks, D(2024, 1, 11), ["1,2"], header="volume,ticker")
    got = ingest_missing(wh, "stocks", str(stocks))
    assert (got["files_processed"], got["errors"], got["rows"]) == (5, 2, 15)
    assert wh.scan("stocks_raw").count() == 18
    broken = flatfiles.unreadable_files(spark, [str(p) for p in stocks.rglob("*.gz")])
    assert {p.rsplit("/", 1)[1]: why for p, why in broken.items()} == {
        "2024-01-10.csv.gz": "damaged", "2024-01-11.csv.gz": "header",
    }
    # Refused files are not tried again until they change.
    again = ingest_missing(wh, "stocks", str(stocks))
    assert (again["files_processed"], again["errors"]) == (0, 0)
    land(stocks, D(2024, 1, 10), stock_lines(D(2024, 1, 10)) * 3)
    assert ingest_missing(wh, "stocks", str(stocks))["rows"] == 9


def test_quoted_header_beside_a_damaged_file(spark, tmp_path, wh):
    root = tmp_path / "quoted"
    land(root, DAYS[0], stock_lines(DAYS[0]), header=",".join(f'"{c}"' for c in HEADER.split(",")))
    cut = land(root, DAYS[1], stock_lines(DAYS[1]) * 2000)
    cut.write_bytes(cut.read_bytes()[:-200])
    got = ingest_missing(wh, "stocks", str(root))
    assert (got["files_processed"], got["errors"], got["rows"]) == (1, 1, 3)


def test_columns_in_another_order(spark, tmp_path, wh):
    root = tmp_path / "ordered"
    land(root, DAYS[0], stock_lines(DAYS[0]))
    land(root, DAYS[1], [f"{ns(DAYS[1])},x,AAA,7,1.5,2.5,3.5,0.5,2", f"{ns(DAYS[1])},x,BBB,seven,1,1,1,1,1"],
         header="window_start,note,ticker,volume,open,close,high,low,transactions")
    got = ingest_missing(wh, "stocks", str(root))
    assert (got["files_processed"], got["errors"], got["rows"], got["bad_rows"]) == (2, 0, 4, 1)
    row = wh.scan("stocks_raw", "AAA", DAYS[1], DAYS[1]).first()
    assert (row.volume, row.open, row.close, row.high, row.low, row.transactions) == (7, 1.5, 2.5, 3.5, 0.5, 2)


def test_counts_that_are_no_counts(spark, tmp_path, wh):
    root = tmp_path / "counts"
    bad = [f"BAD,{v},1,1,1,1,{ns(DAYS[0])},1" for v in ("NaN", "1e300", "Infinity", "-Infinity")]
    land(root, DAYS[0], [*stock_lines(DAYS[0]), *bad, f"OK,,1,1,1,1,{ns(DAYS[0])},1"])
    land(root, DAYS[1], stock_lines(DAYS[1]))
    got = ingest_missing(wh, "stocks", str(root))
    assert (got["files_processed"], got["errors"], got["rows"], got["bad_rows"]) == (2, 0, 7, 4)


def test_reload_replaces_the_whole_source(spark, tmp_path, wh):
    root, day = tmp_path / "reload", DAYS[0]
    late = ns(day + dt.timedelta(days=1), 1)
    land(root, day, [f"AAA,1,1,1,1,1,{ns(day)},1", f"AAA,2,1,1,1,1,{late},1"])
    land(root, DAYS[1], stock_lines(DAYS[1]))
    load_dates(wh, "stocks", str(root))
    land(root, day, [f"AAA,5,1,1,1,1,{ns(day)},1"])
    load_dates(wh, "stocks", str(root), [day])
    assert [r.volume for r in wh.scan("stocks_raw", "AAA").orderBy("window_start").collect()] == [5, 10]
    land(root, day, [f"AAA,-1,1,1,1,1,{ns(day)},1"])
    load_dates(wh, "stocks", str(root), [day])  # all rows are rejected
    assert wh.scan("stocks_raw").count() == 3


def test_batch_and_stream_do_not_double(spark, options, tmp_path, wh):
    run = lambda: ingest_stream(wh, "options", str(options), str(tmp_path / "cp"), 2).awaitTermination()
    load_dates(wh, "options", str(options), DAYS[:2])
    run()
    assert wh.scan("options").count() == 10
    load_dates(wh, "options", str(options), DAYS)
    assert wh.scan("options").count() == 10


def test_versions(spark, wh, stocks):
    load_dates(wh, "stocks", str(stocks))
    raw = wh.scan("stocks_raw")
    for _ in range(3):
        wh.write(raw, "stocks_adjusted", "overwrite")
    root = Path(wh.root) / "stocks_adjusted"
    # A version without a marker is one that a lost job left.
    (root / "v00004").mkdir()
    assert wh.scan("stocks_adjusted").count() == 15
    assert wh._next("stocks_adjusted").endswith("v00005")
    assert wh.drop_old_versions("stocks_adjusted") == ["v00001"]
    assert not (root / "v00001").exists() and wh.scan("stocks_adjusted").count() == 15


def test_options_ingest(spark, options, wh):
    got = ingest_missing(wh, "options", str(options))
    assert got == {"files_processed": 5, "errors": 0, "rows": 10, "parse_errors": 5, "bad_rows": 0}
    one = wh.scan("options", underlying_symbol="BBB", start=DAYS[0], end=DAYS[0]).first()
    assert (one.ticker, one.expiration_date, one.option_type, one.strike_price, one.volume) == (
        "BBB1240119P00050500", D(2024, 1, 19), "P", 50.5, 7,
    )
    assert wh.scan("options", ticker="AAA240119C00100000").count() == 5
    assert rejected_rows(wh, "options", str(options), DAYS[:1]).first().reject == "symbol"


def test_scan_bounds(spark, wh, stocks):
    load_dates(wh, "stocks", str(stocks))
    scan = lambda **k: wh.scan("stocks_raw", **k).count()
    assert scan(start=DAYS[1], end=DAYS[1]) == 3
    assert scan(ticker="TRUE", start=DAYS[1]) == 4
    assert scan(end=DAYS[1]) == 6
    assert scan(start=dt.datetime(2024, 1, 3, 5), end=dt.datetime(2024, 1, 3, 5)) == 3
    assert scan(start=dt.datetime(2024, 1, 3, 6), end=dt.datetime(2024, 1, 4, 4)) == 0
    aware = dt.datetime(2024, 1, 3, 6, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    assert scan(start=aware, end=aware) == 3


def test_overwrite_reads_its_own_table(spark, wh, stocks):
    load_dates(wh, "stocks", str(stocks))
    raw = wh.scan("stocks_raw")
    wh.write(raw, "stocks_adjusted", "overwrite")
    doubled = wh.scan("stocks_adjusted").withColumn("close", F.col("close") * 2)
    wh.write(doubled, "stocks_adjusted", "overwrite")
    assert wh.scan("stocks_adjusted").count() == 15
    assert wh.scan("stocks_adjusted", "AAA", DAYS[0], DAYS[0]).first().close == 200.0
    wh.write(raw.limit(1), "stocks_adjusted", "append")
    assert wh.scan("stocks_adjusted").count() == 16
    with pytest.raises(ValueError):
        wh.write(raw, "stocks_adjusted", "merge")
    with pytest.raises(ValueError):
        wh.write(raw, "stocks_adjusted", "replace")


def test_stream_equals_batch(spark, stocks, tmp_path, wh):
    load_dates(wh, "stocks", str(stocks), DAYS[:3])
    streamed = Warehouse(spark, str(tmp_path / "streamed"))
    run = lambda: ingest_stream(streamed, "stocks", str(stocks), str(tmp_path / "cp"), 2).awaitTermination()
    run()
    run()
    load_dates(wh, "stocks", str(stocks), DAYS[3:])
    assert sorted(streamed.scan("stocks_raw").collect()) == sorted(wh.scan("stocks_raw").collect())
    land(stocks, D(2024, 1, 1), stock_lines(D(2024, 1, 1)))
    run()
    assert streamed.scan("stocks_raw").count() == 18
    assert D(2024, 1, 1) in {r.date for r in streamed.loaded_dates("stocks_raw").collect()}


def make_feeds(spark, stocks, options, off=1.0, holidays=()):
    splits = spark.createDataFrame(
        [("s1", "AAA", DAYS[3], 1.0, 4.0), ("s1", "AAA", DAYS[3], 1.0, 4.0), ("s2", "BBB", D(2020, 1, 1), 1.0, 2.0),
         ("s3", "BBB", DAYS[3], 0.0, 2.0)],
        SPLITS_FEED,
    )
    none = [None] * 8
    tickers = spark.createDataFrame(
        [("AAA", "A corp", "stocks", "us", "NASDAQ", "CS", True, *none[:5], "2024-01-01T00:00:00Z", None),
         ("bbb", "B corp", "stocks", "us", "NYSE", "CS", False, *none[:5], None, None)],
        TICKERS_FEED,
    )
    reference = spark.createDataFrame(
        [("AAA", d, None, None, None, (100.0 + i) / (4 if d <= DAYS[3] else 1) * off, None, None) for i, d in enumerate(DAYS)],
        REFERENCE_PRICES,
    )
    closed = spark.createDataFrame([(d,) for d in holidays], "date date")
    return update.Feeds(str(stocks), str(options), splits, tickers, reference, closed)


def test_daily_update(spark, stocks, options, wh):
    feeds_ = make_feeds(spark, stocks, options)
    report = update.daily_update(wh, feeds_, as_of=D(2024, 1, 31))
    assert report["stocks"]["rows"] == 15 and report["options"]["rows"] == 10
    assert report["splits"] == 1 and report["adjusted"] == 15 and report["technical"] == 15
    assert report["tickers"] == 1
    assert report["checks"] == {"tickers_checked": 1, "dates_checked": 2, "passed": 2, "failed": 0, "errors": 2}
    assert report["tables"] == {
        "stocks_raw": 15, "stocks_adjusted": 15, "stocks_technical": 15, "splits": 1, "options": 10, "tickers": 1,
    }
    again = update.daily_update(wh, feeds_, as_of=D(2024, 1, 31))
    assert again["tables"] == report["tables"] and again["stocks"]["files_processed"] == 0
    land(stocks, D(2024, 1, 9), stock_lines(D(2024, 1, 9), 105.0))
    ready = update.new_data_ready(wh, str(stocks), str(options), D(2024, 1, 31))
    assert ready.count() == 0
    land(options, D(2024, 1, 9), option_lines(D(2024, 1, 9)))
    ready = update.new_data_ready(wh, str(stocks), str(options), D(2024, 1, 31))
    assert [r.date for r in ready.collect()] == [D(2024, 1, 9)]
    assert update.daily_update(wh, feeds_, as_of=D(2024, 1, 31))["tables"]["stocks_technical"] == 18
    wh.register_views()
    top = spark.sql("select underlying_symbol, count(*) as n from options group by 1 order by 2 desc, 1 limit 1").first()
    assert tuple(top) == ("AAA", 6)
    with pytest.raises(CheckFailure):
        update.verify(wh, make_feeds(spark, stocks, options, off=1.01).reference_prices, as_of=D(2024, 1, 31))


def test_gap_filling(spark, stocks, wh):
    load_dates(wh, "stocks", str(stocks), [DAYS[0], DAYS[4]])
    holidays = spark.createDataFrame([(DAYS[2],)], "date date")
    assert update.fill_gaps(wh, str(stocks), holidays) == {"gaps_found": 2, "dates_filled": 2, "raw_rows_added": 6}
    assert update.fill_gaps(wh, str(stocks), holidays)["gaps_found"] == 0
    assert update.fill_gaps(wh, str(stocks)) == {"gaps_found": 1, "dates_filled": 1, "raw_rows_added": 3}
    assert wh.scan("stocks_adjusted").count() == wh.scan("stocks_technical").count() == 15


def test_one_ticker_jobs(spark, stocks, options, wh):
    load_dates(wh, "stocks", str(stocks))
    feeds_ = make_feeds(spark, stocks, options)
    assert rebuild.recalculate_adjusted(wh) == 15
    assert rebuild.sync_splits(wh, feeds_.splits, "AAA") == 1
    assert rebuild.sync_splits(wh, feeds_.splits, "ZZZ") == 0
    assert rebuild.recalculate_adjusted(wh, ["AAA"]) == 15
    assert wh.scan("stocks_adjusted", "AAA", DAYS[0], DAYS[0]).first().close == 25.0
    assert wh.scan("stocks_adjusted", "BBB", DAYS[0], DAYS[0]).first().close == 101.0
    assert rebuild.recalculate_adjusted(wh, ["ZZZ"]) == 0


def test_empty_warehouse(spark, wh, stocks, options):
    feeds_ = make_feeds(spark, stocks, options)
    assert rebuild.sync_splits(wh, feeds_.splits) == 0
    assert rebuild.recalculate_adjusted(wh) == 0 and rebuild.recalculate_technical(wh) == 0
    assert wh.stats().count() == 0
    for table, spec in TABLES.items():
        assert wh.scan(table).schema == spec.schema and wh.scan(table).count() == 0


def test_feeds(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"id":"1","ticker":"TRUE","execution_date":"2024-01-02","split_from":1,"split_to":4}\n')
    row = feeds.read_splits(spark, str(tmp_path / "s.json")).first()
    assert (row.id, row.ticker, row.execution_date, row.split_to) == ("1", "TRUE", D(2024, 1, 2), 4.0)
    (tmp_path / "t.json").write_text('{"ticker":"A","active":true,"last_updated_utc":"2024-01-02T00:00:00Z"}\n')
    assert feeds.read_tickers(spark, str(tmp_path / "t.json")).first().active is True
    (tmp_path / "p.csv").write_text("ticker,date,open,high,low,close,volume,transactions\nA,2024-01-02,1,2,1,1.5,10,\n")
    row = feeds.read_reference_prices(spark, str(tmp_path / "p.csv"), "csv").first()
    assert (row.date, row.close, row.transactions) == (D(2024, 1, 2), 1.5, None)


def files_of(wh, table):
    """Names of the files that the current version is made of, by bucket."""
    out = {}
    for folder in wh.folders(table):
        for path in (Path(wh.root) / table / folder).rglob("*.parquet"):
            bucket = next(int(p.split("=")[1]) for p in path.parts if p.startswith("ticker_bucket="))
            out.setdefault(bucket, set()).add(str(path))
    return out


def many_bars(spark, n=40):
    rows = [(f"T{k:02d}", dt.datetime(2021 + k % 3, 1 + d, 4, 4), 10, 1.0 * k, 1.0 * k, 1.0 * k, 1.0 * k, 1) for k in range(n) for d in range(3)]
    return spark.createDataFrame(rows, "ticker string, window_start timestamp, volume long, open double, close double, high double, low double, transactions long")


def test_replacing_tickers_leaves_other_buckets_alone(spark, wh):
    bars = many_bars(spark)
    wh.write(bars, "stocks_adjusted", "overwrite")
    before, old = files_of(wh, "stocks_adjusted"), wh.scan("stocks_adjusted")
    new = bars.filter("ticker in ('T03', 'T07', 'T08')").withColumn("close", F.col("close") + 100)
    # Rows of tickers that are not named do not come in.
    touched = wh.replace_tickers(new, "stocks_adjusted", ["T03", "T07", "GONE"])
    after = files_of(wh, "stocks_adjusted")
    assert 0 < len(touched) <= 3
    assert {b: f for b, f in before.items() if b not in touched} == {b: f for b, f in after.items() if b not in touched}
    assert all(not before[b] & after[b] for b in touched if b in before)
    got = {(r.ticker, r.close) for r in wh.scan("stocks_adjusted").collect()}
    assert got == {(f"T{k:02d}", k + (100.0 if k in (3, 7) else 0.0)) for k in range(40)}
    assert old.filter("close >= 100").count() == 0, "readers of the version before go on with it"
    assert wh.scan("stocks_adjusted").count() == 120


def test_after_a_replacement(spark, wh):
    """Appending, replacing again, removing a ticker, and dropping versions whose folders are still used."""
    bars = many_bars(spark)
    wh.write(bars, "stocks_adjusted", "append")
    wh.replace_tickers(bars.filter("ticker = 'T01'").limit(1), "stocks_adjusted", ["T01"])
    later = bars.filter("ticker in ('T01', 'T02')").withColumn("window_start", F.expr("window_start + interval 5 years"))
    wh.write(later, "stocks_adjusted", "append")
    assert wh.scan("stocks_adjusted", "T01").count() == 4 and wh.scan("stocks_adjusted", "T02").count() == 6
    wh.replace_tickers(bars.limit(0), "stocks_adjusted", ["T02"])
    assert wh.scan("stocks_adjusted", "T02").count() == 0
    count = wh.scan("stocks_adjusted").count()
    assert count == 118 + 3 - 3
    assert wh.drop_old_versions("stocks_adjusted", keep=1) == ["v00001", "v00002", "v00003"]
    assert wh.scan("stocks_adjusted").count() == count
    wh.write(bars, "stocks_adjusted", "overwrite")
    wh.drop_old_versions("stocks_adjusted", keep=1)
    names = {p.name for p in (Path(wh.root) / "stocks_adjusted").iterdir() if p.name.startswith("v")}
    assert len(names) == 1 and wh.scan("stocks_adjusted").count() == 120
    assert wh.replace_tickers(bars, "stocks_adjusted", []) == []
    with pytest.raises(ValueError):
        wh.replace_tickers(bars, "stocks_raw", ["T01"])


def test_replacing_in_an_absent_table(spark, wh):
    bars = many_bars(spark, 4)
    wh.replace_tickers(bars, "stocks_adjusted", ["T01", "T02"])
    assert wh.scan("stocks_adjusted").count() == 6
    wh.replace_tickers(bars.limit(0), "stocks_adjusted", ["T01", "T02"])
    assert wh.exists("stocks_adjusted") and wh.scan("stocks_adjusted").count() == 0


def test_a_ticker_reads_its_bucket_only(spark, wh):
    wh.write(many_bars(spark), "stocks_adjusted", "overwrite")
    read = {f.split("ticker_bucket=")[1].split("/")[0] for f in wh.scan("stocks_adjusted", "T05").select("ticker", F.input_file_name().alias("f")).toPandas().f}
    assert len(read) == 1
    plan = wh.scan("stocks_adjusted", "T05", D(2023, 1, 1))._jdf.queryExecution().toString().split("PartitionFilters")[1]
    assert "ticker_bucket" in plan and "trade_year" in plan


def test_directly_written_bars_keep_their_dates(spark, wh):
    wh.write(many_bars(spark), "stocks_raw", "append")
    days = {r.date for r in wh.loaded_dates("stocks_raw").collect()}
    assert days == {D(2021 + y, m, 4) for y in range(3) for m in (1, 2, 3)}
    assert wh.scan("stocks_raw", start=D(2022, 2, 3), end=D(2022, 2, 5)).count() == 13
    assert len(list((Path(wh.root) / "stocks_raw" / "v00001").glob("source=direct/trade_date=*"))) == 9


def test_splits_of_one_ticker(spark, wh):
    wh.write(many_bars(spark), "stocks_raw", "append")
    feed = spark.createDataFrame([("a", "T01", D(2022, 5, 1), 1.0, 2.0), ("b", "T02", D(2022, 6, 1), 1.0, 3.0), ("c", "T03", D(2022, 6, 1), 1.0, 3.0)], SPLITS_FEED)
    rebuild.sync_splits(wh, feed)
    before = files_of(wh, "splits")
    assert rebuild.sync_splits(wh, feed.withColumn("split_to", F.lit(5.0)), "T02") == 1
    after = files_of(wh, "splits")
    assert sum(before[b] == after[b] for b in before) == len(before) - 1
    assert {r.ticker: r.split_to for r in wh.scan("splits").collect()} == {"T01": 2.0, "T02": 5.0, "T03": 3.0}
