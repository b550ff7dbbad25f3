"""Times the headline queries; prints one JSON line.

``queries`` are seconds (median of the warm runs). Names are those of ``queries()`` in
``__spark_entry__``, which derive their bars from the driver's tables each time; names that
start with ``tables/`` run one operator over bars that were written as Parquet before.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from barloom.operators import bars, options, splits, technical, validate
from barloom.session import materialize
from barloom.workload.fixtures import Fixtures
from barloom.workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINES = (
    "daily_bars", "adjusted_bars", "sma_lagged", "atr_wilder", "options_parsed", "bar_violations",
    "violation_summary", "price_checks", "splits_per_ticker", "contracts_by_underlying", "csv_ingest",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("barloom-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    job()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        times.append(time.perf_counter() - start)
    return statistics.median(times)


def main() -> None:
    spark = session()
    fx = Fixtures(spark, SF_DIR)
    seconds = {}
    for name in HEADLINES:
        seconds[name] = timed(lambda: run(QUERIES[name](spark, SF_DIR)))
        print(f"{name}: {seconds[name]:.2f}", file=sys.stderr)

    daily = materialize(bars.typed_bars(fx.bars_raw()), "bars")
    split = materialize(splits.prepare_splits(fx.splits_raw())[0], "splits")
    contracts = materialize(bars.typed_bars(fx.options_raw()), "options")
    on_tables = {
        "adjust_prices": lambda: splits.adjust_prices(daily, split),
        "technical_indicators": lambda: technical.technical_indicators(daily),
        "dedupe_bars": lambda: bars.dedupe_bars(daily),
        "parse_option_tickers": lambda: options.parse_option_tickers(contracts),
        "validate": lambda: validate.violations(fx.bad_bars(daily), validate.stock_rules()),
    }
    for name, build in on_tables.items():
        seconds[f"tables/{name}"] = timed(lambda: run(build()))
        print(f"tables/{name}: {seconds[f'tables/{name}']:.2f}", file=sys.stderr)

    print(
        json.dumps(
            {
                "metric": "total of median warm query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
