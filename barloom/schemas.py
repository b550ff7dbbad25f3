"""Table schemas, layouts and the schema of the landed CSV files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The names of all columns below are those that users of the tables rely on.


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_S, _TS, _D = T.StringType(), T.TimestampType(), T.DateType()
_L, _F, _DBL, _B = T.LongType(), T.FloatType(), T.DoubleType(), T.BooleanType()

PRICES = ("open", "close", "high", "low")

STOCK_BARS = _schema(
    ticker=_S, window_start=_TS, volume=_L, open=_F, close=_F, high=_F, low=_F, transactions=_L
)
TECHNICAL = _schema(
    ticker=_S, window_start=_TS, sma_20=_F, sma_50=_F, sma_200=_F, volume_sma_20=_DBL, atr=_F
)
SPLITS = _schema(id=_S, ticker=_S, execution_date=_D, split_from=_F, split_to=_F, split_factor=_DBL)
OPTIONS = _schema(
    ticker=_S,
    underlying_symbol=_S,
    expiration_date=_D,
    option_type=_S,
    strike_price=_F,
    window_start=_TS,
    volume=_L,
    open=_F,
    close=_F,
    high=_F,
    low=_F,
    transactions=_L,
)
TICKERS = _schema(
    ticker=_S,
    name=_S,
    market=_S,
    locale=_S,
    primary_exchange=_S,
    type=_S,
    active=_B,
    currency_name=_S,
    currency_symbol=_S,
    cik=_S,
    composite_figi=_S,
    share_class_figi=_S,
    last_updated_utc=_TS,
    delisted_utc=_TS,
)

# Landed files. Volume may be written with a fraction, so it is read as a double.
BARS_CSV = _schema(
    ticker=_S, volume=_DBL, open=_DBL, close=_DBL, high=_DBL, low=_DBL, window_start=_L,
    transactions=_L,
)
CORRUPT = "_corrupt_record"
LANDED_CSV = T.StructType([*BARS_CSV, T.StructField(CORRUPT, _S)])

# Vendor extracts as they are landed (times are ISO-8601 text).
SPLITS_FEED = _schema(id=_S, ticker=_S, execution_date=_D, split_from=_DBL, split_to=_DBL)
TICKERS_FEED = T.StructType(
    [
        T.StructField(f.name, _S if isinstance(f.dataType, T.TimestampType) else f.dataType)
        for f in TICKERS
    ]
)
REFERENCE_PRICES = _schema(
    ticker=_S, date=_D, open=_DBL, high=_DBL, low=_DBL, close=_DBL, volume=_L, transactions=_L
)

#: Buckets of the ticker in tables laid out by ticker; fixed for the life of a warehouse.
BUCKETS = 16


def ticker_bucket(ticker: Column) -> Column:
    return F.pmod(F.xxhash64(ticker), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class Table:
    """Schema and layout of one warehouse table."""

    schema: T.StructType
    sort_keys: tuple[str, ...] = ()
    date_column: str | None = None
    # "day": partitions (source, trade_date); "year": (ticker_bucket, trade_year);
    # "bucket": ticker_bucket; None: unpartitioned
    grain: str | None = None
    default_mode: str = "overwrite"
    # Columns kept in double precision beside the schema's, for jobs that go on from them: name -> source.
    exact: tuple[tuple[str, str], ...] = ()
    # Columns that scans look up by equality: their files hold Bloom filters.
    lookups: tuple[str, ...] = ()

    @property
    def partition_columns(self) -> tuple[str, ...]:
        by_ticker = {"year": ("ticker_bucket", "trade_year"), "bucket": ("ticker_bucket",)}
        return {"day": ("source", "trade_date"), **by_ticker}.get(self.grain, ())

    @property
    def bucketed(self) -> bool:
        return "ticker_bucket" in self.partition_columns

    @property
    def stored_schema(self) -> T.StructType:
        types = {"source": _S, "ticker_bucket": T.IntegerType()}
        layout = [T.StructField(n, types.get(n, _D)) for n in self.partition_columns]
        exact = [T.StructField(n, _DBL) for n, _ in self.exact]
        return T.StructType([*self.schema, *exact, *layout])

    def rows(self, df: DataFrame) -> DataFrame:
        """``df`` cast to the schema, with the exact columns (from their source where ``df`` lacks them)."""
        exact = [F.col(n if n in df.columns else source).cast("double").alias(n) for n, source in self.exact]
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema], *exact)


TABLES: dict[str, Table] = {
    "stocks_raw": Table(
        STOCK_BARS, ("ticker", "window_start"), "window_start", "day", "append", lookups=("ticker",)
    ),
    "stocks_adjusted": Table(
        STOCK_BARS, ("ticker", "window_start"), "window_start", "year", "append", lookups=("ticker",)
    ),
    "stocks_technical": Table(
        TECHNICAL, ("ticker", "window_start"), "window_start", "year", exact=(("atr_exact", "atr"),), lookups=("ticker",)
    ),
    "splits": Table(SPLITS, date_column="execution_date", grain="bucket"),
    "options": Table(
        OPTIONS, ("underlying_symbol", "window_start"), "window_start", "day", "append", lookups=("ticker", "underlying_symbol")
    ),
    "tickers": Table(TICKERS),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order and cast them; a missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
