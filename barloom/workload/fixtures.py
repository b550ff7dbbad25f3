"""Market data derived from whole driver tables; ``SQL`` holds the same for the oracle.

Line items become bars (one ticker per brand), suppliers splits, events option bars and
intraday stock bars, and parts ticker records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import use_utc


class Fixtures:
    """Derived inputs of one data folder, each built lazily on request."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = use_utc(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def bars_raw(self) -> DataFrame:
        """Daily bars as landed: one per brand and ship date, stamped 04:00Z in nanoseconds."""
        line = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
        parts = self.table("part").select("p_partkey", "p_brand")
        price = F.col("l_extendedprice") / F.col("l_quantity")
        order = F.struct(*line)
        return (
            self.table("lineitem")
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("p_brand", "l_shipdate")
            .agg(
                F.sum("l_quantity").cast("long").alias("volume"),
                F.min_by(price, order).alias("open"),
                F.max_by(price, order).alias("close"),
                F.max(price).alias("high"),
                F.min(price).alias("low"),
                F.count("*").alias("transactions"),
            )
            .select(
                self._letter(F.substring("p_brand", 7, 10).cast("int") - 1).alias("ticker"),
                "volume", "open", "close", "high", "low",
                ((F.unix_micros(F.col("l_shipdate").cast("timestamp")) + 14_400_000_000) * 1000)
                .alias("window_start"),
                "transactions",
            )
        )

    @staticmethod
    def _letter(index) -> F.Column:
        return F.concat(F.lit("TK"), F.char(F.lit(65) + index))

    def splits_raw(self) -> DataFrame:
        """Splits as landed: a forward split and its reverse 30 days later per supplier pair,
        with zero ratios (every 29th) and exact copies (every 7th)."""
        pair = F.call_function("div", F.col("k"), F.lit(2))
        ratio = F.lit(2.0) + pair % 3
        rows = self.table("supplier").select(F.col("s_suppkey").alias("k")).select(
            "k",
            F.concat(F.lit("S"), F.col("k")).alias("id"),
            self._letter((pair % 20).cast("int")).alias("ticker"),
            F.date_add(
                F.to_date(F.lit("1996-01-01")),
                ((pair * 97) % 1800 + (F.col("k") % 2) * 30).cast("int"),
            ).alias("execution_date"),
            F.when(F.col("k") % 29 == 0, 0.0)
            .when(F.col("k") % 2 == 1, ratio)
            .otherwise(1.0)
            .alias("split_from"),
            F.when(F.col("k") % 2 == 1, 1.0).otherwise(ratio).alias("split_to"),
        )
        return rows.unionByName(rows.filter(F.col("k") % 7 == 0)).drop("k")

    def options_raw(self) -> DataFrame:
        """Option bars as landed, a tenth of them with a broken symbol."""
        e = F.col("event_id")
        symbol = F.concat(
            F.when(e % 23 == 0, "").otherwise("O:"),
            self._letter((F.col("user_id") % 25).cast("int")),
            F.when(e % 11 == 0, "1").otherwise(""),
            F.date_format(F.date_add(F.to_date("ts"), 30), "yyMMdd"),
            F.when(e % 17 == 0, "X").when(e % 2 == 0, "C").otherwise("P"),
            F.lpad(F.floor(F.col("value") * 1000 + 0.5).cast("string"), 8, "0"),
        )
        day = F.unix_micros(F.date_trunc("day", F.col("ts").cast("timestamp")))
        return self.table("events").select(
            symbol.alias("ticker"),
            (e % 500).alias("volume"),
            F.col("value").alias("open"),
            F.col("value").alias("close"),
            (F.col("value") * 1.02).alias("high"),
            (F.col("value") * 0.99).alias("low"),
            (day * 1000 + 14_400_000_000_000).alias("window_start"),
            (e % 50).alias("transactions"),
        )

    def ticks_raw(self) -> DataFrame:
        """Intraday stock bars as landed, one per event, on few dates (one file each)."""
        e = F.col("event_id")
        millis = F.call_function("div", F.unix_micros(F.col("ts").cast("timestamp")), F.lit(1000))
        return self.table("events").select(
            self._letter((F.col("user_id") % 25).cast("int")).alias("ticker"),
            (e % 500).alias("volume"),
            F.col("value").alias("open"),
            F.col("value").alias("close"),
            (F.col("value") * 1.02).alias("high"),
            (F.col("value") * 0.99).alias("low"),
            (millis * 1_000_000).alias("window_start"),
            (e % 50).alias("transactions"),
        )

    def tickers_raw(self) -> DataFrame:
        """Ticker records as landed, some with a bad symbol, no activity or no valid time."""
        k = F.col("p_partkey")
        second = F.char(F.lit(65) + (F.call_function("div", k, F.lit(26)) % 26).cast("int"))
        symbol = (
            F.when(k % 13 == 0, F.concat(F.lit("tk"), k))
            .when(k % 11 == 0, "TOOLONGTICKER")
            .otherwise(F.concat(self._letter((k % 26).cast("int")), F.lit("."), second))
        )
        updated = F.when(k % 9 == 0, "not-a-date").otherwise(
            F.concat(
                F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z")
            )
        )
        null = F.lit(None).cast("string")
        return self.table("part").select(
            symbol.alias("ticker"),
            F.col("p_name").alias("name"),
            F.lit("stocks").alias("market"),
            F.lit("us").alias("locale"),
            F.when(F.col("p_size") % 2 == 0, "NASDAQ").otherwise("NYSE").alias("primary_exchange"),
            F.lit("CS").alias("type"),
            F.when(F.col("p_size") % 7 != 0, F.col("p_size") % 3 != 0).alias("active"),
            F.lit("usd").alias("currency_name"),
            null.alias("currency_symbol"),
            null.alias("cik"),
            null.alias("composite_figi"),
            null.alias("share_class_figi"),
            updated.alias("last_updated_utc"),
            null.alias("delisted_utc"),
        )

    def bad_bars(self, bars: DataFrame) -> DataFrame:
        """Bars with swapped high and low, negative volume and missing open."""
        swapped = F.col("transactions") % 5 == 0
        return bars.select(
            "ticker", "window_start",
            F.when(F.col("volume") % 13 == 0, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
            F.when(F.col("volume") % 17 != 0, F.col("open")).alias("open"),
            "close",
            F.when(swapped, F.col("low")).otherwise(F.col("high")).alias("high"),
            F.when(swapped, F.col("high")).otherwise(F.col("low")).alias("low"),
            "transactions",
        )

    def reference_prices(self, adjusted: DataFrame) -> DataFrame:
        """A vendor series: 0.05 % off (passes), 0.2 % for some tickers (fails), none for others."""
        letter = F.ascii(F.substring("ticker", 3, 1))
        return adjusted.filter(letter % 7 != 0).select(
            "ticker",
            F.to_date("window_start").alias("date"),
            (F.col("close") * F.when(letter % 5 == 0, 1.002).otherwise(1.0005)).alias("close"),
        )


# The same inputs for the oracle, as common table expressions.
SQL = {
    "bars_raw": """
select 'TK'||chr((64+cast(substr(p_brand,7) as int))::int) as ticker,
  cast(sum(l_quantity) as bigint) as volume,
  min_by(l_extendedprice/l_quantity, row(l_orderkey,l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity)) as open,
  max_by(l_extendedprice/l_quantity, row(l_orderkey,l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity)) as close,
  max(l_extendedprice/l_quantity) as high, min(l_extendedprice/l_quantity) as low,
  (epoch_us(l_shipdate)+14400000000)*1000 as window_start, count(*) as transactions
from lineitem join part on l_partkey=p_partkey group by p_brand, l_shipdate""",
    "bars": """
select ticker, make_timestamp(window_start//1000) as window_start, volume, open, close, high, low,
  transactions from bars_raw""",
    "splits_raw": """
select id, ticker, execution_date, split_from, split_to from (
  select s_suppkey as k, 'S'||s_suppkey as id, 'TK'||chr((65+(s_suppkey//2)%20)::int) as ticker,
    date '1996-01-01'+cast(((s_suppkey//2)*97)%1800+(s_suppkey%2)*30 as int) as execution_date,
    case when s_suppkey%29=0 then 0.0::double when s_suppkey%2=1 then (2+(s_suppkey//2)%3)::double else 1.0::double end as split_from,
    case when s_suppkey%2=1 then 1.0::double else (2+(s_suppkey//2)%3)::double end as split_to
  from supplier) t, lateral (select unnest(case when k%7=0 then [1,2] else [1] end) as copy)""",
    "splits": """
select distinct id, ticker, execution_date, split_from, split_to, split_to/split_from as split_factor
from splits_raw where split_from>0 and split_to>0""",
    "options_raw": """
select case when event_id%23=0 then '' else 'O:' end||'TK'||chr((65+user_id%25)::int)
  ||case when event_id%11=0 then '1' else '' end||strftime(ts+interval 30 day,'%y%m%d')
  ||case when event_id%17=0 then 'X' when event_id%2=0 then 'C' else 'P' end
  ||lpad(cast(cast(floor(value*1000+0.5) as bigint) as varchar),8,'0') as ticker,
  event_id%500 as volume, value as open, value as close, value*1.02 as high, value*0.99 as low,
  epoch_us(date_trunc('day',ts))*1000+14400000000000 as window_start, event_id%50 as transactions
from events""",
    "ticks": """
select 'TK'||chr((65+user_id%25)::int) as ticker, date_trunc('millisecond',ts) as window_start,
  event_id%500 as volume, value as open, value as close, value*1.02 as high, value*0.99 as low,
  event_id%50 as transactions from events""",
    "options": """
select replace(ticker,'O:','') as ticker,
  regexp_replace(upper(substr(ticker,3,length(ticker)-17)),'[^A-Z]','','g') as underlying_symbol,
  try_strptime('20'||substr(ticker,length(ticker)-14,6),'%Y%m%d')::date as expiration_date,
  substr(ticker,length(ticker)-8,1) as option_type, cast(right(ticker,8) as int)/1000.0::double as strike_price,
  make_timestamp(window_start//1000) as window_start, volume, open, close, high, low, transactions
from options_raw where regexp_matches(ticker,'^O:.+[0-9]{6}[CP][0-9]{8}$')
  and regexp_replace(upper(substr(ticker,3,length(ticker)-17)),'[^A-Z]','','g')<>''
  and try_strptime('20'||substr(ticker,length(ticker)-14,6),'%Y%m%d') is not null""",
    "tickers_raw": """
select case when p_partkey%13=0 then 'tk'||p_partkey when p_partkey%11=0 then 'TOOLONGTICKER'
    else 'TK'||chr((65+p_partkey%26)::int)||'.'||chr((65+(p_partkey//26)%26)::int) end as ticker,
  p_name as name, 'stocks' as market, 'us' as locale,
  case when p_size%2=0 then 'NASDAQ' else 'NYSE' end as primary_exchange, 'CS' as type,
  case when p_size%7=0 then null else p_size%3<>0 end as active, 'usd' as currency_name,
  case when p_partkey%9=0 then 'not-a-date'
    else '2024-01-'||lpad(cast(1+p_partkey%28 as varchar),2,'0')||'T00:00:00Z' end as last_updated_utc
from part""",
    "tickers": """
select ticker, name, market, locale, primary_exchange, type, active, currency_name,
  try_strptime(last_updated_utc,'%Y-%m-%dT%H:%M:%SZ') as last_updated_utc
from tickers_raw where regexp_full_match(ticker,'[A-Z.]{1,10}')""",
    "bad_bars": """
select ticker, window_start, case when volume%13=0 then -volume else volume end as volume,
  case when volume%17<>0 then open end as open, close,
  case when transactions%5=0 then low else high end as high,
  case when transactions%5=0 then high else low end as low, transactions
from bars""",
    "factors": """
select b.ticker, b.window_start, coalesce(product(s.split_factor),1.0) as cumulative_factor
from bars b left join splits s on s.ticker=b.ticker and s.execution_date>=b.window_start::date
group by b.ticker, b.window_start""",
    "adjusted": """
select b.ticker, b.window_start, b.volume, b.open/f.cumulative_factor as open, b.close/f.cumulative_factor as close,
  b.high/f.cumulative_factor as high, b.low/f.cumulative_factor as low, b.transactions, f.cumulative_factor
from bars b join factors f using (ticker, window_start)""",
    "stored": """
select ticker, window_start, volume, open::float::double as open, close::float::double as close,
  high::float::double as high, low::float::double as low, transactions from bars""",
    "stored_adjusted": """
select b.ticker, b.window_start, b.volume, (b.open/f.cumulative_factor)::float::double as open,
  (b.close/f.cumulative_factor)::float::double as close, (b.high/f.cumulative_factor)::float::double as high,
  (b.low/f.cumulative_factor)::float::double as low, b.transactions, f.cumulative_factor
from stored b join factors f using (ticker, window_start)""",
    "check_dates": """
select distinct ticker, execution_date+cast(d as int) as date
from splits, lateral (select unnest([-30,-1,0,1]) as d)""",
    "reference_prices": """
select ticker, window_start::date as date,
  close*case when ascii(substr(ticker,3,1))%5=0 then 1.002 else 1.0005 end as close
from adjusted where ascii(substr(ticker,3,1))%7<>0""",
    "checks": """
select c.ticker, c.date, a.close as our_price, r.close as reference_price,
  abs((a.close-r.close)/r.close*100) as diff_percent,
  case when a.close is null or r.close is null then 'error'
    when abs((a.close-r.close)/r.close*100)<=0.1 then 'pass' else 'fail' end as status
from check_dates c left join adjusted a on a.ticker=c.ticker and a.window_start::date=c.date
  left join reference_prices r on r.ticker=c.ticker and r.date=c.date""",
}

# Which inputs an input is made of.
NEEDS = {
    "bars": ["bars_raw"],
    "splits": ["splits_raw"],
    "options": ["options_raw"],
    "tickers": ["tickers_raw"],
    "bad_bars": ["bars"],
    "factors": ["bars", "splits"],
    "adjusted": ["bars", "factors"],
    "stored": ["bars"],
    "stored_adjusted": ["stored", "factors"],
    "check_dates": ["splits"],
    "reference_prices": ["adjusted"],
    "checks": ["check_dates", "adjusted", "reference_prices"],
}


def with_inputs(query: str, *inputs: str) -> str:
    """``query`` preceded by the common table expressions it reads."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in inputs:
        add(name)
    ctes = ",\n".join(f"{name} as materialized ({SQL[name]})" for name in ordered)
    return f"with {ctes}\n{query}" if ordered else query
