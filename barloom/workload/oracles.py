"""DuckDB SQL with the results that the queries must give."""

from __future__ import annotations

from barloom.workload.fixtures import with_inputs

ORACLES: dict[str, str] = {}

_BAR_PRICES = ("open", "close", "high", "low")


def _add(name: str, query: str, *inputs: str) -> None:
    ORACLES[name] = with_inputs(query, *inputs)


def _r2(x: str, name: str | None = None) -> str:
    return f"round({x}+1e-5,2) as {name or x}"


def _r4(x: str, name: str | None = None) -> str:
    return f"round({x}+1e-7,4) as {name or x}"


def _r6(x: str, name: str | None = None) -> str:
    return f"round({x}+1e-9,6) as {name or x}"


def _day(x: str, name: str | None = None) -> str:
    return f"strftime({x},'%Y-%m-%d') as {name or x}"


def _stamp(x: str, name: str | None = None) -> str:
    return f"strftime({x},'%Y-%m-%d %H:%M:%S') as {name or x}"


_WHEN = _stamp("window_start")
_OHLC4 = ", ".join(_r4(p) for p in _BAR_PRICES)
_OHLC6 = ", ".join(_r6(p) for p in _BAR_PRICES)
_STORED4 = ", ".join(_r4(f"{p}::float::double", p) for p in _BAR_PRICES)

_add("daily_bars", f"select ticker, {_WHEN}, volume, {_OHLC6}, transactions from bars", "bars")
# The copies differ from their original by a larger volume or not at all.
_add("deduped_bars", f"select ticker, {_WHEN}, volume, {_OHLC6}, transactions from bars", "bars")
_add(
    "split_intervals",
    f"""select ticker, {_day('lag(execution_date) over w', 'after')}, {_day('execution_date', 'upto')},
  {_r6('product(step) over (partition by ticker order by execution_date rows between current row and unbounded following)', 'cumulative_factor')}
from (select ticker, execution_date, product(split_factor) as step from splits group by all)
window w as (partition by ticker order by execution_date)""",
    "splits",
)
_add(
    "adjusted_bars",
    f"select ticker, {_WHEN}, volume, {_OHLC4}, transactions, {_r6('cumulative_factor')} from adjusted",
    "adjusted",
)
_add(
    "splits_per_ticker",
    f"""select ticker, count(*) as split_count, {_day('min(execution_date)', 'first_split_date')},
  {_day('max(execution_date)', 'last_split_date')} from splits group by ticker""",
    "splits",
)
_add(
    "splits_for_ticker",
    f"""select id, ticker, {_day('execution_date')}, {_r6('split_factor')} from splits
where ticker='TKC' and execution_date between date '1996-01-01' and date '2000-12-31'""",
    "splits",
)
_add(
    "splits_dedup",
    f"select id, ticker, {_day('execution_date')}, split_from, split_to, {_r6('split_factor')} from splits",
    "splits",
)
_add(
    "split_rejects",
    f"""select distinct id, ticker, {_day('execution_date')}, split_from, split_to from splits_raw
where not (split_from>0 and split_to>0)""",
    "splits_raw",
)
_add(
    "split_labels",
    """select id, cast(split_from as bigint)||':'||cast(split_to as bigint)||' ('
  ||case when split_to>split_from then 'forward' else 'reverse' end||' split)' as label from splits_raw""",
    "splits_raw",
)
_add(
    "replace_ticker_splits",
    f"""select id, ticker, {_day('execution_date')}, {_r6('split_factor')} from splits where ticker<>'TKA'
union all select id||'-new', ticker, {_day('execution_date+1', 'execution_date')}, {_r6('split_factor')}
from splits where ticker='TKA'""",
    "splits",
)


def _sma(column: str, n: int) -> str:
    frame = f"over (partition by ticker order by window_start rows between {n} preceding and 1 preceding)"
    return f"case when count({column}) {frame}={n} then avg({column}) {frame} end"


_add(
    "sma_lagged",
    f"""select ticker, {_WHEN}, {_r6(_sma('close', 20), 'sma_20')}, {_r6(_sma('close', 50), 'sma_50')},
  {_r6(_sma('close', 200), 'sma_200')} from adjusted""",
    "adjusted",
)
_add(
    "volume_sma",
    f"select ticker, {_WHEN}, {_r4(_sma('volume', 20), 'volume_sma_20')} from adjusted",
    "adjusted",
)
# The recurrence step by step: the mean of the first fourteen ranges, then each range's share.
_RANGES = """ranges as materialized (select ticker, window_start, row_number() over w-1 as pos,
    greatest(high-low, abs(high-lag(close) over w), abs(low-lag(close) over w)) as tr
  from adjusted window w as (partition by ticker order by window_start)),
wilder as (
  select ticker, 14::bigint as pos, avg(tr) as atr from ranges where pos between 1 and 14 group by ticker having count(*)=14
  union all select r.ticker, r.pos, (13*w.atr+r.tr)/14 from wilder w join ranges r on r.ticker=w.ticker and r.pos=w.pos+1)"""


def _wilder(query: str, prices: str = "adjusted") -> str:
    inputs = with_inputs("", prices).rstrip().replace("with ", "with recursive ", 1)
    return f"{inputs},\n{_RANGES.replace('from adjusted', f'from {prices}')}\n{query}"


ORACLES["atr_wilder"] = _wilder(
    f"""select r.ticker, {_stamp('r.window_start', 'window_start')}, {_r6('w.atr', 'atr')}
from ranges r left join wilder w on w.ticker=r.ticker and w.pos=r.pos-1"""
)
_add(
    "indicators_extreme",
    f"""select ticker, {_WHEN}, round(log10({_sma('x', 20)}),6) as sma_20, round(log10({_sma('x', 50)}),6) as sma_50
from (select ticker, window_start, case when volume%97<>0 and volume%89<>0
  then close*case when quarter(window_start)%2=0 then 1e12 else 1e-12 end end as x from bars)""",
    "bars",
)

_add(
    "options_parsed",
    f"""select ticker, underlying_symbol, {_day('expiration_date')}, option_type, {_r6('strike_price')},
  {_WHEN}, volume, {_OHLC6}, transactions from options""",
    "options",
)
_add(
    "options_rejects",
    """select ticker, window_start, volume from options_raw
where not (regexp_matches(ticker,'^O:.+[0-9]{6}[CP][0-9]{8}$')
  and try_strptime('20'||substr(ticker,length(ticker)-14,6),'%Y%m%d') is not null)""",
    "options_raw",
)
_add(
    "option_underlyings",
    """select case when length(ticker)>=18 and ticker like 'O:%' then
    nullif(regexp_replace(upper(substr(ticker,3,length(ticker)-17)),'[^A-Z]','','g'),'') end as underlying_symbol,
  count(*) as row_count from options_raw group by 1""",
    "options_raw",
)
_add(
    "option_volume_top10",
    f"""select {_day('expiration_date')}, total_volume from (
  select expiration_date, cast(sum(volume) as bigint) as total_volume from options
  where underlying_symbol='TKA' group by expiration_date order by total_volume desc, expiration_date limit 10)""",
    "options",
)
_CONTRACTS = """select underlying_symbol, count(*) as contract_count from options
group by underlying_symbol order by contract_count desc, underlying_symbol limit 10"""
_add("contracts_by_underlying", _CONTRACTS, "options")
_add("contracts_by_underlying_sql", _CONTRACTS, "options")
_add("strike_labels", "select ticker, printf('$%.2f',strike_price) as label from options", "options")

_add(
    "ticker_clean",
    f"""select ticker, name, market, locale, primary_exchange, type, active, currency_name,
  {_stamp('last_updated_utc')} from tickers""",
    "tickers",
)
_add(
    "ticker_rejects",
    "select ticker, name from tickers_raw where not regexp_full_match(ticker,'[A-Z.]{1,10}')",
    "tickers_raw",
)
_add(
    "active_nasdaq",
    "select ticker, name, primary_exchange from tickers where active and primary_exchange='NASDAQ'",
    "tickers",
)

# (rule, condition, message) as the validation reports them.
_ORDER_RULES = [
    ("high >= low", "high<low"),
    ("high >= open", "high<open"),
    ("high >= close", "high<close"),
    ("low <= open", "low>open"),
    ("low <= close", "low>close"),
]
_COMPLETE = "open is not null and close is not null and high is not null and low is not null"
_STOCK_FURTHER = [(f"{p} not positive", f"{p}<=0") for p in _BAR_PRICES] + [
    ("volume negative", "volume<0"),
    *[(rule, f"({_COMPLETE}) and {broken}") for rule, broken in _ORDER_RULES],
]
_STOCK_REQUIRED = ("ticker", "window_start", "volume", *_BAR_PRICES)


def _broken_rules(source: str, columns: str) -> str:
    missing = [
        f"select {columns}, 'missing {c}' as rule from {source} where {c} is null" for c in _STOCK_REQUIRED
    ]
    present = " and ".join(f"{c} is not null" for c in _STOCK_REQUIRED)
    further = [
        f"select {columns}, '{rule}' as rule from {source} where {present} and ({broken})"
        for rule, broken in _STOCK_FURTHER
    ]
    return "\nunion all ".join(missing + further)


_add("bar_violations", _broken_rules("bad_bars", f"ticker, {_WHEN}"), "bad_bars")
_add(
    "violation_summary",
    f"select rule, count(*) as row_count from ({_broken_rules('bad_bars', 'ticker')}) group by rule",
    "bad_bars",
)

_OPTION_REQUIRED = ("underlying_symbol", "expiration_date", "option_type", "strike_price")


def _option_violations() -> str:
    rows = """select ticker, make_timestamp(window_start//1000) as window_start,
    case when volume%17<>0 then open end as open, close,
    case when transactions%5=0 then low else high end as high,
    case when transactions%5=0 then high else low end as low,
    regexp_matches(ticker,'^O:.+[0-9]{6}[CP][0-9]{8}$')
      and try_strptime('20'||substr(ticker,length(ticker)-14,6),'%Y%m%d') is not null as ok,
    case when regexp_matches(ticker,'[0-9]{8}$') then cast(right(ticker,8) as int)/1000.0::double end as strike
  from options_raw"""
    missing = [
        f"select ticker, {_WHEN}, 'missing {c}' as rule, 'Missing required field: {c}' as message from o where not ok"
        for c in _OPTION_REQUIRED
    ]
    below = [
        f"select ticker, {_WHEN}, '{p} negative', '{p} must be non-negative, got '||{p} from o where ok and {p}<0"
        for p in _BAR_PRICES
    ]
    zero = f"""select ticker, {_WHEN}, 'strike_price not positive',
  'strike_price must be positive, got '||cast(strike as varchar) from o where ok and strike<=0"""
    order = []
    for rule, broken in _ORDER_RULES:
        first, sign, second = rule.split(" ")
        order.append(
            f"select ticker, {_WHEN}, '{rule}', '{first} ('||{first}||') must be {sign} {second} ('||{second}||')' "
            f"from o where ok and {_COMPLETE} and {broken}"
        )
    return f"with o as ({rows})\n" + "\nunion all ".join([*missing, *below, zero, *order])


ORACLES["option_violations"] = _option_violations().replace(
    "with o as (", with_inputs("", "options_raw").rstrip() + ",\no as (", 1
)
_add(
    "split_violations",
    """select id, 'split_from not positive' as rule, 'split_from must be positive, got '||split_from as message
from splits_raw where split_from<=0""",
    "splits_raw",
)
_add(
    "ticker_violations",
    """select ticker, name, 'ticker malformed' as rule, 'Invalid ticker: '||ticker as message
from tickers_raw where not regexp_full_match(ticker,'[A-Z.]{1,10}')""",
    "tickers_raw",
)
_add(
    "price_differences",
    f"select ticker, {_WHEN}, {_r6('(high-low)/low*100', 'spread')} from bars",
    "bars",
)

_LOADED = "(select distinct window_start::date as date from bars where day(window_start) not in (3,11,19,27))"
_add(
    "missing_dates",
    f"""select {_day('date')} from (select distinct l_shipdate::date as date from lineitem
  except select date from {_LOADED})""",
    "bars",
)
_add(
    "trading_day_gaps",
    f"""select {_day('date')} from (
  select unnest(generate_series(min(date), max(date), interval 1 day))::date as date from {_LOADED})
where dayofweek(date) not in (0,6) and strftime(date,'%m-%d') not in ('01-01','07-04','12-25')
  and date not in (select date from {_LOADED})""",
    "bars",
)
_add(
    "ready_dates",
    f"""select {_day('date')} from (
  select l_shipdate::date as date from lineitem where l_shipdate::date>date '1996-06-01'
  intersect select o_orderdate::date from orders where o_orderdate::date>date '1996-05-01') where year(date)>=1997""",
)
_add(
    "exchange_holidays",
    f"""select distinct {_day('date')} from (
  select unnest([
    case dayofweek(make_date(y,1,1)) when 0 then make_date(y,1,2) else make_date(y,1,1) end,
    case when y>=1998 then make_date(y,1,15)+((8-dayofweek(make_date(y,1,15)))%7)::int end,
    make_date(y,2,15)+((8-dayofweek(make_date(y,2,15)))%7)::int,
    g.friday,
    make_date(y,5,25)+((8-dayofweek(make_date(y,5,25)))%7)::int,
    case dayofweek(make_date(y,7,4)) when 0 then make_date(y,7,5) when 6 then make_date(y,7,3) else make_date(y,7,4) end,
    make_date(y,9,1)+((8-dayofweek(make_date(y,9,1)))%7)::int,
    make_date(y,11,22)+((11-dayofweek(make_date(y,11,22)))%7)::int,
    case dayofweek(make_date(y,12,25)) when 0 then make_date(y,12,26) when 6 then make_date(y,12,24) else make_date(y,12,25) end
  ]) as date
  from (select unnest(generate_series((select year(min(l_shipdate)) from lineitem), (select year(max(l_shipdate)) from lineitem)))::int as y)
  join (values (1991,date '1991-03-29'),(1992,date '1992-04-17'),(1993,date '1993-04-09'),(1994,date '1994-04-01'),(1995,date '1995-04-14'),
    (1996,date '1996-04-05'),(1997,date '1997-03-28'),(1998,date '1998-04-10'),(1999,date '1999-04-02'),(2000,date '2000-04-21'),
    (2001,date '2001-04-13'),(2002,date '2002-03-29'),(2003,date '2003-04-18'),(2004,date '2004-04-09')) g(year,friday) on g.year=y
  union all select date '1994-04-27' where (select year(min(l_shipdate)) from lineitem)<=1994
  union all select unnest([date '2001-09-11',date '2001-09-12',date '2001-09-13',date '2001-09-14'])
    where (select year(max(l_shipdate)) from lineitem)>=2001)
where date is not null""",
)
_add(
    "trading_days",
    f"""select {_day('date')} from (select unnest(generate_series((select min(l_shipdate)::date from lineitem),
  (select max(l_shipdate)::date from lineitem), interval 1 day))::date as date)
where dayofweek(date) not in (0,6) and strftime(date,'%m-%d') not in ('01-01','07-04','12-25')""",
)
_add(
    "times_rejected",
    """select event_id, case event_id%6 when 3 then strftime(date_trunc('day',ts),'%Y-%m-%d %H:%M:%S')
  when 5 then strftime(date_trunc('minute',ts),'%Y-%m-%d %H:%M:%S') end as time from events""",
)
_add("split_check_dates", f"select ticker, {_day('date')} from check_dates", "check_dates")
_add(
    "epoch_times",
    """select event_id, strftime(date_trunc('millisecond',ts),'%Y-%m-%d %H:%M:%S.%f') as from_ns,
  strftime(ts,'%Y-%m-%d %H:%M:%S.%f') as from_ns_micros,
  strftime(date_trunc('millisecond',ts),'%Y-%m-%d %H:%M:%S.%f') as from_ms,
  strftime(date_trunc('second',ts),'%Y-%m-%d %H:%M:%S.%f') as from_iso from events""",
)

_add(
    "price_checks",
    f"""select ticker, {_day('date')}, status, {_r4('our_price')}, {_r4('reference_price')},
  {_r4('diff_percent')} from checks""",
    "checks",
)
_TOTALS = """count(distinct ticker) as tickers_checked, count(*) filter (status<>'error') as dates_checked,
  count(*) filter (status='pass') as passed, count(*) filter (status='fail') as failed,
  count(*) filter (status='error') as errors"""
_add(
    "price_check_summary",
    f"""select ticker, {_TOTALS} from checks group by ticker
union all select 'all', {_TOTALS} from checks""",
    "checks",
)
_add(
    "failed_price_checks",
    f"select ticker, {_day('date')}, {_r4('diff_percent')} from checks where status='fail'",
    "checks",
)
_add(
    "sampled_check_tickers",
    "select ticker from (select distinct ticker from splits) order by md5(ticker||'#7'), ticker limit 5",
    "splits",
)

_STORED = f"select ticker, {_WHEN}, volume, {_STORED4}, transactions from"
_add("csv_ingest", f"{_STORED} ticks", "ticks")
_add("stream_ingest", f"{_STORED} ticks", "ticks")
_add(
    "scan_ticker_range",
    f"{_STORED} bars where ticker='TKB' and window_start::date between date '1997-03-01' and date '1999-06-30'",
    "bars",
)
_add(
    "options_ingest",
    f"""select ticker, underlying_symbol, {_day('expiration_date')}, option_type, {_WHEN}, volume,
  {_STORED4}, transactions from options""",
    "options",
)
for _name, _column in (("scan_contract", "ticker"), ("scan_underlying", "underlying_symbol")):
    _add(
        _name,
        f"""select ticker, underlying_symbol, {_WHEN}, volume, {_STORED4} from options
where {_column}=(select min({_column}) from options)""",
        "options",
    )
_add(
    "options_ingest_rejects",
    """select 'symbol' as reject, count(*) as row_count from options_raw
where not (regexp_matches(ticker,'^O:.+[0-9]{6}[CP][0-9]{8}$')
  and try_strptime('20'||substr(ticker,length(ticker)-14,6),'%Y%m%d') is not null)""",
    "options_raw",
)
_add(
    "rows_per_file",
    f"select {_day('window_start', 'date')}, count(*) as row_count from ticks group by 1",
    "ticks",
)
_add(
    "available_dates",
    f"""select distinct {_day('ts', 'date')} from events
where ts::date between date '2024-01-08' and date '2024-01-21'""",
)
_add(
    "file_date_range",
    f"select {_day('min(ts)', 'first_date')}, {_day('max(ts)', 'last_date')} from events",
)
_add(
    "table_stats",
    f"""select table_name, row_count, {_stamp('min_date')}, {_stamp('max_date')} from (
  select t as table_name, count(*) as row_count, min(window_start) as min_date, max(window_start) as max_date
    from stored, unnest(['stocks_raw','stocks_adjusted','stocks_technical']) as u(t) group by t
  union all select 'splits', count(*), min(execution_date)::timestamp, max(execution_date)::timestamp from splits
  union all select 'options', count(*), min(window_start), max(window_start) from options
  union all select 'tickers', count(*), null, null from tickers)""",
    "stored", "splits", "options", "tickers",
)

_add("rebuild_adjusted", f"{_STORED} stored_adjusted", "stored_adjusted")
_add(
    "replace_ticker_adjusted",
    f"{_STORED} (select * from stored_adjusted where ticker<>'TKC' union all select *, 1.0 from stored where ticker='TKC')",
    "stored_adjusted",
)


def _stored2(x: str, name: str) -> str:
    return f"round(({x})::float::double+1e-5,2) as {name}"


ORACLES["rebuild_technical"] = _wilder(
    f"""select r.ticker, {_stamp('r.window_start', 'window_start')}, {_stored2('a.s20', 'sma_20')}, {_stored2('a.s50', 'sma_50')}, {_stored2('a.s200', 'sma_200')},
  {_stored2('w.atr', 'atr')}, round(a.v20+1e-5,2) as volume_sma_20
from ranges r left join wilder w on w.ticker=r.ticker and w.pos=r.pos-1
join (select ticker, window_start, {_sma('close', 20)} as s20, {_sma('close', 50)} as s50, {_sma('close', 200)} as s200,
  {_sma('volume', 20)} as v20 from stored_adjusted) a on a.ticker=r.ticker and a.window_start=r.window_start""",
    "stored_adjusted",
)
ORACLES["refresh_adjusted"] = ORACLES["rebuild_adjusted"]
ORACLES["refresh_technical"] = ORACLES["rebuild_technical"]
_add(
    "scan_technical_range",
    f"""select ticker, {_WHEN}, {_stored2('s', 'sma_20')} from (
  select ticker, window_start, {_sma('close', 20)} as s from stored_adjusted)
where ticker='TKD' and window_start::date between date '1995-02-01' and date '1997-09-30'""",
    "stored_adjusted",
)
_add(
    "sync_splits",
    f"""select id, ticker, {_day("execution_date+case when ticker='TKB' then 2 else 0 end", 'execution_date')},
  {_r6('split_factor')} from splits""",
    "splits",
)
_add(
    "scan_splits_range",
    f"""select id, ticker, {_day('execution_date')}, {_r6('split_factor')} from splits
where execution_date between date '1997-01-01' and date '1998-12-31'""",
    "splits",
)
_add("scan_active_tickers", "select ticker, name, primary_exchange from tickers where active", "tickers")
_add(
    "views_sql",
    """select ticker, count(*) as bar_count, count(*) filter (cumulative_factor<>1 and
  (close*cumulative_factor)::float<>close::float) as adjusted_count
from stored_adjusted where ticker in (select ticker from splits) group by ticker""",
    "stored_adjusted", "splits",
)
_add(
    "reload_source",
    f"select ticker, {_WHEN}, volume+1 as volume, {_STORED4}, transactions from ticks where transactions%4<>0",
    "ticks",
)
ORACLES["stream_after_batch"] = ORACLES["options_ingest"]
_add("ingest_bad_values", f"{_STORED} ticks where transactions not in (7,8,9)", "ticks")
_add(
    "load_counters",
    """select 'stocks' as kind, count(*) filter (transactions not in (7,8,9)) as good_rows,
  count(*) filter (transactions in (7,8,9)) as bad_rows, 0::bigint as parse_errors from ticks
union all select 'options', (select count(*) from options), 0, (select count(*) from options_raw)-(select count(*) from options)""",
    "ticks", "options",
)
_add(
    "gap_backfill",
    f"""select {_day('d', 'date')}, count(*) as row_count from (select distinct ticker, window_start, window_start::date as d from ticks) t,
  (select min(window_start)::date as a, max(window_start)::date as b from ticks)
where day(d)%3<>0 or d in (a,b) or dayofweek(d) not in (0,6) group by d""",
    "ticks",
)
_add("new_files", f"select distinct {_day('ts', 'date')} from events where day(ts)%2<>0")
_add(
    "feeds_roundtrip",
    f"""select id, s.ticker, {_day('execution_date')}, split_from, split_to, listed from splits_raw s
left join (select substr(ticker,1,3) as ticker, count(*) as listed from tickers_raw group by 1) t on t.ticker=s.ticker""",
    "splits_raw", "tickers_raw",
)
_add(
    "verify_sample",
    """select count(distinct ticker) as tickers_checked, count(*) filter (found and not off) as passed, count(*) filter (found and off) as failed,
  count(*) filter (not found) as errors from (
  select d.ticker, ascii(substr(d.ticker,3,1))%5=0 as off, ascii(substr(d.ticker,3,1))%7<>0 and
      exists(select 1 from bars b where b.ticker=d.ticker and b.window_start::date=d.date) as found from (
    select distinct ticker, execution_date+cast(d as int) as date from splits, lateral (select unnest([-30,-1,0,1]) as d)
    where execution_date between date '1998-06-30'-700 and date '1998-06-30' and ticker in (
      select ticker from (select distinct ticker from splits where execution_date between date '1998-06-30'-700 and date '1998-06-30')
      order by md5(ticker||'#3'), ticker limit 10)) d)""",
    "splits", "bars",
)
_add(
    "daily_update_report",
    """select t as table_name, case when t='stocks_raw' then (select count(*) from ticks)
  when t='splits' then (select count(*) from splits where execution_date+10000>=(select min(window_start)::date from ticks))
  when t='options' then (select count(*) from options)
  when t='tickers' then (select count(*) from tickers)
  else (select count(*) from (select distinct ticker, window_start from ticks)) end as row_count
from unnest(['stocks_raw','stocks_adjusted','stocks_technical','splits','options','tickers']) as u(t)""",
    "ticks", "splits", "options", "tickers",
)
