"""Option contract symbols: ``O:<root><YYMMDD><C|P><strike in thousandths, 8 digits>``.

All fields but the root have a fixed width, so they are cut from the right end and only
the shape is checked with a regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the symbol grammar.
PREFIX = "O:"
MIN_LENGTH = 18
TAIL_LENGTH = 15
TAIL_SHAPE = r"\A[0-9]{6}[CP][0-9]{8}\z"

# Fixed value: 1 to 10 upper-case letters or dots.
STOCK_SYMBOL_SHAPE = r"\A[\p{Lu}.]{1,10}\z"


def option_root(symbol: Column) -> Column:
    """Letters A-Z between the prefix and the fixed-width tail; null if there are none."""
    raw = F.substring(symbol, F.lit(len(PREFIX) + 1), F.length(symbol) - len(PREFIX) - TAIL_LENGTH)
    return F.nullif(F.regexp_replace(F.upper(raw), "[^A-Z]", ""), F.lit(""))


def option_tail(symbol: Column) -> Column:
    """Date, type and strike as they stand in the symbol; null if they are malformed."""
    tail = F.substring(symbol, -TAIL_LENGTH, TAIL_LENGTH)
    shaped = symbol.startswith(PREFIX) & (F.length(symbol) >= MIN_LENGTH) & tail.rlike(TAIL_SHAPE)
    return F.when(shaped, tail)


def tail_expiry(tail: Column) -> Column:
    """The date of this century, null if there is no such day."""
    parts = [F.substring(tail, 1, 2), F.substring(tail, 3, 2), F.substring(tail, 5, 2)]
    return F.concat(F.lit("20"), parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2]).try_cast("date")


def tail_type(tail: Column) -> Column:
    return F.substring(tail, 7, 1)


def tail_strike(tail: Column) -> Column:
    return F.substring(tail, 8, 8).try_cast("int") / F.lit(1000.0)


def option_underlying(symbol: Column) -> Column:
    """Only the underlying; the date, type and strike are not looked at."""
    return F.when(
        symbol.startswith(PREFIX) & (F.length(symbol) >= MIN_LENGTH), option_root(symbol)
    )


def strip_prefix(symbol: Column) -> Column:
    """Remove every ``O:``."""
    return F.replace(symbol, F.lit(PREFIX), F.lit(""))


def is_stock_symbol(symbol: Column) -> Column:
    return F.coalesce(symbol.rlike(STOCK_SYMBOL_SHAPE), F.lit(False))
