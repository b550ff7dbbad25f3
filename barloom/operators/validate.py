"""Data-quality rules as column expressions: all rows are checked in one narrow pass.

A rule has a condition, a stable code for counting and a message for people. Messages are
built for failing rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.symbols import is_stock_symbol
from barloom.schemas import PRICES

ERRORS_TYPE = "array<struct<rule:string,message:string>>"


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a failing row; null counts as passing."""

    broken: Column
    code: str
    message: Column

    def error(self) -> Column:
        return F.struct(F.lit(self.code).alias("rule"), self.message.alias("message"))


@dataclass(frozen=True)
class Rules:
    """``required`` rules come first; where one of them fails ``further`` is not looked at."""

    required: tuple[Rule, ...]
    further: tuple[Rule, ...]

    def guarded(self) -> list[tuple[Column, Rule]]:
        """All rules with the condition under which they fail for a row."""
        if not self.required:
            return [(r.broken, r) for r in self.further]
        complete = ~_any(self.required)
        return [(r.broken, r) for r in self.required] + [
            (complete & r.broken, r) for r in self.further
        ]


def _any(rules: tuple[Rule, ...]) -> Column:
    return F.coalesce(reduce(or_, [r.broken for r in rules]), F.lit(False))


def _rule(broken: Column, code: str, *message: Column | str) -> Rule:
    text = [
        F.lit(m) if isinstance(m, str) else F.coalesce(m.cast("string"), F.lit("None"))
        for m in message
    ]
    return Rule(broken, code, F.concat(*text))


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def required(name: str) -> Rule:
    return _rule(F.col(name).isNull(), f"missing {name}", f"Missing required field: {name}")


def non_empty(name: str) -> Rule:
    return _rule(F.col(name).cast("string") == "", f"empty {name}", f"Invalid {name}: ", F.col(name))


def numeric(name: str) -> Rule:
    bad = F.col(name).isNotNull() & _number(name).isNull()
    return _rule(bad, f"{name} not numeric", f"{name} must be numeric, got ", F.col(name))


def positive(name: str) -> Rule:
    return _rule(
        _number(name) <= 0, f"{name} not positive", f"{name} must be positive, got ", _number(name)
    )


def non_negative(name: str) -> Rule:
    return _rule(
        _number(name) < 0, f"{name} negative", f"{name} must be non-negative, got ", _number(name)
    )


def not_nan(name: str) -> Rule:
    return _rule(F.isnan(_number(name)), f"{name} is NaN", f"{name} must be a number, got NaN")


def finite(name: str) -> Rule:
    return _rule(
        F.abs(_number(name)) == float("inf"), f"{name} not finite", f"{name} must be finite, got ", _number(name)
    )


def ordered(greater: str, smaller: str, greater_first: bool = True) -> Rule:
    """``greater`` >= ``smaller``, checked if all four prices are numbers; NaN passes."""
    g, s = _number(greater), _number(smaller)
    comparable = F.lit(True)
    for name in PRICES:
        comparable = comparable & _number(name).isNotNull()
    first, sign, second = (greater, ">=", smaller) if greater_first else (smaller, "<=", greater)
    return _rule(
        comparable & ~F.isnan(g) & ~F.isnan(s) & (g < s),
        f"{first} {sign} {second}",
        f"{first} (",
        _number(first),
        f") must be {sign} {second} (",
        _number(second),
        ")",
    )


def price_order() -> tuple[Rule, ...]:
    return (
        ordered("high", "low"),
        ordered("high", "open"),
        ordered("high", "close"),
        ordered("open", "low", greater_first=False),
        ordered("close", "low", greater_first=False),
    )


def one_of(name: str, values: Sequence[str]) -> Rule:
    quoted = " or ".join(f"'{v}'" for v in values)
    return _rule(
        ~F.col(name).isin(*values), f"{name} unknown", f"{name} must be {quoted}, got ", F.col(name)
    )


def stock_rules() -> Rules:
    fields = ("ticker", "window_start", "volume", *PRICES)
    return Rules(
        tuple(required(f) for f in fields),
        (
            non_empty("ticker"),
            *[rule(p) for p in PRICES for rule in (positive, numeric, not_nan, finite)],
            non_negative("volume"),
            numeric("volume"),
            *price_order(),
        ),
    )


def option_rules(ticker_column: str = "ticker") -> Rules:
    fields = (
        ticker_column, "underlying_symbol", "expiration_date", "option_type", "strike_price",
        "window_start",
    )
    return Rules(
        tuple(required(f) for f in fields),
        (
            non_empty(ticker_column),
            non_empty("underlying_symbol"),
            one_of("option_type", ("C", "P")),
            positive("strike_price"),
            numeric("strike_price"),
            *[rule(p) for p in PRICES for rule in (non_negative, numeric, not_nan, finite)],
            *price_order(),
        ),
    )


def split_rules() -> Rules:
    return Rules((), (positive("split_from"), positive("split_to")))


def ticker_rules(column: str = "ticker") -> Rules:
    return Rules(
        (), (_rule(~is_stock_symbol(F.col(column)), f"{column} malformed", f"Invalid {column}: ", F.col(column)),)
    )


def _errors(rules: Rules) -> Column:
    """The failed rules of a row, null if there are none.

    Conditions are tested in generated code; only failing rows reach the array functions.
    """

    def failed(which: tuple[Rule, ...]) -> Column:
        return F.array_compact(F.array(*[F.when(r.broken, r.error()) for r in which]))

    errors = F.when(_any(rules.further), failed(rules.further))
    if rules.required:
        errors = F.when(_any(rules.required), failed(rules.required)).otherwise(errors)
    return errors


def validate(df: DataFrame, rules: Rules, column: str = "errors") -> DataFrame:
    """Add the array of failed rules; it is empty for a valid row."""
    return df.withColumn(column, F.coalesce(_errors(rules), F.array().cast(ERRORS_TYPE)))


def violations(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per failed rule: the input columns, ``rule`` and ``message``."""
    return df.select(*df.columns, F.inline(_errors(rules)).alias("rule", "message"))


def violation_summary(df: DataFrame, rules: Rules) -> DataFrame:
    """Failed rows per rule, counted without making a row per failure."""
    guarded = rules.guarded()
    counts = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, (broken, _) in enumerate(guarded)])
    pairs = [
        F.struct(F.lit(r.code).alias("rule"), F.col(f"c{i}").alias("row_count"))
        for i, (_, r) in enumerate(guarded)
    ]
    return counts.select(F.inline(F.array(*pairs))).filter("row_count > 0")
