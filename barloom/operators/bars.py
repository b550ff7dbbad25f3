"""Operators on bar tables: typing, deduplication, dates, replacement, statistics, sampling."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.times import ns_to_ts
from barloom.plans.sizing import broadcast_if_small
from barloom.session import materialize


def typed_bars(df: DataFrame) -> DataFrame:
    """Landed bars (nanosecond epoch) with ``window_start`` as timestamp."""
    return df.withColumn("window_start", ns_to_ts(F.col("window_start")))


def dedupe_bars(df: DataFrame, keys: tuple[str, ...] = ("ticker", "window_start")) -> DataFrame:
    """One bar per key; of several the smallest in column order, so that reruns agree.

    Keys that occur more than once are found by a hash aggregate over the keys alone; only
    their rows are compared. Picking the smallest row of every key would sort all bars
    twice, and nearly all of them are single. A key's copies are merged before the shuffle,
    so any number of them stays harmless. Null is a key value like any other.
    """
    rest = [c for c in df.columns if c not in keys]
    names = {k: f"_dup_{k}" for k in keys}
    several = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    several = materialize(several.select(*[F.col(k).alias(n) for k, n in names.items()]), "copies")
    if several.isEmpty():
        return df
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    several = broadcast_if_small(several)
    copies = df.join(several, same, "left_semi")
    picked = copies.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("bar"))
    picked = picked.select(*[F.col(c) if c in keys else F.col(f"bar.{c}") for c in df.columns])
    return df.join(several, same, "left_anti").unionByName(picked)


def loaded_dates(df: DataFrame, column: str = "window_start") -> DataFrame:
    """Distinct UTC dates of a table as column ``date``."""
    return df.select(F.to_date(column).alias("date")).distinct()


def replace_keys(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` without the keys that ``new`` holds, plus ``new``."""
    dropped = broadcast_if_small(new.select(*keys).distinct())
    return existing.join(dropped, keys, "left_anti").unionByName(new.select(existing.columns))


def table_stats(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Row count and first/last date per table; ``tables`` maps name -> (frame, date column)."""

    def one(name: str, df: DataFrame, column: str | None) -> DataFrame:
        date = F.col(column).cast("timestamp") if column else F.lit(None).cast("timestamp")
        return df.agg(
            F.count("*").alias("row_count"),
            F.min(date).alias("min_date"),
            F.max(date).alias("max_date"),
        ).select(F.lit(name).alias("table_name"), "row_count", "min_date", "max_date")

    return reduce(DataFrame.unionByName, [one(n, df, c) for n, (df, c) in tables.items()])


def sample_keys(df: DataFrame, n: int, seed: int = 0, key: str = "ticker") -> DataFrame:
    """``n`` distinct keys chosen by hash: the same seed gives the same sample."""
    ranked = F.md5(F.concat(F.col(key), F.lit(f"#{seed}")).cast("binary"))
    return df.select(key).distinct().orderBy(ranked, key).limit(n)
