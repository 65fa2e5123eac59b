"""Symbols that name an instrument only for part of the time.

``intervals(instrument_id, start_date, end_date, symbol, seq)`` holds what was
inserted, in ``seq`` order. For an instrument and a date the interval with the
latest start at or before the date decides: its symbol when the date is before its
end, else nothing, even where an older interval still runs. Among equal starts the
last inserted wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.operators.joins import lookup_join, measured, stored
from tickloom.schemas import index_column

INTERVALS_PER_PROBE = 32
SHORT_DAYS = 90
INTERVAL_COLUMNS = ("instrument_id", "start_date", "end_date", "symbol", "seq")


def normal_intervals(intervals: DataFrame) -> DataFrame:
    """Disjoint intervals that give the deciding rule by a plain range test.

    Duplicates collapse map-side, so a window holds at most one row per day and
    instrument. The next start is taken before empty intervals are dropped since
    those still shadow older ones.
    """
    one = intervals.groupBy("instrument_id", "start_date").agg(
        F.max(F.struct("seq", "end_date", "symbol")).alias("v"))
    order = W.partitionBy("instrument_id").orderBy("start_date")
    return (
        one.select("instrument_id", "start_date", F.col("v.end_date").alias("end_date"),
                   F.col("v.symbol").alias("symbol"),
                   F.lead("start_date").over(order).alias("next_start"))
        .select("instrument_id", "start_date", F.least("end_date", "next_start").alias("end_date"), "symbol")
        .where(F.col("start_date") < F.col("end_date"))
    )


def _between(left: str, right: str) -> Column:
    return (F.col(f"{left}._day") >= F.col(f"{right}._from")) & (F.col(f"{left}._day") < F.col(f"{right}._to"))


def _quarter(day: Column) -> Column:
    return (F.year(day) * 4 + F.quarter(day)).cast("int")


def resolve(df: DataFrame, intervals: DataFrame, date: Column | str, id_column: str = "instrument_id",
            symbol_column: str = "symbol", normalised: bool = False, split: bool | None = None,
            **options) -> DataFrame:
    """``df`` with the symbol of each row as its last column; NULL where unresolved.

    The interval table is broadcast only after its size is measured; beyond that
    the join is shuffled and hot instruments are salted.

    A row meets every interval of its instrument, so where some instrument has many
    (``split``, by default counted) the short ones are joined by instrument and
    quarter and only the few long ones by instrument alone. Intervals are disjoint,
    hence at most one of the two joins finds a symbol.
    """
    table = intervals if normalised else save(intervals)
    table = table.select(F.col("instrument_id").alias(id_column), F.col("start_date").alias("_from"),
                         F.col("end_date").alias("_to"), F.col("symbol").alias(symbol_column))
    day = F.col(date) if isinstance(date, str) else date
    left = df.drop(symbol_column).withColumn("_day", day)
    size = None
    if split is None:
        size, most = measured(table, id_column)
        split = most > INTERVALS_PER_PROBE
    if not split:
        out = lookup_join(left, table, [id_column], _between, "left", size=size, **options)
        return out.drop("_day", "_from", "_to")
    short = F.datediff("_to", "_from") < SHORT_DAYS
    by_quarter = table.where(short).select("*", F.explode(F.sequence(
        _quarter(F.col("_from")), _quarter(F.date_sub("_to", 1)))).alias("_q"))
    found = lookup_join(left.withColumn("_q", _quarter(F.col("_day"))), by_quarter, [id_column, "_q"],
                        _between, "left", **options).drop("_q", "_from", "_to")
    found = found.withColumnRenamed(symbol_column, "_short")
    out = lookup_join(found, table.where(~short), [id_column], _between, "left", count_on=left, **options)
    keep = [c for c in df.columns if c != symbol_column]
    return out.select(*keep, F.coalesce("_short", symbol_column).alias(symbol_column))


def add_symbol(df: DataFrame, intervals: DataFrame, **options) -> DataFrame:
    """Symbol by the UTC date of the index time."""
    return resolve(df, intervals, times.utc_date(F.col(index_column(df.columns))), **options)


def save(intervals: DataFrame) -> DataFrame:
    """Disjoint intervals written once to the shared folder, to be passed on with
    ``normalised=True``."""
    return stored(normal_intervals(intervals), "intervals")


def insert(intervals: DataFrame, more: DataFrame, clear_existing: bool = False) -> DataFrame:
    """Append (later than all present rows) or replace."""
    if clear_existing:
        return more.select(*INTERVAL_COLUMNS)
    last = intervals.agg(F.max("seq")).first()[0]
    shifted = more.withColumn("seq", F.col("seq") + F.lit(0 if last is None else last + 1))
    return intervals.select(*INTERVAL_COLUMNS).unionByName(shifted.select(*INTERVAL_COLUMNS))


def symbol_map(intervals: DataFrame) -> DataFrame:
    """Per instrument the ordered list of its intervals (one per start date)."""
    one = intervals.groupBy("instrument_id", "start_date").agg(
        F.max(F.struct("seq", "end_date", "symbol")).alias("v"))
    return one.groupBy("instrument_id").agg(F.sort_array(F.collect_list(
        F.struct("start_date", F.col("v.end_date").alias("end_date"), F.col("v.symbol").alias("symbol"))
    )).alias("intervals"))


def clip(intervals: DataFrame, start, end) -> DataFrame:
    """Parts of the intervals inside ``[start, end)``."""
    low, high = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    return (
        intervals.where((F.col("start_date") < high) & (F.col("end_date") > low))
        .withColumn("start_date", F.greatest("start_date", low))
        .withColumn("end_date", F.least("end_date", high))
        .where(F.col("start_date") < F.col("end_date"))
    )


def inverse_rows(requests: DataFrame, intervals: DataFrame, start, end, normalised: bool = False) -> DataFrame:
    """``(symbol, d0, d1, s)`` rows for the requested symbols within ``[start, end)``."""
    table = intervals if normalised else normal_intervals(intervals)
    cut = clip(table, start, end).select(
        "symbol", F.col("start_date").alias("d0"), F.col("end_date").alias("d1"),
        F.col("instrument_id").cast("string").alias("s"))
    names = requests.select("symbol").distinct()
    return lookup_join(cut, names, ["symbol"], how="left_semi")


def resolution_status(requests: DataFrame, rows: DataFrame, start, end) -> DataFrame:
    """Covered days and ``ok`` / ``partial`` / ``not_found`` per requested symbol.

    Overlapping parts count once: each adds only the days past the furthest end
    seen so far.
    """
    spans = rows.groupBy("symbol", "d0").agg(F.max("d1").alias("d1"))
    seen = W.partitionBy("symbol").orderBy("d0").rowsBetween(W.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.datediff(
        "d1", F.greatest(F.col("d0"), F.coalesce(F.max("d1").over(seen), F.col("d0")))))
    covered = (
        spans.select("symbol", fresh.alias("days"))
        .groupBy("symbol").agg(F.sum("days").cast("bigint").alias("covered_days"))
    )
    total = F.datediff(F.lit(str(end)).cast("date"), F.lit(str(start)).cast("date"))
    joined = requests.select("symbol").distinct().join(covered, "symbol", "left")
    days = F.coalesce("covered_days", F.lit(0)).cast("bigint")
    return joined.select(
        "symbol", days.alias("covered_days"),
        F.when(days == 0, "not_found").when(days < total, "partial").otherwise("ok").alias("status"))


def overall_status(status: DataFrame) -> DataFrame:
    """The worst outcome of all symbols, with the partial and missing counts."""
    return status.agg(
        F.sum((F.col("status") == "partial").cast("bigint")).alias("n_partial"),
        F.sum((F.col("status") == "not_found").cast("bigint")).alias("n_not_found"),
        F.count(F.lit(1)).alias("n_symbols"),
    ).withColumn("status", F.when(F.col("n_not_found") > 0, "not_found")
                 .when(F.col("n_partial") > 0, "partial").otherwise("ok"))


def inverse_lists(requests: DataFrame, intervals: DataFrame, start, end, normalised: bool = False) -> DataFrame:
    """Per requested symbol its list of ``{d0, d1, s}`` and its status."""
    rows = inverse_rows(requests, intervals, start, end, normalised)
    lists = rows.groupBy("symbol").agg(F.sort_array(F.collect_set(F.struct("d0", "d1", "s"))).alias("result"))
    return resolution_status(requests, rows, start, end).join(lists, "symbol", "left")


def not_found(requests: DataFrame, rows: DataFrame) -> DataFrame:
    return requests.select("symbol").distinct().join(rows.select("symbol").distinct(), "symbol", "left_anti")
