"""Operators on unbounded input. Each works the same on a bounded frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import flags as fl
from tickloom.functions import prices, times
from tickloom.operators import symbology
from tickloom.operators.bars import KEYS, order_number
from tickloom.operators.filters import record_class


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Adds ``event_time`` with a watermark."""
    return df.withColumn("event_time", times.to_timestamp(F.col(ts))).withWatermark("event_time", delay)


def classes(df: DataFrame, codes: Mapping[str, int], **options) -> DataFrame:
    code = F.col("code") if "code" in df.columns else F.lit(None).cast("int")
    return df.withColumn("record_class", record_class(F.col("rtype"), code, codes, **options))


def route(df: DataFrame, name: str) -> DataFrame:
    """One branch of :func:`classes`."""
    return df.where(F.col("record_class") == name)


def live_symbols(messages: DataFrame, ts: str = "ts_event", sequence: str | None = "sequence") -> DataFrame:
    """Latest out-symbol per instrument, no dates: the last write wins. A running
    aggregate, so its state is one row per instrument."""
    return messages.groupBy("instrument_id").agg(
        F.max_by("stype_out_symbol", order_number(ts, sequence)).alias("symbol"))


def add_symbol(stream: DataFrame, intervals: DataFrame, **options) -> DataFrame:
    """Stream-static join with the interval table, measured when the query starts."""
    return symbology.add_symbol(stream, intervals, **options)


def bars(stream: DataFrame, width: str, delay: str = "1 minute", keys: Sequence[str] = KEYS,
         ts: str = "ts_event", sequence: str | None = "sequence") -> DataFrame:
    """Bars that are emitted once the watermark has passed their end."""
    timed = with_event_time(stream.where(F.col("price") != prices.UNDEF_PRICE), ts, delay)
    order = order_number(ts, sequence)
    return (
        timed.withColumn("_o", order)
        .groupBy(F.window("event_time", width), *keys)
        .agg(F.min_by("price", "_o").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
             F.max_by("price", "_o").alias("close"), F.sum("size").cast("bigint").alias("volume"))
        .select(times.from_timestamp(F.col("window.start")).alias("ts_event"), *keys,
                "open", "high", "low", "close", "volume")
    )


def activity(stream: DataFrame, width: str = "5 minutes", slide: str = "1 minute", delay: str = "1 minute",
             keys: Sequence[str] = ("instrument_id",), ts: str = "ts_event") -> DataFrame:
    """Record count and volume in sliding windows."""
    return (
        with_event_time(stream, ts, delay)
        .groupBy(F.window("event_time", width, slide), *keys)
        .agg(F.count(F.lit(1)).alias("records"), F.sum("size").cast("bigint").alias("volume"))
        .select(times.from_timestamp(F.col("window.start")).alias("window_start"),
                times.from_timestamp(F.col("window.end")).alias("window_end"), *keys, "records", "volume")
    )


def active_spans(stream: DataFrame, keys: Sequence[str], gap: str = "40 seconds", delay: str = "1 minute",
                 ts: str = "ts_recv") -> DataFrame:
    """Spans of activity; a span's end is the moment the feed counts as silent.

    Set ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` for
    feeds with few busy keys, so sessions merge before the shuffle.
    """
    timed = with_event_time(stream, ts, delay)
    return (
        timed.groupBy(F.session_window("event_time", gap), *keys)
        .agg(F.count(F.lit(1)).alias("records"), F.max(ts).alias("last_ts"))
        .select(*keys, times.from_timestamp(F.col("session_window.start")).alias("first_ts"), "last_ts",
                times.from_timestamp(F.col("session_window.end")).alias("silent_from"), "records")
    )


def late_and_good(stream: DataFrame, reference_ns, ts: str = "ts_recv") -> tuple[DataFrame, DataFrame]:
    """Rows to divert before the watermark: older than ``reference_ns`` or with a bad
    clock flag; and the rest."""
    bad = fl.has_flag(F.col("flags"), "f_bad_ts_recv") | (F.col(ts) < F.lit(reference_ns))
    return stream.where(bad), stream.where(~bad)


def without_repeats(stream: DataFrame, delay: str = "10 minutes", ts: str = "ts_event",
                    keys: Sequence[str] = ("publisher_id", "instrument_id", "ts_event", "sequence")) -> DataFrame:
    """One copy of records that a replay delivers again."""
    return with_event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys)).drop("event_time")
