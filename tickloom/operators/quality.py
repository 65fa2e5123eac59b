"""Feed checks: event groups, snapshots, silences, clock faults, gaps, lag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions import flags as fl
from tickloom.functions import times
from tickloom.operators import segments as sg

# Default heartbeat and margin in seconds, and the lag limits.
HEARTBEAT_SECONDS = 30
MARGIN_SECONDS = 10
QUEUE_CAPACITY = 1_048_576
LAG_RECORDS = 128
LAG_NS = 1_000_000_000


def event_ordinal(df: DataFrame, keys: Sequence[str] = ("instrument_id",), ts: str = "ts_recv",
                  sequence: str = "sequence", rows_per_segment: int | None = None,
                  width: int | None = None) -> DataFrame:
    """Adds ``event_no``: how many events of the key ended before this record."""
    cut = sg.segmented(df, keys, ts, rows_per_segment, width).withColumn(
        "_end", fl.has_flag(F.col("flags"), "f_last").cast("bigint"))
    carry = sg.carry_in(cut, keys, {"_done": F.sum("_end")}, {"_done": lambda c: F.sum(c).over(sg.before(keys))})
    local = F.sum("_end").over(sg.inside(keys, ts, sequence).rowsBetween(W.unboundedPreceding, -1))
    out = sg.join_carry(cut.withColumn("_in", local), carry, keys)
    number = F.coalesce("_in", F.lit(0)) + F.coalesce("_done", F.lit(0))
    return out.select(*df.columns, number.cast("bigint").alias("event_no"))


def snapshot_ends(df: DataFrame, keys: Sequence[str] = ("instrument_id",), ts: str = "ts_recv",
                  sequence: str = "sequence", rows_per_segment: int | None = None,
                  width: int | None = None) -> DataFrame:
    """The first ordinary record after each run of snapshot records."""
    cut = sg.segmented(df, keys, ts, rows_per_segment, width).withColumn(
        "_snap", fl.has_flag(F.col("flags"), "f_snapshot"))
    order = F.struct(F.col(ts), F.col(sequence))
    carry = sg.carry_in(cut, keys, {"_prev": F.max_by("_snap", order)},
                        {"_prev": lambda c: F.last(c).over(sg.before(keys))})
    seen = cut.withColumn("_in", F.lag("_snap").over(sg.inside(keys, ts, sequence)))
    out = sg.join_carry(seen.where(~F.col("_snap")), carry, keys)
    return out.where(F.coalesce("_in", "_prev", F.lit(False))).select(*df.columns)


def silences(df: DataFrame, keys: Sequence[str], ts: str = "ts_recv",
             limit_ns: int = (HEARTBEAT_SECONDS + MARGIN_SECONDS) * times.SECOND,
             rows_per_segment: int | None = None, width: int | None = None) -> DataFrame:
    """``(keys, gap_start, gap_end, gap_ns)`` where consecutive records of a key are
    further apart than the limit."""
    cut = sg.segmented(df.select(*keys, ts), keys, ts, rows_per_segment, width)
    carry = sg.carry_in(cut, keys, {"_prev": F.max(ts)}, {"_prev": lambda c: F.max(c).over(sg.before(keys))})
    seen = cut.withColumn("_in", F.lag(ts).over(sg.inside(keys, ts)))
    out = sg.join_carry(seen, carry, keys).withColumn("gap_start", F.coalesce("_in", "_prev"))
    return out.where(F.col(ts) - F.col("gap_start") > limit_ns).select(
        *keys, "gap_start", F.col(ts).alias("gap_end"), (F.col(ts) - F.col("gap_start")).alias("gap_ns"))


def clock_faults(df: DataFrame, keys: Sequence[str] = ("publisher_id",), ts: str = "ts_recv",
                 sequence: str = "sequence", rows_per_segment: int | None = None,
                 width: int | None = None) -> DataFrame:
    """Records flagged with a bad clock or earlier than one that arrived before
    them, in arrival (``sequence``) order; ``behind_ns`` tells by how much."""
    cut = sg.segmented(df, keys, sequence, rows_per_segment, width)
    carry = sg.carry_in(cut, keys, {"_top": F.max(ts)}, {"_top": lambda c: F.max(c).over(sg.before(keys))})
    local = F.max(ts).over(sg.inside(keys, sequence).rowsBetween(W.unboundedPreceding, -1))
    out = sg.join_carry(cut.withColumn("_in", local), carry, keys).withColumn("_max", F.greatest("_in", "_top"))
    bad = fl.has_flag(F.col("flags"), "f_bad_ts_recv")
    late = F.coalesce(F.col(ts) < F.col("_max"), F.lit(False))
    behind = F.when(late, F.col("_max") - F.col(ts)).otherwise(F.lit(0))
    return out.where(bad | late).select(*df.columns, behind.cast("bigint").alias("behind_ns"))


def sessions(records: DataFrame, starts: DataFrame, dataset: str = "dataset", session: str = "session_id",
             ts: str = "ts_event") -> DataFrame:
    """One row per session: its start from ``starts`` and its last record time."""
    last = records.groupBy(dataset, session).agg(F.max(ts).alias("last_ts"))
    return starts.join(last, [dataset, session], "left")


def reconnect_gaps(log: DataFrame, dataset: str = "dataset", start: str = "session_start",
                   last: str = "last_ts", rows_per_segment: int | None = None,
                   width: int | None = None) -> DataFrame:
    """Gap between a session's last record (its start when it had none) and the next
    session's start. ``log`` has one row per session."""
    cut = sg.segmented(log.withColumn("_end", F.coalesce(last, start)), [dataset], start, rows_per_segment, width)
    carry = sg.carry_in(cut, [dataset], {"_prev": F.max_by("_end", start)},
                        {"_prev": lambda c: F.last(c).over(sg.before([dataset]))})
    seen = cut.withColumn("_in", F.lag("_end").over(sg.inside([dataset], start)))
    out = sg.join_carry(seen, carry, [dataset]).withColumn("gap_start", F.coalesce("_in", "_prev"))
    return out.where(F.col("gap_start").isNotNull()).select(
        dataset, "gap_start", F.col(start).alias("gap_end"),
        ((F.col(start) - F.col("gap_start")) / F.lit(float(times.SECOND))).alias("gap_seconds"))


def lag_flag(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts_recv") -> DataFrame:
    """Whether a batch of waiting records counts as full: too many, or more than a
    few that span more than a second."""
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"), F.min(ts).alias("front_ts"), F.max(ts).alias("back_ts"))
    span = F.col("back_ts") - F.col("front_ts")
    full = (F.col("records") > QUEUE_CAPACITY) | ((F.col("records") > LAG_RECORDS) & (span > LAG_NS))
    return out.withColumn("is_full", F.coalesce(full, F.lit(False)))
