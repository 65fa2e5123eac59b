"""Bars, sampled quotes and trading profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import prices, times
from tickloom.operators import segments as sg

# Bar and sample widths by schema suffix.
WIDTHS = {"1s": times.SECOND, "1m": times.MINUTE, "1h": times.HOUR, "1d": times.DAY, "eod": times.DAY}
KEYS = ("publisher_id", "instrument_id")
#: Buckets that a gap is filled with at a time.
STRETCH = 4096


def order_number(ts: str, sequence: str | None) -> Column:
    """Time and sequence as one number, so first and last stay in hash aggregation
    (a struct key would force a sort of all rows).

    Nineteen digits each hold every time and sequence that a bigint can.
    """
    if sequence is None:
        return F.col(ts)
    high = F.col(ts).cast("decimal(19,0)") * F.lit("1" + 19 * "0").cast("decimal(20,0)")
    return (high + F.col(sequence).cast("decimal(19,0)")).cast("decimal(38,0)")


def ohlcv(df: DataFrame, width: str | int, keys: Sequence[str] = KEYS, ts: str = "ts_event",
          sequence: str | None = "sequence", start: int = 0) -> DataFrame:
    """Open, high, low, close and volume per key and bucket, stamped at bucket start.

    ``start`` moves all buckets, as for ``eod`` bars of sessions that don't begin at
    midnight UTC: 22 hours for one that does at 22:00.

    Rows without a price are left out and empty buckets give no bar. Everything
    combines map-side, so a hot instrument costs one row per task and bucket.
    """
    step = WIDTHS[width] if isinstance(width, str) else width
    order = order_number(ts, sequence)
    return (
        df.where(F.col("price") != prices.UNDEF_PRICE)
        .select(*keys, (times.floor_to(F.col(ts) - start, step) + start).alias("bucket"), order.alias("_o"), "price", "size")
        .groupBy(*keys, "bucket")
        .agg(F.min_by("price", "_o").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
             F.max_by("price", "_o").alias("close"), F.sum("size").cast("bigint").alias("volume"))
        .select(F.col("bucket").alias("ts_event"), *keys, "open", "high", "low", "close", "volume")
    )


def sample_quotes(df: DataFrame, width: str | int, keys: Sequence[str] = KEYS, ts: str = "ts_recv",
                  sequence: str = "sequence", values: Sequence[str] = ("bid_px_00", "ask_px_00", "bid_sz_00",
                                                                       "ask_sz_00"),
                  forward_fill: bool = False, rows_per_segment: int | None = None) -> DataFrame:
    """Last quote per key and bucket, stamped at bucket end.

    With ``forward_fill`` a quote is repeated for the empty buckets up to the next
    one: each sampled row is expanded to its own run, with no calendar join.
    """
    step = WIDTHS[width] if isinstance(width, str) else width
    order = order_number(ts, sequence)
    last = (
        df.select(*keys, (times.floor_to(F.col(ts), step) + step).alias("bucket"), order.alias("_o"), *values)
        .groupBy(*keys, "bucket")
        .agg(*[F.max_by(v, "_o").alias(v) for v in values])
    )
    if not forward_fill:
        return last.select(F.col("bucket").alias(ts), *keys, *values)
    cut = sg.segmented(last, keys, "bucket", rows_per_segment)
    carry = sg.carry_in(cut, keys, {"_next": F.min("bucket")},
                        {"_next": lambda c: F.min(c).over(sg.after(keys))})
    following = F.coalesce(F.lead("bucket").over(sg.inside(keys, "bucket")), F.col("_next"))
    until = F.coalesce(F.col("_following") - step, F.col("bucket"))
    # first stretches of a few thousand buckets, then the buckets, so that a long gap is no long array
    stretch = F.lit(step * STRETCH)
    runs = sg.join_carry(cut, carry, keys).withColumn("_following", following).select(
        *keys, *values, until.alias("_until"), F.explode(F.sequence("bucket", until, stretch)).alias("_first"))
    end = F.least(F.col("_until"), F.col("_first") + stretch - step)
    return runs.select(F.explode(F.sequence("_first", end, F.lit(step))).alias(ts), *keys, *values)


def profile(df: DataFrame, levels: Sequence[str], extra_keys: Sequence[str] = ()) -> DataFrame:
    """Count, volume, value-weighted price and price range, rolled up over ``levels``.

    Each coarser level is aggregated from the next finer one, and the shuffled finer
    level is reused, so records are read and shuffled once.
    """
    value = F.col("price").cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")
    level = (
        df.where(F.col("price") != prices.UNDEF_PRICE)
        .groupBy(*extra_keys, *levels)
        .agg(F.count(F.lit(1)).alias("trades"), F.sum("size").alias("volume"),
             F.sum(value).cast("decimal(38,0)").alias("_pv"), F.min("price").alias("low"), F.max("price").alias("high"))
    )
    shown = level
    kinds = dict(level.dtypes)
    for depth in range(len(levels) - 1, -1, -1):
        level = level.groupBy(*extra_keys, *levels[:depth]).agg(
            F.sum("trades").alias("trades"), F.sum("volume").alias("volume"),
            F.sum("_pv").cast("decimal(38,0)").alias("_pv"), F.min("low").alias("low"), F.max("high").alias("high"))
        gone = {c: F.lit(None).cast(kinds[c]) for c in levels[depth:]}
        shown = shown.unionByName(level.withColumns(gone).select(*shown.columns))
    return shown.select(
        *extra_keys, *levels, "trades", "volume",
        F.call_function("div", F.col("_pv"), F.col("volume")).alias("vwap"), "low", "high")
