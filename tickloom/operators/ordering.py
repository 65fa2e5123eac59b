"""Total order, chunks and replay."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.operators import segments as sg
from tickloom.operators.filters import time_order
from tickloom.schemas import index_column

log = logging.getLogger(__name__)
SEGMENTS_PER_GROUP = 4096


def by_index(df: DataFrame, index: str, *ties: str) -> DataFrame:
    """Sorted by an index column with empty values last."""
    return df.orderBy(F.col(index).asc_nulls_last(), *[F.col(t).asc() for t in ties])


def index_first(df: DataFrame, index: str) -> DataFrame:
    return df.select(index, *[c for c in df.columns if c != index])


def row_numbers(df: DataFrame, ts: str | None = None, ties: Sequence[str] = ("publisher_id", "instrument_id",
                                                                             "sequence"),
                rows_per_segment: int | None = None, width: int | None = None) -> DataFrame:
    """Adds ``row_no`` from 0 in time order without sorting all rows in one task.

    Time is cut into segments; each gets the number of rows before it, summed first
    over groups of segments and then inside the group.
    """
    name = ts or index_column(df.columns)
    cut = sg.segmented(df, (), name, rows_per_segment, width)
    counts = cut.groupBy(sg.SEGMENT).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_g", F.floor(F.col(sg.SEGMENT) / SEGMENTS_PER_GROUP))
    # one row per few thousand segments: small enough for the single window task
    groups = counts.groupBy("_g").agg(F.sum("_n").alias("_gn")).select("_g", F.coalesce(F.sum("_gn").over(
        W.orderBy("_g").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_gbase"))
    inner = F.coalesce(F.sum("_n").over(
        W.partitionBy("_g").orderBy(sg.SEGMENT).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    base = counts.withColumn("_in", inner).join(groups, "_g").select(
        sg.SEGMENT, (F.col("_in") + F.col("_gbase")).alias("_base"))
    order: list[Column] = time_order(df, name, ties)
    numbered = cut.withColumn("_r", F.row_number().over(W.partitionBy(sg.SEGMENT).orderBy(*order)))
    out = numbered.join(base, sg.SEGMENT)
    return out.select(*df.columns, (F.col("_base") + F.col("_r") - 1).cast("bigint").alias("row_no"))


def chunk_ids(df: DataFrame, count: int, **options) -> DataFrame:
    """Adds ``chunk_id``: consecutive runs of ``count`` rows in time order."""
    if count < 1:
        raise ValueError("count must be at least 1")
    numbered = row_numbers(df, **options)
    return numbered.withColumn("chunk_id", F.call_function("div", F.col("row_no"), F.lit(count)))


def replay(df: DataFrame, callback: Callable, ts: str | None = None) -> None:
    """Rows to ``callback`` one after the other in time order, one partition in
    memory at a time. An error is logged and raised again."""
    for row in df.orderBy(*time_order(df, ts)).toLocalIterator(prefetchPartitions=False):
        try:
            callback(row)
        except Exception:
            log.exception("replay callback failed")
            raise


def replay_by_key(df: DataFrame, handler: Callable, schema: str, keys: Sequence[str] = ("instrument_id",),
                  ts: str | None = None) -> DataFrame:
    """``handler(batches)`` on each partition's rows, keys together and in time order.

    Rows arrive as a stream of pandas frames, so a large key never sits in memory as
    a whole; its order makes its delivery sequential.
    """
    spread = df.repartition(*keys).sortWithinPartitions(*keys, *time_order(df, ts))
    return spread.mapInPandas(handler, schema)
