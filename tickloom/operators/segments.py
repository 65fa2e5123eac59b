"""Ordered scans (running sum, running maximum, last value, previous row) that do
not need all rows of a key in one task.

The rows of a key are cut into segments of the ordering number. One summary row
per segment is folded over the earlier segments of the key, which gives each
segment what it needs from before; the rest is a window inside the segment.

Where to cut is read from a sample that is taken in the plan itself, in one aggregate
with the row count of each key: rows whose hash is small, 64 for each segment to come.
Only keys above the row target get cut points, so the table of cut points has at most
one number for each row target in the input, and is broadcast. A key with a third of all
rows, or with half of them in one second, is cut as finely as it needs; the others are
one segment each.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions import times

ROWS_PER_SEGMENT = 1_000_000
SEGMENT = "_seg"
#: Sampled rows for a segment, and cut points that are looked through one by one.
SAMPLE, STEP = 64, 64
_SCALE = 1 << 40


def cut_points(df: DataFrame, keys: Sequence[str], order: str, rows_per_segment: int | None = None) -> DataFrame:
    """(keys, _cuts) for the keys of ``df`` that need more than one segment.

    ``_cuts`` holds ascending numbers in runs of ``STEP``; a segment begins at each.
    Segments have ``rows_per_segment`` rows, give or take an eighth. Rows that share one
    number can't be parted.
    """
    top = rows_per_segment or ROWS_PER_SEGMENT
    share = min(1.0, SAMPLE / top)
    stride = max(1, round(top * share))
    taken = F.pmod(F.xxhash64(order), F.lit(_SCALE)) < int(share * _SCALE)
    seen = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.collect_list(F.when(taken, F.col(order).cast("bigint"))).alias("_s"))
    hot = seen.where(F.col("_n") > top).withColumn("_s", F.array_sort("_s"))
    at = F.sequence(F.lit(stride), F.greatest(F.size("_s") - 1, F.lit(stride)), F.lit(stride))
    flat = F.array_distinct(F.array_compact(F.transform(at, lambda i: F.get("_s", i))))
    cut = hot.select(*keys, flat.alias("_flat"))
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size("_flat") - 1) / STEP), F.lit(0))),
                       lambda i: F.slice("_flat", i.cast("int") * STEP + 1, F.lit(STEP)))
    return cut.where(F.size("_flat") > 0).select(*keys, runs.alias("_cuts"))


def place(cuts: Column, value: Column) -> Column:
    """How many of ``cuts`` are at or below ``value``: first by run, then inside one run."""
    run = F.size(F.filter(cuts, lambda c: c[0] <= value))
    inside = F.size(F.filter(F.element_at(cuts, run), lambda c: c <= value))
    return F.when(cuts.isNull() | value.isNull() | (run == 0), 0).otherwise((run - 1) * STEP + inside).cast("bigint")


def segmented(df: DataFrame, keys: Sequence[str], order: str, rows_per_segment: int | None = None,
              width: int | None = None) -> DataFrame:
    """``df`` with the number of its segment, which grows with ``order`` inside a key.

    A caller who knows a ``width`` of the ordering number that keeps segments small
    saves the sample. Without keys the cut points are one row, which the driver reads.
    """
    if width is not None:
        return df.withColumn(SEGMENT, times.bucket(F.col(order), width))
    number = F.col(order).cast("bigint")
    if not keys:
        row = cut_points(df, keys, order, rows_per_segment).first()
        # few rows: one cut behind all of them (a constant segment would make joins on it products)
        runs = [[(1 << 63) - 1]] if row is None else row["_cuts"]
        cuts = F.array(*[F.array(*[F.lit(int(c)) for c in run]) for run in runs])
        return df.withColumn(SEGMENT, place(cuts, number))
    cuts = cut_points(df, keys, order, rows_per_segment)
    cuts = cuts.select(*[F.col(k).alias(f"_cut_{i}") for i, k in enumerate(keys)], "_cuts")
    # at most one number for each ``rows_per_segment`` rows of the input
    joined = df.join(F.broadcast(cuts), _same(df, keys, cuts, "_cut_"), "left")
    return joined.select(*df.columns, place(F.col("_cuts"), number).alias(SEGMENT))


def _same(left: DataFrame, keys: Sequence[str], right: DataFrame, prefix: str) -> Column:
    """Equal keys, empty ones included."""
    out = None
    for i, k in enumerate(keys):
        one = left[k].eqNullSafe(right[f"{prefix}{i}"])
        out = one if out is None else out & one
    return out


def before(keys: Sequence[str]) -> WindowSpec:
    """All earlier segments of the key."""
    return W.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)


def after(keys: Sequence[str]) -> WindowSpec:
    """All later segments of the key. The order runs backwards because a frame that
    grows is linear while one that shrinks is recomputed for each row."""
    return W.partitionBy(*keys).orderBy(F.col(SEGMENT).desc()).rowsBetween(W.unboundedPreceding, -1)


def inside(keys: Sequence[str], *order) -> WindowSpec:
    return W.partitionBy(*keys, SEGMENT).orderBy(*order)


def carry_in(
    df: DataFrame, keys: Sequence[str],
    summaries: Mapping[str, Column], folds: Mapping[str, Callable[[Column], Column]],
) -> DataFrame:
    """One row per key and segment with what earlier segments hand over.

    ``summaries`` aggregate a segment (combined map-side); ``folds`` turn each into
    a window expression over the other segments of the key, a few rows for each row
    target that the key holds.
    """
    one = df.groupBy(*keys, SEGMENT).agg(*[c.alias(n) for n, c in summaries.items()])
    return one.select(*keys, SEGMENT, *[folds[n](F.col(n)).alias(n) for n in summaries])


def join_carry(df: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides are partitioned by key and segment already, so this adds no
    shuffle of the large side."""
    names = [*keys, SEGMENT]
    own = carry.select(*[F.col(k).alias(f"_carry_{i}") for i, k in enumerate(names)], *[c for c in carry.columns if c not in names])
    return df.join(own, _same(df, names, own, "_carry_"), "left").drop(*[f"_carry_{i}" for i in range(len(names))])
