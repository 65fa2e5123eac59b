"""Which of many disjoint spans of a key holds a moment.

A plain join on the key would try every span of the key for every row. Here a span
becomes blocks: the stretches of a power of two that make it up, at most two a level, as
in a binary tree over time. A row lies in one block of each level, and of all those one
belongs to its span, so the join is on equal numbers alone, and a row meets at most one
block a level however many spans its key has.

Beyond the broadcast limit rows and spans are merged in the order of time instead, with
hot keys cut into segments, so that neither side is repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.operators.asof import prevailing_quote
from tickloom.operators.joins import BROADCAST_BYTES, measured_bytes, row_bytes, stored

#: Spans of a key that a row may be held against one by one.
FEW = 64
#: Units that moments may be whole numbers of, in nanoseconds, widest first.
UNITS = (times.DAY, times.HOUR, times.MINUTE, times.SECOND, times.MILLI, 1_000, 1)


def moment(df: DataFrame, column: str) -> Column:
    """A date, timestamp or nanosecond column as nanoseconds."""
    kind = dict(df.dtypes)[column]
    if kind == "date":
        return times.date_to_ns(F.col(column))
    return times.from_timestamp(F.col(column)) if kind.startswith("timestamp") else F.col(column).cast("bigint")


def _div(a: Column, b) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def _blocks(level: Column) -> Column:
    """The blocks of one level that belong to the span from ``_a`` to ``_b``."""
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
    first, last = _div(F.col("_a") + size - 1, size), _div(F.col("_b"), size)
    left = F.when((first < last) & (first % 2 == 1), first)
    right = F.when((first < last) & (last % 2 == 1), last - 1)
    return F.array_compact(F.array(left, right))


def total(spans: DataFrame, keys: Sequence[str], values: Sequence[str], end: int) -> DataFrame:
    """``spans`` (keys, _a, _b, values) with ``_in`` true, and the stretches of 0 to ``end``
    between them with ``_in`` false."""
    order = W.partitionBy(*keys).orderBy("_a")
    inner = F.struct(F.col("_a"), F.col("_b"), F.lit(True).alias("_in"))
    head = F.when(F.col("_n") == 1, F.struct(F.lit(0).cast("bigint").alias("_a"), F.col("_a").alias("_b"), F.lit(False).alias("_in")))
    tail = F.struct(F.col("_b").alias("_a"), F.coalesce("_next", F.lit(end).cast("bigint")).alias("_b"), F.lit(False).alias("_in"))
    each = F.explode(F.array_compact(F.array(inner, head, tail))).alias("_s")
    ordered = spans.withColumns({"_next": F.lead("_a").over(order), "_n": F.row_number().over(order)})
    every = ordered.select(*keys, *values, each).select(*keys, "_s.*", *[F.when(F.col("_s._in"), F.col(v)).alias(v) for v in values])
    return every.where("_a < _b")


def span_join(df: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str = "_from", end: str = "_to",
              values: Sequence[str] | None = None, broadcast_bytes: int | None = None, rows_per_segment: int | None = None,
              few: int = FEW) -> DataFrame:
    """Every row of ``df`` with the ``values`` of the span of its key that holds ``at``.

    ``spans`` (keys, start, end, values) are disjoint inside a key; the start is part of a
    span, the end isn't, and an empty one means that the span is open there. Moments are
    dates, timestamps or nanoseconds. Rows without a span, key or moment get empty values,
    and each row comes back once. Where no key has more than ``few`` spans, trying them all
    is cheaper than blocks, with the same rows.
    """
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    names = list(values) if values is not None else [c for c in spans.columns if c not in (*keys, start, end)]
    spans = stored(spans.select(*keys, moment(spans, start).alias("_start"), moment(spans, end).alias("_end"), *names), "spans")
    # one job: bounds, rows, rows off each unit, the most spans of a key and the size
    folds = [(F.min("_start"), F.min), (F.min("_end"), F.min), (F.max("_start"), F.max), (F.max("_end"), F.max), (F.count(F.lit(1)), F.sum)]
    folds += [(F.count(F.when((F.pmod("_start", F.lit(u)) != 0) | (F.pmod("_end", F.lit(u)) != 0), 1)), F.sum) for u in UNITS]
    folds += [(F.count(F.lit(1)), F.max), (F.sum(row_bytes(spans).cast("bigint")), F.sum)]
    per_key = spans.groupBy(*keys).agg(*[c.alias(f"_{i}") for i, (c, _) in enumerate(folds)])
    row = per_key.agg(*[fold(f"_{i}") for i, (_, fold) in enumerate(folds)]).first()
    bounds = [b for b in row[:4] if b is not None]
    if not row[4] or not bounds:
        # no span at all, or one without bounds for each key
        return _left_equal(df, spans.select(*keys, *names), keys, names)
    unit = next(u for u, n in zip(UNITS, row[5:-2]) if n == 0)
    low, high = min(bounds) - unit, max(bounds) + unit
    timed = df.withColumn("_at", moment(df, at))
    most, size = row[-2:]
    if most <= few and size <= limit:
        return _by_trying(timed, df.columns, spans, keys, names)
    if size <= limit:  # a span is one block at least, so the blocks of larger ones aren't made
        cells = (high - low) // unit + 1
        in_cells = spans.select(
            *keys, _div(F.coalesce("_start", F.lit(low)) - low, unit).alias("_a"),
            F.when(F.col("_end").isNull(), F.lit(cells)).otherwise(_div(F.col("_end") - low, unit)).cast("bigint").alias("_b"), *names)
        blocks = stored(cover(total(in_cells.where("_a < _b"), keys, names, cells), keys, names, cells), "cover")
        if measured_bytes(blocks) <= limit:
            levels = sorted(r[0] for r in blocks.select("_level").distinct().collect())  # 64 at most
            # floor of a moment inside the bounds
            cell = _div(F.greatest(F.least(F.col("_at"), F.lit(high)), F.lit(low)) - low, unit)
            return _by_blocks(timed.withColumn("_cell", F.when(F.col("_at").isNotNull(), cell)), df.columns, blocks, keys, names, levels)
    begun = spans.select(*keys, F.coalesce("_start", F.lit(low)).alias("_at"), F.lit(0).alias("_order"), F.col("_end"), *names)
    rows = timed.select("*", F.lit(0).alias("_order")).withColumn("_at", F.greatest("_at", F.when(F.col("_at").isNotNull(), F.lit(low))))
    met = prevailing_quote(rows, begun, ["_end", *names], keys, "_at", "_order", rows_per_segment)
    holds = F.col("_end").isNull() | (F.col("_at") < F.col("_end"))
    return met.select(*df.columns, *[F.when(holds, F.col(n)).alias(n) for n in names])


def cover(spans: DataFrame, keys: Sequence[str], names: Sequence[str], cells: int) -> DataFrame:
    """(keys, _level, _block, _in, values) of all blocks, and for each key a row of level -1."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(max(1, int(cells).bit_length())))).alias("_level")
    each = spans.select("*", levels)
    made = each.select(*keys, "_level", F.explode(_blocks(F.col("_level"))).alias("_block"), "_in", *names)
    kinds = dict(spans.dtypes)
    known = spans.select(*keys).distinct().select(
        *keys, F.lit(-1).alias("_level"), F.lit(0).cast("bigint").alias("_block"), F.lit(False).alias("_in"),
        *[F.lit(None).cast(kinds[n]).alias(n) for n in names])
    return made.unionByName(known)


def _by_blocks(rows: DataFrame, columns: Sequence[str], blocks: DataFrame, keys: Sequence[str], names: Sequence[str],
               levels: Sequence[int]) -> DataFrame:
    """A row stands for each level; the one that finds its block stays, and that of level
    -1 where the key is unknown."""
    places = [F.struct(F.lit(n).alias("_level"), (
        F.when(F.col("_cell").isNotNull(), F.lit(0)).cast("bigint") if n < 0 else F.call_function("shiftright", F.col("_cell"), F.lit(n))
    ).alias("_block")) for n in levels]
    spread = rows.select(*columns, F.explode(F.array(*places)).alias("_p")).select(*columns, "_p._level", "_p._block")
    right = blocks.select(*[F.col(c).alias(f"_r_{c}") for c in blocks.columns])
    on = (F.col("_level") == F.col("_r__level")) & (F.col("_block") == F.col("_r__block"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    met = spread.join(F.broadcast(right), on, "left")  # measured above
    kept = met.where((F.col("_level") >= 0) == F.col("_r__level").isNotNull())
    return kept.select(*columns, *[F.col(f"_r_{n}").alias(n) for n in names])


def _by_trying(rows: DataFrame, columns: Sequence[str], spans: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Few spans of a key, each of them held against the row."""
    right = spans.select(*[F.col(c).alias(f"_r_{c}") for c in spans.columns])
    on = (F.col("_r__start").isNull() | (F.col("_at") >= F.col("_r__start"))) & (F.col("_r__end").isNull() | (F.col("_at") < F.col("_r__end")))
    on = on & F.col("_at").isNotNull()
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    met = rows.join(F.broadcast(right), on, "left")  # measured above
    return met.select(*columns, *[F.col(f"_r_{n}").alias(n) for n in names])


def _left_equal(df: DataFrame, spans: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    right = spans.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(n).alias(f"_v_{n}") for n in names])
    on = None
    for k in keys:
        one = F.col(k) == F.col(f"_r_{k}")
        on = one if on is None else on & one
    return df.join(right, on, "left").select(*df.columns, *[F.col(f"_v_{n}").alias(n) for n in names])
