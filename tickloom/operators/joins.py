"""Joins against a smaller table that may or may not fit a broadcast.

The size is measured first. Below the limit the small side is broadcast and the
large side never shuffles. Above it both sides shuffle on the keys, and every key
with more rows than one task should hold is spread over as many salts as its row
count asks for; the small side repeats only for those keys. Both ways return the
same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import shared_dir

BROADCAST_BYTES = 64 << 20
ROWS_PER_TASK = 10_000_000


def row_bytes(df: DataFrame) -> Column:
    """Rough bytes of a row in memory."""
    total = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            total = total + F.coalesce(F.octet_length(f.name), F.lit(0)) + 8
        elif isinstance(f.dataType, T.AtomicType):
            total = total + 8
        else:
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    return total


def measured_bytes(df: DataFrame) -> int:
    """Rough in-memory size from one map-side-combined aggregate."""
    return df.agg(F.sum(row_bytes(df).cast("bigint"))).first()[0] or 0


def measured(df: DataFrame, key: str) -> tuple[int, int]:
    """Rough size, and the number of rows of the largest key."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df).cast("bigint")).alias("b"))
    row = per.agg(F.sum("b"), F.max("n")).first()
    return row[0] or 0, row[1] or 0


def stored(df: DataFrame, purpose: str = "table") -> DataFrame:
    """``df`` written once to the shared folder and read back. For a derived table
    that is measured and then joined, so it is not computed twice."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int | None = None) -> DataFrame:
    """Keys above ``rows_per_task`` rows and the number of salts each needs.

    At most ``rows / rows_per_task`` keys qualify.
    """
    top = rows_per_task or ROWS_PER_TASK
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > top))
        .select(*keys, F.ceil(F.col("_n") / top).cast("int").alias("_salts"))
    )


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str],
    condition: Callable[[str, str], Column] | None = None,
    how: str = "left", rows_per_task: int | None = None, count_on: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join whose hot keys are spread; ``right`` is the smaller side.

    ``count_on`` is a frame with the same keys as ``left`` that is cheaper to count,
    where ``left`` is itself the result of a join.
    """
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    hot = stored(hot_keys(left if count_on is None else count_on, keys, rows_per_task), "hot")
    if fits_broadcast(hot):
        hot = F.broadcast(hot)
    # the row's place in its input part keeps equal rows of a hot key apart; rows without
    # a key match nothing and may go anywhere
    plain = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    salts = F.when(keyless, F.lit(1 << 16)).otherwise(F.coalesce("_salts", F.lit(1))).cast("bigint")
    spread = F.pmod(F.xxhash64(*plain, "_place"), salts).cast("int")
    placed = left.withColumn("_place", F.monotonically_increasing_id())
    big = placed.join(hot, list(keys), "left").select(
        *left.columns, spread.alias("_salt"))
    small = right.join(hot, list(keys), "left").select(
        *right.columns,
        F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt"),
    )
    return _join(big, small, [*keys, "_salt"], condition, how).drop("_salt")


def _join(left, right, keys, condition, how):
    a, b = left.alias("l"), right.alias("r")
    on = None
    for k in keys:
        part = F.col(f"l.{k}") == F.col(f"r.{k}")
        on = part if on is None else on & part
    if condition is not None:
        on = on & condition("l", "r")
    joined = a.join(b, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    extra = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return joined.select(*[F.col(f"l.{c}") for c in left.columns], *extra)


def lookup_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str],
    condition: Callable[[str, str], Column] | None = None,
    how: str = "left", broadcast_bytes: int | None = None, rows_per_task: int | None = None,
    count_on: DataFrame | None = None, derived: bool = False, size: int | None = None,
) -> DataFrame:
    """Join ``left`` to the smaller ``right`` on equal keys and ``condition``.

    ``condition`` receives the two alias names. Key columns come from the left.
    A ``derived`` right side is stored first, so it is computed once. ``size`` is its
    size where the caller has measured it. A stream cannot be counted ahead, so on
    one the larger case is a plain shuffle.
    """
    if derived:
        right = stored(right)
    if size is None:
        size = measured_bytes(right)
    if size == 0 and how == "left":
        return left.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                  for f in right.schema.fields if f.name not in keys])
    if size <= (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return _join(left, F.broadcast(right), list(keys), condition, how)
    if left.isStreaming:
        return _join(left, right, list(keys), condition, how)
    return salted_join(left, right, keys, condition, how, rows_per_task, count_on)
