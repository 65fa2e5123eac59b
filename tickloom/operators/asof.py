"""Each trade with the quote that was in force."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import segments as sg


def prevailing_quote(
    trades: DataFrame, quotes: DataFrame, values: Sequence[str], keys: Sequence[str] = ("instrument_id",),
    ts: str = "ts_recv", sequence: str = "sequence", rows_per_segment: int | None = None,
    width: int | None = None,
) -> DataFrame:
    """Trades with the last quote of the same key at or before them (quotes first
    on equal times); NULL before the first quote.

    Trades and quotes are merged in one ordered pass. Keys are cut into time
    segments; a quote from an earlier segment arrives as one carried row.
    """
    q = quotes.select(*keys, ts, sequence, F.lit(0).alias("_tag"), F.lit(None).cast(
        _struct_type(trades)).alias("_t"), F.struct(*values).alias("_q"))
    t = trades.select(*keys, ts, sequence, F.lit(1).alias("_tag"), F.struct(*trades.columns).alias("_t"),
                      F.lit(None).cast(_struct_type(quotes.select(*values))).alias("_q"))
    both = q.unionByName(t)
    order = F.struct(F.col(ts), F.col(sequence))
    both = sg.segmented(both, keys, ts, rows_per_segment, width)
    # taken over trades as well, since a segment without quotes needs a carried row
    carry = sg.carry_in(
        both, keys,
        {"_before": F.max_by("_q", F.when(F.col("_tag") == 0, order))},
        {"_before": lambda c: F.last(c, ignorenulls=True).over(sg.before(keys))})
    local = F.last("_q", ignorenulls=True).over(sg.inside(keys, ts, "_tag", sequence))
    seen = both.withColumn("_q", local).where(F.col("_tag") == 1)
    out = sg.join_carry(seen, carry, keys).withColumn("_q", F.coalesce("_q", "_before"))
    return out.select("_t.*", *[F.col(f"_q.{v}").alias(v) for v in values])


def _struct_type(df: DataFrame) -> str:
    return df.schema.simpleString()
