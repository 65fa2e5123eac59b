"""Reference data as it was known: latest versions, as-of lookups, adjustments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.operators import segments as sg
from tickloom.operators.joins import fits_broadcast, stored
from tickloom.operators.spans import moment, span_join

_LAST = "9999-12-31 00:00:00"


def _version_order(df: DataFrame, ts: str, ties: Sequence[str]) -> Column:
    """Rows without a record time sort last and win, as they do in the usual
    single-machine tools."""
    end = F.lit(_LAST).cast(dict(df.dtypes)[ts])
    return F.struct(F.coalesce(ts, end).alias("t"), *[F.col(c) for c in ties if c in df.columns])


def latest_values(df: DataFrame, key: str = "event_unique_id", ts: str = "ts_record",
                  ties: Sequence[str] = ("ts_created",)) -> DataFrame:
    """One row per key with the last known value of each column: a column that is
    empty in the newest version keeps its value from an older one."""
    order = _version_order(df, ts, ties)
    rest = [c for c in df.columns if c != key]
    return (
        df.where(F.col(key).isNotNull()).withColumn("_o", order)
        .groupBy(key)
        .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_o"))).alias(c) for c in rest])
        .select(*df.columns)
    )


def latest_rows(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the greatest by ``order``; combined map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.struct(*[F.col(c) for c in order])
    return (
        df.where(F.col(keys[0]).isNotNull())
        .groupBy(*keys).agg(F.max_by(F.struct(*df.columns), rank).alias("v")).select("v.*")
    )


def events(df: DataFrame, pit: bool = False, index: str = "event_date", key: str = "event_unique_id",
           ts: str = "ts_record", ties: Sequence[str] = ("ts_created",), mode: str = "values") -> DataFrame:
    """Every version (``pit``) or the latest per event, ordered by the index column."""
    if not pit:
        df = latest_values(df, key, ts, ties) if mode == "values" else latest_rows(df, key, [ts, *ties])
    return df.orderBy(F.col(index).asc_nulls_last(), F.col(key).asc(), F.col(ts).asc())


def last_master(df: DataFrame, key: str = "listing_id") -> DataFrame:
    """Latest security-master record per listing, ordered by its effective time. Between
    records equal in both times a hash of the record decides, so reruns agree."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    last = latest_rows(df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in plain])), key,
                       ["ts_effective", "ts_record", "_tie"]).drop("_tie")
    return last.orderBy(F.col("ts_effective").asc_nulls_last(), F.col(key).asc())


def master_intervals(master: DataFrame, key: str, columns: Sequence[str],
                     effective: str = "ts_effective", recorded: str = "ts_record",
                     rows_per_segment: int | None = None) -> DataFrame:
    """Which master record is in force, as disjoint ``[_from, _to)`` per key.

    A record can be used once it is both effective and recorded; of the usable ones
    the latest effective (then recorded) wins. Versions sharing a start collapse
    first, map-side; a key with very many versions is cut into time segments.
    """
    value = F.struct(F.col(effective).alias("e"), F.col(recorded).alias("r"), *[F.col(c) for c in columns])
    one = master.where(F.col(effective).isNotNull() & F.col(recorded).isNotNull()).groupBy(
        key, F.greatest(effective, recorded).alias("_from")).agg(F.max(value).alias("v"))
    one = stored(one.withColumn("_at", moment(one, "_from")), "versions")
    if one.count() <= (rows_per_segment or sg.ROWS_PER_SEGMENT):  # no key can have a second segment
        here = W.partitionBy(key).orderBy("_at")
        best = one.select(key, "_from", F.lead("_from").over(here).alias("_to"),
                          F.max("v").over(here.rowsBetween(W.unboundedPreceding, 0)).alias("v"))
    else:
        cut = sg.segmented(one, [key], "_at", rows_per_segment)
        carry = sg.carry_in(
            cut, [key], {"_best": F.max("v"), "_next": F.min("_from")},
            {"_best": lambda c: F.max(c).over(sg.before([key])), "_next": lambda c: F.min(c).over(sg.after([key]))})
        here = sg.inside([key], "_at")
        local = cut.withColumn("_lead", F.lead("_from").over(here)).withColumn(
            "v", F.max("v").over(here.rowsBetween(W.unboundedPreceding, 0)))
        best = sg.join_carry(local, carry, [key]).select(
            key, "_from", F.coalesce("_lead", "_next").alias("_to"), F.greatest("v", "_best").alias("v"))
    return best.select(key, "_from", "_to", *[F.col(f"v.{c}").alias(c) for c in columns])


def master_as_of(df: DataFrame, master: DataFrame, key: str, ts: str, columns: Sequence[str],
                 effective: str = "ts_effective", recorded: str = "ts_record", rows_per_segment: int | None = None, **options) -> DataFrame:
    """``df`` with the master columns in force at ``ts``; no look-ahead."""
    spans = master_intervals(master, key, columns, effective, recorded, rows_per_segment)
    return span_join(df, spans, [key], ts, values=columns, rows_per_segment=rows_per_segment, **options)


def adjustment_spans(factors: DataFrame, key: str = "security_id", ex_date: str = "ex_date",
                     factor: str = "factor") -> DataFrame:
    """Cumulative back-adjustment per ``[_from, _to)`` of dates.

    Exact duplicate rows count once; the factors of one date are multiplied
    map-side, so the running product sees one row per key and date.
    """
    day = factors.distinct().groupBy(key, ex_date).agg(F.product(factor).alias("f"))
    back = W.partitionBy(key).orderBy(F.col(ex_date).desc())
    return day.select(
        key, F.lead(ex_date).over(back).alias("_from"), F.col(ex_date).alias("_to"),
        F.product("f").over(back.rowsBetween(W.unboundedPreceding, 0)).alias("adjustment"))


def back_adjust(df: DataFrame, factors: DataFrame, date: Column | str, price: str = "price",
                key: str = "security_id", **options) -> DataFrame:
    """Adds ``adjustment`` and ``adjusted_price``: the price times all factors whose
    ex-date is after the trade date. Of factors beyond the broadcast limit only those of
    securities in ``df`` are folded, if these are few."""
    limit = options.get("broadcast_bytes")
    if not fits_broadcast(factors, limit):
        held = stored(df.select(key).distinct(), "held")
        if fits_broadcast(held, limit):
            factors = factors.join(F.broadcast(held), key, "left_semi")
    spans = adjustment_spans(factors, key)
    left = df.withColumn("_day", F.col(date) if isinstance(date, str) else date)
    out = span_join(left, spans, [key], "_day", values=["adjustment"], **options)
    factor = F.coalesce("adjustment", F.lit(1.0))
    return out.select(*df.columns, factor.alias("adjustment"), (F.col(price) * factor).alias("adjusted_price"))
