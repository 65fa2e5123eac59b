"""Symbols that stand for a set or a rolling choice of instruments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.operators.joins import lookup_join, stored

RULES = {"c": "calendar", "v": "volume", "n": "open_interest"}


def expand_parents(requests: DataFrame, definitions: DataFrame, start, end) -> DataFrame:
    """``(symbol, instrument_id)`` of all instruments of the requested ``ROOT.CLASS``
    that are active in ``[start, end)``."""
    parts = F.split("symbol", r"\.")
    wanted = requests.select("symbol", parts[0].alias("root"), parts[1].alias("asset_class")).distinct()
    low, high = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    active = definitions.where((F.col("activation") < high) & (F.col("expiration") > low))
    out = lookup_join(active, wanted, ["root", "asset_class"], how="inner")
    return out.select("symbol", "instrument_id").distinct()


def ranks(stats: DataFrame, rule: str) -> DataFrame:
    """Contracts of a root ranked from 0 on each day of statistics.

    ``stats`` has ``root, instrument_id, date, expiration, volume, open_interest``,
    one row per contract and day. A day's ranking holds from the next date up to the
    date after the next day of statistics. Expired contracts are left out. The statistics,
    which are mostly aggregates of records, are written once, since they are read twice.
    """
    if rule not in RULES:
        raise ValueError(f"roll rule must be one of {sorted(RULES)}")
    stats = stored(stats.select("root", "instrument_id", "date", "expiration", "volume", "open_interest"), "statistics")
    days = stats.select("root", "date").distinct()
    nxt = F.lead("date").over(W.partitionBy("root").orderBy("date"))
    days = days.select("root", "date", F.date_add("date", 1).alias("valid_from"),
                       F.date_add(F.coalesce(nxt, F.date_add("date", 1)), 1).alias("valid_to"))
    live = stats.join(days, ["root", "date"]).where(F.col("expiration") > F.col("date"))
    first = {"c": F.col("expiration").asc(), "v": F.col("volume").desc_nulls_last(),
             "n": F.col("open_interest").desc_nulls_last()}[rule]
    place = W.partitionBy("root", "date").orderBy(first, F.col("expiration").asc(), F.col("instrument_id").asc())
    return live.select("root", "valid_from", "valid_to", "instrument_id",
                       (F.row_number().over(place) - 1).alias("rank"))


def continuous_intervals(stats: DataFrame, rule: str) -> DataFrame:
    """``ROOT.rule.rank`` as intervals of instruments; equal neighbours are merged."""
    each = ranks(stats, rule)
    order = W.partitionBy("root", "rank").orderBy("valid_from")
    starts = F.coalesce(
        (F.lag("instrument_id").over(order) != F.col("instrument_id"))
        | (F.lag("valid_to").over(order) != F.col("valid_from")), F.lit(True))
    marked = each.withColumn("_new", starts).withColumn(
        "_i", F.sum(F.col("_new").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    return (
        marked.groupBy("root", "rank", "_i")
        .agg(F.first("instrument_id").alias("instrument_id"), F.min("valid_from").alias("start_date"),
             F.max("valid_to").alias("end_date"))
        .select(F.concat_ws(".", "root", F.lit(rule), F.col("rank").cast("string")).alias("symbol"),
                "instrument_id", "start_date", "end_date")
    )
