"""What is stored: counts, sizes, costs, ranges, conditions, listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import flags as fl
from tickloom.functions import times
from tickloom.operators.filters import time_range
from tickloom.schemas import HEADER_FIELDS, Layout

# Fixed value: bytes in the unit prices are given for.
GIGABYTE = 1_000_000_000


def record_count(df: DataFrame, limit: int | None = None) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("record_count"))
    return n if limit is None else n.select(F.least("record_count", F.lit(limit)).alias("record_count"))


def billable_size(df: DataFrame, record_bytes: DataFrame, by: Sequence[str] = ("dataset", "schema")) -> DataFrame:
    """Uncompressed bytes per group. Counts come first, so the join is of a few rows."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"))
    return counts.join(record_bytes, "schema", "left").select(
        *by, "record_count", (F.col("record_count") * F.col("record_bytes")).alias("billable_size"))


def cost(sizes: DataFrame, unit_prices: DataFrame, mode: str) -> DataFrame:
    """Size in GB times the unit price of the mode and schema."""
    price = unit_prices.where(F.col("mode") == mode).select("dataset", "schema", "unit_price")
    return sizes.join(price, ["dataset", "schema"], "left").select(
        *sizes.columns, (F.col("billable_size") / F.lit(float(GIGABYTE)) * F.col("unit_price")).alias("cost"))


def dataset_range(df: DataFrame, ts: str = "ts_recv") -> DataFrame:
    """First and last record time per dataset and per dataset and schema, in one pass."""
    fine = df.groupBy("dataset", "schema").agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    return fine.groupingSets([[F.col("dataset")], [F.col("dataset"), F.col("schema")]], "dataset", "schema").agg(
        F.min("a").alias("start_ns"), F.max("b").alias("end_ns"))


def dataset_condition(df: DataFrame, start, end, ts: str = "ts_recv") -> DataFrame:
    """Per dataset and date of the inclusive range: ``available``, ``degraded`` (some
    record may have a bad book) or ``missing``."""
    low, high = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    day = times.utc_date(F.col(ts))
    # one pass: records outside the range stand together, for the names of their datasets
    daily = df.groupBy("dataset", F.when(day.between(low, high), day).alias("date")).agg(
        F.count(F.lit(1)).alias("records"), F.max(fl.has_flag(F.col("flags"), "f_maybe_bad_book")).alias("bad"))
    held = daily.groupBy("dataset").agg(F.map_from_entries(F.collect_list(F.when(
        F.col("date").isNotNull(), F.struct("date", F.struct("records", "bad"))))).alias("days"))
    each = held.select("dataset", "days", F.explode(F.sequence(low, high)).alias("date"))
    found = F.try_element_at("days", F.col("date"))
    return each.select(
        "dataset", "date", F.coalesce(found["records"], F.lit(0)).alias("records"),
        F.when(found.isNull(), "missing").when(found["bad"], "degraded")
        .otherwise("available").alias("condition"))


def datasets(df: DataFrame, start=None, end=None, ts: str = "ts_recv", **stored) -> DataFrame:
    """Datasets with a record in ``[start, end)``; ``stored`` are the options of
    ``filters.time_range`` that bring the range to the scan."""
    return time_range(df, start, end, ts, **stored).select("dataset").distinct().orderBy("dataset")


def schemas_of(df: DataFrame, dataset: str) -> DataFrame:
    return df.where(F.col("dataset") == dataset).select("schema").distinct().orderBy("schema")


def publishers(df: DataFrame) -> DataFrame:
    return df.select("publisher_id", "name", "dataset", "venue", "description").distinct().orderBy("publisher_id")


def fields(spark: SparkSession, layouts: Sequence[Layout], encoding: str = "csv") -> DataFrame:
    """``(schema, position, name, type)``; JSON shows 64-bit numbers as text and the
    header as one object."""
    rows = []
    for lay in layouts:
        for i, f in enumerate(lay.struct.fields):
            kind = f.dataType.simpleString()
            name = f.name
            if encoding == "json":
                wide = name in lay.prices or name in lay.times or kind.startswith("decimal")
                kind = "string" if wide else kind
                name = f"hd.{name}" if name in HEADER_FIELDS else name
            rows.append((lay.name, i, name, kind))
    return spark.createDataFrame(rows, "schema string, position int, name string, type string")


def unit_prices(prices: DataFrame, dataset: str) -> DataFrame:
    """Per mode a map of schema to unit price."""
    return prices.where(F.col("dataset") == dataset).groupBy("mode").agg(
        F.map_from_entries(F.sort_array(F.collect_set(F.struct("schema", "unit_price")))).alias("unit_prices"))


# The attributes that files of one stream must share.
METADATA_ATTRIBUTES = ("version", "dataset", "schema", "limit", "stype_in", "stype_out", "ts_out", "symbols",
                       "partial", "not_found", "mappings")


def metadata_differences(manifest: DataFrame, attributes: Sequence[str] = METADATA_ATTRIBUTES,
                         by: Sequence[str] = ()) -> DataFrame:
    """Names of the attributes on which the files of a group disagree."""
    def text(c: str):
        kind = manifest.schema[c].dataType
        col = F.col(c).cast("string") if isinstance(kind, T.AtomicType) else F.to_json(F.struct(c))
        return F.coalesce(col, F.lit("\u0000"))

    present = [a for a in attributes if a in manifest.columns]
    varies = [F.when(F.min(text(a)) != F.max(text(a)), F.lit(a)) for a in present]
    return manifest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"), F.array_compact(F.array(*varies)).alias("differing")
    ).withColumn("compatible", F.size("differing") == 0)
