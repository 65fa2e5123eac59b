"""Interval tables from resolve responses, file metadata and mapping messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions import text as tx
from tickloom.functions import times

# The keys a resolve response must have.
RESPONSE_KEYS = ("result", "symbols", "stype_in", "stype_out", "start_date", "end_date", "partial",
                 "not_found", "message", "status")
RESPONSE_SCHEMA = (
    "result map<string, array<struct<d0: string, d1: string, s: string>>>, symbols array<string>, "
    "stype_in string, stype_out string, start_date string, end_date string, partial array<string>, "
    "not_found array<string>, message string, status int"
)
#: What tells the order of documents.
DOCUMENT = ("document_time", "document_name")
METADATA_SCHEMA = (
    "stype_in string, stype_out string, "
    "mappings map<string, array<struct<start_date: string, end_date: string, symbol: string>>>"
)


def read_response(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Resolve responses, one JSON document per file, with the time and name of its file.
    A missing key is an error."""
    raw = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_modification_time").alias("document_time"),
        F.col("_metadata.file_name").alias("document_name"))
    doc = F.col("value")
    lacking = F.array_compact(F.array(*[
        F.when(~F.array_contains(F.json_object_keys(doc), k), F.lit(k)) for k in RESPONSE_KEYS]))
    checked = F.when(F.size(lacking) > 0, F.raise_error(F.concat(
        F.lit("symbology JSON lacks: "), F.array_join(lacking, ", "))).cast("string")).otherwise(doc)
    return raw.select(F.from_json(checked, RESPONSE_SCHEMA, {"mode": "FAILFAST"}).alias("j"), *DOCUMENT).select("j.*", *DOCUMENT)


def inserted_order(documents: DataFrame) -> Column:
    """The order in which documents count: by the time of their files, then by name. It
    doesn't follow the scan, which reads large files first.

    Milliseconds leave room for a million files of one time; their ranks are taken among
    themselves alone.
    """
    if not set(DOCUMENT) <= set(documents.columns):
        raise ValueError(f"documents need an order: give seq, or the columns {DOCUMENT}")
    stamp = F.unix_millis("document_time")
    rank = F.dense_rank().over(W.partitionBy(stamp).orderBy("document_time", "document_name"))
    return stamp * 1_000_000 + rank


def _number(text: Column) -> Column:
    value = text.try_cast("bigint")
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit("not an instrument id: "), F.coalesce(text, F.lit("null")))).cast("bigint"))


def _intervals(df: DataFrame, mapping: str, start: str, end: str, symbol: str, seq: Column) -> DataFrame:
    """Explode symbol lists; the instrument id is on the side its type says."""
    each = df.select("stype_in", "stype_out", seq.alias("_doc"), F.posexplode(mapping).alias("_p", "_in", "_list"))
    flat = each.select("stype_in", "stype_out", "_doc", "_p", "_in", F.posexplode("_list").alias("_q", "_e"))
    kept = flat.where(F.coalesce(F.col(f"_e.{symbol}"), F.lit("")) != "")
    out = F.col(f"_e.{symbol}")
    by_in = F.col("stype_in") == "instrument_id"
    by_out = F.col("stype_out") == "instrument_id"
    wrong = F.raise_error(F.lit("either stype_in or stype_out must be instrument_id"))
    return kept.select(
        F.when(by_in, _number(F.col("_in"))).when(by_out, _number(out)).otherwise(wrong.cast("bigint"))
        .alias("instrument_id"),
        F.to_date(f"_e.{start}").alias("start_date"),
        F.to_date(f"_e.{end}").alias("end_date"),
        F.when(by_in, out).otherwise(F.col("_in")).alias("symbol"),
        # documents first, then position within the document
        (F.col("_doc").cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)")
         + (F.col("_p").cast("bigint") * F.lit(1 << 31) + F.col("_q"))).cast("decimal(38,0)").alias("seq"),
    )


def from_response(responses: DataFrame, seq: Column | None = None) -> DataFrame:
    """Intervals of responses. ``seq`` orders the documents, and a later one wins over an
    earlier one; without it they count in the order of their files, as ``read_response``
    tells it."""
    return _intervals(responses, "result", "d0", "d1", "s", inserted_order(responses) if seq is None else seq)


def from_metadata(manifest: DataFrame, seq: Column | None = None) -> DataFrame:
    """Intervals of file metadata, in the order of ``seq`` or of the files, as above."""
    return _intervals(manifest, "mappings", "start_date", "end_date", "symbol",
                      inserted_order(manifest) if seq is None else seq)


def from_messages(messages: DataFrame, seq: Column) -> DataFrame:
    """Mapping messages. Open ends reach the widest dates; times are cut to dates,
    so an interval within one day is empty."""
    def day(name: str, widest) -> Column:
        return F.coalesce(times.utc_date(F.col(name)), F.lit(widest))

    return messages.select(
        "instrument_id",
        day("start_ts", times.MIN_DATE).alias("start_date"),
        day("end_ts", times.MAX_DATE).alias("end_date"),
        tx.mapping_symbol(F.col("stype_in_symbol"), F.col("stype_out_symbol")).alias("symbol"),
        seq.cast("bigint").alias("seq"),
    )
