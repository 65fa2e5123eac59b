"""Streams of records and their selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import flags as fl
from tickloom.functions import text as tx
from tickloom.functions import times
from tickloom.operators import catalog, filters
from tickloom.schemas import index_column
from tickloom.session import shared_dir


def open_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """Files arriving in a folder. ``max_files`` per batch bounds what a slow reader takes on."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def subscribe(stream: DataFrame, schema: str | None = None, symbols=None, stype: str = "raw_symbol",
              start=None, snapshot: bool = False, state: DataFrame | None = None,
              dataset: str | None = None, snapshot_path: str | None = None) -> DataFrame:
    """Records of one dataset, schema and symbol list.

    ``start`` replays from a time on (0 for all). ``snapshot`` is for ``mbo`` without a
    start; it puts the snapshot records of ``state`` in front of the stream's own. A
    bounded ``state`` is handed over by a folder, written once, that the stream reads as a
    whole in its first batch and not again. A query that is to start again from its
    checkpoint names that folder by ``snapshot_path``; what is there already stays.
    """
    if snapshot and start is not None:
        raise ValueError("a snapshot cannot have a start")
    if snapshot and schema != "mbo":
        raise ValueError("a snapshot is only for mbo")
    out = stream
    if dataset is not None and "dataset" in out.columns:
        out = out.where(F.col("dataset") == dataset)
    if schema is not None and "schema" in out.columns:
        out = out.where(F.col("schema") == schema)
    if start is not None:
        out = out.where(F.col(index_column(out.columns)) >= times.bound_ns(start))
    key = "instrument_id" if stype == "instrument_id" else "symbol"
    if tx.normal_symbols(symbols, stype) != [tx.ALL_SYMBOLS]:
        out = filters.symbols(out, symbols, stype, key)
    if snapshot and state is not None:
        if not state.isStreaming:
            state = handed_over(state.select(*out.columns), snapshot_path)
        marked = state.withColumn("flags", F.col("flags").bitwiseOR(F.lit(fl.FLAG_BITS["f_snapshot"])))
        out = marked.select(*out.columns).unionByName(out)
    return out


def handed_over(df: DataFrame, path: str | None = None) -> DataFrame:
    """A bounded frame as a stream that yields its rows once, in the first batch."""
    spark = df.sparkSession
    folder = path or shared_dir(spark, "snapshot")
    df.write.mode("ignore").parquet(folder)
    return open_stream(spark, folder, df.schema)


def check_headers(manifest: DataFrame) -> None:
    """Stop before a restart when stored files disagree with each other."""
    row = catalog.metadata_differences(manifest).first()
    if row and not row["compatible"]:
        raise ValueError(f"stream files differ in {row['differing']}")
