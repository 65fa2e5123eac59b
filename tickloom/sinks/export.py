"""Partitioned exports and their manifest check."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions import text as tx
from tickloom.functions import times
from tickloom.functions.domains import SPLIT_DURATION, member
from tickloom.operators import segments as sg
from tickloom.operators import symbology
from tickloom.operators.filters import first_records
from tickloom.operators.joins import row_bytes
from tickloom.schemas import Layout, index_column
from tickloom.sinks import files

# Bounds of the split size in bytes.
MIN_SPLIT = 1_000_000_000
MAX_SPLIT = 10_000_000_000


def split_key(ns: Column, duration: str) -> Column:
    """First date of the split a record falls in (UTC, weeks from Sunday); empty
    text when the export is not split by time."""
    kind = member(duration, SPLIT_DURATION, "split_duration")
    day = times.utc_date(ns)
    start = {
        "day": day,
        "week": F.date_sub(day, F.dayofweek(day) - 1),
        "month": F.trunc(day, "month"),
        "year": F.trunc(day, "year"),
    }.get(kind)
    return F.lit("all") if start is None else F.date_format(start, "yyyyMMdd")


def checked_size(split_size: int | None) -> int | None:
    if split_size is not None and not MIN_SPLIT <= split_size <= MAX_SPLIT:
        raise ValueError(f"split_size must be in {MIN_SPLIT}..{MAX_SPLIT}")
    return split_size


def file_numbers(df: DataFrame, parts: Sequence[str], order: Sequence[str], size: Column, bound: int,
                 rows_per_segment: int | None = None) -> DataFrame:
    """Adds ``file``: rows of each split in the order of ``order`` (numbers, the first one
    a time), cut so that the ``size`` of no file is above ``bound`` bytes.

    Sizes are added up inside segments and over the segments of a split, so a split of
    any length spreads over tasks. A file ends early enough to leave room for the longest
    row; only a row that is longer than the bound itself has a larger file, of its own.
    """
    sized = df.withColumn("_bytes", size.cast("bigint"))
    longest = min(sized.agg(F.max("_bytes")).first()[0] or 0, bound - 1)
    cut = sg.segmented(sized, parts, order[0], rows_per_segment)
    carry = sg.carry_in(cut, parts, {"_before": F.sum("_bytes")}, {"_before": lambda c: F.sum(c).over(sg.before(parts))})
    inner = F.sum("_bytes").over(sg.inside(parts, *order).rowsBetween(W.unboundedPreceding, -1))
    joined = sg.join_carry(cut.withColumn("_in", inner), carry, parts)
    start = F.coalesce("_before", F.lit(0)) + F.coalesce("_in", F.lit(0))
    return joined.select(*df.columns, F.call_function("div", start, F.lit(bound - longest)).alias("file"))


def written_bytes(df: DataFrame, shown: Sequence[str], encoding: str) -> Column:
    """Bytes of a row in a file, with its line end; Parquet counts as it is in memory."""
    if encoding == "csv":
        return F.octet_length(F.to_csv(F.struct(*shown), {"emptyValue": "", "nullValue": "", "quoteAll": "false"})) + 1
    if encoding == "json":
        return F.octet_length("value") + 1
    return row_bytes(df.select(*shown))


def header_bytes(shown: Sequence[str], encoding: str) -> int:
    return len(",".join(shown).encode()) + 1 if encoding == "csv" else 0


def export(
    df: DataFrame, path: str, layout: Layout, encoding: str = "parquet", symbols=None,
    split_symbols: bool = False, split_duration: str = "day", split_size: int | None = None,
    map_symbols: bool | None = None, intervals: DataFrame | None = None,
    pretty_px: bool = False, pretty_ts: bool = False, limit: int | None = None,
    compression: str | None = None, mode: str = "x",
) -> None:
    """Files partitioned by symbol and time, sorted by time inside.

    Rows are range-partitioned by the split and the time, so a symbol and day with
    most of the rows still spreads over many tasks. With ``split_size`` they are cut into
    files of at most so many bytes, as they are before compression, measured row by row;
    the number of the file is one more partition column.
    """
    checked_size(split_size)
    everything = tx.normal_symbols(symbols) == [tx.ALL_SYMBOLS]
    if split_symbols and everything:
        raise ValueError("split_symbols needs a list of symbols")
    mapped = encoding in ("csv", "json") if map_symbols is None else map_symbols
    if (mapped or split_symbols or not everything) and "symbol" not in df.columns:
        if intervals is None:
            raise ValueError("symbols need an interval table")
        df = symbology.add_symbol(df, intervals)
    if not everything:
        df = df.where(F.col("symbol").isin(tx.normal_symbols(symbols)))
    index = index_column(df.columns)
    if limit is not None:
        df = first_records(df, limit)
    df = df.withColumn("split", split_key(F.col(index), split_duration))
    parts = ["split"]
    if split_symbols:
        df = df.withColumn("split_symbol", F.coalesce("symbol", F.lit("")))
        parts = ["split_symbol", "split"]
    if not mapped and "symbol" in df.columns:
        df = df.drop("symbol")
    ties = [c for c in ("publisher_id", "instrument_id", "sequence") if c in df.columns]
    order = [f"_order_{i}" for i in range(1 + len(ties))]
    df = df.withColumns({o: F.col(c).cast("bigint") for o, c in zip(order, [index, *ties])})
    keep = [*parts, *order]
    if encoding == "csv":
        df = files.csv_columns(df, layout, pretty_px, pretty_ts, keep=keep)
    elif encoding == "json":
        df = files.json_lines(files.json_columns(df, layout, pretty_px, pretty_ts, keep=keep), keep=keep)
    shown = [c for c in df.columns if c not in keep]
    if split_size is None:
        df = df.repartitionByRange(*parts, *order)
    else:
        df = file_numbers(df, parts, order, written_bytes(df, shown, encoding), split_size - header_bytes(shown, encoding))
        parts = [*parts, "file"]
        df = df.repartition(*parts)
    df = df.sortWithinPartitions(*parts, *order).drop(*order)
    writer = df.write.mode(files.save_mode(mode)).partitionBy(*parts)
    if encoding == "parquet":
        writer.option("compression", compression or "zstd").parquet(path)
    elif encoding == "csv":
        writer.option("header", True).option("emptyValue", "").option(
            "compression", files.TEXT_CODECS[compression]).csv(path)
    elif encoding == "json":
        writer.option("compression", files.TEXT_CODECS[compression]).text(path)
    else:
        raise ValueError(f"encoding must be parquet, csv or json, not {encoding!r}")


def verify(spark: SparkSession, manifest: DataFrame, path: str, chunk_bytes: int = 32_000_000) -> DataFrame:
    """Compare a manifest ``(filename, size, hash)`` with the files below ``path``.

    ``status`` is ``ok``, ``missing``, ``extra``, ``too_small``, ``too_large``,
    ``bad_hash`` or ``unchecked`` (a hash other than sha256). Files are listed
    without their content and hashed in chunks inside the tasks, whatever their size.
    """
    base = path.rstrip("/") + "/"
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", F.col("length").alias("actual_size"))
        .repartition(F.col("path"))
        .mapInPandas(_digests(chunk_bytes), "path string, actual_size bigint, digest string")
        .select(F.substring_index("path", base, -1).alias("filename"), "actual_size", "digest")
    )
    both = manifest.select("filename", "size", "hash").join(listed, "filename", "full_outer")
    algo = F.substring_index("hash", ":", 1)
    want = F.substring_index("hash", ":", -1)
    return both.select(
        "filename", "size", "actual_size",
        F.when(F.col("actual_size").isNull(), "missing").when(F.col("size").isNull(), "extra")
        .when(F.col("actual_size") < F.col("size"), "too_small")
        .when(F.col("actual_size") > F.col("size"), "too_large")
        .when(algo != "sha256", "unchecked").when(want != F.col("digest"), "bad_hash")
        .otherwise("ok").alias("status"))


def _digests(chunk_bytes: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        from urllib.parse import unquote

        from pyarrow import fs

        for frame in frames:
            out = []
            for name in frame["path"]:
                store, inner = fs.FileSystem.from_uri(
                    name.replace("file:/", "file:///", 1) if name.startswith("file:/") and
                    not name.startswith("file://") else name)
                digest = hashlib.sha256()
                with store.open_input_stream(unquote(inner)) as stream:
                    while block := stream.read(chunk_bytes):
                        digest.update(block)
                out.append(digest.hexdigest())
            yield frame.assign(digest=out)
    return run


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    """A manifest of the files below ``path``."""
    base = path.rstrip("/") + "/"
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", F.col("length").alias("actual_size"))
        .repartition(F.col("path"))
        .mapInPandas(_digests(32_000_000), "path string, actual_size bigint, digest string")
        .select(F.substring_index("path", base, -1).alias("filename"), F.col("actual_size").alias("size"),
                F.concat(F.lit("sha256:"), "digest").alias("hash"))
    )
