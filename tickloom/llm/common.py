"""Helpers the operators share: reading inputs, folders, prefix sums, blocks of text."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.joins import stored
from tickloom.session import shared_dir

__all__ = ["SPACE", "WORD", "blocks", "buckets_for", "open_store", "read", "running_start", "shared_dir", "ship", "stored",
           "word_count"]

#: Characters that part words, and a word, as Java and RE2 patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        base = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="tickloom-")) / "tickloom.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for path in sorted((base / "tickloom").rglob("*.py")):
                archive.write(path, path.relative_to(base))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def buckets_for(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def running_start(df: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[str], value: str,
                  name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows of the group that come before the row.

    Rows come in the order of ``bucket`` and, inside a bucket, of ``order``. Bucket sums
    are added up first, one row per bucket, so that no task holds a whole group.
    ``df`` should be a stored table: it is read twice.
    """
    sums = df.groupBy(*groups, bucket).agg(F.sum(value).alias("_sum"))
    whole = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*groups, bucket, F.coalesce(F.sum("_sum").over(whole), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(base, [*groups, bucket])
        .withColumn(name, (F.col("_base") + F.coalesce(F.sum(value).over(inner), F.lit(0))).cast("long"))
        .drop("_base")
    )


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           chars: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of Arrow batches with about ``chars`` bytes of ``column`` and at least one
    row, beside that column as a list."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        begin, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > chars:
                part = batch.slice(begin, i - begin)
                yield part, part.column(column).to_pylist()
                begin, held = i, 0
            held += n
        if begin < len(sizes):
            part = batch.slice(begin)
            yield part, part.column(column).to_pylist()


def open_store(path: str):
    """The file system of a shared folder, and the path on it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path
