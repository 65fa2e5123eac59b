"""The publisher dimension.

A publisher name is ``DATASET.VENUE`` with a two-part dataset, so the name alone
gives both. ``publishers.csv`` beside this module lists the feeds that venues publish
themselves; consolidated products of resellers come from a table of the user's own,
``publisher_id, name, description`` as Parquet or CSV.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.operators.joins import lookup_join


def dataset_of(name: Column) -> Column:
    return F.substring_index(name, ".", 2)


def venue_of(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def _with_parts(raw: DataFrame) -> DataFrame:
    name = F.col("name")
    return raw.select(F.col("publisher_id").cast("int").alias("publisher_id"), "name",
                      venue_of(name).alias("venue"), dataset_of(name).alias("dataset"),
                      F.col("description"))


def read_publishers(spark: SparkSession, path: str) -> DataFrame:
    return _with_parts(spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path))


def shipped_rows() -> list[tuple[int, str, str]]:
    with open(Path(__file__).with_name("publishers.csv"), newline="", encoding="utf-8") as lines:
        rows = csv.reader(line for line in lines if not line.startswith("#"))
        next(rows)
        return [(int(i), name, text) for i, name, text in rows]


def known_publishers(spark: SparkSession, more: DataFrame | None = None) -> DataFrame:
    """The feeds that come with this package and ``more``, a table as ``read_publishers``
    gives it, whose rows count where both know an id."""
    own = _with_parts(spark.createDataFrame(shipped_rows(), "publisher_id int, name string, description string"))
    if more is None:
        return own
    return own.join(more.select("publisher_id"), "publisher_id", "left_anti").unionByName(more.select(*own.columns))


def code_table(publishers: DataFrame, column: str) -> DataFrame:
    """Integer codes of venues or datasets by first appearance among publisher ids."""
    first = publishers.groupBy(column).agg(F.min("publisher_id").alias("first_id"))
    return first.select(column, F.row_number().over(W.orderBy("first_id")).alias("code"))


def add_publisher(df: DataFrame, publishers: DataFrame, strict: bool = False) -> DataFrame:
    """Name, venue, dataset and description by publisher id."""
    out = lookup_join(df, publishers.select("publisher_id", "name", "venue", "dataset", "description"),
                      ["publisher_id"])
    if strict:
        out = out.withColumn("name", F.when(F.col("name").isNotNull(), F.col("name")).otherwise(
            F.raise_error(F.concat(F.lit("unknown publisher id "), F.col("publisher_id").cast("string")))
            .cast("string")))
    return out
