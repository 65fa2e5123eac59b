"""The plans the operators are meant to have."""

import re

import pytest
from compare import SF_DIR
from pyspark.sql import functions as F

from tickloom.operators import bars, filters, symbology
from tickloom.plans import registry, views
from tickloom.schemas import layout
from tickloom.sources import records

registry.load()
PYTHON = re.compile(r"Python|Pandas|Arrow")
PRODUCTS = re.compile(r"CartesianProduct|NestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(registry.QUERIES) if not n.startswith("stream_")])
def test_no_products_and_no_python(spark, name):
    text = plan(registry.QUERIES[name](spark, SF_DIR))
    assert not PRODUCTS.search(text)
    if name not in ("export_and_verify", "replay_steps", "verified_files"):
        assert not PYTHON.search(text)


def test_symbol_map_leaves_the_facts_in_place(spark):
    table = views.saved_intervals(spark, SF_DIR)
    text = plan(symbology.add_symbol(views.trades(spark, SF_DIR), table, normalised=True))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_symbol_map_beyond_the_limit_is_salted(spark):
    table = views.saved_intervals(spark, SF_DIR)
    df = symbology.add_symbol(views.trades(spark, SF_DIR), table, normalised=True, broadcast_bytes=-1)
    assert "_salt" in plan(df)


def test_range_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    t = views.ticks(spark, SF_DIR).withColumn("date", F.to_date(F.timestamp_seconds(F.col("ts_recv") / 1e9)))
    t.select(*layout("trades").columns, "date").write.partitionBy("date").parquet(path)
    df = filters.time_range(spark.read.parquet(path), "2024-01-05", "2024-01-07", date_column="date").select("price")
    text = plan(df)
    assert "GreaterThanOrEqual(ts_recv," in text and "LessThan(ts_recv," in text
    assert "ReadSchema: struct<ts_recv:bigint,price:bigint>" in text
    assert re.search(r"PartitionFilters: \[isnotnull\(date.*date#\d+ >= 2024-01-05.*date#\d+ <= 2024-01-06", text)
    names = [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
    assert names and all("date=2024-01-05" in f or "date=2024-01-06" in f for f in names)
    scan = records.read_records(spark, path, layout("trades")).where("instrument_id = 3").select("size")
    assert "EqualTo(instrument_id,3)" in plan(scan) and "price" not in plan(scan).split("ReadSchema")[1]


@pytest.mark.parametrize("name,column,both", [
    ("time_range", "l_shipdate", True), ("range_fills_forward", "l_shipdate", True), ("range_request", "l_shipdate", True), ("record_counts", "ts", False)])
def test_ranges_of_queries_reach_the_scan(spark, name, column, both):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # else the list is cut short
    try:
        scans = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(registry.QUERIES[name](spark, SF_DIR)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any(f"GreaterThanOrEqual({column}" in s and (not both or f"LessThanOrEqual({column}" in s) for s in scans)


def test_limit_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(filters.first_records(views.ticks(spark, SF_DIR), 10))


@pytest.mark.parametrize("width", ["1s", "1m"])
def test_bars_combine_before_one_shuffle(spark, width):
    text = plan(bars.ohlcv(views.ticks(spark, SF_DIR), width))
    assert "SortAggregate" not in text and text.count("Exchange") == 1
    assert "partial_min_by" in text


def test_rollup_reuses_its_shuffle(spark):
    df = registry.QUERIES["profile_rollup"](spark, SF_DIR)
    df.collect()
    text = plan(df)
    assert text.count("ReusedExchange") >= 2
