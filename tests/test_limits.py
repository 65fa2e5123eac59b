"""Values and sizes beyond the usual, and inputs that earlier versions got wrong."""

import pytest
from pyspark.sql import functions as F

from tickloom.functions.times import SECOND
from tickloom.operators import bars, catalog, filters, formatting, joins
from tickloom.plans import requests
from tickloom.schemas import layout
from tickloom.sinks import files
from tickloom.sources import records
from tickloom.sources import symbology as source

TRADES = "publisher_id int, instrument_id long, ts_event long, ts_recv long, sequence long, price long, size long"


def test_bars_order_by_any_sequence(spark):
    rows = [(1, 9, SECOND + 5, 0, q, q % 97, 10**13) for q in (2**33, 2**62, 2**63 - 1, 3)]
    for width in ("1s", "1m", "1d"):
        bar = bars.ohlcv(spark.createDataFrame(rows, TRADES), width).first()
        assert (bar["open"], bar["close"], bar["volume"]) == (3, (2**63 - 1) % 97, 4 * 10**13)
    whole = bars.profile(spark.createDataFrame(rows, TRADES), ["instrument_id"]).where("instrument_id is null").first()
    assert whole["volume"] == 4 * 10**13


def test_a_long_symbol_list_is_a_join(spark):
    names = spark.range(9000).select(F.concat(F.lit("S"), "id").alias("symbol"))
    got = filters.symbols(names, [f"s{i}" for i in range(0, 10_000, 2)])
    assert got.count() == 4500 and filters.symbols(names, ["S1", "S2"]).count() == 2
    ids = spark.range(9000).select(F.col("id").alias("instrument_id"))
    assert filters.symbols(ids, list(range(5000)), "instrument_id").count() == 5000


def test_info_objects_of_any_depth(spark):
    rows = [(1, '{"a":{"b":{"c":{"d":{"e":{"f":"deep"}}}}},"p":"1"}'), (2, '{"a":"{N/A","p":"x"}'), (3, '{"k":{"b":1},"k.b":2}'), (4, None)]
    got = {r["id"]: r.asDict() for r in formatting.flatten_info(spark.createDataFrame(rows, "id int, date_info string"), ["date_info"]).collect()}
    assert got[1]["a.b.c.d.e.f"] == "deep" and got[1]["p"] == "1"
    assert (got[2]["a"], got[2]["p"]) == ("{N/A", "x")
    assert got[3]["k.b"] == "2" and set(got[4].values()) == {4, None}


@pytest.mark.parametrize("how,rows", [("left", 4000), ("inner", 400), ("left_anti", 3600), ("left_semi", 400)])
def test_rows_without_a_key_and_equal_rows_are_spread(spark, how, rows):
    key = F.when(F.col("id") % 10 == 0, F.lit(1))
    left = spark.range(4000).select(key.alias("k"), F.lit("same").alias("v"), F.create_map(F.lit("a"), F.lit("b")).alias("m"))
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, w string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.salted_join(left, right, ["k"], how=how, rows_per_task=10)
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == rows and max(per_task) < 0.6 * rows


def test_a_later_document_wins(spark):
    entry = "array<struct<d0:string,d1:string,s:string>>"
    docs = spark.createDataFrame([
        ("raw_symbol", "instrument_id", {"A": [("2024-01-01", "2024-06-01", "7")]}),
        ("raw_symbol", "instrument_id", {"B": [("2024-01-01", "2024-03-01", "7")]})],
        f"stype_in string, stype_out string, result map<string,{entry}>").coalesce(1)
    with pytest.raises(ValueError, match="order"):
        source.from_response(docs)
    told = docs.withColumn("document_time", F.lit("2024-01-01 00:00:00.0004").cast("timestamp")).withColumn(
        "document_name", F.when(F.array_contains(F.map_keys("result"), "A"), "1.json").otherwise("2.json"))
    got = {r["symbol"]: r["seq"] for r in source.from_response(told).collect()}
    assert got["A"] < got["B"]
    far = {r["symbol"]: r["seq"] for r in source.from_response(docs, F.when(F.col("result").isNotNull(), F.lit(2**62))).collect()}
    assert far["A"] > 2**120


def test_files_of_one_stream_share_what_counts(spark):
    fields = "version int, start long, ts_out boolean, mappings array<string>"
    ranges = spark.createDataFrame([(1, 10, False, ["a"]), (1, 20, False, ["a"])], fields)
    assert catalog.metadata_differences(ranges).first()["compatible"]
    other = spark.createDataFrame([(1, 10, False, ["a"]), (1, 10, True, ["b"])], fields)
    assert catalog.metadata_differences(other).first()["differing"] == ["ts_out", "mappings"]


def test_countries_need_their_column(spark):
    table = spark.createDataFrame([("2024-01-02", 1, 1)], "ex_date string, security_id int, event_id int").withColumn("ex_date", F.to_date("ex_date"))
    with pytest.raises(ValueError, match="listing_country"):
        requests.adjustment_factors(table, "2024-01-01", countries=["US"])


def test_a_symbol_in_the_record_is_replaced(spark):
    intervals = spark.createDataFrame([(7, "A$B", 0)], "instrument_id long, symbol string, seq long").select(
        "instrument_id", F.to_date(F.lit("2000-01-01")).alias("start_date"), F.to_date(F.lit("2100-01-01")).alias("end_date"), "symbol", "seq")
    head = '"hd":{"ts_event":"951782400000000000","instrument_id":7}'
    lines = spark.createDataFrame([("{ %s, \"symbol\": \"OLD\", \"note\" : \"a  b\" }" % head,), ("{%s}" % head,)], "value string")
    assert {r["value"] for r in files.map_json(lines, intervals).collect()} == {
        '{%s,"symbol":"A$B","note":"a  b"}' % head, '{%s,"symbol":"A$B"}' % head}


def test_a_bad_line_is_seen_whatever_is_read(spark, tmp_path):
    path = tmp_path / "trades.json"
    path.write_text('{"hd":{"ts_event":"1","instrument_id":7},"price":"5"}\nnot a record\n')
    with pytest.raises(Exception, match="invalid record"):
        records.read_json(spark, str(path), layout("trades")).select("price").collect()
