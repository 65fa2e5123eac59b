"""Symbol resolution against a plain per-row reading of the rule."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import joins, smart, symbology
from tickloom.schemas import layout
from tickloom.sinks import files
from tickloom.sources import symbology as source

INTERVALS = "instrument_id bigint, start_date date, end_date date, symbol string, seq bigint"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def expected(rows, iid, date):
    """The latest started interval decides; of equal starts the last inserted."""
    started = [r for r in rows if r[0] == iid and r[1] <= date]
    if not started:
        return None
    best = max(started, key=lambda r: (r[1], r[4]))
    return best[3] if date < best[2] else None


def random_case(seed, ids=6, spans=40, facts=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(spans):
        a = rnd.randrange(0, 60)
        rows.append((rnd.randrange(ids), day(a), day(a + rnd.randrange(0, 25)), f"S{i}", i))
    # a third of all facts on one instrument
    points = [(0 if rnd.random() < 0.34 else rnd.randrange(ids + 1), day(rnd.randrange(-3, 90)), n) for n in range(facts)]
    return rows, points


@pytest.mark.parametrize("options", [
    {}, {"split": True}, {"broadcast_bytes": -1, "rows_per_task": 20},
    {"split": True, "broadcast_bytes": -1, "rows_per_task": 20}])
@pytest.mark.parametrize("seed", [1, 2])
def test_resolve_matches_the_rule(spark, options, seed):
    rows, points = random_case(seed)
    intervals = spark.createDataFrame(rows, INTERVALS)
    facts = spark.createDataFrame(points, "instrument_id bigint, d date, n int")
    got = symbology.resolve(facts, intervals, "d", **options)
    assert got.columns == ["instrument_id", "d", "n", "symbol"]
    assert {(r["n"], r["symbol"]) for r in got.collect()} == {(n, expected(rows, i, d)) for i, d, n in points}
    assert got.count() == len(points)


def test_boundaries(spark):
    rows = [(1, day(0), day(10), "A", 0), (1, day(5), day(6), "B", 1), (1, day(5), day(8), "C", 2)]
    intervals = spark.createDataFrame(rows, INTERVALS)
    facts = spark.createDataFrame([(1, day(i)) for i in (-1, 0, 4, 5, 7, 8, 9, 10)] + [(2, day(0))],
                                  "instrument_id bigint, d date")
    got = {(r["instrument_id"], r["d"]): r["symbol"] for r in symbology.resolve(facts, intervals, "d").collect()}
    # day 8 and 9: the later interval has ended, the older one does not come back
    assert [got[1, day(i)] for i in (-1, 0, 4, 5, 7, 8, 9, 10)] == [None, "A", "A", "C", "C", None, None, None]
    assert got[2, day(0)] is None


def test_no_intervals(spark):
    facts = spark.createDataFrame([(1, day(0))], "instrument_id bigint, d date")
    assert symbology.resolve(facts, spark.createDataFrame([], INTERVALS), "d").first()["symbol"] is None


def test_daily_rotation(spark):
    """100 instruments whose symbols move on by one every day of a year."""
    ids, days = 100, 366
    grid = spark.range(ids * days).select((F.col("id") % ids).alias("instrument_id"), F.floor(F.col("id") / ids).cast("int").alias("k"))
    symbol = F.concat(F.lit("SYM"), ((F.col("instrument_id") + F.col("k")) % ids).cast("string"))
    start = F.date_add(F.lit("2020-01-01").cast("date"), F.col("k"))
    intervals = grid.select("instrument_id", start.alias("start_date"), F.date_add(start, 1).alias("end_date"),
                            symbol.alias("symbol"), F.col("k").cast("bigint").alias("seq"))
    facts = grid.select("instrument_id", start.alias("d"), symbol.alias("want"))
    got = symbology.resolve(facts, intervals, "d")
    assert got.where(~F.col("want").eqNullSafe(F.col("symbol"))).count() == 0
    assert got.count() == ids * days


def test_insert_and_clear(spark):
    base = spark.createDataFrame([(1, day(0), day(5), "A", 3)], INTERVALS)
    more = spark.createDataFrame([(1, day(0), day(5), "B", 0)], INTERVALS)
    both = symbology.insert(base, more)
    facts = spark.createDataFrame([(1, day(1))], "instrument_id bigint, d date")
    assert symbology.resolve(facts, both, "d").first()["symbol"] == "B"
    assert symbology.insert(base, more, clear_existing=True).count() == 1
    assert symbology.insert(base, base).agg(F.max("seq")).first()[0] == 7


RESPONSE = ('{"result":{"ESH1":[{"d0":"2020-12-28","d1":"2020-12-29","s":"5482"},{"d0":"2020-12-29","d1":"2020-12-30","s":""}]},'
            '"symbols":["ESH1"],"stype_in":"raw_symbol","stype_out":"instrument_id","start_date":"2020-12-28",'
            '"end_date":"2020-12-30","partial":[],"not_found":[],"message":"OK","status":0}')


def test_response_file(spark, tmp_path):
    (tmp_path / "symbology.json").write_text(RESPONSE)
    rows = source.from_response(source.read_response(spark, str(tmp_path))).collect()
    assert [(r["instrument_id"], str(r["start_date"]), str(r["end_date"]), r["symbol"]) for r in rows] == [
        (5482, "2020-12-28", "2020-12-29", "ESH1")]


def test_response_lacks_a_key(spark, tmp_path):
    (tmp_path / "symbology.json").write_text(RESPONSE.replace('"partial":[],', ""))
    with pytest.raises(Exception, match="lacks: partial"):
        source.from_response(source.read_response(spark, str(tmp_path))).collect()


def test_response_by_instrument_id(spark, tmp_path):
    text = RESPONSE.replace('"ESH1":[', '"5482":[').replace('"s":"5482"', '"s":"ESH1"').replace(
        '"stype_in":"raw_symbol","stype_out":"instrument_id"', '"stype_in":"instrument_id","stype_out":"raw_symbol"')
    (tmp_path / "s.json").write_text(text)
    row = source.from_response(source.read_response(spark, str(tmp_path))).first()
    assert (row["instrument_id"], row["symbol"]) == (5482, "ESH1")


def test_response_needs_an_id_side(spark, tmp_path):
    (tmp_path / "s.json").write_text(RESPONSE.replace('"stype_out":"instrument_id"', '"stype_out":"parent"'))
    with pytest.raises(Exception, match="instrument_id"):
        source.from_response(source.read_response(spark, str(tmp_path))).collect()


def test_messages(spark):
    ns = 86_400 * 10**9
    rows = [(1, 1, "ES.c.0", "5482", 18000 * ns + 5, 18000 * ns + 9), (2, 2, "ESH1", "ESM1", None, None)]
    m = spark.createDataFrame(rows, "instrument_id bigint, n int, stype_in_symbol string, stype_out_symbol string, "
                                    "start_ts bigint, end_ts bigint")
    got = {r["instrument_id"]: r for r in source.from_messages(m, F.col("n")).collect()}
    assert got[1]["symbol"] == "ES.c.0" and got[1]["start_date"] == got[1]["end_date"]
    assert got[2]["symbol"] == "ESM1"
    assert (str(got[2]["start_date"]), str(got[2]["end_date"])) == ("1677-09-21", "2262-04-11")


def test_csv_annotation_equals_mapped_export(spark):
    bars = layout("ohlcv-1m")
    rows = [(1609113600000000000 + i * 86_400 * 10**9, 33, 1, 5482, 1, 2, 1, 2, 7) for i in range(3)]
    df = spark.createDataFrame(rows, bars.struct)
    intervals = spark.createDataFrame([(5482, dt.date(2020, 12, 28), dt.date(2020, 12, 30), "ESH1", 0)], INTERVALS)
    plain = files.csv_columns(df, bars)
    mapped = files.csv_columns(df, bars, intervals=intervals)
    annotated = files.map_csv(plain, intervals)
    assert annotated.columns == mapped.columns
    assert sorted(annotated.collect()) == sorted(mapped.collect()) or (
        {tuple(r) for r in annotated.collect()} == {tuple(r) for r in mapped.collect()})
    assert {r["symbol"] for r in mapped.collect()} == {"ESH1", None}


def test_json_annotation(spark):
    intervals = spark.createDataFrame([(5482, dt.date(2020, 12, 28), dt.date(2020, 12, 30), 'E"1', 0)], INTERVALS)
    lines = spark.createDataFrame([('{"hd":{"ts_event":"1609113600000000000","instrument_id":5482},"x":1}',),
                                   ('{"hd":{"ts_event":"1609113600000000000","instrument_id":1}}',)], "value string")
    got = {r["value"] for r in files.map_json(lines, intervals).collect()}
    assert got == {'{"hd":{"ts_event":"1609113600000000000","instrument_id":5482},"x":1,"symbol":"E\\"1"}',
                   '{"hd":{"ts_event":"1609113600000000000","instrument_id":1},"symbol":null}'}
    with pytest.raises(Exception, match="invalid record"):
        files.map_json(spark.createDataFrame([("{}",)], "value string"), intervals).collect()


def test_only_the_top_level_symbol_is_set(spark):
    intervals = spark.createDataFrame([(7, dt.date(2020, 12, 28), dt.date(2020, 12, 30), 'N"1', 0)], INTERVALS)
    head = '"hd":{"symbol":"inner","ts_event":"1609113600000000000","instrument_id":7}'
    lines = [('{%s,"x":1.5,"symbol":"old","levels":[{"symbol":2}],"t":"a\\"b"}' % head, '{%s,"x":1.5,"symbol":"N\\"1","levels":[{"symbol":2}],"t":"a\\"b"}' % head),
             ('{%s}' % head, '{%s,"symbol":"N\\"1"}' % head),
             ('{"symbol":{"a":1},"hd":{"ts_event":"1609113600000000000","instrument_id":7}}', '{"symbol":"N\\"1","hd":{"instrument_id":7,"ts_event":"1609113600000000000"}}')]
    got = [json.loads(r["value"]) for r in files.map_json(spark.createDataFrame([x[:1] for x in lines], "value string"), intervals).collect()]
    told = lambda rows: sorted(json.dumps(r, sort_keys=True) for r in rows)
    assert told(got) == told(json.loads(b) for _, b in lines)


def test_file_to_file(spark, tmp_path):
    (tmp_path / "symbology.json").write_text(RESPONSE)
    table, csv, lines = (str(tmp_path / x) for x in ("symbology.json", "r.csv", "r.json"))
    (tmp_path / "r.csv").write_text("ts_event,instrument_id,note\n1609113600000000000,5482,a\n2020-12-29T01:00:00Z,5482,\n")
    (tmp_path / "r.json").write_text('{"hd":{"ts_event":"1609113600000000000","instrument_id":5482}}\n')
    out = files.map_csv_file(spark, table, csv)
    assert out == str(tmp_path / "r_mapped.csv") and files.map_csv_file(spark, table, csv) == str(tmp_path / "r_mapped_0.csv")
    assert sorted((r["ts_event"], r["symbol"]) for r in spark.read.option("header", True).csv(out).collect()) == [
        ("1609113600000000000", "ESH1"), ("2020-12-29T01:00:00Z", None)]
    assert spark.read.text(files.map_json_file(spark, table, lines)).first()[0].endswith('"symbol":"ESH1"}')
    with pytest.raises(ValueError, match="does not exist"):
        files.map_csv_file(spark, table, csv + "x")
    with pytest.raises(ValueError, match="must not be"):
        files.map_json_file(spark, table, lines, lines)
    with pytest.raises(ValueError, match="instrument_id"):
        files.map_csv_file(spark, table, table)


def test_a_newer_small_document_beats_an_older_large_one(spark, tmp_path):
    big = RESPONSE.replace('"symbols":["ESH1"]', '"symbols":[%s]' % ",".join('"X%d"' % i for i in range(5_000))).replace("ESH1", "OLD")
    (tmp_path / "a.json").write_text(RESPONSE.replace("ESH1", "NEW"))
    (tmp_path / "b.json").write_text(big)
    (tmp_path / "c.json").write_text(RESPONSE.replace("ESH1", "SAME"))
    for name, at in (("a.json", 1_700_000_100), ("b.json", 1_700_000_000), ("c.json", 1_700_000_000)):
        os.utime(tmp_path / name, (at, at))
    rows = source.from_response(source.read_response(spark, str(tmp_path))).orderBy("seq").collect()
    assert [r["symbol"] for r in rows] == ["OLD", "SAME", "NEW"]


def test_mapped_path():
    assert files.mapped_path("/a/b.csv") == "/a/b_mapped.csv"
    assert files.mapped_path("/a/b.csv", {"/a/b_mapped.csv"}) == "/a/b_mapped_0.csv"
    assert files.mapped_path("/a.b/c") == "/a.b/c_mapped"


def test_salted_join_keeps_every_row(spark):
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("k"), F.col("id").alias("n"))
    right = spark.createDataFrame([(i, f"v{i}") for i in range(5)] + [(7, "hot")], "k bigint, v string")
    want = sorted(map(tuple, left.join(right, "k", "left").select("k", "n", "v").collect()), key=str)
    for how in ("left", "inner", "left_semi"):
        got = joins.salted_join(left, right, ["k"], how=how, rows_per_task=30)
        plain = left.join(right, "k", how)
        assert got.count() == plain.count()
    got = joins.salted_join(left, right, ["k"], rows_per_task=30).select("k", "n", "v")
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert joins.hot_keys(left, ["k"], 30).where("k = 7").first()["_salts"] > 10


def test_status_counts_overlap_once(spark):
    wanted = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    rows = spark.createDataFrame([("A", day(0), day(6), "1"), ("A", day(3), day(10), "2"), ("B", day(2), day(4), "3"),
                                  ("B", day(2), day(3), "4")], "symbol string, d0 date, d1 date, s string")
    got = {r["symbol"]: (r["covered_days"], r["status"]) for r in
           symbology.resolution_status(wanted, rows, "2020-01-01", "2020-01-11").collect()}
    assert got == {"A": (10, "ok"), "B": (2, "partial"), "C": (0, "not_found")}


def test_continuous_merges_equal_days(spark):
    rows = [("ES", i, day(d), day(5 + 10 * i), 100 - 10 * i + d * 12 * i, 1) for d in range(4) for i in (0, 1)]
    stats = spark.createDataFrame(rows, "root string, instrument_id bigint, date date, expiration date, volume bigint, open_interest bigint")
    got = [tuple(r) for r in smart.continuous_intervals(stats, "v").where("symbol = 'ES.v.0'").orderBy("start_date").collect()]
    assert got == [("ES.v.0", 0, day(1), day(2)), ("ES.v.0", 1, day(2), day(5))]
    with pytest.raises(ValueError):
        smart.ranks(stats, "x")


def test_inverse_lists(spark):
    intervals = spark.createDataFrame([(1, day(0), day(10), "A", 0), (2, day(10), day(20), "A", 1)], INTERVALS)
    wanted = spark.createDataFrame([("A",), ("Z",)], "symbol string")
    got = {r["symbol"]: r for r in symbology.inverse_lists(wanted, intervals, "2020-01-05", "2020-01-15").collect()}
    assert [(str(x["d0"]), str(x["d1"]), x["s"]) for x in got["A"]["result"]] == [
        ("2020-01-05", "2020-01-11", "1"), ("2020-01-11", "2020-01-15", "2")]
    assert got["A"]["status"] == "ok" and got["Z"]["status"] == "not_found" and got["Z"]["result"] is None
