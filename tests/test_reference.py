"""Reference tables: explicit types, versions, info fields, adjustments."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom.operators import catalog, formatting, pointintime
from tickloom.plans import requests
from tickloom.sources import reference, venues
from tickloom.schemas import layout


def lines(path, *rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


ACTION = {"ts_record": "2023-10-10T04:37:14Z", "event_unique_id": "U-1", "event": "RSPLT", "event_date": "2023-10-10",
          "ex_date": "bad", "us_code": "037833100", "multi_currency": False, "rd_priority": 1, "par_value": 0.01,
          "date_info": {}, "rate_info": {"par_value_old": 0.01, "maxprice": 5}, "event_info": {},
          "ts_created": "2024-01-01T00:00:00Z"}


def test_corporate_actions(spark, tmp_path):
    path = lines(tmp_path / "c.jsonl", ACTION,
                 {**ACTION, "ts_record": "2023-11-01T00:00:00Z", "par_value": None, "event": "DIV"})
    df = reference.read_reference(spark, path, "corporate_actions")
    assert len(df.columns) == 104
    flat = formatting.flatten_info(df, renames=True)
    assert {"par_value_old", "max_price"} <= set(flat.columns) and "rate_info" not in flat.columns
    assert len(flat.columns) == 103
    every = pointintime.events(flat, pit=True).collect()
    assert [str(r["ts_record"]) for r in every] == ["2023-10-10 04:37:14", "2023-11-01 00:00:00"]
    last = pointintime.events(flat).collect()
    assert len(last) == 1 and str(last[0]["ts_record"]) == "2023-11-01 00:00:00"
    # an empty value keeps the older one; an unreadable date is empty; zeros stay
    assert last[0]["par_value"] == 0.01 and last[0]["event"] == "DIV"
    assert last[0]["ex_date"] is None and last[0]["us_code"] == "037833100"
    assert pointintime.events(df, mode="row").first()["par_value"] is None


def test_version_without_record_time_wins(spark):
    df = spark.createDataFrame([("a", dt.datetime(2020, 1, 1), 1), ("a", None, 2), (None, dt.datetime(2021, 1, 1), 3)],
                               "event_unique_id string, ts_record timestamp, v int")
    got = pointintime.latest_values(df).collect()
    assert [(r["event_unique_id"], r["v"]) for r in got] == [("a", 2)]


def test_zstd_and_empty(spark, tmp_path):
    import zstandard

    raw = (json.dumps({"security_id": 39827, "us_code": "037833100", "ex_date": "2007-02-13", "factor": 0.99,
                       "ts_created": "2024-06-10T07:21:25.845228Z"}) + "\n").encode()
    (tmp_path / "a.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(raw))
    row = reference.read_reference(spark, str(tmp_path / "a.jsonl.zst"), "adjustment_factors").first()
    assert row["us_code"] == "037833100" and str(row["ex_date"]) == "2007-02-13"
    (tmp_path / "e.jsonl").write_text("")
    empty = reference.read_reference(spark, str(tmp_path / "e.jsonl"), "security_master")
    assert empty.count() == 0 and len(empty.columns) == 50


def test_last_master(spark, tmp_path):
    base = {"ts_record": "2024-08-07T23:00:00Z", "listing_id": "L-1", "cik": "0000320193"}
    path = lines(tmp_path / "m.jsonl", {**base, "ts_effective": "2024-08-07T00:00:00Z"},
                 {**base, "ts_effective": "2024-08-15T00:00:00Z"})
    df = reference.read_reference(spark, path, "security_master")
    got = pointintime.last_master(df).collect()
    assert len(got) == 1 and str(got[0]["ts_effective"]) == "2024-08-15 00:00:00" and got[0]["cik"] == "0000320193"


def test_nested_info(spark):
    df = spark.createDataFrame([('{"a":1,"b":{"c":"x","d":{"e":2}}}', '{"a":"y","k":9}')], "event_info string, rate_info string").withColumn("k", F.lit("kept"))
    got = formatting.flatten_info(df, ("event_info", "rate_info"))
    assert sorted(got.columns) == sorted(["k", "a_event_info", "b.c", "b.d.e", "a_rate_info", "k_rate_info"])
    row = got.first()
    assert (row["b.d.e"], row["a_event_info"], row["a_rate_info"], row["k"]) == ("2", "1", "y", "kept")
    given = formatting.flatten_info(df, ("event_info", "rate_info"), keys={"event_info": ["a"], "rate_info": []})
    assert given.columns == ["k", "a"]


def test_renamed_fields(spark):
    m = spark.sql("select map('maxprice','1','max_price','2','minprice','3') as m").select(formatting.rename_keys(F.col("m")))
    assert m.first()[0] == {"max_price": "2", "min_price": "3"}
    assert len(formatting.INFO_RENAMES) == 46


def test_master_without_look_ahead(spark):
    d = lambda n: dt.date(2020, 1, n)
    master = spark.createDataFrame([("x", d(1), d(1), "a"), ("x", d(5), d(9), "b"), ("x", d(3), d(11), "late")],
                                   "id string, ts_effective date, ts_record date, name string")
    facts = spark.createDataFrame([("x", d(n)) for n in (1, 5, 8, 9, 11, 20)], "id string, t date")
    got = {r["t"].day: r["name"] for r in pointintime.master_as_of(facts, master, "id", "t", ["name"]).collect()}
    assert got == {1: "a", 5: "a", 8: "a", 9: "b", 11: "b", 20: "b"}
    spread = pointintime.master_as_of(facts, master, "id", "t", ["name"], broadcast_bytes=-1, rows_per_segment=1)
    assert {r["t"].day: r["name"] for r in spread.collect()} == got


def test_back_adjustment(spark):
    d = lambda n: dt.date(2020, 1, n)
    f = spark.createDataFrame([(1, d(5), 0.5), (1, d(5), 0.5), (1, d(9), 0.8)], "security_id bigint, ex_date date, factor double")
    t = spark.createDataFrame([(1, d(n), 100.0) for n in (1, 4, 5, 8, 9)] + [(2, d(1), 100.0)],
                              "security_id bigint, day date, price double")
    got = {(r["security_id"], r["day"].day): round(r["adjusted_price"], 9) for r in pointintime.back_adjust(t, f, "day").collect()}
    assert got == {(1, 1): 40.0, (1, 4): 40.0, (1, 5): 80.0, (1, 8): 80.0, (1, 9): 100.0, (2, 1): 100.0}


def test_fields(spark):
    shown = {(r["name"], r["type"]) for r in catalog.fields(spark, [layout("mbo")], "json").collect()}
    assert ("hd.ts_event", "string") in shown and ("order_id", "string") in shown and ("size", "bigint") in shown
    assert catalog.fields(spark, [layout("mbp-10")]).count() == 73


def test_publishers(spark, tmp_path):
    (tmp_path / "p.csv").write_text("publisher_id,name,description\n1,GLBX.MDP3.GLBX,Futures\n2,XNAS.ITCH.XNAS,Stocks\n")
    pub = venues.read_publishers(spark, str(tmp_path / "p.csv"))
    assert tuple(pub.orderBy("publisher_id").first()) == (1, "GLBX.MDP3.GLBX", "GLBX", "GLBX.MDP3", "Futures")
    df = spark.createDataFrame([(1,), (9,)], "publisher_id int")
    assert venues.add_publisher(df, pub).where("name is null").count() == 1
    with pytest.raises(Exception, match="unknown publisher id 9"):
        venues.add_publisher(df, pub, strict=True).collect()
    shipped = venues.known_publishers(spark)
    assert shipped.count() == shipped.select("publisher_id").distinct().count() == len(venues.shipped_rows())
    assert shipped.where("venue is null or dataset not like '%.%' or description = ''").count() == 0
    own = spark.createDataFrame([(1, "OWN.FEED.MINE", "MINE", "OWN.FEED", "ours"), (9_000, "OWN.FEED.MORE", "MORE", "OWN.FEED", "ours")], shipped.schema)
    both = {r["publisher_id"]: r["venue"] for r in venues.known_publishers(spark, own).collect()}
    assert (both[1], both[9_000], both[2], len(both)) == ("MINE", "MORE", "XNAS", shipped.count() + 1)


def test_metadata_differences(spark):
    m = spark.createDataFrame([(3, "A", ["x"], None), (3, "B", ["x"], None)], "version int, dataset string, symbols array<string>, limit int")
    row = catalog.metadata_differences(m).first()
    assert row["differing"] == ["dataset"] and not row["compatible"]


def test_conditions_include_both_ends(spark):
    day = 86_400 * 10**9
    df = spark.createDataFrame([("d", 0, 0), ("d", 2 * day, 4)], "dataset string, ts_recv bigint, flags int")
    got = {str(r["date"]): r["condition"] for r in catalog.dataset_condition(df, "1970-01-01", "1970-01-03").collect()}
    assert got == {"1970-01-01": "available", "1970-01-02": "missing", "1970-01-03": "degraded"}


def test_requests(spark, tmp_path):
    path = lines(tmp_path / "c.jsonl", {**ACTION, "symbol": "A", "listing_country": "US", "exchange": "X", "security_type": "EQS"},
                 {**ACTION, "symbol": "B", "event_unique_id": "U-2", "listing_country": "GB", "event": "DIV"})
    df = reference.read_reference(spark, path, "corporate_actions")
    got = requests.corporate_actions(df, "2023-10-10", symbols="a,b", events="RSPLT,DIV", countries=["US"])
    assert got.columns[0] == "event_date" and [r["symbol"] for r in got.collect()] == ["A"]
    assert requests.corporate_actions(df, "2023-10-10", pit=True, flatten=False).count() == 2
    assert requests.corporate_actions(df, "2023-10-09", "2023-10-10").count() == 0
    master = reference.read_reference(spark, lines(tmp_path / "m.jsonl", {
        "listing_id": "L", "ts_record": "2024-08-07T23:00:00Z", "ts_effective": "2024-08-07T00:00:00Z", "symbol": "A",
        "listing_country": "US"}), "security_master")
    assert requests.security_master(master, "2024-08-07", "2024-08-08", countries="US,GB").count() == 1
    assert requests.security_master(master, "2024-08-07T00:00:01").count() == 0
    assert requests.last_security_master(master, "A").count() == 1 and requests.last_security_master(master, "Z").count() == 0


def test_time_series_request(spark):
    day = 86_400 * 10**9
    df = spark.range(40).select((F.col("id") * (day // 4)).alias("ts_recv"), (F.col("id") % 2).alias("instrument_id"),
                                F.lit(1).alias("publisher_id"), F.col("id").alias("sequence"))
    table = spark.sql("select 0L instrument_id, date'1970-01-02' start_date, date'1970-01-04' end_date, 'A' symbol, 0L seq "
                      "union all select 1L, date'1970-01-03', date'1970-01-09', 'A', 1L")
    got = requests.time_series(df, "1970-01-01", "1970-01-06", "a", intervals=table).collect()
    assert [r["sequence"] for r in got] == [4, 6, 8, 9, 10, 11, 13, 15, 17, 19]
    assert requests.time_series(df, "1970-01-03", symbols=[1], stype_in="instrument_id").count() == 2
    assert [r["sequence"] for r in requests.time_series(df, 0, 10 * day, limit=3).collect()] == [0, 1, 2]
    assert requests.record_count(df, start=0, end=10 * day, limit=7).first()[0] == 7
    with pytest.raises(ValueError):
        requests.time_series(df, 0, 1, "A")
