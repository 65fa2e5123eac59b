"""Streams give what the same operator gives on the whole input."""

import time
import warnings

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars as batch_bars
from tickloom.session import shared_dir
from tickloom.streaming import operators as op
from tickloom.streaming import sinks, sources

S = 10**9
B = 1_699_999_980 * S  # a whole minute
SCHEMA = "publisher_id int, instrument_id bigint, ts_event bigint, ts_recv bigint, sequence bigint, price bigint, size bigint, flags int, symbol string"


def data(spark):
    i = F.col("id")
    return spark.range(600).select(
        F.lit(1).alias("publisher_id"), (i % 3).alias("instrument_id"), (B + i * 7 * S).alias("ts_event"),
        (B + i * 7 * S + 5).alias("ts_recv"), i.alias("sequence"), ((i * 31) % 50 * S).alias("price"), (i % 5).alias("size"),
        F.when(i % 50 == 0, 8).otherwise(0).alias("flags"), F.concat(F.lit("S"), (i % 3).cast("string")).alias("symbol"))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Three files in time order."""
    root = tmp_path_factory.mktemp("feed")
    for k in range(3):
        data(spark).where((F.col("sequence") >= k * 200) & (F.col("sequence") < k * 200 + 200)).coalesce(1).write.mode(
            "append").parquet(str(root))
        time.sleep(0.05)
    return str(root)


@pytest.fixture
def stream(spark, folder):
    return lambda: sources.open_stream(spark, folder, spark.read.parquet(folder).schema, max_files=1)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_bars_match_batch(spark, stream):
    got = sinks.drain(spark, op.bars(stream(), "1 minute"))
    whole = batch_bars.ohlcv(data(spark), "1m")
    last = B + 599 * 7 * S - 60 * S
    assert rows(got) == rows(whole.where(F.col("ts_event") + 60 * S <= last).select(*got.columns))


def test_activity_matches_batch(spark, stream):
    got = sinks.drain(spark, op.activity(stream(), "5 minutes", "1 minute"))
    again = op.activity(data(spark), "5 minutes", "1 minute").where(F.col("window_end") <= B + 599 * 7 * S - 60 * S)
    assert rows(got) == rows(again)


def test_repeats_are_dropped(spark, stream):
    s = stream()
    assert sinks.drain(spark, op.without_repeats(s.unionByName(stream()))).count() == 600


def test_live_symbols(spark, stream):
    s = stream().withColumn("stype_out_symbol", F.concat(F.lit("N"), F.col("sequence").cast("string")))
    got = {r["instrument_id"]: r["symbol"] for r in sinks.drain(spark, op.live_symbols(s), "complete").collect()}
    assert got == {0: "N597", 1: "N598", 2: "N599"}


def test_mapped_stream(spark, stream):
    table = spark.sql("select 1L instrument_id, date'2023-11-14' start_date, date'2023-11-16' end_date, 'ONE' symbol, 0L seq")
    out = sinks.drain(spark, op.add_symbol(stream(), table).select("instrument_id", "symbol"))
    assert {tuple(r) for r in out.collect()} == {(0, None), (1, "ONE"), (2, None)}
    assert out.count() == 600
    # a table above the broadcast limit is joined by shuffle
    large = sinks.drain(spark, op.add_symbol(stream(), table, broadcast_bytes=-1).select("instrument_id", "symbol"))
    assert rows(large.where("symbol is not null")) == rows(out.where("symbol is not null"))


def test_spans_end_in_silence(spark, tmp_path):
    quiet = data(spark).where("sequence < 10 or (sequence > 100 and sequence < 110) or sequence > 500")
    quiet.coalesce(1).write.parquet(str(tmp_path / "q"))
    s = sources.open_stream(spark, str(tmp_path / "q"), quiet.schema)
    got = rows(sinks.drain(spark, op.active_spans(s, ["publisher_id"])).select("first_ts", "silent_from", "records"))
    assert got == [(B, B + 63 * S + 40 * S, 10), (B + 707 * S, B + 763 * S + 40 * S, 9)]


def test_subscribe(spark, stream):
    assert sinks.drain(spark, sources.subscribe(stream(), symbols="s1", start=0)).count() == 200
    assert sinks.drain(spark, sources.subscribe(stream(), symbols=[2], stype="instrument_id", start=B + 300 * 7 * S)).count() == 100
    for bad in ({"snapshot": True, "start": 0, "schema": "mbo"}, {"snapshot": True, "schema": "trades"}):
        with pytest.raises(ValueError):
            sources.subscribe(stream(), **bad)


def test_snapshot_comes_from_its_own_stream(spark, stream, tmp_path):
    data(spark).limit(7).write.parquet(str(tmp_path / "snap"))
    snap = sources.open_stream(spark, str(tmp_path / "snap"), data(spark).schema)
    out = sinks.drain(spark, sources.subscribe(stream(), "mbo", snapshot=True, state=snap))
    assert out.count() == 607 and out.where(F.col("flags").bitwiseAND(32) != 0).count() == 7


def test_late_and_good(stream, spark):
    late, good = op.late_and_good(stream(), B + 70 * S)
    assert sinks.drain(spark, late).count() == 10 + 11 and sinks.drain(spark, good).count() == 579


def test_routes(spark):
    df = spark.createDataFrame([(21, 0), (23, 0), (23, 1), (22, 0), (160, 0)], "rtype int, code int")
    codes = {"error": 21, "system": 23, "mapping": 22}
    out = op.classes(df, codes, interval_end=1)
    assert [r["record_class"] for r in out.collect()] == ["error", "heartbeat", "end_of_interval", "mapping", "data"]
    assert op.route(out, "data").count() == 1


def test_callback_errors_are_reported_and_the_stream_goes_on(stream):
    seen, errors = [], []

    def work(batch, n):
        seen.append(batch.count())
        if n == 1:
            raise RuntimeError("second batch")

    sinks.to_callback(stream(), work, errors.append).awaitTermination()
    assert seen == [200, 200, 200] and [str(e) for e in errors] == ["second batch"]


def test_lagging_batches_are_reported(spark, stream, tmp_path):
    seen = []
    sinks.watch_lag(stream(), lambda n, row: seen.append((n, row["records"]))).awaitTermination()
    assert seen == [(0, 200), (1, 200), (2, 200)]
    data(spark).limit(100).write.parquet(str(tmp_path / "few"))
    few = sources.open_stream(spark, str(tmp_path / "few"), data(spark).schema)
    sinks.watch_lag(few, lambda n, row: seen.append(n)).awaitTermination()
    assert len(seen) == 3


def test_ten_warnings_at_most():
    def fail(_batch, _n):
        raise ValueError("no")

    call = sinks.Callback(fail)
    with warnings.catch_warnings(record=True) as shown:
        warnings.simplefilter("always")
        for n in range(14):
            call(None, n)
    assert len(shown) == 10 and "not shown" in str(shown[-1].message)


def test_one_failing_sink_leaves_the_other(spark, stream, tmp_path):
    bad = stream().withColumn("price", F.when(F.col("sequence") > 300, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(0))
    good_path = str(tmp_path / "good")
    queries = [sinks.to_folder(bad, str(tmp_path / "bad")), *sinks.fan_out(stream(), [good_path])]
    failed = sinks.await_all(queries)
    assert len(failed) == 1 and spark.read.parquet(good_path).count() == 600


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    data(spark).where("sequence < 300").coalesce(1).write.parquet(src)
    schema = data(spark).schema
    sinks.to_folder(sources.open_stream(spark, src, schema), out, mark).awaitTermination()
    data(spark).where("sequence >= 300").coalesce(1).write.mode("append").parquet(src)
    sinks.to_folder(sources.open_stream(spark, src, schema), out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 600


def test_gap_callback(spark):
    gaps = spark.createDataFrame([(20, 26), (5, 9)], "gap_start bigint, gap_end bigint")
    seen, errors = [], []

    def work(a, b):
        seen.append((a, b))
        if a == 5:
            raise RuntimeError("x")

    sinks.report_gaps(gaps, work, errors.append)
    assert seen == [(5, 9), (20, 26)] and len(errors) == 1


def test_header_check(spark):
    sources.check_headers(spark.createDataFrame([(3, "A"), (3, "A")], "version int, dataset string"))
    with pytest.raises(ValueError, match="dataset"):
        sources.check_headers(spark.createDataFrame([(3, "A"), (3, "B")], "version int, dataset string"))


def test_shared_dir_follows_the_session(spark, monkeypatch):
    """The folder the cluster names is used; without one only a local run goes on."""
    class Conf:
        def __init__(self, value):
            self.get = lambda key, default=None: value if key == "spark.checkpoint.dir" else default

    class Session:
        def __init__(self, value, master):
            self.conf = Conf(value)
            self.sparkContext = type("C", (), {"master": master, "applicationId": "app"})()

    assert shared_dir(Session("hdfs://x/y/", "yarn"), "z").startswith("hdfs://x/y/z-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(None, "yarn"), "z")
    one, two = (shared_dir(Session(None, "local[2]"), "z") for _ in range(2))
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
