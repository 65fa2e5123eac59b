"""Operators with state: timers, live maps, lateness, snapshots in front of a stream."""

import time

import pytest
from pyspark.sql import functions as F

from tickloom.streaming import sinks, sources, state

S = 10**9
SCHEMA = "instrument_id bigint, ts_event bigint, sequence bigint, flags int, note string, at timestamp"


def append(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def feed(spark, path, schema=SCHEMA, **options):
    return sources.open_stream(spark, path, spark.createDataFrame([], schema).schema, **options)


def row(key, ts, sequence, flags=0, note=None):
    return key, ts, sequence, flags, note, None


def wait_for(check, seconds=60):
    until = time.monotonic() + seconds
    while not check():
        assert time.monotonic() < until
        time.sleep(0.1)


def test_a_feed_that_stops_is_reported_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    big = (1 << 62) + 1
    append(spark, src, [row(1, 5, 1), row(1, big, 2), row(1, None, 3), row(None, 7, 4), row(2, None, 5)])
    ended = state.timeouts(feed(spark, src), ["instrument_id"], limit=1.5, ts="ts_event")
    query = sinks.to_folder(ended, out, mark, once=False)
    state.run_until_silent(query)
    rows = {tuple(r) for r in spark.read.parquet(out).collect()}
    assert rows == {(1, 5, big, 3), (None, 7, 7, 1), (2, None, None, 1)}
    # one that comes back begins another spell; nothing is told twice
    append(spark, src, [row(1, 9, 6)])
    state.run_until_silent(sinks.to_folder(state.timeouts(feed(spark, src), ["instrument_id"], limit=1.5, ts="ts_event"), out, mark, once=False))
    assert {tuple(r) for r in spark.read.parquet(out).collect()} - rows == {(1, 9, 9, 1)} and spark.read.parquet(out).count() == 4


def test_a_restart_keeps_the_timer(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    append(spark, src, [row(1, 5, 1)])

    def start(limit):
        return sinks.to_folder(state.timeouts(feed(spark, src), ["instrument_id"], limit=limit, ts="ts_event"), out, mark, once=False)

    query = start(4.0)
    wait_for(lambda: query.lastProgress and query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1)
    query.stop()
    assert spark.read.schema("instrument_id bigint").parquet(out).count() == 0
    time.sleep(4.5)
    # no record comes any more: what ran out while the query was down is told by the old timer
    again = start(3_600.0)
    wait_for(lambda: spark.read.schema("instrument_id bigint").parquet(out).count() == 1)
    again.stop()
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(1, 5, 5, 1)]


def test_a_busy_query_is_given_up(spark, tmp_path):
    src = str(tmp_path / "src")
    append(spark, src, [row(1, 5, 1)])
    query = sinks.to_folder(state.timeouts(feed(spark, src), ["instrument_id"], limit=3_600.0, ts="ts_event"), str(tmp_path / "out"), once=False)
    with pytest.raises(TimeoutError):
        state.run_until_silent(query, seconds=3)
    assert not query.isActive


@pytest.mark.parametrize("salts", [1, 5])
def test_a_message_changes_later_rows_only(spark, tmp_path, salts):
    """Three batches; the map of a batch is that of the messages so far."""
    src, told, out, mark = (str(tmp_path / x) for x in ("src", "told", "out", "mark"))
    message = "instrument_id bigint, ts_event bigint, sequence bigint, stype_out_symbol string"
    big = (1 << 62) + 1
    parts = [
        ([row(1, 10, 1, note="{\"a\": 1}"), row(1, 30, 3), row(2, 10, 4), row(None, 10, 5)], [(1, 20, 2, "A"), (None, 1, 1, "X")]),
        ([row(1, 5, 6), row(1, big, 7), row(2, 50, 8)], []),
        ([row(1, 60, 9), row(1, 70, 11), row(2, 70, 12)], [(1, 70, 10, "B"), (2, 80, 1, "C"), (1, 1, 99, None)]),
    ]
    found = {}
    for records, messages in parts:
        append(spark, src, records)
        append(spark, told, messages, message)
        mapped = state.map_live(feed(spark, src), feed(spark, told, message), salts=salts)
        assert mapped.columns == ["instrument_id", "ts_event", "sequence", "flags", "note", "at", "symbol"]
        sinks.to_folder(mapped, out, mark).awaitTermination()
    for r in spark.read.parquet(out).collect():
        found[r["sequence"]] = r
    assert {k: r["symbol"] for k, r in found.items()} == {
        1: None, 3: "A", 4: None, 5: None, 6: "A", 7: "A", 8: None, 9: None, 11: "B", 12: None}
    assert found[7]["ts_event"] == big and found[1]["note"] == "{\"a\": 1}" and spark.read.parquet(out).count() == 10


def test_keys_share_buckets(spark, tmp_path):
    """Many keys: a batch has no more groups than buckets and salts, and each key its own symbol."""
    src, told, out, mark = (str(tmp_path / x) for x in ("src", "told", "out", "mark"))
    message = "instrument_id bigint, ts_event bigint, sequence bigint, stype_out_symbol string"
    for part in range(2):
        append(spark, src, [row(k, part * 100 + t, part * 1000 + k) for k in range(300) for t in (10, 30)] + [row(None, 30, -1)])
        append(spark, told, [(k, part * 100 + 20, 0, f"{k}.{part}") for k in range(0, 300, 1 + part)], message)
        mapped = state.map_live(feed(spark, src), feed(spark, told, message), salts=2, buckets=3)
        query = sinks.to_folder(mapped, out, mark)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 2
    got = {(r["instrument_id"], r["ts_event"]): r["symbol"] for r in spark.read.parquet(out).collect()}
    assert got == {(None, 30): None} | {(k, 10): None for k in range(300)} | {(k, t): f"{k}.0" for k in range(300) for t in (30, 110)} | {
        (k, 130): f"{k}.{1 - k % 2}" for k in range(300)}


def test_late_rows_are_told_and_kept(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    parts = [[100, 200], [150, 195, 300, None], [239, 240, 299, 10, 400]]
    for part in parts:
        append(spark, src, [row(1, None if t is None else t * S, 1) for t in part])
        told = state.with_lateness(feed(spark, src), "1 minute", salts=3)
        sinks.to_folder(told, out, mark).awaitTermination()
    rows = spark.read.parquet(out)
    got = {(r["ts_event"] and r["ts_event"] // S, r["watermark_ns"] // S) for r in rows.where("late").collect()}
    assert got == {(239, 240), (10, 240)}
    assert rows.count() == sum(map(len, parts)) and rows.where("not late").count() == 9
    assert {r[0] // S for r in rows.select("watermark_ns").distinct().collect()} == {0, 140, 240}


def test_a_bounded_snapshot_comes_once_and_first(spark, tmp_path):
    src, held, mark = (str(tmp_path / x) for x in ("src", "held", "mark"))
    snapshot = spark.createDataFrame([row(1, 1, i, 8) for i in range(7)], SCHEMA)
    batches = []

    def run():
        live = sources.subscribe(feed(spark, src, max_files=1), "mbo", snapshot=True, state=snapshot, snapshot_path=held)
        sinks.to_callback(live, lambda df, n: batches.append((n, df.where("flags = 40").count(), df.where("flags = 0").count())),
                          checkpoint=mark).awaitTermination()

    for k in range(3):
        append(spark, src, [row(1, 10 + k, 100 + k)])
    run()
    assert batches == [(0, 7, 1), (1, 0, 1), (2, 0, 1)]
    append(spark, src, [row(1, 20, 200)])
    run()
    assert batches[3:] == [(3, 0, 1)]
    # without a stream's name for it the snapshot is one of its own
    once = sources.subscribe(feed(spark, src), "mbo", snapshot=True, state=snapshot)
    assert sinks.drain(spark, once).groupBy(F.col("flags") == 40).count().orderBy("count").collect()[1][1] == 7


def test_one_read_feeds_many_sinks(spark, tmp_path):
    """A fault in one of three sinks: the others go on, and a restart repeats that one alone."""
    src, a, b, mark = (str(tmp_path / x) for x in ("src", "a", "b", "mark"))
    for k in range(3):
        append(spark, src, [row(1, i, 10 * k + i) for i in range(10)])
    seen, broken = [], [True]

    def third(batch, number):
        if number == 1 and broken[0]:
            raise OSError("full")
        seen.append((number, batch.count()))

    def start():
        return sinks.fan_out_once(feed(spark, src, max_files=1), {"a": a, "b": b, "third": third}, mark)

    query = start()
    with pytest.raises(Exception, match="third"):
        query.awaitTermination()
    assert seen == [(0, 10)] and {r["batch"] for r in spark.read.parquet(a).collect()} == {0, 1}
    before = sorted(p.name for p in (tmp_path / "a" / "batch=1").iterdir())
    broken[0] = False
    query = start()
    query.awaitTermination()
    assert seen == [(0, 10), (1, 10), (2, 10)]
    assert sorted(p.name for p in (tmp_path / "a" / "batch=1").iterdir()) == before
    for path in (a, b):
        assert sorted(r["sequence"] for r in spark.read.parquet(path).collect()) == sorted(10 * k + i for k in range(3) for i in range(10))
    # three sinks, and the source is read once for each batch
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [10, 10]
