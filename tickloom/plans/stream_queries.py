"""The same operators on a stream of the event table.

Each query reads the table as a stream, runs over all that is available into a new
folder below ``spark.checkpoint.dir`` and returns what was written.
"""

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.plans import views
from tickloom.plans.market_queries import _bar_sql
from tickloom.plans.record_queries import CODES
from tickloom.plans.registry import query
from tickloom.plans.symbology_queries import MESSAGES, _NEAR, _TICK_MAP, _TICK_SYMBOL, _near, messages_of
from tickloom.plans.views import sql
from tickloom.streaming import operators as op
from tickloom.session import shared_dir
from tickloom.streaming import sinks, sources, state

# Event times at or below this are final once all input is read, for a one-minute delay.
_MARK = "(SELECT (max(ts_event) // 1000000) * 1000000 - 60000000000 FROM ticks)"


def tick_stream(spark, sf):
    schema = views.table(spark, sf, "events").schema
    # a pattern finds one file as well as a folder of files
    return views.ticks_of(sources.open_stream(spark, f"{sf}/events.parquet*", schema))


@query("stream_subscription", sql("ticks", """SELECT sequence, instrument_id, ts_recv, size FROM ticks
  WHERE event_type = 'click' AND instrument_id IN (1, 2, 3, 5, 8) AND ts_recv >= epoch_us(TIMESTAMP '2024-01-04') * 1000"""))
def stream_subscription(spark, sf):
    s = tick_stream(spark, sf).withColumn("schema", F.col("event_type")).withColumn(
        "symbol", F.col("instrument_id").cast("string"))
    out = sources.subscribe(s, "click", "1,2,3,5,8", "instrument_id", start="2024-01-04")
    return sinks.drain(spark, out.select("sequence", "instrument_id", "ts_recv", "size"))


@query("stream_errors", sql("ticks", "SELECT sequence, instrument_id, 'error' AS record_class FROM ticks WHERE rtype = 21"))
def stream_errors(spark, sf):
    out = op.route(op.classes(tick_stream(spark, sf), CODES), "error")
    return sinks.drain(spark, out.select("sequence", "instrument_id", "record_class"))


@query("stream_symbols", sql("ticks", f""", {MESSAGES} SELECT instrument_id,
  arg_max(stype_out_symbol, row(ts_event, sequence)) AS symbol FROM messages GROUP BY 1"""))
def stream_symbols(spark, sf):
    return sinks.drain(spark, op.live_symbols(messages_of(tick_stream(spark, sf))), "complete")


@query("stream_mapped", sql("ticks intervals", f""", {_NEAR} SELECT sequence, t.instrument_id, {_TICK_SYMBOL} AS symbol
  FROM {_TICK_MAP.replace('intervals i', 'near i')}"""))
def stream_mapped(spark, sf):
    out = op.add_symbol(tick_stream(spark, sf), _near(spark, sf))
    return sinks.drain(spark, out.select("sequence", "instrument_id", "symbol"))


@query("stream_bars", f"SELECT * FROM ({_bar_sql(times.MINUTE)}) b WHERE b.ts_event + 60000000000 <= ("
       + sql("ticks", f"SELECT (max(ts_event) // 1000000) * 1000000 - 60000000000 FROM ticks WHERE price <> 9223372036854775807") + ")")
def stream_bars(spark, sf):
    return sinks.drain(spark, op.bars(tick_stream(spark, sf), "1 minute"))


@query("stream_activity", sql("ticks", f""", w AS (SELECT instrument_id, size, unnest(range(ts_event - ts_event % 3600000000000 - 4 * 3600000000000,
  ts_event + 1, 3600000000000)) AS window_start, ts_event FROM ticks)
  SELECT window_start, window_start + 5 * 3600000000000 AS window_end, instrument_id, CAST(count(*) AS BIGINT) AS records,
  CAST(sum(size) AS BIGINT) AS volume FROM w WHERE ts_event < window_start + 5 * 3600000000000
  AND window_start + 5 * 3600000000000 <= {_MARK} GROUP BY 1, 3"""))
def stream_activity(spark, sf):
    return sinks.drain(spark, op.activity(tick_stream(spark, sf), "5 hours", "1 hour"))


# one-publisher sessions of 40 s; the last ones are open as long as the watermark has not passed their end
@query("stream_spans", sql("ticks", f""", o AS (SELECT publisher_id, ts_recv, (ts_recv // 1000) * 1000 AS us, (ts_recv // 1000) * 1000
  - lag((ts_recv // 1000) * 1000) OVER (PARTITION BY publisher_id ORDER BY ts_recv) > 40000000000 AS fresh FROM ticks),
  s AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY publisher_id ORDER BY ts_recv ROWS UNBOUNDED PRECEDING) AS n FROM o)
  SELECT publisher_id, min(us) AS first_ts, max(ts_recv) AS last_ts, max(us) + 40000000000 AS silent_from, CAST(count(*) AS BIGINT) AS records
  FROM s GROUP BY publisher_id, n HAVING max(us) + 40000000000 <= (SELECT (max(ts_recv) // 1000000) * 1000000 - 60000000000 FROM ticks)"""))
def stream_spans(spark, sf):
    return sinks.drain(spark, op.active_spans(tick_stream(spark, sf), ["publisher_id"]))


@query("stream_without_repeats", sql("ticks", "SELECT sequence, instrument_id, size FROM ticks"))
def stream_without_repeats(spark, sf):
    s = tick_stream(spark, sf)
    return sinks.drain(spark, op.without_repeats(s.unionByName(s)).select("sequence", "instrument_id", "size"))


@query("stream_late_rows", sql("ticks", """SELECT sequence, flags FROM ticks
  WHERE flags & 8 <> 0 OR ts_recv < epoch_us(TIMESTAMP '2024-01-02') * 1000"""))
def stream_late_rows(spark, sf):
    late, _good = op.late_and_good(tick_stream(spark, sf), times.bound_ns("2024-01-02"))
    return sinks.drain(spark, late.select("sequence", "flags"))


@query("stream_timeouts", sql("ticks", """SELECT publisher_id, min(ts_recv) AS first_ts, max(ts_recv) AS last_ts,
  CAST(count(*) AS BIGINT) AS records FROM ticks GROUP BY 1"""))
def stream_timeouts(spark, sf):
    """The feed ends for good, so every publisher runs into its timer (a short one here)."""
    path = shared_dir(spark, "timeouts")
    out = state.timeouts(tick_stream(spark, sf), ["publisher_id"], limit=2.0)
    state.run_until_silent(sinks.to_folder(out, path, once=False))
    return spark.read.schema(out.schema).parquet(path)


@query("stream_live_map", sql("ticks", f""", {MESSAGES} SELECT t.sequence, t.instrument_id, m.stype_out_symbol AS symbol
  FROM (SELECT *, ts_event * 100000000::HUGEINT + sequence AS o FROM ticks WHERE rtype <> 22) t ASOF LEFT JOIN
  (SELECT *, ts_event * 100000000::HUGEINT + sequence AS o FROM messages) m ON t.instrument_id = m.instrument_id AND t.o >= m.o"""))
def stream_live_map(spark, sf):
    """Records and mapping messages of one feed, each record with the symbol it had when it came."""
    messages = messages_of(tick_stream(spark, sf))
    records = tick_stream(spark, sf).where("rtype <> 22").select("ts_event", "sequence", "instrument_id")
    out = state.map_live(records, messages)
    return sinks.drain(spark, out.select("sequence", "instrument_id", "symbol"))


@query("stream_lateness", sql("ticks", """, m AS (SELECT sequence % 3 AS part, (max(ts_event) // 1000000) * 1000000 - 60000000000 AS mark
  FROM ticks GROUP BY 1) SELECT sequence, coalesce((ts_event // 1000000) * 1000000 < w, false) AS late, coalesce(w, 0) AS watermark_ns
  FROM (SELECT t.*, (SELECT max(mark) FROM m WHERE part < t.sequence % 3) AS w FROM ticks t)"""))
def stream_lateness(spark, sf):
    """A feed that arrives in three parts, each over the whole time: later parts are late."""
    feed, mark, out = (shared_dir(spark, x) for x in ("feed", "mark", "late"))
    t = views.ticks(spark, sf).select("sequence", "ts_event")
    for part in range(3):
        t.where(F.pmod("sequence", F.lit(3)) == part).write.mode("append").parquet(feed)
        told = state.with_lateness(sources.open_stream(spark, feed, t.schema), "1 minute")
        sinks.to_folder(told.select("sequence", "late", "watermark_ns"), out, mark).awaitTermination()
    return spark.read.parquet(out)


@query("stream_snapshot", sql("ticks", """SELECT sequence, CASE WHEN sequence < 500 THEN flags | 32 ELSE flags END AS flags FROM ticks"""))
def stream_snapshot(spark, sf):
    """A bounded snapshot in front of the live records."""
    live = tick_stream(spark, sf).where("sequence >= 500")
    held = views.ticks(spark, sf).where("sequence < 500")
    out = sources.subscribe(live, "mbo", snapshot=True, state=held)
    return sinks.drain(spark, out.select("sequence", "flags"))


@query("stream_fan_out", sql("ticks", """SELECT 'trades' AS sink, sequence FROM ticks WHERE rtype = 0
  UNION ALL SELECT 'quotes', sequence FROM ticks WHERE rtype = 1 UNION ALL SELECT 'all', sequence FROM ticks"""))
def stream_fan_out(spark, sf):
    """Three sinks of one reading; each keeps what concerns it."""
    all_, quotes, trades, mark = (shared_dir(spark, x) for x in ("all", "quotes", "trades", "mark"))

    def part(path, rtype):
        return lambda batch, n: batch.where(F.col("rtype") == rtype).write.mode("overwrite").parquet(f"{path}/batch={n}")

    s = tick_stream(spark, sf).select("sequence", "rtype")
    sinks.fan_out_once(s, {"all": all_, "quotes": part(quotes, 1), "trades": part(trades, 0)}, mark).awaitTermination()
    read = lambda name, path: spark.read.schema(s.schema).parquet(path).select(F.lit(name).alias("sink"), "sequence")
    return read("all", all_).unionByName(read("quotes", quotes)).unionByName(read("trades", trades))


@query("stream_restarted", sql("ticks", "SELECT sequence, size FROM ticks"))
def stream_restarted(spark, sf):
    """A query that ends in the middle of its feed and goes on from its checkpoint."""
    feed, mark, out = (shared_dir(spark, x) for x in ("feed", "mark", "restarted"))
    t = views.ticks(spark, sf).select("sequence", "size")
    for half in range(2):
        t.where(F.pmod("sequence", F.lit(2)) == half).write.mode("append").parquet(feed)
        sinks.to_folder(sources.open_stream(spark, feed, t.schema), out, mark).awaitTermination()
    return spark.read.parquet(out)


@query("stream_callback", sql("ticks", "SELECT instrument_id, CAST(count(*) AS BIGINT) AS records, max(ts_recv) AS last_ts FROM ticks GROUP BY 1"))
def stream_callback(spark, sf):
    """A user's function of each batch, after one that fails and is reported."""
    out, errors = shared_dir(spark, "called"), []
    s = tick_stream(spark, sf).select("instrument_id", "ts_recv")

    def fail(batch, number):
        raise ValueError("a user's own error")

    def work(batch, number):
        sums = batch.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("records"), F.max("ts_recv").alias("last_ts"))
        sums.write.mode("overwrite").parquet(f"{out}/batch={number}")

    sinks.to_callback(s, fail, errors.append).awaitTermination()
    sinks.to_callback(s, work, errors.append).awaitTermination()
    if [type(e) for e in errors] != [ValueError]:
        raise RuntimeError(f"errors of callbacks: {errors}")
    sums = spark.read.schema("instrument_id bigint, records bigint, last_ts bigint").parquet(out)
    return sums.groupBy("instrument_id").agg(F.sum("records").alias("records"), F.max("last_ts").alias("last_ts"))
