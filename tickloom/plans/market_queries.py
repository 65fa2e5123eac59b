"""Bars, quotes, profiles and feed checks."""

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.operators import asof, bars, quality
from tickloom.plans import views
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.sources.venues import add_publisher

_UNDEF = "9223372036854775807"


def _bar_sql(width):
    return sql("ticks", f"""SELECT ts_event - ts_event % {width} AS ts_event, publisher_id, instrument_id,
  arg_min(price, row(ts_event, sequence)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, row(ts_event, sequence)) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM ticks WHERE price <> {_UNDEF} GROUP BY ALL""")


for _name, _width in bars.WIDTHS.items():
    if _name != "eod":
        @query(f"bars_{_name}", _bar_sql(_width))
        def _bars(spark, sf, width=_name):
            return bars.ohlcv(views.ticks(spark, sf), width)


@query("bars_eod", _bar_sql(times.DAY))
def bars_eod(spark, sf):
    """Session bars straight from the ticks; ``eod`` and ``1d`` share a width."""
    return bars.ohlcv(views.ticks(spark, sf), "eod")


@query("bars_session", sql("ticks", f"""SELECT ts_event - (ts_event - {22 * times.HOUR}) % {times.DAY} AS ts_event, publisher_id, instrument_id,
  arg_min(price, row(ts_event, sequence)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, row(ts_event, sequence)) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM ticks WHERE price <> {_UNDEF} GROUP BY ALL"""))
def bars_session(spark, sf):
    """Bars of trading days that begin at 22:00 UTC of the day before."""
    return bars.ohlcv(views.ticks(spark, sf), "eod", start=22 * times.HOUR)


@query("quote_samples", sql("ticks", """SELECT ts_recv - ts_recv % 60000000000 + 60000000000 AS ts_recv, publisher_id,
  instrument_id, arg_max(bid_px_00, row(ts_recv, sequence)) AS bid_px_00, arg_max(ask_px_00, row(ts_recv, sequence)) AS ask_px_00,
  arg_max(bid_sz_00, row(ts_recv, sequence)) AS bid_sz_00, arg_max(ask_sz_00, row(ts_recv, sequence)) AS ask_sz_00
  FROM ticks WHERE rtype = 1 GROUP BY ts_recv - ts_recv % 60000000000, publisher_id, instrument_id"""))
def quote_samples(spark, sf):
    return bars.sample_quotes(views.ticks(spark, sf).where("rtype = 1"), "1m")


@query("quote_samples_filled", sql("ticks", """, s AS (SELECT ts_recv - ts_recv % 3600000000000 + 3600000000000 AS b, publisher_id,
  instrument_id, arg_max(bid_px_00, row(ts_recv, sequence)) AS bid_px_00, arg_max(ask_px_00, row(ts_recv, sequence)) AS ask_px_00
  FROM ticks WHERE rtype = 1 GROUP BY 1, 2, 3), n AS (SELECT *, coalesce(lead(b) OVER (PARTITION BY publisher_id, instrument_id
  ORDER BY b), b + 3600000000000) AS e FROM s)
  SELECT unnest(range(b, e, 3600000000000)) AS ts_recv, publisher_id, instrument_id, bid_px_00, ask_px_00 FROM n"""))
def quote_samples_filled(spark, sf):
    return bars.sample_quotes(views.ticks(spark, sf).where("rtype = 1"), "1h", values=("bid_px_00", "ask_px_00"),
                              forward_fill=True)


@query("trade_quotes", sql("ticks", """SELECT t.sequence, t.instrument_id, t.price, q.bid_px_00, q.ask_px_00
  FROM (SELECT * FROM ticks WHERE rtype = 0) t ASOF LEFT JOIN (SELECT * FROM ticks WHERE rtype = 1) q
  ON t.instrument_id = q.instrument_id AND t.ts_recv >= q.ts_recv"""))
def trade_quotes(spark, sf):
    t = views.ticks(spark, sf)
    trades = t.where("rtype = 0").select("instrument_id", "ts_recv", "sequence", "price")
    quotes = t.where("rtype = 1").select("instrument_id", "ts_recv", "sequence", "bid_px_00", "ask_px_00")
    return asof.prevailing_quote(trades, quotes, ("bid_px_00", "ask_px_00")).select(
        "sequence", "instrument_id", "price", "bid_px_00", "ask_px_00")


@query("profile_rollup", sql("trades venues", """SELECT day, dataset, publisher_id, instrument_id, CAST(count(*) AS BIGINT) AS trades,
  CAST(sum(size) AS BIGINT) AS volume, CAST(sum(price::HUGEINT * size) // sum(size) AS BIGINT) AS vwap, min(price) AS low,
  max(price) AS high FROM (SELECT t.*, v.dataset FROM trades t LEFT JOIN venues v USING (publisher_id))
  GROUP BY GROUPING SETS ((day), (day, dataset), (day, dataset, publisher_id), (day, dataset, publisher_id, instrument_id))"""))
def profile_rollup(spark, sf):
    t = add_publisher(views.trades(spark, sf), views.venues(spark, sf)).withColumn(
        "day", times.utc_date(F.col("ts_event")))
    return bars.profile(t, ("dataset", "publisher_id", "instrument_id"), ("day",))


@query("event_ordinals", sql("ticks", """SELECT sequence, instrument_id, CAST(coalesce(sum(CASE WHEN flags & 128 <> 0 THEN 1 ELSE 0 END)
  OVER (PARTITION BY instrument_id ORDER BY ts_recv, sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
  AS event_no FROM ticks"""))
def event_ordinals(spark, sf):
    t = views.ticks(spark, sf).select("instrument_id", "ts_recv", "sequence", "flags")
    return quality.event_ordinal(t).select("sequence", "instrument_id", "event_no")


@query("snapshot_ends", sql("ticks", """SELECT sequence, instrument_id FROM (SELECT *, lag(flags & 32 <> 0) OVER (
  PARTITION BY instrument_id ORDER BY ts_recv, sequence) AS p FROM ticks) WHERE p AND flags & 32 = 0"""))
def snapshot_ends(spark, sf):
    t = views.ticks(spark, sf).select("instrument_id", "ts_recv", "sequence", "flags")
    return quality.snapshot_ends(t).select("sequence", "instrument_id")


@query("silences", sql("ticks", """SELECT publisher_id, gap_start, gap_end, gap_end - gap_start AS gap_ns FROM (
  SELECT publisher_id, ts_recv AS gap_end, lag(ts_recv) OVER (PARTITION BY publisher_id ORDER BY ts_recv) AS gap_start FROM ticks)
  WHERE gap_end - gap_start > 40000000000"""))
def silences(spark, sf):
    return quality.silences(views.ticks(spark, sf), ["publisher_id"])


@query("clock_faults", sql("ticks", """SELECT sequence, publisher_id, CASE WHEN late THEN m - ts_recv ELSE 0 END AS behind_ns FROM (
  SELECT *, coalesce(ts_recv < m, false) AS late FROM (SELECT *, max(ts_recv) OVER (PARTITION BY publisher_id
  ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM (SELECT *,
  2 * (sequence + CASE WHEN sequence % 13 = 0 THEN 20 ELSE 0 END) + CASE WHEN sequence % 13 = 0 THEN 1 ELSE 0 END AS arrival
  FROM ticks))) WHERE late OR flags & 8 <> 0"""))
def clock_faults(spark, sf):
    s = F.col("sequence")
    held = F.pmod(s, F.lit(13)) == 0
    t = views.ticks(spark, sf).select("publisher_id", "ts_recv", "flags", "sequence", (
        (s + F.when(held, 20).otherwise(0)) * 2 + F.when(held, 1).otherwise(0)).alias("arrival"))
    return quality.clock_faults(t, sequence="arrival").select("sequence", "publisher_id", "behind_ns")


@query("reconnect_gaps", sql("ticks", """, r AS (SELECT publisher_id AS dataset, ts_event // 3600000000000 AS session_id, max(ts_event) AS last_ts
  FROM ticks WHERE rtype = 0 GROUP BY 1, 2), s AS (SELECT publisher_id AS dataset, ts_event // 3600000000000 AS session_id,
  min(ts_event) AS session_start FROM ticks GROUP BY 1, 2), g AS (SELECT dataset, session_start AS gap_end,
  lag(coalesce(last_ts, session_start)) OVER (PARTITION BY dataset ORDER BY session_start) AS gap_start
  FROM s LEFT JOIN r USING (dataset, session_id))
  SELECT dataset, gap_start, gap_end, (gap_end - gap_start) / 1e9 AS gap_seconds FROM g WHERE gap_start IS NOT NULL"""))
def reconnect_gaps(spark, sf):
    """Hourly sessions; those without a trade count from their start."""
    t = views.ticks(spark, sf).select(
        F.col("publisher_id").alias("dataset"), times.bucket(F.col("ts_event"), times.HOUR).alias("session_id"),
        "ts_event", "rtype")
    starts = t.groupBy("dataset", "session_id").agg(F.min("ts_event").alias("session_start"))
    return quality.reconnect_gaps(quality.sessions(t.where("rtype = 0"), starts))


@query("lag_flags", sql("ticks", """SELECT publisher_id, hour, records, front_ts, back_ts,
  records > 1048576 OR (records > 128 AND back_ts - front_ts > 1000000000) AS is_full FROM (
  SELECT publisher_id, ts_recv // 21600000000000 AS hour, CAST(count(*) AS BIGINT) AS records, min(ts_recv) AS front_ts,
  max(ts_recv) AS back_ts FROM ticks GROUP BY 1, 2)"""))
def lag_flags(spark, sf):
    t = views.ticks(spark, sf).withColumn("hour", times.bucket(F.col("ts_recv"), 6 * times.HOUR))
    return quality.lag_flag(t, ["publisher_id", "hour"])
