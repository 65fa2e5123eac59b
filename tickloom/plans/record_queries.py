"""Selection, scans and column forms of records."""

from pyspark.sql import functions as F

from tickloom.functions import flags as fl
from tickloom.functions import prices, times
from tickloom.operators import filters, formatting, ordering, symbology
from tickloom.plans import requests, views
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.schemas import layout
from tickloom.session import shared_dir
from tickloom.sinks import export, files
from tickloom.sources import records

MBP1 = layout("mbp-1")
MAPPED = """SELECT t.*, CASE WHEN t.day < i.end_date THEN i.symbol END AS symbol FROM trades t
  ASOF LEFT JOIN intervals i ON t.instrument_id = i.instrument_id AND t.day >= i.start_date"""
ISO = "strftime(make_timestamp(({0}) // 1000), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(({0}) % 1000000000 AS VARCHAR), 9, '0') || 'Z'"
PX = ("CASE WHEN {0} <> 9223372036854775807 THEN CASE WHEN {0} < 0 THEN '-' ELSE '' END || (abs({0}) // 1000000000)"
      " || '.' || lpad(CAST(abs({0}) % 1000000000 AS VARCHAR), 9, '0') END")


@query("time_range", sql("trades", """SELECT ts_event, publisher_id, instrument_id, sequence, price / 1e9 AS price, size
  FROM trades WHERE day >= DATE '1996-03-01' AND day < DATE '1999-07-01'"""))
def time_range(spark, sf):
    out = filters.time_range(views.trades(spark, sf, stored=True), "1996-03-01", "1999-07-01", **views.STORED_TIME)
    return out.select("ts_event", "publisher_id", "instrument_id", "sequence",
                      prices.to_float(F.col("price")).alias("price"), "size")


@query("range_fills_forward", sql("trades", """SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(size) AS BIGINT) AS volume
  FROM trades WHERE day >= DATE '1997-06-01' AND day < DATE '1997-07-01'"""))
def range_fills_forward(spark, sf):
    out = filters.time_range(views.trades(spark, sf, stored=True), "1997-06", fill_end=True, **views.STORED_TIME)
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("volume"))


@query("symbol_selection", sql("trades intervals", f"""SELECT symbol, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(size) AS BIGINT) AS volume FROM ({MAPPED})
  WHERE upper(symbol) IN ('RED WIDGET.1997', 'HOT ROD.1998', 'SMALL RING.1999.X') GROUP BY symbol"""))
def symbol_selection(spark, sf):
    out = symbology.add_symbol(views.trades(spark, sf), views.saved_intervals(spark, sf), normalised=True)
    out = out.withColumn("upper_symbol", F.upper("symbol"))
    wanted = filters.symbols(out, "red widget.1997, hot rod.1998,small ring.1999.x,", column="upper_symbol")
    return wanted.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("volume"))


@query("symbol_table_selection", sql("trades", """SELECT instrument_id, CAST(count(*) AS BIGINT) AS n FROM trades
  WHERE instrument_id IN (SELECT p_partkey FROM part WHERE p_size < 10) GROUP BY 1"""))
def symbol_table_selection(spark, sf):
    wanted = views.table(spark, sf, "part").where("p_size < 10").select(F.col("p_partkey").alias("instrument_id"))
    out = filters.symbols_in(views.trades(spark, sf), wanted, "instrument_id")
    return out.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"))


@query("first_records", sql("ticks", """SELECT ts_recv, publisher_id, instrument_id, sequence, size FROM ticks
  ORDER BY ts_recv, publisher_id, instrument_id, sequence LIMIT 500"""))
def first_records(spark, sf):
    return filters.first_records(views.ticks(spark, sf), 500).select(
        "ts_recv", "publisher_id", "instrument_id", "sequence", "size")


@query("row_chunks", sql("ticks", """SELECT sequence, n AS row_no, n // 1000 AS chunk_id FROM (SELECT sequence,
  row_number() OVER (ORDER BY ts_recv, publisher_id, instrument_id, sequence) - 1 AS n FROM ticks)"""))
def row_chunks(spark, sf):
    return ordering.chunk_ids(views.ticks(spark, sf), 1000).select("sequence", "row_no", "chunk_id")


@query("sorted_by_index", sql("trades", """SELECT day, instrument_id, sequence, CAST(count(*) AS BIGINT) AS n
  FROM trades GROUP BY ALL ORDER BY day NULLS LAST, instrument_id, sequence"""))
def sorted_by_index(spark, sf):
    t = views.trades(spark, sf).withColumn("day", times.utc_date(F.col("ts_event")))
    return ordering.by_index(t.groupBy("day", "instrument_id", "sequence").agg(F.count(F.lit(1)).alias("n")),
                             "day", "instrument_id", "sequence")


@query("price_forms", sql("ticks", f"""SELECT sequence, price AS px_fixed,
  CASE WHEN price <> 9223372036854775807 THEN price / 1e9 END AS px_float,
  CAST(CASE WHEN price <> 9223372036854775807 THEN price * 0.000000001::DECIMAL(9,9) END AS DECIMAL(28,9)) AS px_decimal,
  {PX.format('price')} AS px_text FROM ticks"""))
def price_forms(spark, sf):
    p = F.col("price")
    return views.ticks(spark, sf).select(
        "sequence", prices.convert(p, "fixed").alias("px_fixed"), prices.convert(p, "float").alias("px_float"),
        prices.convert(p, "decimal").alias("px_decimal"), prices.to_text(p).alias("px_text"))


@query("time_forms", sql("ticks", f"""SELECT sequence, {ISO.format('ts_recv')} AS iso,
  CAST(make_timestamp(ts_recv // 1000) AS DATE) AS utc_date,
  CAST(CASE WHEN ts_recv % 86400000000000 = 0 THEN make_timestamp(ts_recv // 1000)
    ELSE make_timestamp(ts_recv // 1000) + INTERVAL 1 DAY END AS DATE) AS end_date,
  CAST(ts_recv // 1000 AS BIGINT) AS micros,
  strftime(make_timestamp(ts_recv // 1000), '%Y-%m-%d') AS date_text FROM ticks"""))
def time_forms(spark, sf):
    ns = F.col("ts_recv")
    return views.ticks(spark, sf).select(
        "sequence", times.iso_text(ns).alias("iso"), times.utc_date(ns).alias("utc_date"),
        times.ceil_date(ns).alias("end_date"), F.unix_micros(times.to_timestamp(ns)).alias("micros"),
        times.text_of(times.utc_date(ns), "date").alias("date_text"))


@query("zone_view", sql("ticks", """SELECT sequence,
  strftime(make_timestamp(ts_recv // 1000) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time,
  CASE WHEN price <> 9223372036854775807 THEN price / 1e9 END AS price FROM ticks"""))
def zone_view(spark, sf):
    out = formatting.table(views.ticks(spark, sf).select("ts_recv", "ts_event", "sequence", "price"),
                           tz="Asia/Tokyo")
    return out.select("sequence", F.date_format("ts_recv", "yyyy-MM-dd HH:mm:ss").alias("local_time"), "price")


@query("record_table", sql("ticks intervals", """SELECT ts_recv // 1000 AS recv_us, ts_recv AS ts_recv_ns, rtype,
  t.instrument_id, CASE WHEN price <> 9223372036854775807 THEN price / 1e9 END AS price,
  bid_px_00 / 1e9 AS bid_px_00, CASE WHEN CAST(make_timestamp(ts_recv // 1000) AS DATE) < i.end_date
  THEN i.symbol END AS symbol FROM ticks t ASOF LEFT JOIN intervals i ON t.instrument_id = i.instrument_id
  AND CAST(make_timestamp(ts_recv // 1000) AS DATE) >= i.start_date"""))
def record_table(spark, sf):
    out = formatting.table(views.ticks(spark, sf), MBP1, intervals=views.saved_intervals(spark, sf), normalised=True, keep_ns=True)
    return out.select(F.unix_micros("ts_recv").alias("recv_us"), "ts_recv_ns", "rtype", "instrument_id", "price",
                      "bid_px_00", "symbol")


@query("null_markers", """SELECT p_partkey, nullif(p_size, 50) AS p_size, p_name AS p_name FROM part""")
def null_markers(spark, sf):
    p = views.table(spark, sf, "part").select(
        "p_partkey", "p_size", F.encode(F.rpad("p_name", 24, "\x00"), "UTF-8").alias("p_name"))
    return formatting.decode_chars(formatting.nulls_for(p, {"p_size": 50}), ["p_name"])


@query("csv_text", sql("ticks", f"""SELECT {ISO.format('ts_recv')} || ',' || {ISO.format('ts_event')} || ',' || rtype || ','
  || publisher_id || ',' || instrument_id || ',' || action || ',' || side || ',0,' || coalesce({PX.format('price')}, '')
  || ',' || size || ',' || flags || ',' || ts_in_delta || ',' || sequence || ',' || {PX.format('bid_px_00')} || ','
  || {PX.format('ask_px_00')} || ',' || bid_sz_00 || ',' || ask_sz_00 || ',' || bid_ct_00 || ',' || ask_ct_00
  AS value FROM ticks"""))
def csv_text(spark, sf):
    t = views.ticks(spark, sf).select(*MBP1.columns)
    return files.csv_lines(files.csv_columns(t, MBP1))


_JSON = (f"""'{{"ts_recv":"' || {ISO.format('ts_recv')} || '","hd":{{"ts_event":"' || {ISO.format('ts_event')} || '","rtype":'
  || rtype || ',"publisher_id":' || publisher_id || ',"instrument_id":' || instrument_id || '}},"action":"' || action
  || '","side":"' || side || '","depth":0,"price":' || coalesce('"' || {PX.format('price')} || '"', 'null') || ',"size":'
  || size || ',"flags":' || flags || ',"ts_in_delta":' || ts_in_delta || ',"sequence":' || sequence
  || ',"levels":[{{"bid_px":"' || {PX.format('bid_px_00')} || '","ask_px":"' || {PX.format('ask_px_00')}
  || '","bid_sz":' || bid_sz_00 || ',"ask_sz":' || ask_sz_00 || ',"bid_ct":' || bid_ct_00 || ',"ask_ct":'
  || ask_ct_00 || '}}]}}'""").replace("{{", "{").replace("}}", "}")


def _json_lines(spark, sf, pretty=True):
    t = views.ticks(spark, sf).select(*MBP1.columns)
    return files.json_lines(files.json_columns(t, MBP1, pretty, pretty))


@query("json_text", sql("ticks", f"SELECT {_JSON} AS value FROM ticks"))
def json_text(spark, sf):
    return _json_lines(spark, sf)


_FLAT = """SELECT ts_recv, ts_event, rtype, publisher_id, instrument_id, action, side, size, flags, sequence,
  bid_px_00, ask_px_00 FROM ticks"""
_FLAT_COLUMNS = ["ts_recv", "ts_event", "rtype", "publisher_id", "instrument_id", "action", "side", "size", "flags",
                 "sequence", "bid_px_00", "ask_px_00"]


@query("csv_scan", sql("ticks", _FLAT))
def csv_scan(spark, sf):
    """Text columns as a CSV reader gives them, half the times as ISO text."""
    t = views.ticks(spark, sf).select(*MBP1.columns)
    text = files.csv_columns(t, MBP1, pretty_px=False, pretty_ts=False)
    text = text.withColumn("ts_event", times.iso_text(F.col("ts_event").cast("bigint")))
    return records.typed_text(text, MBP1).select(*_FLAT_COLUMNS)


@query("json_scan", sql("ticks", _FLAT))
def json_scan(spark, sf):
    lines = _json_lines(spark, sf, pretty=False)
    parsed = lines.select(F.from_json("value", records.json_schema(MBP1)).alias("j")).select("j.*")
    return records.flat_json(parsed, MBP1).select(*_FLAT_COLUMNS)


@query("damaged_lines", sql("ticks", """SELECT CAST(count(*) FILTER (WHERE sequence % 50 <> 0) AS BIGINT) AS good,
  CAST(count(*) FILTER (WHERE sequence % 50 = 0) AS BIGINT) AS bad FROM ticks"""))
def damaged_lines(spark, sf):
    t = views.ticks(spark, sf).select(*MBP1.columns)
    cols = files.json_columns(t, MBP1, False, False)
    lines = files.json_lines(cols.withColumn("_s", F.col("sequence")), keep=["_s"])
    cut = F.when(F.pmod("_s", F.lit(50)) == 0, F.expr("left(value, length(value) - 20)")).otherwise(F.col("value"))
    good, bad = records.parse_lines(lines.select(cut.alias("value")), MBP1)
    marks = good.select(F.col("instrument_id").isNotNull().alias("ok")).unionByName(
        bad.select(F.lit(False).alias("ok")))
    return marks.agg(F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("bad"))


@query("demux", sql("ticks", """SELECT ts_recv, ts_event, instrument_id, price, size, sequence FROM ticks WHERE rtype = 0"""))
def demux(spark, sf):
    return records.of_type(views.ticks(spark, sf), layout("trades"), 0).select(
        "ts_recv", "ts_event", "instrument_id", "price", "size", "sequence")


@query("other_schema_is_empty", sql("ticks", """SELECT rtype, CAST(count(*) AS BIGINT) AS quotes, CAST(0 AS BIGINT) AS bars,
  CAST(NULL AS BIGINT) AS volume FROM ticks GROUP BY rtype"""))
def other_schema_is_empty(spark, sf):
    """Rows of the stored schema by type, beside the typed but empty rows of another."""
    ticks = views.ticks(spark, sf)
    own = records.as_schema(ticks, "mbp-1", layout("mbp-1")).select("rtype", F.lit(1).alias("quote"))
    bars = records.as_schema(ticks, "mbp-1", layout("ohlcv-1m")).select("rtype", "volume")
    every = own.unionByName(bars, allowMissingColumns=True)
    return every.groupBy("rtype").agg(F.count("quote").alias("quotes"), F.count("volume").alias("bars"), F.sum("volume").alias("volume"))


@query("layout_versions", sql("ticks", """SELECT sequence, instrument_id, CASE WHEN sequence % 2 = 0 THEN side END AS side,
  price FROM ticks"""))
def layout_versions(spark, sf):
    t = views.ticks(spark, sf)
    new = t.where(F.pmod("sequence", F.lit(2)) == 0)
    old = t.where(F.pmod("sequence", F.lit(2)) != 0).drop("side").withColumn("price", F.col("price").cast("string"))
    return records.newest_version([new, old], layout("trades")).select("sequence", "instrument_id", "side", "price")


@query("levels_and_header", sql("ticks", """SELECT sequence, instrument_id, rtype, bid_px_00, ask_ct_00 FROM ticks"""))
def levels_and_header(spark, sf):
    nested = formatting.nest_header(formatting.nest_levels(views.ticks(spark, sf), 1))
    return formatting.flatten_levels(formatting.flatten_header(nested), 1).select(
        "sequence", "instrument_id", "rtype", "bid_px_00", "ask_ct_00")


_FLAGS = ", ".join(f"CASE WHEN flags & {b} <> 0 THEN '{n}' END" for n, b in fl.FLAG_BITS.items())


@query("flag_text", sql("ticks", f"""SELECT flags, concat_ws(', ', {_FLAGS}) AS flag_names,
  CAST(count(*) AS BIGINT) AS n FROM ticks GROUP BY ALL"""))
def flag_text(spark, sf):
    return views.ticks(spark, sf).groupBy("flags").agg(F.count(F.lit(1)).alias("n")).select(
        "flags", fl.flags_text(F.col("flags")).alias("flag_names"), "n")


@query("flagged_records", sql("ticks", """SELECT sequence, flags FROM ticks WHERE flags & 32 <> 0 AND flags & 8 = 0"""))
def flagged_records(spark, sf):
    out = filters.flagged(filters.flagged(views.ticks(spark, sf), "f_snapshot"), "f_bad_ts_recv", on=False)
    return out.select("sequence", "flags")


CODES = {"error": 21, "system": 23, "mapping": 22}


@query("record_classes", sql("ticks", """SELECT CASE WHEN rtype = 21 THEN 'error' WHEN rtype = 1 AND sequence % 3 = 0
  THEN CASE WHEN sequence % 2 = 0 THEN 'heartbeat' WHEN sequence % 4 = 1 THEN 'end_of_interval' ELSE 'system' END
  WHEN rtype = 22 THEN 'mapping' ELSE 'data' END AS record_class, CAST(count(*) AS BIGINT) AS n FROM ticks GROUP BY 1"""))
def record_classes(spark, sf):
    s = F.col("sequence")
    t = views.ticks(spark, sf).withColumn(
        "rtype", F.when((F.col("rtype") == 1) & (F.pmod(s, F.lit(3)) == 0), 23).otherwise(F.col("rtype")))
    code = F.when(F.pmod(s, F.lit(2)) == 0, 0).otherwise(F.pmod(s, F.lit(4)).cast("int"))
    kind = filters.record_class(F.col("rtype"), code, CODES, heartbeat=0, interval_end=1)
    return t.groupBy(kind.alias("record_class")).agg(F.count(F.lit(1)).alias("n"))


@query("info_fields", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k,
  'v' || event_id AS issuer_new_name, CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 7 AS VARCHAR) END AS "terms.max_price"
  FROM events""")
def info_fields(spark, sf):
    e = views.table(spark, sf, "events")
    nested = F.when(F.pmod("event_id", F.lit(2)) == 0, F.format_string(
        ',"terms":{"max_price":%d}', F.pmod("event_id", F.lit(7)))).otherwise(F.lit(""))
    df = e.select("event_id", F.col("props").alias("date_info"), F.concat(
        F.lit('{"iss_new_name":"v'), F.col("event_id").cast("string"), F.lit('"'), nested, F.lit("}")
    ).alias("event_info"))
    return formatting.flatten_info(df, ("date_info", "event_info"), renames=True)


@query("export_splits", sql("trades intervals", f"""SELECT coalesce(symbol, '') AS split_symbol,
  strftime(day - CAST(dayofweek(day) AS INTEGER), '%Y%m%d') AS week, strftime(date_trunc('month', day), '%Y%m%d') AS month,
  CAST(count(*) AS BIGINT) AS n FROM ({MAPPED}) GROUP BY ALL"""))
def export_splits(spark, sf):
    t = symbology.add_symbol(views.trades(spark, sf), views.saved_intervals(spark, sf), normalised=True)
    ns = F.col("ts_event")
    return t.groupBy(F.coalesce("symbol", F.lit("")).alias("split_symbol"),
                     export.split_key(ns, "week").alias("week"), export.split_key(ns, "month").alias("month")
                     ).agg(F.count(F.lit(1)).alias("n"))


@query("subscription_union", sql("ticks", """SELECT sequence, instrument_id, event_type FROM ticks
  WHERE (event_type = 'purchase') OR (event_type = 'click' AND instrument_id IN (1, 2, 3))"""))
def subscription_union(spark, sf):
    t = views.ticks(spark, sf).withColumn("schema", F.col("event_type"))
    return filters.subscription_union(
        t, [("purchase", None, "instrument_id"), ("click", [1, "2,3"], "instrument_id"), ("purchase", [1], "instrument_id")]
    ).select("sequence", "instrument_id", "event_type")


@query("range_request", sql("trades intervals", f"""SELECT ts_event, instrument_id, sequence, size, symbol FROM ({MAPPED})
  WHERE day >= DATE '1997-01-01' AND day < DATE '1998-01-01'
  AND symbol IN (SELECT p_name || '.1997' FROM part WHERE p_name IN ('red widget', 'hot rod', 'small ring'))"""))
def range_request(spark, sf):
    """One whole request: range, symbols that are valid on the day, time order."""
    named = views.saved_intervals(spark, sf).withColumn("symbol", F.upper("symbol"))
    out = requests.time_series(views.trades(spark, sf, stored=True), "1997", symbols="red widget.1997,hot rod.1997,small ring.1997",
                               intervals=named, normalised=True, **views.STORED_TIME)
    return out.select("ts_event", "instrument_id", "sequence", "size", F.lower("symbol").alias("symbol"))


@query("stored_table", sql("ticks", """SELECT CAST(ts_recv // 1000 AS BIGINT) AS recv_us, instrument_id, sequence,
  CAST(CASE WHEN price <> 9223372036854775807 THEN price * 0.000000001::DECIMAL(9,9) END AS DECIMAL(28,9)) AS price FROM ticks"""))
def stored_table(spark, sf):
    """Records stored, scanned, formatted, written as Parquet and read back."""
    raw, out = shared_dir(spark, "records"), shared_dir(spark, "table")
    views.ticks(spark, sf).select(*MBP1.columns).write.parquet(raw)
    scan = records.read_records(spark, raw, MBP1)
    files.write_parquet(scan, out, price_type="decimal", layout=MBP1)
    back = spark.read.parquet(out)
    return back.select(F.unix_micros("ts_recv").alias("recv_us"), "instrument_id", "sequence", "price")


def _steps(frames):
    """Time since the key's previous record, from rows that arrive in key and time order."""
    last: dict[int, int] = {}
    for pdf in frames:
        steps = []
        for key, t in zip(pdf["instrument_id"], pdf["ts_recv"]):
            steps.append(t - last.get(key, t))
            last = {key: t}
        yield pdf[["sequence"]].assign(step=steps)


@query("replay_steps", sql("ticks", """SELECT sequence, ts_recv - lag(ts_recv, 1, ts_recv) OVER (PARTITION BY instrument_id
  ORDER BY ts_recv, publisher_id, sequence) AS step FROM ticks"""))
def replay_steps(spark, sf):
    t = views.ticks(spark, sf).select("instrument_id", "ts_recv", "publisher_id", "sequence")
    return ordering.replay_by_key(t, _steps, "sequence bigint, step bigint")
