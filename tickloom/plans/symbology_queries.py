"""Symbol resolution in all directions."""

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions import text as tx
from tickloom.operators import smart, symbology
from tickloom.plans import views
from tickloom.plans.record_queries import ISO, MAPPED, _json_lines
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.sinks import files
from tickloom.sources import symbology as source

START, END = "1996-03-01", "1999-08-01"
NORMAL = """normal AS (SELECT * FROM (SELECT instrument_id, start_date,
  least(end_date, lead(start_date, 1, DATE '9999-12-31') OVER (PARTITION BY instrument_id ORDER BY start_date)) AS end_date,
  symbol FROM intervals) WHERE start_date < end_date)"""
ROWS = f"""rows AS (SELECT symbol, greatest(start_date, DATE '{START}') AS d0, least(end_date, DATE '{END}') AS d1,
  CAST(instrument_id AS VARCHAR) AS s FROM normal WHERE start_date < DATE '{END}' AND end_date > DATE '{START}'
  AND symbol IN (SELECT symbol FROM wanted))"""
WANTED = "wanted AS (SELECT DISTINCT p_name || '.' || y AS symbol FROM part, (SELECT unnest(['1995','1996','1999']) AS y))"


def _wanted(spark, sf):
    return views.table(spark, sf, "part").select("p_name").distinct().select(F.explode(F.transform(
        F.array(F.lit("1995"), F.lit("1996"), F.lit("1999")),
        lambda y: F.concat("p_name", F.lit("."), y))).alias("symbol"))


@query("symbol_map", sql("trades intervals", f"""SELECT instrument_id, sequence, day, price / 1e9 AS price, size, symbol
  FROM ({MAPPED})"""))
def symbol_map(spark, sf):
    t = views.trades(spark, sf)
    out = symbology.add_symbol(t, views.saved_intervals(spark, sf), normalised=True)
    return out.select("instrument_id", "sequence", times.utc_date(F.col("ts_event")).alias("day"),
                      (F.col("price") / 1e9).alias("price"), "size", "symbol")


@query("distinct_pairs", sql("trades intervals", f"""SELECT instrument_id, day, max(symbol) AS symbol FROM ({MAPPED})
  GROUP BY 1, 2"""))
def distinct_pairs(spark, sf):
    pairs = views.trades(spark, sf).select(
        "instrument_id", times.utc_date(F.col("ts_event")).alias("day")).distinct()
    return symbology.resolve(pairs, views.saved_intervals(spark, sf), "day", normalised=True).select("instrument_id", "day", "symbol")


@query("normal_intervals", sql("intervals", f""", {NORMAL} SELECT * FROM normal"""))
def normal_intervals(spark, sf):
    return symbology.normal_intervals(views.intervals(spark, sf))


@query("symbol_history", sql("intervals", """SELECT instrument_id, CAST(count(*) AS INTEGER) AS n,
  string_agg(CAST(start_date AS VARCHAR) || '/' || CAST(end_date AS VARCHAR) || '=' || symbol, ';' ORDER BY start_date)
  AS history FROM intervals GROUP BY 1"""))
def symbol_history(spark, sf):
    m = symbology.symbol_map(views.intervals(spark, sf))
    return m.select("instrument_id", F.size("intervals").alias("n"), F.array_join(F.transform(
        "intervals", lambda v: F.concat(v["start_date"].cast("string"), F.lit("/"), v["end_date"].cast("string"),
                                        F.lit("="), v["symbol"])), ";").alias("history"))


@query("inverse_symbols", sql("intervals", f""", {NORMAL}, {WANTED}, {ROWS} SELECT * FROM rows"""))
def inverse_symbols(spark, sf):
    return symbology.inverse_rows(_wanted(spark, sf), views.intervals(spark, sf), START, END)


STATUS = f"""status AS (SELECT symbol, covered_days, CASE WHEN covered_days = 0 THEN 'not_found'
    WHEN covered_days < DATE '{END}' - DATE '{START}' THEN 'partial' ELSE 'ok' END AS status
  FROM (SELECT w.symbol, CAST(count(DISTINCT d) AS BIGINT) AS covered_days FROM wanted w LEFT JOIN (
    SELECT symbol, unnest(range(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM rows) r
    ON w.symbol = r.symbol GROUP BY 1))"""


@query("resolution_status", sql("intervals", f""", {NORMAL}, {WANTED}, {ROWS}, {STATUS} SELECT * FROM status"""))
def resolution_status(spark, sf):
    wanted = _wanted(spark, sf)
    rows = symbology.inverse_rows(wanted, views.intervals(spark, sf), START, END)
    return symbology.resolution_status(wanted, rows, START, END)


@query("overall_status", sql("intervals", f""", {NORMAL}, {WANTED}, {ROWS}, {STATUS} SELECT
  CAST(count(*) FILTER (WHERE status = 'partial') AS BIGINT) AS n_partial,
  CAST(count(*) FILTER (WHERE status = 'not_found') AS BIGINT) AS n_not_found, CAST(count(*) AS BIGINT) AS n_symbols,
  CASE WHEN count(*) FILTER (WHERE status = 'not_found') > 0 THEN 'not_found'
    WHEN count(*) FILTER (WHERE status = 'partial') > 0 THEN 'partial' ELSE 'ok' END AS status FROM status"""))
def overall_status(spark, sf):
    return symbology.overall_status(resolution_status(spark, sf))


@query("missing_symbols", sql("intervals", f""", {NORMAL}, {WANTED}, {ROWS}
  SELECT symbol FROM wanted WHERE symbol NOT IN (SELECT symbol FROM rows)"""))
def missing_symbols(spark, sf):
    wanted = _wanted(spark, sf)
    return symbology.not_found(wanted, symbology.inverse_rows(wanted, views.intervals(spark, sf), START, END))


@query("inserted_intervals", sql("intervals", """SELECT instrument_id, start_date, max_by(symbol, q) AS symbol,
  max_by(end_date, q) AS end_date FROM (SELECT *, seq AS q FROM intervals UNION ALL
  SELECT instrument_id, start_date, end_date + 30, symbol || '.new', seq, seq + 100 FROM intervals WHERE instrument_id % 3 = 0)
  GROUP BY 1, 2"""))
def inserted_intervals(spark, sf):
    base = views.intervals(spark, sf)
    more = base.where(F.pmod("instrument_id", F.lit(3)) == 0).withColumn(
        "symbol", F.concat("symbol", F.lit(".new"))).withColumn("end_date", F.date_add("end_date", 30))
    m = symbology.symbol_map(symbology.insert(base, more))
    return m.select("instrument_id", F.explode("intervals").alias("v")).select(
        "instrument_id", "v.start_date", "v.symbol", "v.end_date")


def _mappings(spark, sf, start, end, out):
    """Intervals grouped to one document per symbol and instrument; their order is of no
    account here. A list holds at most one entry per day."""
    i = views.intervals(spark, sf)
    entry = F.struct(F.col("start_date").cast("string").alias(start), F.col("end_date").cast("string").alias(end),
                     F.col("instrument_id").cast("string").alias(out))
    return i.groupBy("symbol", "instrument_id").agg(F.sort_array(F.collect_list(entry)).alias("list")).select(
        F.create_map("symbol", "list").alias("m"), F.lit("raw_symbol").alias("stype_in"),
        F.lit("instrument_id").alias("stype_out"))


INTERVAL_ROWS = sql("intervals", "SELECT instrument_id, start_date, end_date, symbol FROM intervals")


@query("response_intervals", INTERVAL_ROWS)
def response_intervals(spark, sf):
    docs = _mappings(spark, sf, "d0", "d1", "s").withColumnRenamed("m", "result")
    return source.from_response(docs, F.lit(0)).select("instrument_id", "start_date", "end_date", "symbol")


@query("later_documents", sql("intervals", """SELECT instrument_id, min(start_date) AS start_date, max(end_date) AS end_date,
  arg_max(symbol, row(instrument_id % 97, symbol)) AS symbol FROM (SELECT instrument_id, DATE '2020-01-01' AS start_date,
  DATE '2021-01-01' AS end_date, symbol FROM intervals WHERE seq = 0) GROUP BY 1"""))
def later_documents(spark, sf):
    """Documents that speak of one span: the one whose file came last decides."""
    entry = F.struct(F.lit("2020-01-01").alias("d0"), F.lit("2021-01-01").alias("d1"), F.col("instrument_id").cast("string").alias("s"))
    docs = views.intervals(spark, sf).where("seq = 0").select(
        F.create_map("symbol", F.array(entry)).alias("result"), F.lit("raw_symbol").alias("stype_in"), F.lit("instrument_id").alias("stype_out"),
        F.timestamp_seconds(F.pmod("instrument_id", F.lit(97))).alias("document_time"), F.col("symbol").alias("document_name"))
    return symbology.normal_intervals(source.from_response(docs)).select("instrument_id", "start_date", "end_date", "symbol")


@query("metadata_intervals", INTERVAL_ROWS)
def metadata_intervals(spark, sf):
    docs = _mappings(spark, sf, "start_date", "end_date", "symbol").withColumnRenamed("m", "mappings")
    return source.from_metadata(docs, F.lit(0)).select("instrument_id", "start_date", "end_date", "symbol")


def messages_of(ticks):
    s = F.col("sequence")
    return ticks.where(F.col("rtype") == 22).select(
        "instrument_id", "ts_event", "sequence",
        F.concat(F.lit("S"), F.col("instrument_id").cast("string")).alias("stype_in_symbol"),
        F.when(F.pmod(s, F.lit(2)) == 0, F.col("instrument_id").cast("string")).otherwise(
            F.concat_ws(".", F.lit("SYM"), F.col("instrument_id").cast("string"), s.cast("string"))
        ).alias("stype_out_symbol"),
        F.when(F.pmod(s, F.lit(5)) != 0, F.col("ts_event")).alias("start_ts"),
        F.when(F.pmod(s, F.lit(7)) != 0, F.col("ts_event") + F.pmod(s, F.lit(3)) * times.DAY).alias("end_ts"))


MESSAGES = """messages AS (SELECT instrument_id, ts_event, sequence, 'S' || instrument_id AS stype_in_symbol,
  CASE WHEN sequence % 2 = 0 THEN CAST(instrument_id AS VARCHAR) ELSE 'SYM.' || instrument_id || '.' || sequence END
  AS stype_out_symbol, CASE WHEN sequence % 5 <> 0 THEN ts_event END AS start_ts,
  CASE WHEN sequence % 7 <> 0 THEN ts_event + (sequence % 3) * 86400000000000 END AS end_ts FROM ticks WHERE rtype = 22)"""


@query("message_intervals", sql("ticks", f""", {MESSAGES} SELECT instrument_id,
  coalesce(CAST(make_timestamp(start_ts // 1000) AS DATE), DATE '1677-09-21') AS start_date,
  coalesce(CAST(make_timestamp(end_ts // 1000) AS DATE), DATE '2262-04-11') AS end_date,
  CASE WHEN regexp_full_match(stype_out_symbol, '[0-9]+') THEN stype_in_symbol ELSE stype_out_symbol END AS symbol,
  sequence AS seq FROM messages"""))
def message_intervals(spark, sf):
    return source.from_messages(messages_of(views.ticks(spark, sf)), F.col("sequence"))


_TICK_MAP = """ticks t ASOF LEFT JOIN intervals i ON t.instrument_id = i.instrument_id
  AND CAST(make_timestamp(ts_recv // 1000) AS DATE) >= i.start_date"""
_TICK_SYMBOL = "CASE WHEN CAST(make_timestamp(ts_recv // 1000) AS DATE) < i.end_date THEN i.symbol END"


def _near(spark, sf):
    """Intervals moved next to the tick dates, so some resolve."""
    i = views.intervals(spark, sf)
    return i.withColumn("start_date", F.make_date(F.year("start_date") + 23, F.month("start_date"), F.lit(1))).withColumn(
        "end_date", F.make_date(F.year("end_date") + 23, F.month("end_date"), F.lit(1)))


_NEAR = """near AS (SELECT instrument_id, make_date(CAST(year(start_date) + 23 AS INTEGER), CAST(month(start_date) AS INTEGER), 1)
  AS start_date, make_date(CAST(year(end_date) + 23 AS INTEGER), CAST(month(end_date) AS INTEGER), 1) AS end_date, symbol
  FROM intervals)"""


@query("mapped_csv", sql("ticks intervals", f""", {_NEAR} SELECT CAST(t.instrument_id AS VARCHAR) AS instrument_id,
  {ISO.format('t.ts_recv')} AS ts_recv, CAST(sequence AS VARCHAR) AS sequence, {_TICK_SYMBOL} AS symbol
  FROM {_TICK_MAP.replace('intervals i', 'near i')}"""))
def mapped_csv(spark, sf):
    t = views.ticks(spark, sf).select(
        F.col("instrument_id").cast("string").alias("instrument_id"), times.iso_text(F.col("ts_recv")).alias("ts_recv"),
        F.col("sequence").cast("string").alias("sequence"))
    return files.map_csv(t, _near(spark, sf))


@query("mapped_json", sql("ticks intervals", f""", {_NEAR} SELECT '{{"ts_recv":"' || ts_recv || '","hd":{{"instrument_id":'
  || t.instrument_id || '}},"sequence":' || sequence || ',"symbol":' || coalesce('"' || {_TICK_SYMBOL} || '"', 'null')
  || '}}' AS value FROM {_TICK_MAP.replace('intervals i', 'near i')}""".replace("{{", "{").replace("}}", "}")))
def mapped_json(spark, sf):
    lines = views.ticks(spark, sf).select(F.to_json(F.struct(
        F.col("ts_recv").cast("string").alias("ts_recv"), F.struct("instrument_id").alias("hd"), "sequence"
    )).alias("value"))
    return files.map_json(lines, _near(spark, sf))


def definitions(spark, sf):
    p = views.table(spark, sf, "part")
    base = F.lit("1995-01-01").cast("date")
    return p.select(
        F.col("p_partkey").alias("instrument_id"), F.upper(F.replace("p_brand", F.lit("#"), F.lit(""))).alias("root"),
        F.when(F.pmod("p_size", F.lit(2)) == 0, "FUT").otherwise("OPT").alias("asset_class"),
        F.date_add(base, F.pmod(F.col("p_partkey") * 13, F.lit(1500)).cast("int")).alias("activation"),
        F.date_add(base, (F.pmod(F.col("p_partkey") * 37, F.lit(2400)) + 100).cast("int")).alias("expiration"))


DEFINITIONS = """definitions AS (SELECT p_partkey AS instrument_id, upper(replace(p_brand, '#', '')) AS root,
  CASE WHEN p_size % 2 = 0 THEN 'FUT' ELSE 'OPT' END AS asset_class,
  DATE '1995-01-01' + CAST((p_partkey * 13) % 1500 AS INTEGER) AS activation,
  DATE '1995-01-01' + CAST((p_partkey * 37) % 2400 + 100 AS INTEGER) AS expiration FROM part)"""


@query("parent_members", f"""WITH {DEFINITIONS} SELECT root || '.' || asset_class AS symbol, instrument_id FROM definitions
  WHERE activation < DATE '1998-01-01' AND expiration > DATE '1997-01-01' AND asset_class = 'FUT'""")
def parent_members(spark, sf):
    d = definitions(spark, sf)
    wanted = d.select(F.concat("root", F.lit(".FUT")).alias("symbol")).distinct()
    return smart.expand_parents(wanted, d, "1997-01-01", "1998-01-01")


def contract_days(spark, sf):
    """Daily statistics of each contract."""
    t = views.table(spark, sf, "lineitem")
    daily = t.groupBy(F.col("l_partkey").alias("instrument_id"), F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").cast("bigint").alias("volume"), F.sum("l_linenumber").cast("bigint").alias("open_interest"))
    return daily.join(definitions(spark, sf).select("instrument_id", "root", "expiration"), "instrument_id")


DAYS = f"""{DEFINITIONS}, stats AS (SELECT a.*, root, expiration FROM (SELECT l_partkey AS instrument_id,
  CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS volume,
  CAST(sum(l_linenumber) AS BIGINT) AS open_interest FROM lineitem GROUP BY 1, 2) a JOIN definitions USING (instrument_id)),
  days AS (SELECT root, date, date + 1 AS valid_from,
    coalesce(lead(date) OVER (PARTITION BY root ORDER BY date), date + 1) + 1 AS valid_to
    FROM (SELECT DISTINCT root, date FROM stats))"""


def _ranked(order):
    return f"""{DAYS}, ranked AS (SELECT root, valid_from, valid_to, instrument_id, CAST(row_number() OVER (
  PARTITION BY root, date ORDER BY {order}, expiration, instrument_id) - 1 AS INTEGER) AS rank
  FROM stats JOIN days USING (root, date) WHERE expiration > date)"""


def _rolled(order, letter):
    return f"""WITH {_ranked(order)} SELECT root || '.{letter}.' || rank AS symbol, instrument_id,
  min(valid_from) AS start_date, max(valid_to) AS end_date FROM (SELECT *, sum(new) OVER (PARTITION BY root, rank
  ORDER BY valid_from ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN
  lag(instrument_id) OVER w = instrument_id AND lag(valid_to) OVER w = valid_from THEN 0 ELSE 1 END AS new
  FROM ranked WINDOW w AS (PARTITION BY root, rank ORDER BY valid_from))) GROUP BY root, rank, island, instrument_id"""


@query("roll_ranks", f"WITH {_ranked('volume DESC')} SELECT * FROM ranked")
def roll_ranks(spark, sf):
    return smart.ranks(contract_days(spark, sf), "v")


@query("continuous_calendar", _rolled("expiration", "c"))
def continuous_calendar(spark, sf):
    return smart.continuous_intervals(contract_days(spark, sf), "c")


@query("continuous_volume", _rolled("volume DESC", "v"))
def continuous_volume(spark, sf):
    return smart.continuous_intervals(contract_days(spark, sf), "v")


@query("continuous_interest", _rolled("open_interest DESC", "n"))
def continuous_interest(spark, sf):
    return smart.continuous_intervals(contract_days(spark, sf), "n")


@query("mapping_symbols", sql("ticks", f""", {MESSAGES} SELECT sequence,
  CASE WHEN sequence % 2 = 0 THEN stype_in_symbol ELSE stype_out_symbol END AS symbol FROM messages"""))
def mapping_symbols(spark, sf):
    m = messages_of(views.ticks(spark, sf))
    return m.select("sequence", tx.mapping_symbol(F.col("stype_in_symbol"), F.col("stype_out_symbol")).alias("symbol"))
