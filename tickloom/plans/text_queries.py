"""Symbol and list text, enumerations, parsed times."""

from pyspark.sql import functions as F

from tickloom.functions import domains, times
from tickloom.functions import text as tx
from tickloom.plans import views
from tickloom.plans.registry import query


@query("symbol_lists", """SELECT p_partkey, upper(p_name) || '|' || upper(p_brand) || '|' || upper(p_type) AS symbols,
  CAST(3 AS INTEGER) AS n FROM part""")
def symbol_lists(spark, sf):
    p = views.table(spark, sf, "part")
    listed = tx.symbol_list(F.concat(F.lit(" ,"), "p_name", F.lit(" , "), "p_brand", F.lit(","), F.lower("p_type"),
                                     F.lit(",, ")))
    return p.select("p_partkey", F.array_join(listed, "|").alias("symbols"), F.size(listed).alias("n"))


@query("smart_symbols", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN upper(p_type)
  WHEN 1 THEN upper(p_type) || '.FUT' WHEN 2 THEN upper(p_type) || '.c.' || p_size END AS smart FROM part""")
def smart_symbols(spark, sf):
    p = views.table(spark, sf, "part")
    kind = F.pmod("p_partkey", F.lit(4))
    low = F.lower("p_type")
    text = (F.when(kind == 0, low).when(kind == 1, F.concat(low, F.lit(".fut")))
            .when(kind == 2, F.concat(low, F.lit(".C."), F.col("p_size").cast("string")))
            .otherwise(F.concat(low, F.lit("..9"))))
    return p.select("p_partkey", tx.smart_symbol(text).alias("smart"))


@query("value_lists", """SELECT p_partkey, lower(p_name || ',' || p_type) AS from_array, lower(p_name) AS from_text,
  p_name || '|' || ' ' || p_type AS split_back FROM part""")
def value_lists(spark, sf):
    p = views.table(spark, sf, "part")
    return p.select(
        "p_partkey", tx.values_text(F.array("p_name", "p_type"), True).alias("from_array"),
        tx.values_text(F.concat(F.lit(" "), "p_name", F.lit(",,"))).alias("from_text"),
        F.array_join(tx.split_list(F.concat(F.lit(" ,"), "p_name", F.lit(", "), "p_type", F.lit(", "))), "|")
        .alias("split_back"))


@query("domain_members", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'ohlcv-1m' WHEN 1 THEN 'mbp-10'
  WHEN 2 THEN 'trades' END AS schema, CASE WHEN event_id % 3 = 0 THEN 128 WHEN event_id % 3 = 1 THEN 64 END AS flag
  FROM events""")
def domain_members(spark, sf):
    e = views.table(spark, sf, "events")
    kind, part = F.pmod("event_id", F.lit(4)), F.pmod("event_id", F.lit(3))
    text = (F.when(kind == 0, "OHLCV-1M").when(kind == 1, "mbp_10").when(kind == 2, "Trades")
            .otherwise(F.col("event_type")))
    flag = F.when(part == 0, "f-last").when(part == 1, "64").otherwise("none")
    return e.select("event_id", tx.coerce(text, domains.SCHEMA).alias("schema"),
                    tx.coerce(flag, {"F_LAST": 128, "F_TOB": 64}).alias("flag"))


@query("semantic_text", """SELECT event_id, event_id % 4 = 0 AS meaningful FROM events""")
def semantic_text(spark, sf):
    e = views.table(spark, sf, "events")
    kind = F.pmod("event_id", F.lit(4))
    text = (F.when(kind == 0, F.col("event_type")).when(kind == 1, "").when(kind == 2, " \t")
            .otherwise(F.concat("event_type", F.lit("\x00"))))
    return e.select("event_id", tx.is_semantic(text).alias("meaningful"))


@query("symbol_chunks", """SELECT p_partkey, CAST(chunk AS INTEGER) AS chunk, items, chunk = 1 AS is_last FROM (
  SELECT p_partkey, 0 AS chunk, upper(p_name) || ',' || upper(p_brand) || ',' || upper(p_type) AS items FROM part
  UNION ALL SELECT p_partkey, 1, CAST(p_size AS VARCHAR) FROM part)""")
def symbol_chunks(spark, sf):
    p = views.table(spark, sf, "part")
    listed = tx.symbol_list(F.concat_ws(",", "p_name", "p_brand", "p_type", F.col("p_size").cast("string")))
    return p.select("p_partkey", F.explode(tx.chunks(listed, 3)).alias("c")).select(
        "p_partkey", "c.chunk", F.array_join("c.items", ",").alias("items"), "c.is_last")


@query("parsed_times", """SELECT event_id, CASE event_id % 5
  WHEN 0 THEN epoch_us(ts) * 1000 + event_id % 1000
  WHEN 1 THEN epoch_us(ts) * 1000 + event_id % 1000
  WHEN 2 THEN epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) * 1000
  WHEN 3 THEN epoch_us(ts) * 1000 - 19800000000000 END AS ns,
  CASE event_id % 5 WHEN 1 THEN CAST(ts AS DATE) WHEN 2 THEN CAST(ts AS DATE)
  WHEN 3 THEN CAST(ts - INTERVAL 330 MINUTE AS DATE) END AS day FROM events""")
def parsed_times(spark, sf):
    e = views.table(spark, sf, "events")
    us = times.from_timestamp(F.col("ts"))
    ns = us + F.pmod("event_id", F.lit(1000))
    kind = F.pmod("event_id", F.lit(5))
    text = (F.when(kind == 0, ns.cast("string")).when(kind == 1, times.iso_text(ns))
            .when(kind == 2, F.date_format("ts", "yyyy-MM-dd"))
            .when(kind == 3, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30")))
            .otherwise(F.concat(F.lit("no time "), "event_type")))
    day = F.when(kind != 0, times.date_or_null(text))
    return e.select("event_id", times.parse_ns(text).alias("ns"), day.alias("day"))


@query("request_times", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0
  THEN '' ELSE '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') END AS stamp_text,
  CAST(event_id AS VARCHAR) AS number_text FROM events""")
def request_times(spark, sf):
    return views.table(spark, sf, "events").select(
        "event_id", times.text_of(F.col("ts"), "timestamp_ntz").alias("stamp_text"),
        times.text_of(F.col("event_id"), "bigint").alias("number_text"))
