"""Versions of reference data and price adjustment."""

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.operators import filters, formatting, pointintime
from tickloom.plans import requests, views
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.session import shared_dir
from tickloom.sources import reference

_LAST = ", ".join(f"arg_max({c}, row(ts_record, version)) FILTER (WHERE {c} IS NOT NULL) AS {c}"
                  for c in ("event", "global_status", "par_value", "event_date"))


@query("latest_values", sql("actions", f"""SELECT event_unique_id, max(version) FILTER (WHERE false) IS NULL AS one_row,
  {_LAST} FROM actions GROUP BY event_unique_id"""))
def latest_values(spark, sf):
    out = pointintime.events(views.actions(spark, sf), ties=("version",))
    return out.select("event_unique_id", F.lit(True).alias("one_row"), "event", "global_status", "par_value", "event_date")


@query("latest_rows", sql("actions", """SELECT event_unique_id, version, event, global_status, par_value, event_date
  FROM actions QUALIFY row_number() OVER (PARTITION BY event_unique_id ORDER BY ts_record DESC, version DESC) = 1"""))
def latest_rows(spark, sf):
    return pointintime.latest_rows(views.actions(spark, sf), "event_unique_id", ["ts_record", "version"]).select(
        "event_unique_id", "version", "event", "global_status", "par_value", "event_date")


@query("all_versions", sql("actions", """SELECT event_unique_id, version, event, par_value, event_date FROM actions"""))
def all_versions(spark, sf):
    return pointintime.events(views.actions(spark, sf), pit=True, ties=("version",)).select(
        "event_unique_id", "version", "event", "par_value", "event_date")


def master(spark, sf):
    o = views.table(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("listing_id"), F.to_date("o_orderdate").alias("ts_effective"),
        F.date_add(F.to_date("o_orderdate"), F.pmod("o_orderkey", F.lit(90)).cast("int")).alias("ts_record"),
        F.col("o_orderkey").alias("security_id"), F.col("o_orderstatus").alias("listing_status"),
        F.substring("o_orderpriority", 1, 1).alias("exchange"))


MASTER = """master AS (SELECT o_custkey AS listing_id, CAST(o_orderdate AS DATE) AS ts_effective,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS ts_record, o_orderkey AS security_id,
  o_orderstatus AS listing_status, substring(o_orderpriority, 1, 1) AS exchange FROM orders)"""


@query("last_master", f"""WITH {MASTER} SELECT listing_id, ts_effective, ts_record, listing_status FROM master
  QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY ts_effective DESC, ts_record DESC, security_id DESC) = 1""")
def last_master(spark, sf):
    m = master(spark, sf)
    return pointintime.latest_rows(m, "listing_id", ["ts_effective", "ts_record", "security_id"]).select(
        "listing_id", "ts_effective", "ts_record", "listing_status")


@query("master_as_of", f"""WITH {MASTER}, t AS (SELECT l_orderkey, l_suppkey, CAST(l_shipdate AS DATE) AS day,
  count(*) AS n FROM lineitem GROUP BY ALL)
  SELECT l_orderkey, l_suppkey, day, max(security_id) FILTER (WHERE r = 1) AS security_id,
  max(listing_status) FILTER (WHERE r = 1) AS listing_status FROM (SELECT t.*, m.*, row_number() OVER (
  PARTITION BY l_orderkey, l_suppkey, day ORDER BY ts_effective DESC, ts_record DESC, security_id DESC) AS r
  FROM t LEFT JOIN master m ON m.listing_id = t.l_suppkey AND m.ts_effective <= t.day AND m.ts_record <= t.day)
  GROUP BY ALL""")
def master_as_of(spark, sf):
    t = views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("day")).distinct()
    m = master(spark, sf).withColumnRenamed("listing_id", "l_suppkey")
    return pointintime.master_as_of(t, m, "l_suppkey", "day", ["security_id", "listing_status"])


@query("back_adjusted", sql("trades factors", """, d AS (SELECT security_id, ex_date, product(factor) AS f FROM (SELECT DISTINCT * FROM factors)
  GROUP BY 1, 2), s AS (SELECT security_id, ex_date, lag(ex_date) OVER (PARTITION BY security_id ORDER BY ex_date) AS prev,
  list_reduce(list(f) OVER (PARTITION BY security_id ORDER BY ex_date DESC ROWS UNBOUNDED PRECEDING),
    lambda a, b: a * b) AS adj FROM d)
  SELECT publisher_id, instrument_id, sequence, day, size, price, coalesce(adj, 1.0) AS adjustment,
  price / 1e9 * coalesce(adj, 1.0) AS adjusted_price
  FROM trades LEFT JOIN s ON security_id = publisher_id AND day < ex_date AND (prev IS NULL OR day >= prev)"""))
def back_adjusted(spark, sf):
    t = views.trades(spark, sf).select(
        "publisher_id", "instrument_id", "sequence", times.utc_date(F.col("ts_event")).alias("day"), "size", "price")
    f = views.factors(spark, sf)
    out = pointintime.back_adjust(t.withColumn("security_id", F.col("publisher_id").cast("bigint")), f, "day")
    return out.select("publisher_id", "instrument_id", "sequence", "day", "size", "price",
                      "adjustment", (F.col("price") / 1e9 * F.col("adjustment")).alias("adjusted_price"))


@query("reference_filters", sql("actions", """SELECT event_unique_id, version, event FROM actions
  WHERE event IN ('LOW', 'HIGH', 'URGENT') AND global_status IN ('F', 'O') AND event_date >= DATE '1996-01-01'
  AND event_date < DATE '2000-01-01'"""))
def reference_filters(spark, sf):
    a = views.actions(spark, sf).withColumnRenamed("global_status", "exchange")
    out = filters.reference_filters(a, events="LOW,HIGH,URGENT", countries=None, exchanges=["F", "O"])
    out = filters.reference_range(out, "corporate_actions", "event_date", "1996-01-01", "2000-01-01")
    return out.select("event_unique_id", "version", "event")


@query("reference_symbols", """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('5-LOW', '2-HIGH')""")
def reference_symbols(spark, sf):
    o = views.table(spark, sf, "orders").withColumn("local_code", F.col("o_orderpriority"))
    return filters.reference_symbols(o, ["5-low", " 2-high "], "raw_symbol", adjustment=True).select(
        "o_orderkey", "o_orderpriority")


@query("reference_dates", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS ex_date,
  CASE WHEN o_orderkey % 4 <> 0 THEN epoch_us(o_orderdate) END AS record_us FROM orders""")
def reference_dates(spark, sf):
    o = views.table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = o.select("o_orderkey", F.when(F.pmod("o_orderkey", F.lit(3)) != 0, day).otherwise("no date").alias("ex_date"),
                    F.when(F.pmod("o_orderkey", F.lit(4)) != 0, F.concat(day, F.lit("T00:00:00Z"))).otherwise("?")
                    .alias("ts_record"))
    out = formatting.datetimes(formatting.dates(text, ["ex_date", "absent_date"]), ["ts_record"])
    return out.select("o_orderkey", "ex_date", F.unix_micros("ts_record").alias("record_us"))


@query("reference_lines", """SELECT o_custkey AS security_id, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS us_code,
  CAST(o_orderdate AS DATE) AS ex_date, o_totalprice AS close FROM orders
  WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def reference_lines(spark, sf):
    """Factors written as JSON lines and requested back; codes keep their zeros."""
    path = shared_dir(spark, "lines")
    views.table(spark, sf, "orders").select(F.to_json(F.struct(
        F.col("o_custkey").alias("security_id"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("us_code"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ex_date"), F.col("o_totalprice").alias("close")
    )).alias("value")).write.option("compression", "gzip").text(path)
    table = reference.read_reference(spark, path, "adjustment_factors")
    return requests.adjustment_factors(table, "1996-01-01", "1999-01-01").select(
        "security_id", "us_code", "ex_date", "close")
