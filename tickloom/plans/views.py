"""Market-data views over the given tables, with the same views as SQL text.

``lineitem`` stands for trades, ``events`` for a tick stream, ``orders`` for
corporate actions and factors, ``part``/``supplier``/``nation``/``region`` for
instruments and venues.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions.prices import UNDEF_PRICE
from tickloom.operators import symbology
from tickloom.session import configure

# Record types the tick view uses, by event type.
TICK_RTYPES = {"view": 1, "click": 1, "purchase": 0, "signup": 22, "error": 21}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(value: str):
    return F.round(F.col(value) * 100).cast("bigint") * F.lit(10_000_000)


#: The stored time of a view, and how far the computed times lie from it.
STORED_TIME = {"stored_column": "stored_at", "slack_ns": 5_000_000}


def trades(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """The trade view; with ``stored`` it keeps the stored time for range filters."""
    t = table(spark, sf_dir, "lineitem")
    return t.select(
        *([F.col("l_shipdate").alias("stored_at")] if stored else []),
        times.from_timestamp(F.col("l_shipdate")).alias("ts_event"),
        (F.col("l_suppkey") % 142 + 1).cast("int").alias("publisher_id"),
        F.col("l_partkey").alias("instrument_id"),
        F.col("l_returnflag").alias("action"),
        F.col("l_linestatus").alias("side"),
        _cents("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("bigint").alias("size"),
        F.pmod(F.col("l_linenumber") * 37, F.lit(256)).cast("int").alias("flags"),
        F.col("l_orderkey").alias("sequence"),
    )


def ticks_of(events: DataFrame, stored: bool = False) -> DataFrame:
    """The tick view of an ``events`` table or stream; with ``stored`` it keeps the stored
    time for range filters."""
    eid = F.col("event_id")
    us = times.from_timestamp(F.col("ts"))
    kind = F.lit(None).cast("int")
    for name, code in TICK_RTYPES.items():
        kind = F.when(F.col("event_type") == name, F.lit(code)).otherwise(kind)
    px = F.when(F.pmod(eid, F.lit(97)) == 0, F.lit(UNDEF_PRICE)).otherwise(_cents("value"))
    return events.select(
        *([F.col("ts").alias("stored_at")] if stored else []),
        (us + F.pmod(eid * 7919, F.lit(1000))).alias("ts_recv"),
        (us - F.pmod(eid * 7919, F.lit(5_000_000))).alias("ts_event"),
        kind.alias("rtype"),
        (F.pmod(F.col("user_id"), F.lit(5)) + 1).cast("int").alias("publisher_id"),
        F.col("user_id").alias("instrument_id"),
        F.lit("T").alias("action"),
        F.when(F.pmod(eid, F.lit(2)) == 0, "A").otherwise("B").alias("side"),
        F.lit(0).alias("depth"),
        px.alias("price"),
        (F.pmod(eid, F.lit(100)) + 1).alias("size"),
        F.pmod(eid * 37, F.lit(256)).cast("int").alias("flags"),
        F.pmod(eid * 31, F.lit(100_000)).cast("int").alias("ts_in_delta"),
        eid.alias("sequence"),
        (_cents("value") - F.lit(5_000_000)).alias("bid_px_00"),
        (_cents("value") + F.lit(5_000_000)).alias("ask_px_00"),
        (F.pmod(eid, F.lit(7)) + 1).alias("bid_sz_00"),
        (F.pmod(eid, F.lit(11)) + 1).alias("ask_sz_00"),
        (F.pmod(eid, F.lit(3)) + 1).alias("bid_ct_00"),
        (F.pmod(eid, F.lit(4)) + 1).alias("ask_ct_00"),
        F.col("event_type"),
        F.col("props"),
    )


def ticks(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"), stored)


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per traded instrument and year a symbol for January to September, and for
    every seventh instrument a June overlap."""
    t = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("instrument_id"), "p_name")
    years = t.select(F.col("l_partkey").alias("instrument_id"),
                     F.year("l_shipdate").alias("y")).distinct().join(p, "instrument_id")
    year = F.col("y").cast("string")
    spans = F.array(
        F.struct(F.make_date("y", F.lit(1), F.lit(1)).alias("a"),
                 F.make_date("y", F.lit(10), F.lit(1)).alias("b"),
                 F.concat("p_name", F.lit("."), year).alias("s"), F.lit(0).cast("bigint").alias("q")),
        F.struct(F.make_date("y", F.lit(6), F.lit(1)).alias("a"),
                 F.make_date("y", F.lit(7), F.lit(1)).alias("b"),
                 F.concat("p_name", F.lit("."), year, F.lit(".x")).alias("s"), F.lit(1).cast("bigint").alias("q")),
    )
    kept = F.when(F.pmod("instrument_id", F.lit(7)) == 0, spans).otherwise(F.slice(spans, 1, 1))
    return years.select("instrument_id", F.explode(kept).alias("v")).select(
        "instrument_id", F.col("v.a").alias("start_date"), F.col("v.b").alias("end_date"),
        F.col("v.s").alias("symbol"), F.col("v.q").alias("seq"))


def saved_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intervals made disjoint and stored, as a symbology table would be."""
    return symbology.save(intervals(spark, sf_dir))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of one corporate event per customer."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("event_unique_id"),
        F.col("o_orderdate").cast("timestamp").alias("ts_record"),
        F.col("o_orderkey").alias("version"),
        F.substring("o_orderpriority", 3, 20).alias("event"),
        F.col("o_orderstatus").alias("global_status"),
        F.when(F.pmod("o_orderkey", F.lit(3)) != 0, _cents("o_totalprice")).alias("par_value"),
        F.to_date("o_orderdate").alias("event_date"),
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("security_id"), F.to_date("o_orderdate").alias("ex_date"),
        (F.lit(1000) - F.pmod("o_orderkey", F.lit(10))).cast("bigint").alias("factor_milli"),
    ).withColumn("factor", F.col("factor_milli") / F.lit(1000.0))


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A publisher dimension: supplier in a nation (venue) of a region (dataset)."""
    s, n, r = (table(spark, sf_dir, x) for x in ("supplier", "nation", "region"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select((F.col("s_suppkey") + 1).cast("int").alias("publisher_id"),
                F.concat_ws(".", "r_name", "n_name", "s_name").alias("name"),
                F.col("n_name").alias("venue"), F.col("r_name").alias("dataset"),
                F.col("s_name").alias("description"))
    )


_CENTS = "CAST(round({0} * 100) AS BIGINT) * 10000000"
SQL_VIEWS = {
    "trades": f"""SELECT epoch_us(l_shipdate) * 1000 AS ts_event, CAST(l_suppkey % 142 + 1 AS INTEGER) AS publisher_id,
      l_partkey AS instrument_id, l_returnflag AS action, l_linestatus AS side,
      {_CENTS.format('l_extendedprice')} AS price, CAST(l_quantity AS BIGINT) AS size,
      CAST((l_linenumber * 37) % 256 AS INTEGER) AS flags, l_orderkey AS sequence, CAST(l_shipdate AS DATE) AS day
      FROM lineitem""",
    "ticks": f"""SELECT epoch_us(ts) * 1000 + (event_id * 7919) % 1000 AS ts_recv,
      epoch_us(ts) * 1000 - (event_id * 7919) % 5000000 AS ts_event,
      CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 1 WHEN 'purchase' THEN 0 WHEN 'signup' THEN 22
        WHEN 'error' THEN 21 END AS INTEGER) AS rtype,
      CAST(user_id % 5 + 1 AS INTEGER) AS publisher_id, user_id AS instrument_id, 'T' AS action,
      CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS side,
      CASE WHEN event_id % 97 = 0 THEN 9223372036854775807 ELSE {_CENTS.format('value')} END AS price,
      event_id % 100 + 1 AS size, CAST((event_id * 37) % 256 AS INTEGER) AS flags,
      CAST((event_id * 31) % 100000 AS INTEGER) AS ts_in_delta, event_id AS sequence,
      {_CENTS.format('value')} - 5000000 AS bid_px_00, {_CENTS.format('value')} + 5000000 AS ask_px_00,
      event_id % 7 + 1 AS bid_sz_00, event_id % 11 + 1 AS ask_sz_00,
      event_id % 3 + 1 AS bid_ct_00, event_id % 4 + 1 AS ask_ct_00, event_type, props FROM events""",
    "intervals": """SELECT instrument_id, make_date(y, 1, 1) AS start_date, make_date(y, 10, 1) AS end_date,
        p_name || '.' || y AS symbol, 0 AS seq
      FROM (SELECT DISTINCT l_partkey AS instrument_id, CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem) a
      JOIN part ON p_partkey = instrument_id
      UNION ALL SELECT instrument_id, make_date(y, 6, 1), make_date(y, 7, 1), p_name || '.' || y || '.x', 1
      FROM (SELECT DISTINCT l_partkey AS instrument_id, CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem) a
      JOIN part ON p_partkey = instrument_id WHERE instrument_id % 7 = 0""",
    "actions": f"""SELECT o_custkey AS event_unique_id, o_orderdate AS ts_record, o_orderkey AS version,
      substring(o_orderpriority, 3, 20) AS event, o_orderstatus AS global_status,
      CASE WHEN o_orderkey % 3 <> 0 THEN {_CENTS.format('o_totalprice')} END AS par_value,
      CAST(o_orderdate AS DATE) AS event_date FROM orders""",
    "factors": """SELECT o_custkey AS security_id, CAST(o_orderdate AS DATE) AS ex_date,
      1000 - o_orderkey % 10 AS factor_milli, (1000 - o_orderkey % 10) / 1000.0::DOUBLE AS factor FROM orders""",
    "venues": """SELECT CAST(s_suppkey + 1 AS INTEGER) AS publisher_id,
      r_name || '.' || n_name || '.' || s_name AS name, n_name AS venue, r_name AS dataset, s_name AS description
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}


def sql(views: str, body: str) -> str:
    """``body`` behind the named views as common table expressions. A body that starts
    with a comma adds more of them."""
    head = ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in views.split())
    return f"WITH {head}\n{body}"
