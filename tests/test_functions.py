"""Column functions and their parameter forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import domains, flags, prices, text, times
from tickloom.functions.prices import UNDEF_PRICE


def one(spark, col, **values):
    kinds = {int: "bigint", str: "string", list: "array<string>", dt.date: "date"}
    row = spark.range(1).select(*[
        (F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).cast(kinds[type(v)]).alias(n)
        for n, v in values.items()])
    return row.select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("px", [7, -42, 10**9, 5 * 10**8 + 1, 123_456_789_012_345, -(10**15) - 9, 9 * 10**18])
def test_price_text_has_nine_decimals(spark, px):
    units, part = divmod(abs(px), 10**9)
    shown = f"{'-' if px < 0 else ''}{units}.{part:09d}"
    assert one(spark, prices.to_text(F.col("p")), p=px) == shown
    assert f"{one(spark, prices.to_decimal(F.col('p')), p=px):.9f}" == shown


def test_missing_price(spark):
    assert one(spark, prices.to_text(F.col("p")), p=UNDEF_PRICE) is None
    assert one(spark, prices.to_decimal(F.col("p")), p=UNDEF_PRICE) is None


def test_price_type_is_checked():
    with pytest.raises(ValueError):
        prices.convert(None, "money")


@pytest.mark.parametrize("seconds, nanos", [(951_782_400, 1), (1_709_164_799, 999_999_999), (2_000_000_000, 0), (-86_400, 5)])
def test_iso_and_dates(spark, seconds, nanos):
    ns = seconds * 10**9 + nanos
    at = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)
    shown = f"{at:%Y-%m-%dT%H:%M:%S}.{nanos:09d}Z"
    whole = nanos == 0 and at.time() == dt.time()
    assert one(spark, times.iso_text(F.col("t")), t=ns) == shown
    assert one(spark, times.utc_date(F.col("t")), t=ns) == at.date()
    assert one(spark, times.ceil_date(F.col("t")), t=ns) == at.date() + dt.timedelta(days=not whole)
    assert one(spark, times.parse_ns(F.col("t")), t=shown) == ns == times.bound_ns(shown)


@pytest.mark.parametrize("shown, at, nanos", [
    ("2024-02-29", (2024, 2, 29), 0), ("2024-02-29T07:08:09", (2024, 2, 29, 7, 8, 9), 0),
    ("2024-02-29T07:08:09.25Z", (2024, 2, 29, 7, 8, 9), 250_000_000),
    ("2024-02-29T01:30:00-03:00", (2024, 2, 29, 4, 30), 0)])
def test_times_are_read(spark, shown, at, nanos):
    ns = int((dt.datetime(*at) - dt.datetime(1970, 1, 1)).total_seconds()) * 10**9 + nanos
    assert one(spark, times.parse_ns(F.col("t")), t=shown) == ns == times.bound_ns(shown)


def test_other_time_forms(spark):
    assert one(spark, times.parse_ns(F.col("t")), t="86400000000007") == 86_400_000_000_007
    assert one(spark, times.parse_ns(F.col("t")), t="19700103") == 2 * 86_400 * 10**9
    assert one(spark, times.parse_ns(F.col("t")), t="soon") is None


@pytest.mark.parametrize("zone", ["Pacific/Auckland", "America/Bogota"])
def test_dates_do_not_follow_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert str(one(spark, times.utc_date(F.col("t")), t=951_782_400 * 10**9)) == "2000-02-29"
        assert one(spark, times.iso_text(F.col("t")), t=951_782_400 * 10**9 + 3) == "2000-02-29T00:00:00.000000003Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("value, end", [
    ("1999", "2000-01-01"), ("2024-02", "2024-03-01"), ("1999-12-31", "2000-01-01"), ("2024-02-28T23", "2024-02-29T00:00:00"),
    ("2024-02-28T23:59", "2024-02-29T00:00:00"), ("2024-02-28T23:59:59", "2024-02-29T00:00:00"), (dt.date(2024, 2, 28), "2024-02-29")])
def test_end_is_filled_forward(value, end):
    assert times.bound_ns(value, end_of=True) == times.bound_ns(end)


@pytest.mark.parametrize("stype, given, expected", [
    ("parent", "zc.fut", ["ZC.FUT"]), ("parent", " zc , ZS ,", ["ZC", "ZS"]), ("continuous", "zc.V.3", ["ZC.v.3"]),
    ("continuous", [["zs.n.1"], "zw"], ["ZS.n.1", "ZW"]), ("instrument_id", 31, ["31"]),
    ("instrument_id", [8, [" 9", 10]], ["8", "9", "10"]), ("raw_symbol", None, [text.ALL_SYMBOLS]),
    ("raw_symbol", "QQ  1", ["QQ  1"])])
def test_symbol_parameters(spark, stype, given, expected):
    assert text.normal_symbols(given, stype) == expected
    if isinstance(given, str):
        assert one(spark, text.symbol_list(F.col("s"), stype), s=given) == expected


@pytest.mark.parametrize("stype, given, error", [
    ("raw_symbol", [None], TypeError), ("parent", ["zc", ""], ValueError), ("continuous", "zc..", ValueError),
    ("raw_symbol", 8, ValueError), ("instrument_id", [[8], [[None]]], TypeError)])
def test_bad_symbol_parameters(stype, given, error):
    with pytest.raises(error):
        text.normal_symbols(given, stype)


@pytest.mark.parametrize("given, expected", [
    ("zc", "ZC"), ("zc.FUT", "ZC.FUT"), ("zC.V.12", "ZC.v.12"), ("zc..4", None), (".", None), ("zc.v.1.2", None)])
def test_smart_symbol(spark, given, expected):
    assert one(spark, text.smart_symbol(F.col("s")), s=given) == expected


def test_strict_forms_raise(spark):
    with pytest.raises(Exception, match="not a smart symbol"):
        one(spark, text.smart_symbol(F.col("s"), strict=True), s="zc.v.")
    with pytest.raises(Exception, match="not in the domain"):
        one(spark, text.coerce(F.col("s"), domains.SCHEMA, strict=True), s="candles")


@pytest.mark.parametrize("given, ok", [
    ("key 1", True), ("\t", False), ("a\u0007", False), ("\u65e5\u672c", True), ("x\u2029y", False), ("x\u3000y", False)])
def test_semantic_text(spark, given, ok):
    assert one(spark, text.is_semantic(F.col("s")), s=given) is ok


@pytest.mark.parametrize("given, expected", [("Zc , ZW", "zc , zw"), (["  Zc", "ZW", "Q "], "zc,zw,q")])
def test_values_text(spark, given, expected):
    assert one(spark, text.values_text(F.col("v"), isinstance(given, list)), v=given) == expected


@pytest.mark.parametrize("domain, given, expected", [
    (domains.SCHEMA, "MBP-10", "mbp-10"), (domains.SCHEMA, "ohlcv_1m", "ohlcv-1m"), (domains.FEED_MODE, "HISTORICAL_STREAMING",
                                                                                   "historical-streaming"),
    (domains.ROLL_RULE, "open-interest", "open_interest"), (domains.RESOLUTION, "OK", "ok")])
def test_domains(spark, domain, given, expected):
    assert domains.member(given, domain, "x") == expected
    assert one(spark, text.coerce(F.col("s"), domain), s=given) == expected


def test_domain_needs_a_value():
    for bad in (None, "other"):
        with pytest.raises(ValueError):
            domains.member(bad, domains.PACKAGING, "packaging")


def test_chunks(spark):
    got = one(spark, text.chunks(F.col("a"), 2), a=["a", "b", "c"])
    assert [(r["chunk"], r["items"], r["is_last"]) for r in got] == [(0, ["a", "b"], False), (1, ["c"], True)]
    assert one(spark, text.chunks(F.col("a"), 2), a=[]) == []
    with pytest.raises(ValueError):
        text.chunks(F.col("a"), 0)


def test_flags(spark):
    assert one(spark, flags.flags_text(F.col("f")), f=130) == "f_last, f_publisher_specific"
    assert one(spark, flags.flags_text(F.col("f")), f=1) == ""
    assert one(spark, flags.has_flag(F.col("f"), "F_SNAPSHOT"), f=40) is True
