"""Records in and out of files."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.prices import UNDEF_PRICE
from tickloom.operators import filters, formatting
from tickloom.schemas import Layout, known_layouts, layout, register, struct
from tickloom.sinks import export, files
from tickloom.sources import records

MBO, MBP1 = layout("mbo"), layout("mbp-1")
# The first golden rows of two record types.
MBO_ROW = "1609113600000000000,1609099225061045683,160,1,5482,A,B,3675750000000,2,0,647784248135,40,0,1180"
MBP1_ROW = ("1609113600006150193,1609113600005871213,1,1,5482,A,B,0,3702250000000,1,130,26128,145805,"
            "3702250000000,3702750000000,19,13,11,13")
MBP1_PRETTY = ("2020-12-28T00:00:00.006150193Z,2020-12-28T00:00:00.005871213Z,1,1,5482,A,B,0,3702.250000000,1,130,26128,145805,"
               "3702.250000000,3702.750000000,19,13,11,13,ESH1")
MBO_JSON = ('{"ts_recv":"1609113600000000000","hd":{"ts_event":"1609099225061045683","rtype":160,"publisher_id":1,'
            '"instrument_id":5482},"action":"A","side":"B","price":"3675750000000","size":2,"channel_id":0,'
            '"order_id":"647784248135","flags":40,"ts_in_delta":0,"sequence":1180}')
MBP1_JSON = ('{"ts_recv":"2020-12-28T00:00:00.006150193Z","hd":{"ts_event":"2020-12-28T00:00:00.005871213Z","rtype":1,'
             '"publisher_id":1,"instrument_id":5482},"action":"A","side":"B","depth":0,"price":"3702.250000000","size":1,'
             '"flags":130,"ts_in_delta":26128,"sequence":145805,"levels":[{"bid_px":"3702.250000000",'
             '"ask_px":"3702.750000000","bid_sz":19,"ask_sz":13,"bid_ct":11,"ask_ct":13}],"symbol":"ESH1"}')
INTERVALS = "instrument_id bigint, start_date date, end_date date, symbol string, seq bigint"


def rows(spark, lay, *lines):
    raw = spark.createDataFrame([(x,) for x in lines], "line string").select(F.split("line", ",").alias("p"))
    return raw.select(*[F.col("p")[i].cast(f.dataType).alias(f.name) for i, f in enumerate(lay.struct.fields)])


@pytest.fixture
def intervals(spark):
    return spark.sql("select 5482L instrument_id, date'2020-12-28' start_date, date'2020-12-29' end_date, 'ESH1' symbol, 0L seq")


def text_of(path, suffix):
    return "".join(f.read_text() for f in sorted(path.glob(f"*.{suffix}")))


def test_csv_text(spark, tmp_path, intervals):
    files.write_csv(rows(spark, MBO, MBO_ROW).coalesce(1), str(tmp_path / "a"), MBO, False, False)
    assert text_of(tmp_path / "a", "csv") == ",".join(MBO.columns) + "\n" + MBO_ROW + "\n"
    files.write_csv(rows(spark, MBP1, MBP1_ROW).coalesce(1), str(tmp_path / "b"), MBP1, intervals=intervals)
    assert text_of(tmp_path / "b", "csv") == ",".join(MBP1.columns) + ",symbol\n" + MBP1_PRETTY + "\n"
    assert files.csv_lines(files.csv_columns(rows(spark, MBP1, MBP1_ROW), MBP1, intervals=intervals)).first()[0] == MBP1_PRETTY


def test_null_price_is_empty_text(spark):
    df = rows(spark, MBO, MBO_ROW.replace("3675750000000", str(UNDEF_PRICE)))
    assert ",B,,2," in files.csv_lines(files.csv_columns(df, MBO)).first()[0]
    assert '"price":null' in files.json_lines(files.json_columns(df, MBO)).first()[0]


def test_json_text(spark, tmp_path, intervals):
    files.write_json(rows(spark, MBO, MBO_ROW).coalesce(1), str(tmp_path / "a"), MBO, False, False)
    assert text_of(tmp_path / "a", "txt") == MBO_JSON + "\n"
    shown = files.json_lines(files.json_columns(rows(spark, MBP1, MBP1_ROW), MBP1, intervals=intervals))
    assert shown.first()[0] == MBP1_JSON


def test_text_is_read_back(spark, tmp_path):
    df = rows(spark, MBP1, MBP1_ROW)
    want = tuple(df.first())
    for pretty in (True, False):
        files.write_csv(df, str(tmp_path / f"c{pretty}"), MBP1, False, pretty)
        assert tuple(records.read_csv(spark, str(tmp_path / f"c{pretty}"), MBP1).first()) == want
        files.write_json(df, str(tmp_path / f"j{pretty}"), MBP1, False, pretty)
        assert tuple(records.read_json(spark, str(tmp_path / f"j{pretty}"), MBP1).first()) == want


def test_csv_needs_its_columns(spark):
    with pytest.raises(ValueError, match="instrument_id"):
        records.typed_text(spark.sql("select '1' ts_event"))
    with pytest.raises(ValueError, match="ts_recv"):
        records.typed_text(spark.sql("select '1' instrument_id"))


def test_invalid_json_record(spark, tmp_path):
    (tmp_path / "x.json").write_text(MBO_JSON + "\n" + MBO_JSON[:-30] + "\n")
    with pytest.raises(Exception, match="invalid record"):
        records.read_json(spark, str(tmp_path), MBO).collect()
    good, bad = records.read_damaged(spark, str(tmp_path), MBO)
    assert [r["sequence"] for r in good.collect()] == [1180]
    assert [r["_corrupt_record"] for r in bad.collect()] == [MBO_JSON[:-30]]


def test_damaged_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",".join(MBO.columns) + "\n" + MBO_ROW + "\n" + MBO_ROW[:60] + "\n")
    good, bad = records.read_damaged(spark, str(tmp_path), MBO, "csv")
    assert good.count() == 1 and bad.count() == 1


def test_parquet_round_trip_and_modes(spark, tmp_path, intervals):
    df = rows(spark, MBP1, MBP1_ROW)
    path = str(tmp_path / "p")
    files.write_parquet(df, path, layout=MBP1, intervals=intervals)
    table = formatting.table(df, MBP1, intervals=intervals)
    back = spark.read.parquet(path)
    assert back.columns == table.columns and back.columns[0] == "ts_recv" and back.columns[-1] == "symbol"
    assert tuple(back.first()) == tuple(table.first())
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_parquet(df, path, layout=MBP1, mode="x")
    want = T.StructType([T.StructField("price", T.StringType()), T.StructField("size", T.IntegerType())])
    files.write_parquet(df, path, price_type="decimal", layout=MBP1, parquet_schema=want)
    assert tuple(spark.read.parquet(path).first()) == ("3702.250000000", 1)
    with pytest.raises(ValueError):
        files.save_mode("a")


def test_record_scan_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        records.read_records(spark, str(tmp_path / "none"), MBO)
    rows(spark, MBO, MBO_ROW).write.parquet(str(tmp_path / "m"))
    assert records.read_records(spark, str(tmp_path / "m"), MBO).count() == 1
    with pytest.raises(ValueError, match="lacks"):
        records.read_records(spark, str(tmp_path / "m"), MBP1)
    rows(spark, MBO, MBO_ROW).limit(0).write.parquet(str(tmp_path / "e"))
    with pytest.raises(ValueError, match="no records"):
        records.read_records(spark, str(tmp_path / "e"), MBO)


def test_table_zone_and_fixed_prices(spark, intervals):
    df = rows(spark, MBP1, MBP1_ROW)
    for zone in ("America/Los_Angeles", "Asia/Tokyo", "Pacific/Honolulu"):
        row = formatting.table(df, MBP1, tz=zone, intervals=intervals).first()
        assert row["symbol"] == "ESH1"
    assert formatting.table(df, MBP1, price_type="fixed").first()["price"] == 3702250000000
    with pytest.raises(ValueError):
        formatting.table(df, MBP1, tz="Asia/Tokyo", pretty_ts=False)


def test_ten_levels_nest_and_flatten(spark):
    lay = layout("mbp-10")
    values = [1, 2, 10, 1, 5482, "A", "B", 0, 5, 6, 0, 0, 9] + list(range(60))
    df = spark.createDataFrame([tuple(values)], lay.struct)
    back = formatting.flatten_levels(formatting.nest_levels(df, 10), 10)
    assert back.columns == df.columns and tuple(back.first()) == tuple(df.first())
    assert len(formatting.nest_levels(df, 10).first()["levels"]) == 10


def test_mixed_run(spark):
    """Record counts per schema of a mixed run."""
    counts = {160: 5, 1: 2, 10: 2, 0: 2}
    data = [(1, 2, code, 1, 7) for code, n in counts.items() for _ in range(n)]
    df = spark.createDataFrame(data, "ts_recv bigint, ts_event bigint, rtype int, publisher_id int, instrument_id bigint")
    assert records.of_type(df, MBO).count() == 5
    assert records.of_type(df, layout("mbp-10"), 10).count() == 2
    assert records.of_type(df, layout("trades"), 0).columns == layout("trades").columns
    assert records.of_type(df, layout("ohlcv-1h"), 34).count() == 0
    with pytest.raises(ValueError, match="record type"):
        records.of_type(df, Layout("own", layout("trades").struct))
    empty = records.as_schema(df, "mbo", layout("ohlcv-1d"))
    assert empty.count() == 0 and empty.columns == layout("ohlcv-1d").columns


def test_layouts_are_registered_by_users():
    assert {x.name for x in known_layouts()} >= {"mbo", "mbp-1", "mbp-10", "trades", "tbbo", "ohlcv-eod"}
    with pytest.raises(ValueError, match="no layout"):
        layout("imbalance")
    register(Layout("status", struct("ts_recv bigint, instrument_id bigint, reason int"), times=("ts_recv",)))
    assert layout("STATUS").index == "ts_recv"


def test_sentinels_and_padding(spark):
    lay = Layout("definition", struct("ts_recv bigint, instrument_id bigint, lot int, raw_symbol string"), times=("ts_recv",),
                 chars=("raw_symbol",), sentinels={"lot": 2147483647})
    df = spark.createDataFrame([(1, 1, 2147483647, "ES\x00\x00"), (1, 1, 5, "A B")], lay.struct)
    got = [(r["lot"], r["raw_symbol"]) for r in formatting.table(df, lay).collect()]
    assert got == [(None, "ES"), (5, "A B")]


def test_export_splits_and_verifies(spark, tmp_path):
    trades = layout("trades")
    day = 86_400 * 10**9
    data = [(1609113600000000000 + i * day // 4, i, 0, 1, i % 3, "T", "A", 0, 10**9 * i, 1, 0, 0, i) for i in range(100)]
    df = spark.createDataFrame(data, trades.struct).withColumn(
        "symbol", F.when(F.col("instrument_id") != 2, F.concat(F.lit("S"), F.col("instrument_id").cast("string"))))
    path = str(tmp_path / "x")
    export.export(df, path, trades, "csv", symbols=["S0", "S1"], split_symbols=True, split_duration="week", pretty_px=True)
    back = spark.read.option("header", True).csv(path)
    assert set(back.columns) == {*trades.columns, "symbol", "split_symbol", "split"}
    assert back.count() == 67
    weeks = {str(r["split"]) for r in back.select("split").distinct().collect()}
    assert "20201227" in weeks and all(w in {"20201227", "20210103", "20210110", "20210117"} for w in weeks)
    with pytest.raises(ValueError, match="list of symbols"):
        export.export(df, path, trades, split_symbols=True)
    with pytest.raises(ValueError):
        export.checked_size(5)
    assert export.checked_size(2_000_000_000) == 2_000_000_000
    manifest = export.manifest_of(spark, path)
    local = {f"{p.relative_to(path)}": hashlib.sha256(p.read_bytes()).hexdigest() for p in (tmp_path / "x").rglob("part-*")}
    got = {r["filename"]: r["hash"] for r in manifest.where("filename like '%part-%'").collect()}
    assert got == {k: f"sha256:{v}" for k, v in local.items()}
    name = sorted(local)[0]
    other = sorted(local)[1]
    odd = manifest.withColumn("size", F.when(F.col("filename") == name, F.col("size") + 1).otherwise(F.col("size"))).withColumn(
        "hash", F.when(F.col("filename") == other, "sha256:00").otherwise(F.col("hash"))).unionByName(
        spark.createDataFrame([("gone.csv", 3, "sha256:11")], "filename string, size bigint, hash string"))
    status = {r["filename"]: r["status"] for r in export.verify(spark, odd, path).collect()}
    assert status[name] == "too_small" and status[other] == "bad_hash" and status["gone.csv"] == "missing"
    assert all(v == "ok" for k, v in status.items() if k not in (name, other, "gone.csv"))
    md5 = manifest.withColumn("hash", F.lit("md5:1"))
    assert {r["status"] for r in export.verify(spark, md5, path).collect()} == {"unchecked"}


@pytest.mark.parametrize("encoding", ["csv", "json", "parquet"])
def test_files_keep_to_their_size(spark, tmp_path, encoding, monkeypatch):
    """Rows of unlike length; every file is within the bound and holds a run of times."""
    monkeypatch.setattr(export, "MIN_SPLIT", 2_000)
    trades, day = layout("trades"), 86_400 * 10**9
    data = [(1609113600000000000 + i * day // 300, i, 0, 1, 10 ** (i % 12), "T", "A", 0, 10 ** (i % 17), i % 7, 0, 0, i) for i in range(900)]
    df = spark.createDataFrame(data, trades.struct).repartition(5)
    path = str(tmp_path / "x")
    export.export(df, path, trades, encoding, split_size=3_000, map_symbols=False)
    found = sorted((tmp_path / "x").rglob(f"*.{'json' if encoding == 'none' else {'csv': 'csv', 'json': 'txt', 'parquet': 'parquet'}[encoding]}"))
    assert len(found) > 20
    if encoding != "parquet":
        assert max(f.stat().st_size for f in found) <= 3_000 and sorted(f.stat().st_size for f in found)[len(found) // 2] > 2_000
    read = spark.read.option("header", True)
    back = read.text(path) if encoding == "json" else getattr(read, encoding)(path)
    assert back.count() == 900
    if encoding == "csv":
        runs = back.groupBy("split", "file").agg(F.min(F.col("ts_recv").cast("long")).alias("a"), F.max(F.col("ts_recv").cast("long")).alias("b")).orderBy("a").collect()
        assert all(x["b"] < y["a"] for x, y in zip(runs, runs[1:]))


def test_a_long_split_is_measured_in_segments(spark):
    df = spark.range(2_000).select(F.lit("all").alias("split"), F.col("id").alias("t"), (F.col("id") % 90 + 10).alias("n"))
    made = export.file_numbers(df, ["split"], ["t"], F.col("n"), 1_000, rows_per_segment=100)
    sums = made.groupBy("file").agg(F.sum("n").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).orderBy("file").collect()
    assert max(r["n"] for r in sums) <= 1_000 and all(x["b"] + 1 == y["a"] for x, y in zip(sums, sums[1:]))
    long = export.file_numbers(df.withColumn("n", F.when(F.col("t") == 7, 5_000).otherwise(F.col("n"))), ["split"], ["t"], F.col("n"), 1_000)
    assert long.groupBy("file").agg(F.sum("n").alias("n")).where("n > 1000").count() <= 1


def test_listed_symbols_are_resolved_for_parquet_too(spark, tmp_path, intervals):
    df = rows(spark, MBP1, MBP1_ROW)
    name = formatting.table(df, MBP1, intervals=intervals).first()["symbol"]
    export.export(df, str(tmp_path / "one"), MBP1, symbols=f"{name},OTHER", intervals=intervals)
    back = spark.read.parquet(str(tmp_path / "one"))
    assert back.count() == 1 and "symbol" not in back.columns
    export.export(df, str(tmp_path / "none"), MBP1, symbols="OTHER,MORE", intervals=intervals)
    assert not list((tmp_path / "none").rglob("*.parquet"))


def test_damaged_csv_follows_its_header(spark, tmp_path):
    names, values = list(MBO.columns)[::-1], MBO_ROW.split(",")[::-1]
    (tmp_path / "x.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n" + ",".join(values)[:40] + "\n")
    good, bad = records.read_damaged(spark, str(tmp_path), MBO, "csv")
    plain = rows(spark, MBO, MBO_ROW)
    assert good.columns == list(MBO.columns) and bad.count() == 1
    assert [tuple(r) for r in good.collect()] == [tuple(r) for r in plain.collect()]
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="lacks"):
        records.read_damaged(spark, str(tmp_path), MBO, "csv")


def test_every_known_layout_is_told_by_its_type(spark):
    mixed = spark.createDataFrame([(r, i) for i, r in enumerate([0, 1, 1, 10, 32, 33, 34, 35, 36, 160, 160, 160, 21])], "rtype int, sequence bigint")
    want = {"mbo": 3, "mbp-1": 2, "tbbo": 2, "mbp-10": 1, "trades": 1, **{f"ohlcv-{w}": 1 for w in ("1s", "1m", "1h", "1d", "eod")}}
    assert {name: records.of_type(mixed, layout(name)).count() for name in want} == want


def test_json_export(spark, tmp_path):
    trades = layout("trades")
    df = spark.createDataFrame([(1609113600000000000, 1, 0, 1, 5, "T", "A", 0, 10**9, 1, 0, 0, 1)], trades.struct)
    export.export(df, str(tmp_path / "j"), trades, "json", split_duration="none", map_symbols=False)
    line = text_of(tmp_path / "j" / "split=all", "txt").strip()
    assert line.startswith('{"ts_recv":"1609113600000000000","hd":{"ts_event":"1"') and '"split"' not in line


def test_filters(spark):
    df = spark.range(10).select(F.col("id").alias("ts_event"), F.col("id").alias("instrument_id"), F.lit(1).alias("publisher_id"))
    got = filters.time_range(df, 3, 7)
    assert [r[0] for r in got.orderBy("ts_event").select("ts_event").collect()] == [3, 4, 5, 6]
    assert filters.symbols(df, [1, "2,3"], "instrument_id").count() == 3
    assert filters.symbols(df, None).count() == 10
    assert filters.first_records(df, 4).count() == 4
    assert filters.symbols(df, list(range(3000)), "instrument_id").count() == 10
    with pytest.raises(ValueError):
        filters.reference_range(df, "adjustment_factors", "ts_record")
    with pytest.raises(ValueError):
        filters.reference_symbols(df, "A", "figi", adjustment=True)
