"""Parquet, CSV and JSON-lines files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import prices, times
from tickloom.operators import formatting, symbology
from tickloom.schemas import HEADER_FIELDS, Layout, index_column
from tickloom.sources.symbology import from_response, read_response

MODES = {"w": "overwrite", "x": "errorifexists"}
# zstd text output is not part of Spark, so text is gzipped where compression is asked for
TEXT_CODECS = {None: "none", "none": "none", "zstd": "gzip", "gzip": "gzip"}


def save_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be w or x, not {mode!r}")
    return MODES[mode]


def write_parquet(df: DataFrame, path: str, price_type: str = "float", pretty_ts: bool = True,
                  intervals: DataFrame | None = None, layout: Layout | None = None, mode: str = "w",
                  parquet_schema: T.StructType | None = None, compression: str = "zstd") -> None:
    """The formatted table, cast to ``parquet_schema`` when one is given."""
    out = formatting.table(df, layout, price_type, pretty_ts, intervals=intervals)
    if parquet_schema is not None:
        out = out.select(*[F.col(f.name).cast(f.dataType) for f in parquet_schema.fields])
    out.write.mode(save_mode(mode)).option("compression", compression).parquet(path)


def csv_columns(df: DataFrame, layout: Layout, pretty_px: bool = True, pretty_ts: bool = True,
                intervals: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Columns as CSV shows them; the symbol comes last. ``keep`` names columns that
    pass through, such as partition columns."""
    if intervals is not None:
        df = symbology.add_symbol(df, intervals)

    def shown(name: str) -> Column:
        if name in layout.prices and pretty_px:
            return prices.to_text(F.col(name)).alias(name)
        if name in layout.times and pretty_ts:
            return times.iso_text(F.col(name)).alias(name)
        return F.col(name).cast("string").alias(name)

    extra = ["symbol"] if "symbol" in df.columns else []
    return df.select(*[shown(c) for c in layout.columns if c in df.columns], *extra, *keep)


def csv_lines(columns: DataFrame) -> DataFrame:
    """One CSV line per row, without a header."""
    options = {"emptyValue": "", "nullValue": "", "quoteAll": "false"}
    return columns.select(F.to_csv(F.struct(*columns.columns), options).alias("value"))


def write_csv(df: DataFrame, path: str, layout: Layout, pretty_px: bool = True, pretty_ts: bool = True,
              intervals: DataFrame | None = None, compression: str | None = None, mode: str = "w") -> None:
    out = csv_columns(df, layout, pretty_px, pretty_ts, intervals)
    (out.write.mode(save_mode(mode)).option("header", True).option("emptyValue", "")
     .option("compression", TEXT_CODECS[compression]).csv(path))


def json_columns(df: DataFrame, layout: Layout, pretty_px: bool = True, pretty_ts: bool = True,
                 intervals: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Nested columns as JSON shows them: header object, levels, wide numbers as text."""
    if intervals is not None:
        df = symbology.add_symbol(df, intervals)
    wide = {f.name for f in layout.struct.fields if isinstance(f.dataType, T.DecimalType)}

    def shown(name: str) -> Column:
        col = F.col(name)
        if name in layout.prices:
            return (prices.to_text(col) if pretty_px else col.cast("string")).alias(name)
        if name in layout.times:
            return (times.iso_text(col) if pretty_ts else col.cast("string")).alias(name)
        return col.cast("string").alias(name) if name in wide else col

    extra = ["symbol"] if "symbol" in df.columns else []
    out = df.select(*[shown(c) for c in layout.columns if c in df.columns], *extra, *keep)
    out = formatting.nest_header(out) if set(HEADER_FIELDS) <= set(out.columns) else out
    if layout.levels:
        out = formatting.nest_levels(out, layout.levels)
        if extra:
            out = out.select(*[c for c in out.columns if c != "symbol"], "symbol")
    return out


def json_lines(columns: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    body = [c for c in columns.columns if c not in keep]
    return columns.select(F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("value"), *keep)


def write_json(df: DataFrame, path: str, layout: Layout, pretty_px: bool = True, pretty_ts: bool = True,
               intervals: DataFrame | None = None, compression: str | None = None, mode: str = "w") -> None:
    out = json_lines(json_columns(df, layout, pretty_px, pretty_ts, intervals))
    out.write.mode(save_mode(mode)).option("compression", TEXT_CODECS[compression]).text(path)


def mapped_path(path: str, taken=()) -> str:
    """``name_mapped.ext``, numbered from 0 when taken. ``taken`` holds paths or tells of
    one whether it is there."""
    there = taken if callable(taken) else lambda p: p in taken
    stem, dot, ext = path.rpartition(".")
    if not dot or "/" in ext:
        stem, dot, ext = path, "", ""
    out, i = f"{stem}_mapped{dot}{ext}", 0
    while there(out):
        out, i = f"{stem}_mapped_{i}{dot}{ext}", i + 1
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _path_pair(spark: SparkSession, source: str, out: str | None) -> str:
    if not path_exists(spark, source):
        raise ValueError(f"{source} does not exist")
    target = out or mapped_path(source, lambda p: path_exists(spark, p))
    if target.rstrip("/") == source.rstrip("/"):
        raise ValueError("the output must not be the input")
    return target


def map_csv_file(spark: SparkSession, symbology_path: str, path: str, out: str | None = None) -> str:
    """CSV records with the symbols that a symbology document gives them, written to
    ``out`` or beside the input. Returns where."""
    target = _path_pair(spark, path, out)
    table = from_response(read_response(spark, symbology_path))
    text = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    if "instrument_id" not in text.columns or not {"ts_recv", "ts_event"} & set(text.columns):
        raise ValueError(f"{path} needs instrument_id and ts_recv or ts_event")
    map_csv(text, table).write.option("header", True).option("emptyValue", "").mode("errorifexists").csv(target)
    return target


def map_json_file(spark: SparkSession, symbology_path: str, path: str, out: str | None = None) -> str:
    """JSON-lines records with their symbols, as above."""
    target = _path_pair(spark, path, out)
    table = from_response(read_response(spark, symbology_path))
    map_json(spark.read.text(path), table).write.mode("errorifexists").text(target)
    return target


def map_csv(df: DataFrame, intervals: DataFrame) -> DataFrame:
    """Any CSV records with their symbol appended. Text of the other columns stays as
    it was read; only the index time and id are parsed."""
    day = times.utc_date(times.parse_ns(F.col(index_column(df.columns))))
    ided = df.withColumn("_id", F.col("instrument_id").cast("bigint"))
    return symbology.resolve(ided, intervals, day, id_column="_id").drop("_id")


def map_json(lines: DataFrame, intervals: DataFrame) -> DataFrame:
    """JSON-lines text with the ``symbol`` of each record: in the place of one that is
    there, else as the last field. Blanks between fields go."""
    doc = F.col("value")
    stamp = F.coalesce(F.get_json_object(doc, "$.ts_recv"), F.get_json_object(doc, "$.hd.ts_event"))
    raw_id = F.get_json_object(doc, "$.hd.instrument_id")
    checked = F.when(raw_id.isNotNull() & stamp.isNotNull(), raw_id.try_cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("invalid record: "), doc)).cast("bigint"))
    ided = lines.select("value", checked.alias("_id"), stamp.alias("_ts"))
    out = symbology.resolve(ided, intervals, times.utc_date(times.parse_ns(F.col("_ts"))), id_column="_id")
    tail = F.when(F.col("symbol").isNull(), F.lit("null")).otherwise(
        F.regexp_extract(F.to_json(F.struct("symbol")), r'^\{"symbol":(.*)\}$', 1))
    tight = F.regexp_replace(doc, r'("(?:[^"\\]|\\.)*+")|\s+', "$1")
    exact = F.regexp_replace(tail, r"([\\$])", r"\\$1")  # as a replacement text
    place = r'([{,]"symbol":)(?:"(?:[^"\\]|\\.)*+"|[^,}]*+)'
    replaced = F.regexp_replace(tight, F.lit(place), F.concat(F.lit("$1"), exact))
    # where the name occurs on other levels too, or holds an object, the members are told apart by parsing
    held = F.from_json(doc, "map<string,variant>")
    members = F.transform(F.json_object_keys(doc), lambda k: F.concat(
        F.regexp_extract(F.to_json(F.struct(k.alias("k"))), r'^\{"k":(.*)\}$', 1), F.lit(":"),
        F.when(k == "symbol", tail).otherwise(F.to_json(F.element_at(held, k)))))
    rebuilt = F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
    several = (F.regexp_count(tight, F.lit(place)) > 1) | tight.rlike(r'[{,]"symbol":[\[{]')
    added = F.concat(F.regexp_replace(tight, r"\}$", ""), F.lit(',"symbol":'), tail, F.lit("}"))
    known = F.coalesce(F.array_contains(F.json_object_keys(doc), "symbol"), F.lit(False))
    return out.select(F.when(known & several, rebuilt).when(known, replaced).otherwise(added).alias("value"))
