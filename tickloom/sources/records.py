"""Record readers for Parquet, CSV and JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import times
from tickloom.schemas import HEADER_FIELDS, LEVEL_FIELDS, Layout

CORRUPT = "_corrupt_record"


def _load(reader, fmt: str, path, what: str) -> DataFrame:
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as err:
        raise ValueError(f"cannot read {what} from {path}: {err}") from err


def read_records(spark: SparkSession, path: str | Sequence[str], layout: Layout,
                 require_rows: bool = True) -> DataFrame:
    """Stored records with the layout's columns. Missing, foreign or empty input is
    an error."""
    reader = spark.read
    df = _load(reader, "parquet", path, layout.name)
    lacking = [c for c in layout.columns if c not in df.columns]
    if lacking:
        raise ValueError(f"{path} has no {layout.name} records: lacks {lacking}")
    if require_rows and df.isEmpty():
        raise ValueError(f"{path} holds no records")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in layout.struct.fields])


def read_csv(spark: SparkSession, path, layout: Layout | None = None) -> DataFrame:
    """CSV records with a header row. Times may be nanosecond numbers or ISO text."""
    df = _load(spark.read.option("header", True), "csv", path, "CSV records")
    return typed_text(df, layout)


def typed_text(df: DataFrame, layout: Layout | None = None) -> DataFrame:
    if not {"ts_recv", "ts_event"} & set(df.columns):
        raise ValueError("CSV records need ts_recv or ts_event")
    if "instrument_id" not in df.columns:
        raise ValueError("CSV records need instrument_id")
    stamps = {c: times.parse_ns(F.col(c)) for c in ("ts_recv", "ts_event", "ts_out") if c in df.columns}
    out = df.withColumns({**stamps, "instrument_id": F.col("instrument_id").cast("bigint")})
    if layout is not None:
        names = [f for f in layout.struct.fields if f.name in out.columns]
        out = out.select(*[F.col(f.name).cast(f.dataType) for f in names],
                         *[c for c in out.columns if c not in layout.columns])
    return out


def json_schema(layout: Layout) -> T.StructType:
    """Nested text form of a layout: header object, level array, wide numbers as text."""
    flat = {f"{f}_{i:02d}" for i in range(layout.levels) for f in LEVEL_FIELDS}
    wide = {*layout.prices, *layout.times}

    def field(f: T.StructField) -> T.StructField:
        text = f.name in wide or isinstance(f.dataType, T.DecimalType)
        return T.StructField(f.name, T.StringType() if text else f.dataType)

    head = T.StructType([field(layout.struct[n]) for n in HEADER_FIELDS])
    out = T.StructType()
    if "ts_recv" in layout.columns:
        out.add(field(layout.struct["ts_recv"]))
    out.add("hd", head)
    for f in layout.struct.fields:
        if f.name not in HEADER_FIELDS and f.name not in flat and f.name != "ts_recv":
            out.add(field(f))
    if layout.levels:
        out.add("levels", T.ArrayType(T.StructType([
            T.StructField(n, T.StringType() if n.endswith("px") else T.LongType()) for n in LEVEL_FIELDS])))
    return out


def read_json(spark: SparkSession, path, layout: Layout) -> DataFrame:
    """JSON-lines records. Wide numbers may be quoted. A line that is no record is an
    error that quotes it."""
    schema = T.StructType([*json_schema(layout).fields, T.StructField(CORRUPT, T.StringType())])
    df = _load(spark.read.schema(schema).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT), "json", path, "JSON records")
    return flat_json(df, layout, strict=True)


def flat_json(df: DataFrame, layout: Layout, strict: bool = False) -> DataFrame:
    def typed(col, f: T.StructField):
        if f.name in layout.times:
            return times.parse_ns(col.cast("string")).alias(f.name)
        return col.cast(f.dataType).alias(f.name)

    cols = []
    for f in layout.struct.fields:
        level = f.name[-2:]
        stem = f.name[:-3]
        if layout.levels and stem in LEVEL_FIELDS and level.isdigit():
            cols.append(typed(F.get("levels", F.lit(int(level)))[stem], f))
        elif f.name in HEADER_FIELDS:
            cols.append(typed(F.col(f"hd.{f.name}"), f))
        else:
            cols.append(typed(F.col(f.name), f))
    if strict and CORRUPT in df.columns:
        bad = F.col(CORRUPT).isNotNull() | F.col("hd.instrument_id").isNull()
        # as a condition on rows, so it holds whichever columns are read
        df = df.where(F.when(bad, F.raise_error(F.concat(
            F.lit("invalid record: "), F.coalesce(CORRUPT, F.lit("no instrument id")))).cast("boolean")).otherwise(True))
    return df.select(*cols)


def read_damaged(spark: SparkSession, path, layout: Layout, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """Good records and the damaged lines, as two frames. Lines are read as text, so
    either frame can be counted on its own."""
    if fmt == "json":
        return parse_lines(_load(spark.read, "text", path, layout.name), layout)
    if fmt != "csv":
        raise ValueError("fmt must be json or csv")
    # columns are where the header says; the files of one call share their header
    header = _load(spark.read.option("header", True), "csv", path, layout.name).columns
    if lacking := [c for c in layout.columns if c not in header]:
        raise ValueError(f"{path} has no {layout.name} records: lacks {lacking}")
    lines = _load(spark.read, "text", path, layout.name).where(F.col("value") != ",".join(header))
    kinds = [layout.struct[c].dataType.simpleString() if c in layout.columns else "string" for c in header]
    schema = ", ".join(f"`{c}` {k}" for c, k in zip(header, kinds))
    parsed = lines.select("value", F.from_csv(
        "value", f"{schema}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("j"))
    good = parsed.where(F.col(f"j.{CORRUPT}").isNull()).select(*[f"j.{c}" for c in layout.columns])
    return good, parsed.where(F.col(f"j.{CORRUPT}").isNotNull()).select(F.col("value").alias(CORRUPT))


def parse_lines(lines: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """JSON-lines text (column ``value``) to good records and the damaged lines."""
    schema = T.StructType([*json_schema(layout).fields, T.StructField(CORRUPT, T.StringType())])
    parsed = lines.select("value", F.from_json(
        "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("j"))
    good = parsed.where(F.col(f"j.{CORRUPT}").isNull()).select("j.*")
    bad = parsed.where(F.col(f"j.{CORRUPT}").isNotNull()).select(F.col("value").alias(CORRUPT))
    return flat_json(good, layout), bad


def of_type(df: DataFrame, layout: Layout, rtype: int | None = None) -> DataFrame:
    """Records of one type out of a mixed run, with that layout's columns."""
    code = layout.rtype if rtype is None else rtype
    if code is None:
        raise ValueError(f"give the record type of {layout.name}")
    have = set(df.columns)
    return df.where(F.col("rtype") == code).select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in layout.struct.fields])


def as_schema(df: DataFrame, stored: str, wanted: Layout) -> DataFrame:
    """Homogeneous data asked for as another schema is empty but typed."""
    if stored == wanted.name:
        return df.select(*wanted.columns)
    return df.where(F.lit(False)).select(*[
        F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.struct.fields])


def newest_version(parts: Sequence[DataFrame], layout: Layout) -> DataFrame:
    """Several layout versions as one; columns a version lacks are NULL."""
    out = None
    for df in parts:
        have = set(df.columns)
        same = df.select(*[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in layout.struct.fields])
        out = same if out is None else out.unionByName(same)
    return out
