"""Row selection: time range, symbols, limit, record flags and classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import flags as fl
from tickloom.functions import text as tx
from tickloom.functions import times
from tickloom.operators.joins import lookup_join
from tickloom.schemas import index_column

# Fixed value: the documented number of symbols per request.
#: Longer lists are joined as a table.
LISTED_SYMBOLS = 2_000

# Reference-data time columns a range may select on, and symbol columns by type.
REFERENCE_INDEX = {
    "corporate_actions": ("event_date", "ex_date", "ts_record"),
    "security_master": ("ts_effective", "ts_record"),
    "adjustment_factors": ("ex_date",),
}
STYPE_COLUMNS = {
    "raw_symbol": "symbol", "nasdaq_symbol": "nasdaq_symbol", "isin": "isin", "us_code": "us_code",
    "bbg_comp_id": "bbg_comp_id", "bbg_comp_ticker": "bbg_comp_ticker", "figi": "figi",
    "figi_ticker": "figi_ticker",
}
ADJUSTMENT_STYPES = {"raw_symbol": "local_code", "nasdaq_symbol": "nasdaq_symbol", "isin": "isin",
                     "us_code": "us_code"}


def time_range(df: DataFrame, start=None, end=None, column: str | None = None,
               date_column: str | None = None, fill_end: bool = False, stored_column: str | None = None,
               slack_ns: int = 0) -> DataFrame:
    """``start <= t < end`` on the index time, in nanoseconds.

    With ``fill_end`` a missing end is the start filled forward by its resolution.
    ``date_column`` names a date partition column that is pruned as well. Where the index
    time is computed from a stored date or timestamp, ``stored_column`` is that column and
    ``slack_ns`` how far the two may lie apart: the same range, rounded outward, then
    reaches the scan.
    """
    name = column or index_column(df.columns)
    low = None if start is None else times.bound_ns(start)
    high = None if end is None else times.bound_ns(end)
    if high is None and fill_end and start is not None:
        high = times.bound_ns(start, end_of=True)
    if low is not None:
        df = df.where(F.col(name) >= low)
    if high is not None:
        df = df.where(F.col(name) < high)
    if stored_column:
        kind = dict(df.dtypes)[stored_column]
        if low is not None:
            df = df.where(F.col(stored_column) >= F.timestamp_micros(F.lit((low - slack_ns) // 1000)).cast(kind))
        if high is not None:
            df = df.where(F.col(stored_column) <= F.timestamp_micros(F.lit(-(-(high + slack_ns) // 1000))).cast(kind))
    if date_column:
        if low is not None:
            df = df.where(F.col(date_column) >= times.utc_date(F.lit(low)))
        if high is not None:
            df = df.where(F.col(date_column) <= times.utc_date(F.lit(high - 1)))
    return df


def date_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """The same half-open range on a date or timestamp column of reference data."""
    kind = dict(df.dtypes)[column]
    if start is not None:
        df = df.where(F.col(column) >= F.lit(str(start)).cast(kind))
    if end is not None:
        df = df.where(F.col(column) < F.lit(str(end)).cast(kind))
    return df


def reference_range(df: DataFrame, kind: str, index: str, start=None, end=None) -> DataFrame:
    if index not in REFERENCE_INDEX[kind]:
        raise ValueError(f"{kind} is selected by one of {REFERENCE_INDEX[kind]}, not {index!r}")
    return date_range(df, index, start, end)


def symbols(df: DataFrame, wanted, stype: str = "raw_symbol", column: str = "symbol") -> DataFrame:
    """Rows of the given symbols; ``None`` and ``ALL_SYMBOLS`` keep all."""
    names = tx.normal_symbols(wanted, stype)
    if names == [tx.ALL_SYMBOLS]:
        return df
    if stype == "instrument_id" and column == "symbol":
        column = "instrument_id"
    kind = dict(df.dtypes)[column]
    values = [int(n) if kind in ("int", "bigint") else n for n in names]
    if len(values) <= LISTED_SYMBOLS:
        return df.where(F.col(column).isin(values))
    # a long list is a table of its own; the rows are the same
    return symbols_in(df, df.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` {kind}"), column)


def symbols_in(df: DataFrame, wanted: DataFrame, column: str = "symbol", **options) -> DataFrame:
    """Rows whose symbol is in a table of any size."""
    return lookup_join(df, wanted.select(column).distinct(), [column], how="left_semi", **options)


def reference_symbols(df: DataFrame, wanted, stype: str = "raw_symbol", adjustment: bool = False) -> DataFrame:
    columns = ADJUSTMENT_STYPES if adjustment else STYPE_COLUMNS
    if stype not in columns:
        raise ValueError(f"symbols can be given as {sorted(columns)}, not {stype!r}")
    names = tx.normal_symbols(wanted, stype)
    if names == [tx.ALL_SYMBOLS]:
        return df
    return df.where(F.upper(columns[stype]).isin(names))


def one_of(df: DataFrame, choices: Mapping[str, str | Sequence[str] | None]) -> DataFrame:
    """``column -> comma text or list``; an absent list keeps all rows."""
    for column, values in choices.items():
        if isinstance(values, str):
            values = values.strip().strip(",").split(",")
        if values:
            df = df.where(F.col(column).isin([str(v).strip() for v in values]))
    return df


def reference_filters(df: DataFrame, events=None, countries=None, exchanges=None, security_types=None):
    given = {"event": events, "listing_country": countries, "exchange": exchanges,
             "security_type": security_types}
    return one_of(df, {c: v for c, v in given.items() if v})


ORDER_TIES = ("publisher_id", "instrument_id", "sequence")


def time_order(df: DataFrame, column: str | None = None, ties: Sequence[str] = ORDER_TIES) -> list[Column]:
    name = column or index_column(df.columns)
    return [F.col(name).asc_nulls_last(), *[F.col(t).asc() for t in ties if t in df.columns]]


def first_records(df: DataFrame, limit: int | None, column: str | None = None,
                  ties: Sequence[str] = ORDER_TIES) -> DataFrame:
    """Records in time order, at most ``limit`` of them (a top-k per task, then one merge)."""
    ordered = df.orderBy(*time_order(df, column, ties))
    return ordered if limit is None else ordered.limit(limit)


def flagged(df: DataFrame, name: str, on: bool = True, column: str = "flags") -> DataFrame:
    hit = fl.has_flag(F.col(column), name)
    return df.where(hit if on else ~hit)


def record_class(rtype: Column, code: Column, codes: Mapping[str, int],
                 heartbeat: int = 0, interval_end: int | None = None) -> Column:
    """``error``, ``heartbeat``, ``end_of_interval``, ``system``, ``mapping`` or ``data``.

    ``codes`` gives the record types of ``error``, ``system`` and ``mapping``.
    """
    system = F.when(code == heartbeat, "heartbeat")
    if interval_end is not None:
        system = system.when(code == interval_end, "end_of_interval")
    return (
        F.when(rtype == codes["error"], "error")
        .when(rtype == codes["system"], system.otherwise("system"))
        .when(rtype == codes["mapping"], "mapping")
        .otherwise("data")
    )


def subscription_union(df: DataFrame, wanted: Sequence[tuple[str, object, str]],
                       dataset: str | None = None) -> DataFrame:
    """Rows of any of the ``(schema, symbols, stype)`` requests, each row once.

    All requests are on one dataset; ``schema`` and ``symbol``/``instrument_id`` are
    columns of ``df``.
    """
    if dataset is not None and "dataset" in df.columns:
        df = df.where(F.col("dataset") == dataset)
    keep = None
    for schema, names, stype in wanted:
        listed = tx.normal_symbols(names, stype)
        part = F.col("schema") == schema
        if listed != [tx.ALL_SYMBOLS]:
            key = "instrument_id" if stype == "instrument_id" else "symbol"
            part = part & F.col(key).isin([int(s) if key == "instrument_id" else s for s in listed])
        keep = part if keep is None else keep | part
    return df.where(F.lit(False) if keep is None else keep)
