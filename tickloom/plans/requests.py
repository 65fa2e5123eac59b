"""Whole requests: the selection, resolution and shaping of one answer as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import text as tx
from tickloom.functions import times
from tickloom.operators import catalog, filters, formatting, pointintime, symbology
from tickloom.schemas import index_column


def time_series(
    records: DataFrame, start, end=None, symbols=None, stype_in: str = "raw_symbol",
    intervals: DataFrame | None = None, dataset: str | None = None, schema: str | None = None,
    limit: int | None = None, date_column: str | None = None, normalised: bool = False,
    ordered: bool = True, stored_column: str | None = None, slack_ns: int = 0, **join_options,
) -> DataFrame:
    """Records of ``[start, end)`` for the symbols, in time order, at most ``limit``.

    A missing end is the start filled forward by its resolution. Symbols other than
    instrument ids are looked up in ``intervals``, whose ``symbol`` side holds the
    input symbols (raw, parent or continuous); rows then carry that symbol. Only the
    wanted symbols' intervals take part in the join.
    """
    df = records
    for column, value in (("dataset", dataset), ("schema", schema)):
        if value is not None:
            df = df.where(F.col(column) == value)
    df = filters.time_range(df, start, end, date_column=date_column, fill_end=True, stored_column=stored_column,
                            slack_ns=slack_ns)
    df = df.drop(stored_column) if stored_column else df
    names = tx.normal_symbols(symbols, stype_in)
    if names != [tx.ALL_SYMBOLS]:
        if stype_in == "instrument_id":
            df = filters.symbols(df, symbols, stype_in)
        elif intervals is None:
            raise ValueError(f"{stype_in} symbols need an interval table")
        else:
            table = intervals if normalised else symbology.normal_intervals(intervals)
            wanted = filters.symbols(table, symbols, stype_in)
            day = times.utc_date(F.col(index_column(df.columns)))
            df = symbology.resolve(df, wanted, day, normalised=True, **join_options).where(
                F.col("symbol").isNotNull())
    if limit is not None:
        return filters.first_records(df, limit)
    return df.orderBy(*filters.time_order(df)) if ordered else df


def record_count(records: DataFrame, limit: int | None = None, **request) -> DataFrame:
    return catalog.record_count(time_series(records, ordered=False, **request), limit)


def corporate_actions(
    table: DataFrame, start, end=None, index: str = "event_date", symbols=None, stype_in: str = "raw_symbol",
    events=None, countries=None, exchanges=None, security_types=None, flatten: bool = True,
    pit: bool = False, info_keys=None, renames: bool = False,
) -> DataFrame:
    """Corporate actions of a range: every version (``pit``) or the latest of each event."""
    df = filters.reference_range(table, "corporate_actions", index, start, end)
    df = filters.reference_symbols(df, symbols, stype_in)
    df = filters.reference_filters(df, events, countries, exchanges, security_types)
    if flatten:
        df = formatting.flatten_info(df, keys=info_keys, renames=renames)
    out = pointintime.events(df, pit, index)
    return out.select(index, *[F.col(f"`{c}`") for c in out.columns if c != index])


def adjustment_factors(table: DataFrame, start, end=None, symbols=None, stype_in: str = "raw_symbol",
                       countries=None, security_types=None) -> DataFrame:
    df = filters.reference_range(table, "adjustment_factors", "ex_date", start, end)
    df = filters.reference_symbols(df, symbols, stype_in, adjustment=True)
    if countries and "listing_country" not in df.columns:
        raise ValueError("this table has no listing_country to choose countries by")
    df = filters.reference_filters(df, countries=countries, security_types=security_types)
    return df.orderBy(F.col("ex_date").asc_nulls_last(), "security_id", "event_id")


def security_master(table: DataFrame, start, end=None, index: str = "ts_effective", symbols=None,
                    stype_in: str = "raw_symbol", countries=None, security_types=None) -> DataFrame:
    df = filters.reference_range(table, "security_master", index, start, end)
    df = filters.reference_symbols(df, symbols, stype_in)
    df = filters.reference_filters(df, countries=countries, security_types=security_types)
    return df.orderBy(F.col(index).asc_nulls_last(), "listing_id")


def last_security_master(table: DataFrame, symbols=None, stype_in: str = "raw_symbol", countries=None,
                         security_types=None) -> DataFrame:
    df = filters.reference_symbols(table, symbols, stype_in)
    df = filters.reference_filters(df, countries=countries, security_types=security_types)
    return pointintime.last_master(df)
