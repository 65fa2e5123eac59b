"""Columns of a record table in the form a reader wants them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import prices, times
from tickloom.operators import symbology
from tickloom.schemas import HEADER_FIELDS, LEVEL_FIELDS, Layout, index_column


def price_columns(df: DataFrame) -> list[str]:
    """Columns that hold fixed-point prices by name."""
    plain = {"price", "open", "high", "low", "close", "strike_price"}
    return [c for c in df.columns if c in plain or c.startswith(("bid_px_", "ask_px_"))]


def time_columns(df: DataFrame) -> list[str]:
    return [c for c in ("ts_recv", "ts_event", "ts_out") if c in df.columns]


def nulls_for(df: DataFrame, sentinels: Mapping[str, int]) -> DataFrame:
    """Type maxima that stand for "no value" become NULL."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in sentinels.items() if c in df.columns})


def decode_chars(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed-width text: bytes to UTF-8 with the NUL padding cut off."""
    kinds = dict(df.dtypes)
    out = {}
    for c in columns:
        if c in kinds:
            text = F.decode(F.col(c), "UTF-8") if kinds[c] == "binary" else F.col(c)
            out[c] = F.regexp_replace(text, "\\x00+$", "")
    return df.withColumns(out)


def table(
    df: DataFrame, layout: Layout | None = None, price_type: str = "float", pretty_ts: bool = True,
    tz: str | None = None, intervals: DataFrame | None = None, keep_ns: bool = False,
    columns: Sequence[str] | None = None, **join_options,
) -> DataFrame:
    """The record table with the index time first and the symbol last.

    Steps run in a fixed order: null markers, text, times, symbols, zone, prices.
    Symbols are resolved on the UTC date, before any zone conversion.
    """
    if tz is not None and tz.upper() != "UTC" and not pretty_ts:
        raise ValueError("a time zone needs pretty_ts=True")
    listed = list(columns or (layout.columns if layout else df.columns))
    index = index_column(listed)
    ordered = [index, *[c for c in listed if c != index]]
    px = layout.prices if layout else price_columns(df)
    ts = [c for c in (layout.times if layout else time_columns(df)) if c in listed]
    if layout:
        df = decode_chars(nulls_for(df, layout.sentinels), layout.chars)
    if intervals is not None:
        df = symbology.add_symbol(df, intervals, **join_options)
        ordered = [c for c in ordered if c != "symbol"] + ["symbol"]

    def shown(name: str) -> list[Column]:
        col = F.col(name)
        if name in ts and pretty_ts:
            stamp = times.to_timestamp(col)
            if tz is not None:
                stamp = F.from_utc_timestamp(stamp, tz)
            return [stamp.alias(name), *([col.alias(f"{name}_ns")] if keep_ns else [])]
        if name in px:
            return [prices.convert(col, price_type).alias(name)]
        return [col]

    return df.select(*[c for name in ordered for c in shown(name)])


def nest_levels(df: DataFrame, count: int) -> DataFrame:
    """``bid_px_00 ..`` columns to a ``levels`` array."""
    parts = [F.struct(*[F.col(f"{f}_{i:02d}").alias(f) for f in LEVEL_FIELDS]) for i in range(count)]
    flat = {f"{f}_{i:02d}" for i in range(count) for f in LEVEL_FIELDS}
    return df.select(*[c for c in df.columns if c not in flat], F.array(*parts).alias("levels"))


def flatten_levels(df: DataFrame, count: int) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c != "levels"],
        *[F.get("levels", F.lit(i))[f].alias(f"{f}_{i:02d}") for i in range(count) for f in LEVEL_FIELDS])


def nest_header(df: DataFrame) -> DataFrame:
    """Common header fields to ``hd``, placed after ``ts_recv``."""
    rest = [c for c in df.columns if c not in HEADER_FIELDS and c != "ts_recv"]
    lead = ["ts_recv"] if "ts_recv" in df.columns else []
    return df.select(*lead, F.struct(*HEADER_FIELDS).alias("hd"), *rest)


def flatten_header(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in ("hd", "ts_recv")]
    lead = ["ts_recv"] if "ts_recv" in df.columns else []
    return df.select(*lead, *[F.col(f"hd.{f}").alias(f) for f in HEADER_FIELDS], *rest)


def dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to dates (UTC) for the listed columns that exist; bad text gives NULL."""
    return df.withColumns({c: times.date_or_null(F.col(c).cast("string")) for c in columns if c in df.columns})


def datetimes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: times.timestamp_or_null(F.col(c).cast("string")) for c in columns
                           if c in df.columns})


# Old and new names of info fields.
INFO_RENAMES = {
    "decl_currency": "declared_currency",
    "decl_gross_amount": "declared_gross_amount",
    "f_x_rate": "fx_rate",
    "iss_new_name": "issuer_new_name",
    "iss_old_name": "issuer_old_name",
    "new_bbg_company_id": "new_bbg_comp_id",
    "new_bbg_company_tk": "new_bbg_comp_ticker",
    "new_bbg_exh_id": "new_figi",
    "new_bbg_exh_tk": "new_figi_ticker",
    "new_min_tra_qty": "new_min_trading_qty",
    "new_mktsg_id": "new_market_segment_id",
    "new_reg_s144_a": "new_reg_s144a",
    "new_unit_sec_id": "new_unit_security_id",
    "offeree_iss_id": "offeree_issuer_id",
    "offeror_iss_id": "offeror_issuer_id",
    "old_bbg_company_id": "old_bbg_comp_id",
    "old_bbg_company_tk": "old_bbg_comp_ticker",
    "old_bbg_exh_id": "old_figi",
    "old_bbg_exh_tk": "old_figi_ticker",
    "old_min_tra_qty": "old_min_trading_qty",
    "old_mktsg_id": "old_market_segment_id",
    "old_reg_s144_a": "old_reg_s144a",
    "old_unit_sec_id": "old_unit_security_id",
    "pp_sec_id": "pp_security_id",
    "poolfactor": "pool_factor",
    "pre_offer_q_ty": "pre_offer_qty",
    "qual_st_cap_gains": "qual_short_term_cap_gains",
    "redem_percentage": "redemption_percentage",
    "st_cap_gains": "short_term_cap_gains",
    "sec_new_name": "security_new_name",
    "sec_old_name": "security_old_name",
    "section199_a_foreign_tax_paid": "section199a_foreign_tax_paid",
    "section199_a_inc_div": "section199a_inc_div",
    "section199_a_st_cap_gain": "section199a_short_term_cap_gain",
    "tra_isin": "trading_isin",
    "tra_sec_id": "trading_security_id",
    "us_deposit_receiptateto_currency": "usd_rate_to_currency",
    "cashbak": "cash_back",
    "companyulsory_acq_date": "compulsory_acq_date",
    "frankdiv": "franked_div",
    "lead_plntiff_deadline_date": "lead_plaintiff_deadline_date",
    "maxprice": "max_price",
    "minprice": "min_price",
    "redem_premium": "redemption_premium",
    "redem_price": "redemption_price",
    "unit_frankdiv": "unfranked_div",
}

INFO_COLUMNS = ("date_info", "rate_info", "event_info")
_MAP = "map<string,string>"


def _object(text: Column) -> Column:
    """A JSON object with members as a map, else NULL."""
    inner = F.when(text.startswith("{"), F.from_json(text, _MAP))
    return F.when(F.size(inner) > 0, inner)


def _opened(info: Column) -> Column:
    """Members that are objects give way to their own members, with dotted names. Text
    that only looks like an object stays; of equal names the last one is kept."""
    def members(e: Column) -> Column:
        inner = _object(e["value"])
        sub = F.transform(F.map_entries(inner), lambda x: F.struct(
            F.concat(e["key"], F.lit("."), x["key"]).alias("key"), x["value"].alias("value")))
        return F.when(inner.isNotNull(), sub).otherwise(F.array(e))

    entries = F.flatten(F.transform(F.map_entries(info), members))
    names = F.transform(entries, lambda e: e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: ~F.array_contains(
        F.slice(names, i + 2, F.size(names)), e["key"])))


def info_map(info: Column, kind: str = "string") -> Column:
    """An info object (JSON text or map) as a map of its own members."""
    return F.from_json(info, _MAP) if kind == "string" else info


def open_objects(df: DataFrame, columns: Sequence[str], depth: int | None = None) -> DataFrame:
    """Maps without members that are objects, ``depth`` levels down or, by looking at
    each level, as far as there are any. One step is one projection."""
    while columns and depth != 0:
        if depth is None:
            nested = [F.max(F.exists(F.map_values(c), lambda v: _object(v).isNotNull())).alias(f"n{i}")
                      for i, c in enumerate(columns)]
            if not any(df.agg(*nested).first()):
                break
        else:
            depth -= 1
        df = df.withColumns({c: _opened(F.col(c)) for c in columns})
    return df


def rename_keys(info: Column) -> Column:
    """Old field names to new ones; where both are present the new one is kept."""
    names = F.create_map(*[F.lit(x) for pair in INFO_RENAMES.items() for x in pair])
    old = F.array_intersect(F.map_keys(info), F.map_keys(names))
    both = F.array_intersect(F.map_keys(info), F.transform(old, lambda k: F.try_element_at(names, k)))
    kept = F.map_filter(info, lambda k, _: ~F.coalesce(
        F.array_contains(both, F.try_element_at(names, k)), F.lit(False)))
    return F.transform_keys(kept, lambda k, _: F.coalesce(F.try_element_at(names, k), k))


def info_keys(df: DataFrame, columns: Sequence[str] = INFO_COLUMNS) -> dict[str, list[str]]:
    """Field names present per info column: each becomes a column of the result."""
    def named(c: str) -> Column:
        return F.transform(F.map_keys(c), lambda k: F.struct(F.lit(c).alias("c"), k.alias("k")))

    entries = F.array(*[named(c) for c in columns])
    found = df.select(F.explode(F.flatten(entries)).alias("e")).select("e.*")
    names = found.groupBy("c").agg(F.sort_array(F.collect_set("k")).alias("k")).collect()
    return {c: [] for c in columns} | {r["c"]: list(r["k"]) for r in names}


def flatten_info(df: DataFrame, columns: Sequence[str] = INFO_COLUMNS,
                 keys: Mapping[str, Sequence[str]] | None = None, renames: bool = False) -> DataFrame:
    """Info objects to columns on the same row; the objects are dropped.

    A field name that meets another column or info object gets the info object's
    name as a suffix. Passing ``keys`` saves the pass that finds them.
    """
    kinds = dict(df.dtypes)
    present = [c for c in columns if c in kinds]
    df = df.withColumns({c: info_map(F.col(c), "string" if kinds[c] == "string" else "map") for c in present})
    df = open_objects(df, present, max((k.count(".") for names in keys.values() for k in names), default=0) if keys else None)
    if renames:
        df = df.withColumns({c: rename_keys(F.col(c)) for c in present})
    names = {c: list(k) for c, k in (keys or info_keys(df, present)).items()}
    rest = [c for c in df.columns if c not in present]
    spread = [k for c in present for k in names.get(c, [])]
    out = [F.col(f"`{c}`") for c in rest]
    for c in present:
        for k in names.get(c, []):
            label = f"{k}_{c}" if k in rest or spread.count(k) > 1 else k
            out.append(F.try_element_at(F.col(c), F.lit(k)).alias(label))
    return df.select(*out)
