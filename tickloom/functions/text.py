"""Symbols, lists and enumerated text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL_SYMBOLS = "ALL_SYMBOLS"
SMART_STYPES = ("parent", "continuous")


def strip(text: Column) -> Column:
    """Drop white space of every kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def strip_commas(text: Column) -> Column:
    return F.regexp_replace(text, r"^,+|,+$", "")


def split_list(text: Column) -> Column:
    """Comma list to array; items keep their inner blanks."""
    return F.split(strip_commas(strip(text)), ",")


def values_text(values: Column, is_array: bool = False) -> Column:
    """Request form of a value list: lower case, comma joined."""
    if is_array:
        return F.lower(strip(F.array_join(values, ",")))
    return F.lower(F.regexp_replace(strip(values), r",+$", ""))


def smart_symbol(text: Column, strict: bool = False) -> Column:
    """``root``, ``root.class`` or ``root.rule.rank``; other forms give NULL, or
    an error when ``strict``."""
    parts = F.split(F.upper(text), r"\.")
    good = (F.size(parts) <= 3) & ~F.exists(parts, lambda p: p == "")
    fixed = F.when(
        F.size(parts) == 3,
        F.concat_ws(".", parts[0], F.lower(parts[1]), F.get(parts, F.lit(2))),
    ).otherwise(F.array_join(parts, "."))
    bad = F.raise_error(F.concat(F.lit("not a smart symbol: "), text)) if strict else F.lit(None)
    return F.when(good, fixed).when(text.isNotNull(), bad.cast("string"))


def symbol_list(text: Column, stype: str = "raw_symbol") -> Column:
    """Comma text to an array of normal symbols. Empty text gives NULL."""
    items = split_list(text)
    if stype in SMART_STYPES:
        done = F.transform(items, lambda s: strip(smart_symbol(s)))
    else:
        done = F.transform(items, lambda s: F.upper(strip(s)))
    return F.when(text != "", done)


def is_semantic(text: Column) -> Column:
    """Not empty, not only blanks, and printable throughout."""
    unprintable = text.rlike(r"[\p{C}\p{Zl}\p{Zp}]|[\p{Zs}&&[^ ]]")
    return (text != "") & ~text.rlike(r"^\s*$") & ~unprintable


def mapping_symbol(symbol_in: Column, symbol_out: Column) -> Column:
    """An all-digit out-symbol is only an id, so the in-symbol names it."""
    return F.when(symbol_out.rlike(r"^[0-9]+$"), symbol_in).otherwise(symbol_out)


def coerce(text: Column, domain: Mapping[str, object], strict: bool = False) -> Column:
    """Match a value in lower case, else a member name (``.``/``-`` as ``_``).

    ``domain`` maps member names in upper case to values.
    """
    kind = "int" if all(isinstance(v, int) for v in domain.values()) else "string"
    name = F.upper(F.regexp_replace(text, r"[.\-]", "_"))
    if kind == "int":
        number = text.try_cast("int")
        out = F.when(number.isin([int(v) for v in domain.values()]), number)
    else:
        low = F.lower(text)
        out = F.when(low.isin([str(v) for v in domain.values()]), low)
    for key, value in domain.items():
        out = out.when(name == key, F.lit(value))
    if strict:
        out = out.otherwise(F.raise_error(F.concat(F.lit("not in the domain: "),
                                                   F.coalesce(text, F.lit("null")))).cast(kind))
    return out


def chunks(items: Column, size: int) -> Column:
    """Consecutive slices of at most ``size`` items with the last one marked."""
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    count = F.ceil(F.size(items) / F.lit(size)).cast("int")
    return F.when(F.size(items) > 0, F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(
            i.alias("chunk"),
            F.slice(items, i * size + 1, F.lit(size)).alias("items"),
            (i == count - 1).alias("is_last"),
        ),
    )).otherwise(F.array().cast("array<struct<chunk:int,items:array<string>,is_last:boolean>>"))


def normal_symbols(symbols, stype: str = "raw_symbol") -> list[str]:
    """The symbol list of a request, from text, a number or nested lists."""
    if symbols is None:
        return [ALL_SYMBOLS]
    return list(_walk(symbols, stype))


def _walk(item, stype: str):
    if isinstance(item, str):
        if item == "":
            raise ValueError(f"an empty symbol is not allowed for {stype}")
        for piece in item.strip().strip(",").split(","):
            yield _smart(piece).strip() if stype in SMART_STYPES else piece.strip().upper()
    elif isinstance(item, bool) or item is None:
        raise TypeError(f"{item!r} is not a symbol")
    elif hasattr(item, "__index__"):
        if stype != "instrument_id":
            raise ValueError(f"the number {item} is only a symbol for instrument_id")
        yield str(int(item))
    elif isinstance(item, Iterable):
        for part in item:
            yield from _walk(part, stype)
    else:
        raise TypeError(f"{item!r} is not a symbol")


def _smart(piece: str) -> str:
    root, *rest = piece.upper().split(".")
    if len(rest) > 2 or "" in (root, *rest):
        raise ValueError(f"{piece!r} is not ROOT, ROOT.CLASS or ROOT.RULE.RANK")
    return f"{root}.{rest[0].lower()}.{rest[1]}" if len(rest) == 2 else ".".join([root, *rest])
