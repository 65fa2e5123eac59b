"""Record layouts.

A layout is a Spark schema plus the roles of its columns. Layouts whose columns
are not generally known (definitions, statistics, status, imbalance, sampled and
consolidated quotes) are registered by the user with :func:`register`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tickloom.functions.domains import SCHEMA, member


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "decimal(20,0)": T.DecimalType(20, 0),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def struct(text: str) -> T.StructType:
    """``name type, name type`` to a schema, also where no session is running yet."""
    pairs = (part.split() for part in text.replace("\n", " ").split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Layout:
    name: str
    struct: T.StructType
    prices: tuple[str, ...] = ()
    times: tuple[str, ...] = ()
    chars: tuple[str, ...] = ()
    levels: int = 0
    rtype: int | None = None
    sentinels: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.struct.fieldNames()

    @property
    def index(self) -> str:
        return index_column(self.columns)


def index_column(columns) -> str:
    """The time a record is ordered and selected by."""
    for name in ("ts_recv", "ts_event"):
        if name in columns:
            return name
    raise ValueError("a record needs ts_recv or ts_event")


# Column order and types of the known layouts.
_HEAD = "ts_event bigint, rtype int, publisher_id int, instrument_id bigint"
_TRADE = f"ts_recv bigint, {_HEAD}, action string, side string"
_MBO = (f"{_TRADE}, price bigint, size bigint, channel_id int, order_id decimal(20,0), "
        "flags int, ts_in_delta int, sequence bigint")
_MBP = f"{_TRADE}, depth int, price bigint, size bigint, flags int, ts_in_delta int, sequence bigint"
_BAR = f"{_HEAD}, open bigint, high bigint, low bigint, close bigint, volume bigint"
LEVEL_FIELDS = ("bid_px", "ask_px", "bid_sz", "ask_sz", "bid_ct", "ask_ct")
HEADER_FIELDS = ("ts_event", "rtype", "publisher_id", "instrument_id")


def _levels(count: int) -> str:
    return "".join(f", {f}_{i:02d} bigint" for i in range(count) for f in LEVEL_FIELDS)


def _book(name: str, count: int, rtype: int | None = None) -> Layout:
    prices = ("price", *(f"{p}_{i:02d}" for i in range(count) for p in ("bid_px", "ask_px")))
    columns = struct(_MBP + _levels(count))
    return Layout(name, columns, prices, ("ts_recv", "ts_event"), ("action", "side"), count, rtype)


_REGISTRY: dict[str, Layout] = {}


def register(layout: Layout) -> Layout:
    _REGISTRY[member(layout.name, SCHEMA, "schema")] = layout
    return layout


register(Layout("mbo", struct(_MBO), ("price",), ("ts_recv", "ts_event"),
                ("action", "side"), 0, 160))
register(_book("mbp-1", 1, 1))
register(_book("mbp-10", 10, 10))
register(_book("tbbo", 1, 1))
register(_book("trades", 0, 0))
# Record types of bars.
for _width, _rtype in {"1s": 32, "1m": 33, "1h": 34, "1d": 35, "eod": 36}.items():
    register(Layout(f"ohlcv-{_width}", struct(_BAR), ("open", "high", "low", "close"),
                    ("ts_event",), rtype=_rtype))


def layout(name: str) -> Layout:
    key = member(name, SCHEMA, "schema")
    if key not in _REGISTRY:
        raise ValueError(f"no layout for {key}; describe it with tickloom.schemas.register")
    return _REGISTRY[key]


def known_layouts() -> list[Layout]:
    return list(_REGISTRY.values())
