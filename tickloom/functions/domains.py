"""Enumerated domains, member name to value."""

# The members each domain accepts.
FEED_MODE = {"HISTORICAL": "historical", "HISTORICAL_STREAMING": "historical-streaming", "LIVE": "live"}
SPLIT_DURATION = {"DAY": "day", "WEEK": "week", "MONTH": "month", "YEAR": "year", "NONE": "none"}
PACKAGING = {"NONE": "none", "ZIP": "zip", "TAR": "tar"}
DELIVERY = {"DOWNLOAD": "download"}
ROLL_RULE = {"VOLUME": "volume", "OPEN_INTEREST": "open_interest", "CALENDAR": "calendar"}
RESOLUTION = {"OK": "ok", "PARTIAL": "partial", "NOT_FOUND": "not_found"}
RECONNECT = {"NONE": "none", "RECONNECT": "reconnect"}
PRICE_TYPE = {"FIXED": "fixed", "FLOAT": "float", "DECIMAL": "decimal"}
JOB_STATE = {"QUEUED": "queued", "PROCESSING": "processing", "DONE": "done", "EXPIRED": "expired"}
SLOW_READER = {"SKIP": "skip", "WARN": "warn"}
SCHEMA = {
    "MBO": "mbo", "MBP_1": "mbp-1", "MBP_10": "mbp-10", "TBBO": "tbbo", "TRADES": "trades",
    "OHLCV_1S": "ohlcv-1s", "OHLCV_1M": "ohlcv-1m", "OHLCV_1H": "ohlcv-1h", "OHLCV_1D": "ohlcv-1d",
    "OHLCV_EOD": "ohlcv-eod", "DEFINITION": "definition", "STATISTICS": "statistics",
    "STATUS": "status", "IMBALANCE": "imbalance", "CMBP_1": "cmbp-1", "CBBO_1S": "cbbo-1s",
    "CBBO_1M": "cbbo-1m", "TCBBO": "tcbbo", "BBO_1S": "bbo-1s", "BBO_1M": "bbo-1m",
}


def member(value, domain: dict[str, str], what: str) -> str:
    """Driver-side form of :func:`tickloom.functions.text.coerce` for parameters."""
    if value is None:
        raise ValueError(f"{what} must be given")
    low = str(value).lower()
    if low in domain.values():
        return low
    name = str(value).translate(str.maketrans(".-", "__")).upper()
    if name not in domain:
        raise ValueError(f"{what} {value!r} is none of {list(domain.values())}")
    return domain[name]
