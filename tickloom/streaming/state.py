"""Operators that keep state of their own: clocks, live symbol maps, lateness.

Rows pass through the state functions as JSON text beside the few columns they need, so
any record keeps its types, empty values included. Keys are spread over ``salts``, so one
busy instrument is the work of several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.functions import times

SALTS = 16
#: Groups that the keys of a live map are dealt to, for each salt.
BUCKETS = 256
#: An empty time: a column of numbers with gaps would turn into floats on its way.
_NONE = -(1 << 63)
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "true"}


def _packed(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns), _TIMES).alias("_row")


def _opened(df: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    return df.select(F.from_json("_row", plain, _TIMES).alias("_r"), *extra).select("_r.*", *extra)


def timeouts(stream: DataFrame, keys: Sequence[str], limit: float = 40.0, ts: str = "ts_recv") -> DataFrame:
    """One row for each key that has sent nothing for ``limit`` seconds by the clock of the
    cluster: keys, first_ts, last_ts and records of the spell that ended.

    Every batch of records sets the key's timer anew. The timer is part of the checkpoint:
    a query that starts again goes on counting, and what ran out meanwhile is reported
    first. A key that comes back begins another spell. Records without a time count, and a
    key may be null. Each task adds its rows up before they are shuffled, so a busy key is
    one row for a task and batch.
    """
    none = F.lit(_NONE).cast("bigint")
    kinds = T.StructType([stream.schema[k] for k in keys])
    rows = stream.select(F.to_json(F.struct(*keys), _TIMES).alias("_row"), F.coalesce(F.col(ts).cast("bigint"), none).alias("_ts"))

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            whole = frame.groupby("_row")["_ts"].agg(records="size")
            spans = frame[frame["_ts"] != _NONE].groupby("_row")["_ts"].agg(low="min", high="max")
            yield whole.join(spans.reindex(whole.index, fill_value=_NONE)).astype("int64").reset_index()

    def watch(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            row = [key[0], *state.get]
            state.remove()
            yield pd.DataFrame([row], columns=["_row", "first_ts", "last_ts", "records"])
            return
        first, last, n = state.getOption or (_NONE, _NONE, 0)
        for frame in frames:
            n += int(frame["records"].sum())
            known = frame[frame["low"] != _NONE]
            if len(known):
                low, high = int(known["low"].min()), int(known["high"].max())
                first, last = (low, high) if first == _NONE else (min(first, low), max(last, high))
        state.update((first, last, n))
        state.setTimeoutDuration(max(1, int(limit * 1000)))

    # a clock beside the feed, whose rows count for nothing: without one a query that starts
    # again waits for a record before it looks at its timers
    clock = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    rows = rows.unionByName(clock.select(F.lit(None).cast("string").alias("_row"), none.alias("_ts")))
    sums = rows.mapInPandas(partial, "_row string, records bigint, low bigint, high bigint")
    ended = sums.groupBy("_row").applyInPandasWithState(
        watch, "_row string, first_ts bigint, last_ts bigint, records bigint",
        "first_ts bigint, last_ts bigint, records bigint", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return _opened(ended, kinds, "first_ts", "last_ts", "records").withColumns(
        {c: F.nullif(F.col(c), none) for c in ("first_ts", "last_ts")})


def map_live(records: DataFrame, messages: DataFrame, ts: str = "ts_event", sequence: str = "sequence",
             key: str = "instrument_id", symbol: str = "stype_out_symbol", salts: int = SALTS,
             buckets: int = BUCKETS) -> DataFrame:
    """``records`` with ``symbol``, the out-symbol of the last mapping message that came
    before each record on a running stream.

    ``messages`` (key, ts, sequence, symbol) and records feed one state. Inside a batch
    both are taken in the order of ``ts`` and ``sequence``, messages first on equal ones; a
    message changes what comes after it and nothing before, in whatever batch it arrives.
    Records before the first message, and those without a key, have no symbol and are not
    held back. Keys share ``buckets``, so a batch calls Python once for each bucket and salt
    however many keys it has. Each salt of a key keeps its own copy of the symbol, so
    messages, which are few, go to every salt and records to one. All columns of
    ``records`` pass through the state, so callers select those they need.
    """
    number = F.col(key).cast("bigint")
    order = [F.pmod(F.xxhash64(number), F.lit(buckets)).cast("int").alias("_bucket"), F.coalesce(number, F.lit(0)).alias("_key"),
             F.coalesce(F.col(ts).cast("bigint"), F.lit(0)).alias("_ts"), F.coalesce(F.col(sequence).cast("bigint"), F.lit(0)).alias("_seq")]
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    told = messages.where(number.isNotNull()).select(*order, F.lit(0).alias("_kind"), F.col(symbol).cast("string").alias("_row"), spread)
    # a record without a key is of kind 2
    packed = records.select(*order, F.when(number.isNull(), 2).otherwise(1).alias("_kind"), _packed(records))
    packed = packed.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int"))
    both = told.unionByName(packed)

    def follow(_key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # the rows of one batch, bucket and salt
        rows = pd.concat(list(frames), ignore_index=True).sort_values(["_key", "_ts", "_seq", "_kind"], kind="stable")
        keys, kind, text = rows["_key"].to_numpy(), rows["_kind"].to_numpy(), rows["_row"].to_numpy(object)
        held = dict(zip(*state.get)) if state.exists else {}
        at, fresh = np.arange(len(keys)), np.append(True, keys[1:] != keys[:-1])
        begin = np.maximum.accumulate(np.where(fresh, at, 0))
        last = np.maximum.accumulate(np.where(kind == 0, at, -1))  # below ``begin`` where the key has had no message
        ends = np.flatnonzero(np.append(fresh[1:], True))
        told_now = ends[last[ends] >= begin[ends]]
        asked = np.flatnonzero(kind != 0)
        if len(asked):
            here = last[asked] >= begin[asked]
            names = np.empty(len(asked), object)
            names[here] = text[last[asked][here]]
            names[~here] = [held.get(k) for k in keys[asked[~here]].tolist()]
            names[kind[asked] == 2] = None
            yield pd.DataFrame({"_row": text[asked], "symbol": pd.array(names, "object")})
        if len(told_now):
            held.update(zip(keys[told_now].tolist(), text[last[told_now]].tolist()))
            state.update((list(held), list(held.values())))

    mapped = both.groupBy("_bucket", "_salt").applyInPandasWithState(
        follow, "_row string, symbol string", "keys array<bigint>, symbols array<string>", "append", GroupStateTimeout.NoTimeout)
    return _opened(mapped, T.StructType([f for f in records.schema.fields if f.name != "symbol"]), "symbol")


def with_lateness(stream: DataFrame, delay: str, ts: str = "ts_event", salts: int = SALTS) -> DataFrame:
    """``stream`` with ``late`` and ``watermark_ns``: whether a row is older than the
    watermark that holds in its batch, which operators with that delay would drop.

    No row is dropped here. The watermark is Spark's own, the latest event time of earlier
    batches less ``delay``, in milliseconds; the first batch has none. Rows without a time
    are not late. The state counts rows and late rows of each salt.
    """
    timed = stream.withColumn("_time", times.to_timestamp(F.col(ts))).withWatermark("_time", delay)
    packed = timed.select("_time", F.coalesce(F.floor(F.col(ts) / times.MILLI).cast("bigint"), F.lit((1 << 62))).alias("_ms"),
                          F.to_json(F.struct(*stream.columns), _TIMES).alias("_row"))
    packed = packed.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int"))

    def hold(_key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        rows, behind = state.getOption or (0, 0)
        for frame in frames:
            late = (frame["_ms"] < mark).to_numpy()
            rows, behind = rows + len(late), behind + int(late.sum())
            yield pd.DataFrame({"_row": frame["_row"], "late": late, "watermark_ns": np.full(len(late), mark * times.MILLI)})
        state.update((rows, behind))

    told = packed.groupBy("_salt").applyInPandasWithState(
        hold, "_row string, late boolean, watermark_ns bigint", "records bigint, late bigint", "append", GroupStateTimeout.NoTimeout)
    return _opened(told, stream.schema, "late", "watermark_ns")


def run_until_silent(query, seconds: float = 600.0, pause: float = 0.2) -> None:
    """Waits until a query of ``timeouts`` has read something and holds no key any more,
    then stops it. An error of the query is raised."""
    import time

    until, read = time.monotonic() + seconds, False
    try:
        while time.monotonic() < until:
            if query.exception() is not None:
                raise query.exception()
            for p in query.recentProgress:
                read = read or any(x["numInputRows"] > 0 and not x["description"].startswith("RateStream") for x in p["sources"])
            last = query.lastProgress
            if read and last and last["stateOperators"] and last["stateOperators"][0]["numRowsTotal"] == 0:
                return
            time.sleep(pause)
        raise TimeoutError(f"keys are still active after {seconds} seconds")
    finally:
        query.stop()
