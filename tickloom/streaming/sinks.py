"""Where a stream goes: folders, callbacks, several at once."""

from __future__ import annotations

import logging
import warnings
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import quality
from tickloom.session import shared_dir
from tickloom.sinks.files import path_exists

log = logging.getLogger(__name__)
# Fixed value: warnings shown per callback before they stop.
MAX_WARNINGS = 10


def to_folder(stream: DataFrame, path: str, checkpoint: str | None = None, fmt: str = "parquet",
              mode: str = "append", once: bool = True, name: str | None = None) -> StreamingQuery:
    """Append to a folder. Each sink is its own query with its own checkpoint, so one
    that fails leaves the others running and a restart goes on where it stopped."""
    writer = (stream.writeStream.format(fmt).outputMode(mode).option("path", path)
              .option("checkpointLocation", checkpoint or shared_dir(stream.sparkSession, "stream")))
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if once else writer).start()


def fan_out(stream: DataFrame, paths: list[str], **options) -> list[StreamingQuery]:
    return [to_folder(stream, p, **options) for p in paths]


def fan_out_once(stream: DataFrame, sinks: Mapping[str, str | Callable[[DataFrame, int], None]], checkpoint: str,
                 log_path: str | None = None, once: bool = True) -> StreamingQuery:
    """Several sinks of one query, which reads its source once.

    A sink is a folder for Parquet, or a function of a batch and its number that may be
    run again for a batch it failed on. A folder gets a subfolder ``batch=<number>`` for each batch. What
    is done is kept in a log by sink and batch: a folder's own success mark, and one mark
    below ``log_path`` for functions. If a sink fails, the others take the batch all the
    same, and then the query ends with the error; started again with its ``checkpoint`` it
    replays that batch, only for the sinks that have not finished it.
    """
    spark = stream.sparkSession
    marks = log_path or f"{checkpoint.rstrip('/')}-sinks"

    def done(name: str, target, number: int) -> str:
        folder = f"{target.rstrip('/')}/batch={number}" if isinstance(target, str) else f"{marks.rstrip('/')}/{name}/batch={number}"
        return f"{folder}/_SUCCESS"

    def deliver(batch: DataFrame, number: int) -> None:
        waiting = {n: t for n, t in sinks.items() if not path_exists(spark, done(n, t, number))}
        if not waiting:
            return
        batch.persist()
        failed = {}
        try:
            for name, target in waiting.items():
                try:
                    if isinstance(target, str):
                        batch.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")
                    else:
                        target(batch, number)
                        batch.limit(0).select(F.lit(name).alias("sink")).write.mode("overwrite").parquet(done(name, target, number).rsplit("/", 1)[0])
                except Exception as err:  # noqa: BLE001 - one failed sink must not hold up the others
                    log.error("sink %s failed on batch %s", name, number, exc_info=err)
                    failed[name] = err
        finally:
            batch.unpersist()
        if failed:
            raise RuntimeError(f"batch {number}: sinks failed: {sorted(failed)}") from next(iter(failed.values()))

    writer = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def await_all(queries: list[StreamingQuery]) -> dict[str, Exception]:
    """Wait for every query; failures are returned by query id."""
    failed = {}
    for q in queries:
        try:
            q.awaitTermination()
        except Exception as err:  # noqa: BLE001 - one failed sink must not hide the others
            failed[str(q.id)] = err
    return failed


class Callback:
    """A user function per micro-batch. An error goes to ``on_error`` or becomes a
    warning (at most ten), and the stream goes on."""

    def __init__(self, function: Callable[[DataFrame, int], None],
                 on_error: Callable[[Exception], None] | None = None):
        self.function = function
        self.on_error = on_error
        self.warned = 0

    def __call__(self, batch: DataFrame, number: int) -> None:
        try:
            self.function(batch, number)
        except Exception as err:  # noqa: BLE001 - user code
            log.error("callback failed on batch %s", number, exc_info=err)
            if self.on_error is not None:
                self.on_error(err)
                return
            if self.warned < MAX_WARNINGS:
                self.warned += 1
                last = ", further ones are not shown" if self.warned == MAX_WARNINGS else ""
                warnings.warn(f"callback raised {err!r}{last}", stacklevel=2)


class PerRecord:
    """A user function per record, run inside the tasks (``foreach``). The error text
    of a failed record goes to the executor log; the other records go on."""

    def __init__(self, function: Callable):
        self.function = function

    def process(self, row) -> None:
        try:
            self.function(row)
        except Exception:
            log.exception("record callback failed")


def to_callback(stream: DataFrame, function, on_error=None, checkpoint: str | None = None,
                once: bool = True, mode: str = "append") -> StreamingQuery:
    writer = (stream.writeStream.outputMode(mode).foreachBatch(Callback(function, on_error))
              .option("checkpointLocation", checkpoint or shared_dir(stream.sparkSession, "stream")))
    return (writer.trigger(availableNow=True) if once else writer).start()


def to_records(stream: DataFrame, function, checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
    writer = (stream.writeStream.foreach(PerRecord(function))
              .option("checkpointLocation", checkpoint or shared_dir(stream.sparkSession, "stream")))
    return (writer.trigger(availableNow=True) if once else writer).start()


def watch_lag(stream: DataFrame, on_full: Callable | None = None, ts: str = "ts_recv",
              checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
    """Report micro-batches that count as full (see ``quality.lag_flag``), one summary
    row each. Nothing is skipped: a slow reader is warned and catches up."""
    def look(batch: DataFrame, number: int) -> None:
        row = quality.lag_flag(batch, ts=ts).first()
        if row["is_full"]:
            if on_full is not None:
                on_full(number, row)
            else:
                warnings.warn(f"batch {number} lags: {row['records']} records", stacklevel=2)

    return to_callback(stream.select(ts), look, checkpoint=checkpoint, once=once)


def report_gaps(gaps: DataFrame, function: Callable, on_error=None) -> None:
    """``function(gap_start, gap_end)`` for every reconnect gap, one row at a time."""
    for row in gaps.orderBy("gap_start").toLocalIterator():
        try:
            function(row["gap_start"], row["gap_end"])
        except Exception as err:  # noqa: BLE001 - user code
            log.error("gap callback failed", exc_info=err)
            if on_error is not None:
                on_error(err)


def drain(spark: SparkSession, stream: DataFrame, mode: str = "append", purpose: str = "drained") -> DataFrame:
    """Run a stream over all available input into a new shared folder and read it back."""
    path = shared_dir(spark, purpose)
    if mode == "append":
        to_folder(stream, path).awaitTermination()
    else:
        schema = stream.schema

        def replace(batch: DataFrame, _number: int) -> None:
            batch.write.mode("overwrite").parquet(path)

        (stream.writeStream.outputMode(mode).foreachBatch(replace)
         .option("checkpointLocation", shared_dir(spark, "stream"))
         .trigger(availableNow=True).start().awaitTermination())
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(stream.schema).parquet(path)
