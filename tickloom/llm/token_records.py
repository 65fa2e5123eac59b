"""Token ids as length-delimited binary records.

A file holds one record after another::

    length of the payload   8 bytes
    masked checksum of the length   4 bytes
    payload: 1 byte (1: the id is null), doc_id 8 bytes, bytes of one token id (2 or 4), the ids
    masked checksum of the payload   4 bytes

All numbers are little-endian. A checksum is CRC-32, turned right by 15 bits plus a
constant, so that a checksum of bytes that hold checksums stays meaningful. Files are
numbered in the order of doc_id, and so are the records inside. A separate index table
gives file, offset and length of every record, for reads in any order.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import blocks, buckets_for, open_store, shared_dir, stored
from tickloom.llm.words import encoder_for

#: Fixed value of the mask, as in other record files of this kind.
MASK_DELTA = 0xA282EAD8
INDEX = "part int, file string, doc_id long, offset long, length long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    return struct.pack("<BqB", doc_id is None, doc_id or 0, ids.itemsize) + ids.tobytes()


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    null, doc_id, width = struct.unpack_from("<BqB", payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=10)


def records(stream) -> Iterator[bytes]:
    """Payloads of an open file; a wrong checksum or a short record is an error."""
    while head := stream.read(12):
        if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
            raise ValueError("damaged record length")
        size = struct.unpack("<Q", head[:8])[0]
        body = stream.read(size + 4)
        if len(body) < size + 4 or masked(body[:size]) != struct.unpack("<I", body[size:])[0]:
            raise ValueError("damaged record")
        yield body[:size]


def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1) -> DataFrame:
    """Encodes the texts of ``docs`` (doc_id, text) into files below ``folder`` and
    returns the stored index (part, file, doc_id, offset, length, n_tokens).

    A null text is an empty one, which leaves the end id alone; a null ``doc_id`` comes
    first; rows with one ``doc_id`` lie next to each other. Every attempt of a task
    writes a file of its own name, and only files named in the index count, so a lost
    executor leaves no half file that is read.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    placed = rows.repartitionByRange(buckets_for(spark), "doc_id", "_row").sortWithinPartitions("doc_id", "_row")

    def write(batches):
        encode, part = encoder_for(tokenizer), TaskContext.get().partitionId()
        store, root = open_store(folder)
        name, offset, stream = f"part-{part:06d}-{uuid.uuid4().hex}.rec", 0, None
        try:
            for batch, texts in blocks(batches):
                index = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                    ids = encode(text or "", end_id)
                    data = frame(payload_of(doc_id, ids))
                    if stream is None:
                        store.create_dir(root, recursive=True)
                        stream = store.open_output_stream(f"{root}/{name}")
                    stream.write(data)
                    index.append((part, name, doc_id, offset, len(data), len(ids)))
                    offset += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*index), (pa.int32(), pa.string(), *[pa.int64()] * 4))],
                    ["part", "file", "doc_id", "offset", "length", "n_tokens"])
        finally:
            if stream is not None:
                stream.close()

    return stored(placed.mapInArrow(write, INDEX), "record-index")


def read_records(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Reads all files of ``index`` from front to back: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of the ids as unsigned 32-bit numbers).

    Where a file starts is known from the index, so what is read goes straight on to the
    caller. A file that holds other numbers of records or ids than its index is an error.
    """

    def scan(batches):
        store, root = open_store(folder)
        for batch in batches:
            for name, base, n, tokens in zip(*(batch.column(c).to_pylist() for c in ("file", "base", "n", "tokens"))):
                rows, start = [], base
                with store.open_input_stream(f"{root}/{name}") as stream:
                    for payload in records(stream):
                        doc_id, ids = parse(payload)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                if (len(rows), start - base) != (n, tokens):
                    raise ValueError(f"{name} differs from its index")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = index.groupBy("part", "file").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))).select("file", "base", "n", "tokens")
    return placed.repartition(buckets_for(spark)).mapInArrow(scan, READ)


def read_at(folder: str, index: DataFrame) -> DataFrame:
    """The records that rows of ``index`` name, in any order: doc_id and ids."""

    def fetch(batches):
        store, root = open_store(folder)
        for batch in batches:
            out = []
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                with store.open_input_file(f"{root}/{name}") as stream:
                    data = stream.read_at(length, offset)
                out.append(parse(next(records(pa.BufferReader(data)))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in out], pa.int64()), pa.array([i.tolist() for _, i in out], pa.list_(pa.int64()))],
                ["doc_id", "ids"])

    return index.select("file", "offset", "length").mapInArrow(fetch, "doc_id long, ids array<long>")


def record_digest(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` and reads them back."""
    folder = folder or shared_dir(docs.sparkSession, "records")
    return read_records(docs.sparkSession, folder, write_records(docs, tokenizer, folder, end_id))
