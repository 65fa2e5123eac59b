"""Removing passages that occur elsewhere, by level-wise doubling.

A window of ``length`` words can repeat only if every shorter window inside repeats. So
windows of a short length are tested first, and only what repeats there is tested at
twice that length, and so on up to ``length``. At each level a candidate is tested by
the one window inside that has the smallest hash: equal candidates choose equal windows
at equal places, so none is lost, and neighbours share one choice, so a level moves a
small part of its windows. The last level tests the candidates themselves.

Copies of a whole text count at the first level and then leave: a text with two or more
copies loses every window, and one copy stays to be found by others. Only documents that
hold a candidate are carried past the first level. They are written once, bucketed by
row, and every later level moves hashes to them instead of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import blocks, buckets_for, shared_dir, stored

#: Length of the first level in words.
FIRST = 8
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd; spreads sums of word hashes
_DIGEST = xxhash.xxh64_intdigest
GRAMS = "row long, hash long, pos int"
#: The first pass also lists the documents, with ``pos`` -1 and a digest of their words.
LISTED = f"{GRAMS}, doc_id long, n_words long, digest binary, sha string"
CUT = "row long, n_removed long, kept string, sha string"


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_DIGEST, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` words, built by doubling."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total, done, power, size, factor = None, 0, words, 1, _MULTIPLIER
        while True:
            if length & size:
                part = power[done:][: len(words) - length + 1]
                total = part if total is None else total * factor + part
                done += size
            if 2 * size > length:
                break
            power = power[:-size] * factor + power[size:]
            size, factor = 2 * size, factor * factor
        mixed = total ^ (total >> np.uint64(29))
        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def chosen(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes the place of the smallest, the first of equals."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low, at, size = hashes, np.arange(len(hashes)), 1

    def lower(shift: int):
        a, b = low[: len(low) - shift], low[shift:]
        right = b < a
        return np.where(right, b, a), np.where(right, at[shift:], at[: len(at) - shift])

    while 2 * size <= width:
        low, at = lower(size)
        size *= 2
    if width > size:
        low, at = lower(width - size)
    return at[:n]


def levels(length: int) -> list[int]:
    found = [min(FIRST, length)]
    while found[-1] < length:
        found.append(min(2 * found[-1], length))
    return found


def repeated(grams: DataFrame) -> DataFrame:
    """The rows of the stored ``grams`` (row, hash, pos) whose hash occurs at least twice.

    The hashes are counted first and stored, so that the join only deals out two tables
    and a hash that is everywhere can be split.
    """
    often = grams.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    return grams.join(stored(often, "repeated"), "hash", "left_semi")


def by_row(grams: DataFrame) -> DataFrame:
    """One sorted array of places per document; a document bounds it."""
    return grams.groupBy("row").agg(F.sort_array(F.collect_list("pos")).alias("places"))


def _first_pass(length: int, size: int):
    def work(batches: Iterator[pa.RecordBatch]):
        for batch, texts in blocks(batches):
            rows, pos, hashes, listed = [], [], [], []
            for row, text in zip(batch.column("row").to_pylist(), texts):
                words = (text or "").encode().split()  # parts at ASCII white space only
                whole = b" ".join(words)
                listed.append((len(words), xxhash.xxh3_128_digest(whole), hashlib.sha256(whole).hexdigest()))
                if len(words) >= length:
                    found = window_hashes(word_hashes(words), size)
                    at = np.unique(chosen(found, length - size + 1))
                    rows.append(np.full(len(at), row))
                    pos.append(at.astype(np.int32))
                    hashes.append(found[at])
            if rows:
                grams = [pa.array(np.concatenate(rows), pa.int64()), pa.array(np.concatenate(hashes).view(np.int64)),
                         pa.array(np.concatenate(pos))]
                n = len(grams[0])
                yield pa.RecordBatch.from_arrays(
                    [*grams, *[pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.string())]], _NAMES)
            n, (counts, digests, shas) = len(listed), zip(*listed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.nulls(n, pa.int64()), pa.array([-1] * n, pa.int32()), batch.column("doc_id"),
                 pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(shas)], _NAMES)
    return work


_NAMES = ["row", "hash", "pos", "doc_id", "n_words", "digest", "sha"]


def _texts(batches: Iterator[pa.RecordBatch]):
    for batch, texts in blocks(batches):
        yield [(r, (t or "").encode().split(), np.asarray(p, np.int64))
               for r, t, p in zip(batch.column("row").to_pylist(), texts, batch.column("places").to_pylist())]


def _next_level(length: int, before: int, size: int):
    """Lists the windows of ``size`` words by which the candidates are tested next."""
    def work(batches: Iterator[pa.RecordBatch]):
        for docs in _texts(batches):
            out = []
            for row, words, places in docs:
                hashed = word_hashes(words)
                found = window_hashes(hashed, size)
                at = np.unique(chosen(found, length - size + 1)[candidates(hashed, places, length, before)])
                out.append((row, found[at], at))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([r for r, _, _ in out], [len(p) for _, _, p in out]), pa.int64()),
                pa.array(np.concatenate([h for _, h, _ in out]).view(np.int64)),
                pa.array(np.concatenate([p for _, _, p in out]).astype(np.int32))], ["row", "hash", "pos"])
    return work


def candidates(hashed: np.ndarray, places: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which windows of ``length`` words chose a repeated window at the level ``size``."""
    good = np.zeros(len(hashed), bool)
    good[places] = True
    return good[chosen(window_hashes(hashed, size), length - size + 1)]


def covered(n_words: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Words that a window starting at one of ``starts`` covers."""
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _cut(length: int):
    def work(batches: Iterator[pa.RecordBatch]):
        for docs in _texts(batches):
            out = []
            for row, words, places in docs:
                gone = covered(len(words), places, length)
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                out.append((row, int(gone.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["row", "n_removed", "kept", "sha"])
    return work


def _bucketed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in buckets of ``row``, so that joins on it move only the other side."""
    spark: SparkSession = df.sparkSession
    n, path = buckets_for(spark), shared_dir(spark, name)
    table = f"llm_{name}_{path.rsplit('-', 1)[-1]}"
    (df.repartition(n, "row").write.bucketBy(n, "row").sortBy("row").option("path", path)
     .format("parquet").saveAsTable(table))
    return spark.table(table)


def dedup_substrings(docs: DataFrame, length: int = 35) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept, kept_sha256.

    Removed is each word in a window of ``length`` words that starts anywhere else too,
    in the same document or another. ``kept`` holds the words left, joined by one space;
    it is null where nothing is removed. The digest is that of the words left in any case.
    A null text has no words; a text shorter than the window loses nothing; repeated rows
    are copies of each other. ``docs`` is read twice and should lie in files: a row goes
    by its place in the scan, whatever its doc_id.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    first, *rest = levels(length)
    found = stored(rows.mapInArrow(_first_pass(length, first), LISTED), f"windows{first}")
    listed = found.where("pos = -1").select("row", "doc_id", "n_words", "digest", F.col("sha").alias("whole_sha"))
    copies = listed.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("leader")).where("n > 1")
    listed = stored(listed.join(copies, "digest", "left").select(
        "row", "doc_id", "n_words", "whole_sha", ((F.col("n") > 1) & (F.col("n_words") >= length)).alias("copied"),
        (F.col("leader") != F.col("row")).alias("follows")), "listed")
    alive = by_row(repeated(found.where("pos >= 0").select("row", "hash", "pos")))
    alive = alive.join(listed.where("follows").select("row"), "row", "left_anti")
    held, before = _bucketed(rows.select("row", "text").join(alive, "row"), "candidates"), first
    level = held
    for size in rest:
        grams = level.mapInArrow(_next_level(length, before, size), GRAMS)
        alive = by_row(repeated(stored(grams, f"windows{size}")))
        level, before = held.select("row", "text").join(alive, "row"), size
    cut = level.mapInArrow(_cut(length), CUT)
    gone = F.coalesce("copied", F.lit(False))
    return listed.join(cut, "row", "left").select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "whole_sha")).alias("kept_sha256"))


#: The same in DuckDB's SQL over the table ``documents``.
DEDUP_SQL = """
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents),
starts AS (SELECT r, unnest(range(1, len(w) - 33)) AS s FROM split WHERE len(w) >= 35),
windows AS (SELECT r, s, array_to_string(w[s:s + 34], ' ') AS t FROM starts JOIN split USING (r)),
hits AS (SELECT r, s FROM windows WHERE t IN (SELECT t FROM windows GROUP BY t HAVING count(*) > 1)),
gone AS (SELECT r, list(DISTINCT s + k) AS places FROM hits, unnest(range(0, 35)) AS x(k) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string([x FOR x, i IN w IF NOT coalesce(list_contains(places, i), false)], ' ')) AS kept_sha256
FROM split LEFT JOIN gone USING (r)
"""
