"""Ranked lexical search by the best position algorithm.

Every query term has an impact list: the documents that hold it, highest impact first. The
lists of a query are read from the top in parallel. Each document that turns up is looked
up in all the other lists at once (direct access), which gives its whole score and its
position in each of them. A list's best position ends the run of positions, from the top
on, that have been seen by either kind of access; direct accesses push it past what has
been read. An unseen document stands behind it in every list, so none can score more than
the sum of the impacts there. The walk stops when that sum is strictly below the score of
the last answer, so ties are never cut off.

Documents are the rows of a stored table of term counts. Each task cuts its rows into
shards of bounded size, builds the lists of a shard and answers every query on it, with
the answers so far as the bar to pass. Corpus counts are taken over all documents first,
so the answers don't depend on the shards.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import blocks, running_start, stored

#: Answers to a query, term counts in one shard, and bytes of queries answered in one pass.
TOP, SHARD_COUNTS, QUERY_BYTES = 50, 2_000_000, 8 << 20
#: Positions read from each list at once: at first, and at most.
FIRST, MOST = 64, 8_192
_LETTERS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
COUNTS = "doc_id long, n long, terms array<int>, tfs array<int>"


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased."""
    return text.translate(_LETTERS).split()


class Shard:
    """The impact lists of some documents."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, docs: np.ndarray, numbers: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, documents: int, words: int):
        self.doc_ids = doc_ids
        m = 50 + (50 * lengths * documents) // words
        impacts = weights[numbers] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[docs]))
        kept = impacts > 0
        docs, numbers, impacts = docs[kept], numbers[kept], impacts[kept]
        order = np.lexsort((docs, -impacts, numbers))
        self.docs, self.impacts = docs[order].astype(np.int32), impacts[order]
        self.start = np.searchsorted(numbers[order], np.arange(len(weights) + 1))
        # for direct access: the documents of a list in ascending order, and their positions
        by_doc = np.lexsort((docs, numbers))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.sorted_docs = docs[by_doc].astype(np.int32)
        self.position = place[by_doc] - self.start[numbers[by_doc]].astype(np.int32)
        self.fresh = np.ones(len(doc_ids), bool)

    def search(self, query: np.ndarray, top: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (numbers inside the shard) and scores of all that can be among the
        ``top`` highest; a full set of answers found before scores ``bar`` or more."""
        lists = [(int(self.start[t]), int(self.start[t + 1])) for t in query]
        lists = [(a, b) for a, b in lists if b > a]
        seen = [np.zeros(b - a + 1, bool) for a, b in lists]  # one more, never seen, ends the run
        best, read, step = [0] * len(lists), 0, FIRST
        found, scores = [], []
        while lists:
            heads = [self.docs[a + read:min(a + read + step, b)] for a, b in lists]
            for s in seen:
                s[read:min(read + step, len(s) - 1)] = True
            met = np.unique(np.concatenate(heads))
            met = met[self.fresh[met]]
            self.fresh[met] = False
            score = np.zeros(len(met), np.int64)
            for s, (a, b) in zip(seen, lists):
                at = np.searchsorted(self.sorted_docs[a:b], met)
                at[at == b - a] = 0
                held = self.sorted_docs[a:b][at] == met
                position = self.position[a:b][at[held]]
                s[position] = True
                score[held] += self.impacts[a + position]
            found.append(met)
            scores.append(score)
            read, step = read + step, min(2 * step, MOST)
            limit = 0
            for i, (s, (a, b)) in enumerate(zip(seen, lists)):
                best[i] += int(np.argmin(s[best[i]:]))
                # the first unseen position bounds all unseen documents of its list
                limit += int(self.impacts[a + best[i]]) if best[i] < b - a else 0
            if limit == 0:
                break
            every = np.concatenate(scores)
            kth = int(np.partition(every, len(every) - top)[len(every) - top]) if len(every) >= top else 0
            if limit < max(kth, bar):
                break
        if not found:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        docs, scores = np.concatenate(found), np.concatenate(scores)
        self.fresh[docs] = True
        return docs, scores


def shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc_ids, lengths, document of each count, terms, tfs) of shards with about ``most``
    counts; a null id is told by a mask of its own, the last array."""
    held, size = [], 0

    def joined():
        whole = pa.Table.from_batches(held).combine_chunks()
        terms_, tfs = whole.column("terms").combine_chunks(), whole.column("tfs").combine_chunks()
        docs = np.repeat(np.arange(len(whole)), pc.list_value_length(terms_).to_numpy(zero_copy_only=False))
        ids = whole.column("doc_id").combine_chunks()
        return (ids.fill_null(0).to_numpy(), whole.column("n").to_numpy(), docs, terms_.flatten().to_numpy().astype(np.int64),
                tfs.flatten().to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False))

    for batch in batches:
        for part in (batch.slice(i, 1_000) for i in range(0, batch.num_rows, 1_000)):
            held.append(part)
            size += len(part.column("terms").flatten())
            if size >= most:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def query_terms(items: DataFrame) -> list[tuple[int | None, list[bytes]]]:
    """The distinct terms of every item; of bounded size, see ``QUERY_BYTES``."""
    rows = items.select(F.col("item_id").cast("long"), "text").collect()
    return [(r["item_id"], sorted(set(terms((r["text"] or "").encode())))) for r in rows]


def query_parts(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items in parts of at most ``most`` bytes each, but for a single longer one."""
    sized = stored(items.where("text is not null").select(
        "item_id", "text", F.octet_length("text").cast("long").alias("bytes"),
        F.pmod(F.xxhash64("item_id", "text"), F.lit(64)).alias("bucket")), "queries")
    placed = stored(running_start(sized, [], "bucket", ["item_id", "text"], "bytes", "start"), "queries")
    last = placed.agg(F.max("start")).first()[0]
    for part in range(0 if last is None else last // most + 1):
        yield query_terms(placed.where(F.floor(F.col("start") / most) == part))


def term_counts(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """A stored row for each document with a term: how many terms it has, and how often it
    holds each numbered one."""
    def count(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part, texts in blocks(batch_with_bytes(batch)):
                ids, lengths, own, tfs = [], [], [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts):
                    words = terms(text or b"")
                    if words:
                        # terms beyond the queries all fall on None
                        seen = Counter(map(number.get, words))
                        seen.pop(None, None)
                        ids.append(doc_id)
                        lengths.append(len(words))
                        own.append(list(seen))
                        tfs.append(list(seen.values()))
                if ids:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(own, pa.list_(pa.int32())),
                         pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    def batch_with_bytes(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text").cast(pa.binary())], ["doc_id", "text"])

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, COUNTS), "term-counts")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, query_bytes: int = QUERY_BYTES,
           shard_counts: int = SHARD_COUNTS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) the ``top``
    rows of ``docs`` (doc_id, text) with the highest score above 0.

    Equal scores go to the smaller doc_id, a null one last. Every row is a document: rows
    that repeat take ranks of their own, and so do items with one id but for equal rows of
    items, which are asked once. Null and empty texts hold no term, are no document in the
    counts and find nothing. Texts are read whole; other columns are ignored; an empty
    table on either side gives no row.
    """
    schema = "item_id long, item int, doc_id long, score long"
    out = None
    wanted = items.select(F.col("item_id").cast("long"), "text").distinct()
    for queries in query_parts(wanted, query_bytes):
        number = {t: i for i, t in enumerate(sorted({t for _, ts in queries for t in ts}))}
        counts = term_counts(docs, number)
        sums = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        documents, words = sums[0], sums[1] or 1
        held = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for each query term
        weights = np.array([weight(documents, held[i]) if i in held else 0 for i in range(len(number))], np.int64)
        asked = [(item, i, np.array([number[t] for t in ts], np.int64)) for i, (item, ts) in enumerate(queries)]
        part = counts.mapInArrow(_search(asked, weights, documents, words, top, shard_counts), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # tasks send their own best; a first cut by groups of tasks keeps one item's answers apart
    first = Window.partitionBy("item_id", "item", "_group").orderBy(*order)
    last = Window.partitionBy("item_id", "item").orderBy(*order)
    few = out.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(64)))
    few = few.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= top)
    return few.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _search(asked, weights, documents, words, top, shard_counts):
    """Answers of one task: the best ``top`` of all its shards for each query."""
    def work(batches: Iterator[pa.RecordBatch]):
        best = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))] * len(asked)
        for ids, lengths, docs, numbers, tfs, null in shards(batches, shard_counts):
            shard = Shard(ids, lengths, docs, numbers, tfs, weights, documents, words)
            for k, (_, _, query) in enumerate(asked):
                bar = int(best[k][2][-1]) if len(best[k][2]) == top else 0
                rows, scores = shard.search(query, top, bar)
                rows, scores = rows[scores > 0], scores[scores > 0]
                doc = np.concatenate([best[k][0], ids[rows]])
                none = np.concatenate([best[k][1], null[rows]])
                score = np.concatenate([best[k][2], scores])
                keep = np.lexsort((doc, none, -score))[:top]
                best[k] = doc[keep], none[keep], score[keep]
        for (item, i, _), (doc, none, score) in zip(asked, best):
            if len(doc):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(doc), pa.int64()), pa.array(np.full(len(doc), i, np.int32)),
                     pa.array(doc, pa.int64(), mask=none), pa.array(score)], ["item_id", "item", "doc_id", "score"])
    return work


#: The same in DuckDB's SQL over the tables ``documents`` and ``benchmark``.
RANKED_SQL = r"""
WITH words AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
counts AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row),
corpus AS (SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM sizes),
asked AS (
  SELECT DISTINCT item_id, item, term FROM (
    SELECT item_id, item, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)))),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts CROSS JOIN corpus WHERE term IN (SELECT term FROM asked) GROUP BY term),
impacts AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // total))) AS impact
  FROM counts JOIN weights USING (term) JOIN sizes USING (row) CROSS JOIN corpus),
scores AS (
  SELECT item_id, item, row, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term)
  GROUP BY ALL HAVING sum(impact) > 0)
SELECT item_id, (row_number() OVER (PARTITION BY item_id, item ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM scores QUALIFY rank <= 50
"""
