"""Benchmark decontamination with a BM25 index and block-max WAND.

The test items form an inverted index: for each term the items that hold it. Ranges of
items are blocks, with the largest impact of each term in each block. Impacts are BM25 shares, scaled so that an item that is
wholly inside a passage scores 1. Every training text is cut into passages that overlap
so far that any item fits into one. Each passage asks the index for all items above a
threshold: a passage whose terms stay below it in every block is passed by; otherwise the
terms move along their items, and bounds of terms and then of blocks decide what is
skipped. What is found counts as a leak if both the question and the answer of
the item overlap with the passage.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import blocks, running_start, stored

#: Usual constants of BM25, blocks of an index, and the share of an item to be found.
K1, B, BLOCKS, THRESHOLD = 1.2, 0.75, 64, 0.5
#: Shares of the word triples of question and answer that must occur, and the triples' length.
QUESTION, ANSWER, GRAM = 0.5, 0.5, 3
#: Bytes of test items in one index; more items make more indexes.
INDEX_BYTES = 2 << 20
CACHE_WORDS = 400_000
_EDGES = ".,;:!?\"'()[]{}<>*_-"


def term(word: bytes) -> str:
    """A word in small letters without signs around it."""
    return word.decode().lower().strip(_EDGES)


def terms(text: str | None) -> list[str]:
    return [t for t in map(term, (text or "").encode().split()) if t]


def grams(words: list[str], n: int = GRAM) -> set[tuple[str, ...]]:
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


@dataclass
class Hit:
    item: int
    passage: int
    score: float
    question: float
    answer: float


class Numbers(dict):
    """Numbers of words as they stand in a text, -1 for those beyond the index."""

    known: dict[str, int]

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = self.known.get(term(word), -1)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        found = itemgetter(*words)(self) if len(words) > 1 else [self[words[0]]]
        return np.fromiter(found, np.int64, len(words))


@dataclass
class Corpus:
    """Counts over all items, whichever part an index holds: items with a term, terms in
    all, terms of the longest, and how many items hold each term of the part."""

    items: int
    words: int
    longest: int
    holding: dict[str, int]


class Index:
    """Postings of the items, with bounds by term and by block."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD, corpus: Corpus | None = None):
        self.items = [(i, t) for i, t in ((i, terms(text)) for i, text in items) if t]
        self.threshold = threshold
        counts = [Counter(t) for _, t in self.items]
        if corpus is None:  # these items are all there are
            lengths = [len(t) for _, t in self.items]
            corpus = Corpus(len(counts), sum(lengths), max(lengths, default=1), Counter(t for c in counts for t in c))
        n, mean = len(counts), corpus.words / max(1, corpus.items)
        seen = {t for c in counts for t in c}
        idf = {t: math.log(1 + (corpus.items - corpus.holding[t] + 0.5) / (corpus.holding[t] + 0.5)) for t in seen}
        self.number = {t: i for i, t in enumerate(sorted(seen))}
        self.docs: list[list[int]] = [[] for _ in seen]
        self.impacts: list[list[float]] = [[] for _ in seen]
        for d, c in enumerate(counts):
            length = sum(c.values())
            part = {t: idf[t] * k * (K1 + 1) / (k + K1 * (1 - B + B * length / mean)) for t, k in c.items()}
            whole = sum(part.values())
            for t in sorted(part):
                self.docs[self.number[t]].append(d)
                self.impacts[self.number[t]].append(part[t] / whole)
        self.size = max(1, -(-n // BLOCKS))
        self.block = np.zeros((len(seen), -(-n // self.size)), np.float32)
        for t, (docs, impacts) in enumerate(zip(self.docs, self.impacts)):
            np.maximum.at(self.block[t], np.array(docs) // self.size, impacts)
        self.bound = [max(x) for x in self.impacts]
        # both sides are as long as a triple at least, so the triples of short items straddle the cut
        parts = [(len(t) - len(t) // 3, t) for _, t in self.items]
        self.sides = [(grams(t[:max(k, GRAM)]), grams(t[max(0, min(k, len(t) - GRAM)):])) for k, t in parts]
        self.longest = corpus.longest
        self.numbers = Numbers()
        self.numbers.known = self.number

    def retrieve(self, query: list[int]) -> list[tuple[int, float]]:
        """All items that score ``threshold`` or more for the distinct terms ``query``."""
        docs, impacts, bound, theta = self.docs, self.impacts, self.bound, self.threshold - 1e-9
        # [item that the term stands at, term, place]
        state = sorted([docs[t][0], t, 0] for t in query)
        found = []
        while state:
            total, pivot = 0.0, -1
            for i, (_, t, _) in enumerate(state):
                total += bound[t]
                if total >= theta:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = state[pivot][0]
            while pivot + 1 < len(state) and state[pivot + 1][0] == item:
                pivot += 1
            # the block in which the item stands
            block = item // self.size
            total = sum(self.block[t, block] for _, t, _ in state[:pivot + 1])
            if total >= theta - 1e-5:  # blocks hold single precision
                target = item
                if state[0][0] == item:
                    score = sum(impacts[t][at] for _, t, at in state[:pivot + 1])
                    if score >= theta:
                        found.append((item, score))
                    target = item + 1
            else:
                target = (block + 1) * self.size
                if pivot + 1 < len(state):
                    target = min(target, state[pivot + 1][0])
            moved = []
            for entry in state[:pivot + 1]:
                _, t, at = entry
                at = bisect_left(docs[t], target, at)
                if at < len(docs[t]):
                    moved.append([docs[t][at], t, at])
            state = sorted(moved + state[pivot + 1:])
        return found

    def promising(self, passage: np.ndarray, number: np.ndarray, rows: int = 1 << 16) -> Iterator[tuple[int, int, int]]:
        """Passages whose terms reach the threshold in some block, and where they stand.

        Both arrays are sorted by passage; at most about ``rows`` terms are summed at once.
        """
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        ends = np.append(starts[1:], len(passage))
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + rows, "right")))
            a, b = int(starts[i]), int(ends[j - 1])
            sums = np.add.reduceat(self.block[number[a:b]], starts[i:j] - a, axis=0).max(axis=1)
            for k in (np.flatnonzero(sums >= self.threshold - 1e-5) + i).tolist():
                yield int(passage[starts[k]]), int(starts[k]), int(ends[k])
            i = j

    def hits(self, text: str | None) -> list[Hit]:
        """The best hit of every item in one text."""
        words = (text or "").encode().split()
        if not words or not self.items:
            return []
        ids = self.numbers.of(words)
        stride = self.longest
        # every place belongs to the passage that starts at its stride and to the one before
        own = np.arange(len(ids)) // stride
        known = ids >= 0
        width = len(self.number)
        keys = np.concatenate([own[known], own[known] - 1]) * width + np.tile(ids[known], 2)
        passage, number = np.divmod(np.unique(keys[keys >= 0]), width)
        best: dict[int, Hit] = {}
        for p, a, b in self.promising(passage, number):
            rows = self.retrieve(number[a:b].tolist())
            if rows:
                own_terms = [t for t in map(term, words[p * stride:(p + 2) * stride]) if t]
                # items of fewer words than a triple are compared as a whole
                inside = {n: grams(own_terms, n) for n in {min(GRAM, len(self.items[d][1])) for d, _ in rows}}
                for d, score in rows:
                    held = inside[min(GRAM, len(self.items[d][1]))]
                    q, r = (len(side & held) / len(side) for side in self.sides[d])
                    if q >= QUESTION and r >= ANSWER and (d not in best or score > best[d].score):
                        best[d] = Hit(self.items[d][0], p * stride, score, q, r)
        return [best[d] for d in sorted(best)]


def indexes(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> Iterator[Index]:
    """Indexes over parts of ``benchmark`` (item_id, text) of at most ``index_bytes`` each,
    but for a single longer item. Term weights, mean and longest length are those of all
    items, so what is found doesn't depend on the parts."""
    def split(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [terms(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(f) for f in found], pa.int64()), pa.array([sorted(set(f)) for f in found], pa.list_(pa.string()))],
                [*batch.schema.names, "words", "terms"])

    cut = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text").mapInArrow(
        split, "item_id long, text string, words long, terms array<string>").where("words > 0")
    sized = stored(cut.select("*", F.octet_length("text").cast("long").alias("bytes"),
                              F.pmod(F.xxhash64("item_id", "text"), F.lit(64)).alias("bucket")), "items")
    placed = stored(running_start(sized, [], "bucket", ["item_id", "text"], "bytes", "start"), "items")
    last, items, words, longest = placed.agg(F.max("start"), F.count(F.lit(1)), F.sum("words"), F.max("words")).first()
    each = placed.select("start", F.explode("terms").alias("term"))
    holding = stored(each.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "terms")
    for part in range(0 if last is None else last // index_bytes + 1):
        here = F.floor(F.col("start") / index_bytes) == part
        rows = placed.where(here).select("item_id", "text").collect()
        # the terms of one part, which is of bounded size
        known = dict(holding.join(each.where(here).select("term").distinct(), "term").select("term", "n").collect())
        yield Index(sorted((r["item_id"] if r["item_id"] is not None else -1, r["text"]) for r in rows),
                    corpus=Corpus(items, words, longest, known))


def leaks(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """(doc_id, item_id, place, score, question, answer) for every item found in a row of
    ``docs`` (doc_id, text), at its best passage; ``place`` counts words from 0.

    Null and empty texts hold nothing; items without a word are never found; an item
    without an id is reported as -1; repeated rows report alike.
    """
    def search(index: Index):
        def work(batches: Iterator[pa.RecordBatch]):
            for batch, texts in blocks(batches):
                found = [(d, h.item, h.passage, h.score, h.question, h.answer)
                         for d, t in zip(batch.column("doc_id").to_pylist(), texts) for h in index.hits(t)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), [*[pa.int64()] * 3, *[pa.float64()] * 3])],
                        ["doc_id", "item_id", "place", "score", "question", "answer"])
        return work

    schema = "doc_id long, item_id long, place long, score double, question double, answer double"
    thin = docs.select(F.col("doc_id").cast("long"), "text")
    out = None
    for index in indexes(benchmark, index_bytes):
        part = thin.mapInArrow(search(index), schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no item."""
    def clean(index: Index):
        def work(batches: Iterator[pa.RecordBatch]):
            for batch, texts in blocks(batches):
                yield batch.filter(pa.array([not index.hits(t) for t in texts]))
        return work

    for index in indexes(benchmark):
        docs = docs.mapInArrow(clean(index), docs.schema)
    return docs
