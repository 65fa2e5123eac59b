"""Near duplicates by SimHash, with vantage-point trees over Hamming distance.

Two fingerprints within ``radius`` bits of each other differ by at most ``radius // 2``
bits in their lower or in their upper half. For each half there is a tree of vantage
points under the Hamming distance of that half alone, which is a metric too: inner
nodes hold a vantage point and a distance, points up to the distance go to the near
side, the others to the far side. A leaf is a shard. A fingerprint lives in one leaf,
and asks in every leaf that a ball of ``radius // 2`` around it reaches by the triangle
inequality. Inside a shard the same bounds prune again, by vantage points of whole
fingerprints, before the exact distance is counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import blocks, stored
from tickloom.llm.components import components
from tickloom.operators.joins import lookup_join

#: Seed of the shingle hash.
SEED = 42
#: Bound of the sample that the trees are grown on, and fingerprints aimed at per shard.
SAMPLE = 65_536
SHARD = 8_192
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
HALVES = (np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000))


def shingles(text: str | None, words: int = 3) -> np.ndarray:
    """Hashes of all ``words``-word shingles; a text with fewer words is one shingle."""
    parts = (text or "").encode().lower().split()  # both act on ASCII alone
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        hashes = [digest(b" ".join(parts), SEED)]
    else:
        whole = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = np.concatenate([[0], ends[:-words]]).tolist()
        hashes = [digest(whole[s:e], SEED) for s, e in zip(starts, (ends[words - 1:] - 1).tolist())]
    return np.array(hashes, "<u8")


def fingerprint(text: str | None, words: int = 3) -> int:
    """Majority of the bits over the hashes of all ``words``-word shingles."""
    if not (text or "").encode().split():
        return 0
    hashes = shingles(text, words)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` and fp, the fingerprint's bits of the text as a long."""

    def score(batches: Iterator[pa.RecordBatch]):
        for batch, texts in blocks(batches):
            found = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found)], [*keep, "fp"])

    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(score, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", fp long")


class Tree:
    """Vantage points in the order of a binary heap; node i has children 2i+1 and 2i+2."""

    def __init__(self, sample: np.ndarray, mask: np.uint64, leaves: int):
        self.mask, self.depth = mask, max(0, int(np.ceil(np.log2(max(leaves, 1)))))
        n = (1 << self.depth) - 1
        self.point, self.cut = np.zeros(n, np.uint64), np.full(n, 64, np.int64)
        groups = {0: sample}
        for i in range(n):
            own = groups.pop(i)
            if len(own):
                # of a few candidates the one whose distances part the group most evenly with a thin border
                tries = [own[int(j)] for j in np.linspace(0, len(own) - 1, 9)] + [~own[0]]
                best = min((self._border(own, v) for v in tries), key=lambda x: x[0])
                self.point[i], self.cut[i] = best[1], best[2]
            d = np.bitwise_count((own ^ self.point[i]) & mask)
            groups[2 * i + 1], groups[2 * i + 2] = own[d <= self.cut[i]], own[d > self.cut[i]]

    def _border(self, own: np.ndarray, v: np.uint64):
        d = np.bitwise_count((own ^ v) & self.mask).astype(np.int64)
        counts = np.bincount(d, minlength=65)
        cut = int(np.argmin(np.abs(np.cumsum(counts) - len(own) / 2)))
        near = counts[: cut + 1].sum() / len(own)
        border = counts[max(cut, 0): cut + 2].sum() / len(own)
        return border + 2 * abs(near - 0.5), v, cut

    def leaves(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``points``, leaf) of every leaf that a ball of ``reach`` touches."""
        rows, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            d = np.bitwise_count((points[rows] ^ self.point[node]) & self.mask).astype(np.int64)
            near, far = d - reach <= self.cut[node], d + reach > self.cut[node]
            rows, node = np.concatenate([rows[near], rows[far]]), np.concatenate([2 * node[near] + 1, 2 * node[far] + 2])
        return rows, node


def close_pairs(home: np.ndarray, ask: np.ndarray, radius: int, block: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices (home, ask) of fingerprints at most ``radius`` apart.

    Both sides are sorted by their distance to one vantage point after another, in an
    order of cells; cells whose distances differ by more than the radius are passed by.
    """
    if not len(home) or not len(ask):
        return
    pivots = [home[0], home[len(home) // 2] ^ np.uint64(0x5555555555555555)]
    near = lambda x, v: np.bitwise_count(x ^ v).astype(np.int64)
    hd, qd = near(home, pivots[0]), near(ask, pivots[0])
    he, qe = near(home, pivots[1]), near(ask, pivots[1])
    order = np.lexsort((he, hd))
    bound = np.searchsorted((hd * 65 + he)[order], np.arange(65 * 65 + 65))
    cells, where = np.unique(qd * 65 + qe, return_inverse=True)
    by_cell = np.argsort(where, kind="stable")
    starts = np.searchsorted(where[by_cell], np.arange(len(cells) + 1))
    for c, cell in enumerate(cells):
        queries = by_cell[starts[c]:starts[c + 1]]
        d, e = divmod(int(cell), 65)
        spans = [order[bound[x * 65 + max(0, e - radius)]:bound[x * 65 + min(64, e + radius) + 1]]
                 for x in range(max(0, d - radius), min(64, d + radius) + 1)]
        inside = np.concatenate(spans)
        for i in range(0, len(queries) if len(inside) else 0, block):
            q = queries[i:i + block]
            for j in range(0, len(inside), 1 << 16):
                part = inside[j:j + (1 << 16)]
                a, b = np.nonzero(np.bitwise_count(home[part][:, None] ^ ask[q][None, :]) <= radius)
                if len(a):
                    yield part[a], q[b]


def forest(home: np.ndarray, ask: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what ``close_pairs`` joins, one fewer than members of each group."""
    values, at = np.unique(np.concatenate([home, ask]), return_inverse=True)
    root, h, q = np.arange(len(values)), at[: len(home)], at[len(home):]
    for a, b in close_pairs(home, ask, radius):
        u, v = h[a], q[b]
        while True:
            ru, rv = root[u], root[v]
            open_ = ru != rv
            if not open_.any():
                break
            u, v, ru, rv = u[open_], v[open_], ru[open_], rv[open_]
            np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
            while (root[root] != root).any():
                root = root[root]
    linked = np.flatnonzero(root != np.arange(len(values)))
    return values[linked], values[root[linked]]


def links(distinct: DataFrame, radius: int = 3, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``distinct`` (fp) within ``radius``.

    ``distinct`` should be stored. The trees are grown on at most ``sample`` of its rows,
    those with the smallest hashes; that shapes the shards and not the result. Leaves of
    the trees that come out larger than ``shard`` are cut into blocks, and each two blocks
    of a leaf meet in a task, so that no task holds more than a few times ``shard``.
    """
    n = distinct.count()
    picked = distinct.orderBy(F.xxhash64("fp"), "fp").limit(min(sample, n)).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    leaves = min(-(-n // shard), max(1, len(picked) // 16))
    trees = [Tree(picked, mask, leaves) for mask in HALVES]

    def deal(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            points = batch.column("fp").to_numpy().view(np.uint64)
            for k, tree in enumerate(trees):
                home, own = tree.leaves(points, 0)
                first = np.empty(len(points), np.int64)
                first[home] = own
                rows, leaf = tree.leaves(points, radius // 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf * 2 + k), pa.array(points[rows].view(np.int64)), pa.array(first[rows] == leaf)],
                    ["leaf", "fp", "home"])

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        points, home = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["home"].to_numpy(bool)
        a, b = forest(points[home], points, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = stored(distinct.mapInArrow(deal, "leaf long, fp long, home boolean"), "shards")
    counts = dealt.groupBy("leaf").count().where(F.col("count") > 4 * shard)
    large = counts.select("leaf", F.ceil(F.col("count") / (2 * shard)).cast("int").alias("blocks"))
    # one row for each large leaf: there are no more leaves than 8,192 (SAMPLE / 16 in each tree)
    cut = dealt.join(F.broadcast(large), "leaf", "left").select(
        "leaf", "fp", "home", F.coalesce("blocks", F.lit(1)).alias("blocks"),
        F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int").alias("own"))
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = cut.select("leaf", "fp", "home", "own", meets).select(
        "leaf", "fp", "home", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
    return met.groupBy("leaf", "one", "two").applyInPandas(pairs, "a long, b long")


def component_roots(marked: DataFrame, radius: int) -> DataFrame:
    """Stored (fp, root) of all fingerprints in ``marked`` (fp) that others are linked to."""
    distinct = stored(marked.select("fp").distinct(), "distinct-fingerprints")
    return components(links(distinct, radius)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, radius: int = 3, words: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    Texts with fewer words than a shingle are one shingle, null texts and texts without
    words have fingerprint zero, and equal fingerprints are linked. A null ``doc_id`` is
    never a component's name unless all of its rows have none; repeated rows each come back.
    """
    marked = stored(fingerprints(docs, words), "fingerprints")
    roots = component_roots(marked, radius)
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp", "left")
    first = stored(first.select("fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    # components are numbered by fingerprints, and named by the smallest document inside
    names = stored(first.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    return marked.join(stored(first.join(names, "root").select("fp", "component_id"), "components"), "fp").select(
        "doc_id", "fp", "component_id")


def _row_key() -> list[Column]:
    """What tells rows apart but for repeated ones: the id, and a hash of the text."""
    return [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash")]


def keep_one(docs: DataFrame, radius: int = 3, words: int = 3) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest doc_id.

    Of several texts with that id the longest stays, then that of the smallest hash; of
    repeated rows one. Rows without an id come after all others of their component. Only
    ids and hashes are grouped: rows that have no duplicate never leave the scan, and the
    list of the others is broadcast where it is small enough.
    """
    keys = ["none", "id", "hash"]
    size = F.coalesce(F.length("text"), F.lit(0)).alias("size")
    marked = stored(fingerprints(docs.select("text", "doc_id", *_row_key(), size), words, (*keys, "size")), "fingerprints")
    rows = marked.join(component_roots(marked, radius), "fp", "left").groupBy(
        F.coalesce("root", "fp").alias("root"), *keys).agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    rows = stored(rows, "rows")
    best = rows.groupBy("root").agg(F.min(F.struct("none", "id", (-F.col("size")).alias("size"), "hash")).alias("best"), F.count(F.lit(1)).alias("texts"))
    told = rows.join(best.where("texts > 1"), "root", "left").withColumn(
        "stays", F.col("best").isNull() | (F.struct(*keys) == F.struct(*[F.col(f"best.{k}").alias(k) for k in keys])))
    marks = stored(told.where("not stays or n > 1").select(*keys, "stays"), "marks")
    keyed = docs.select(F.struct(*docs.columns).alias("doc"), *_row_key())
    out = lookup_join(keyed, marks, keys, how="left")
    kept = out.where("stays is null").select("doc.*")
    if marks.where("stays").isEmpty():
        return kept
    whole = [f"doc.`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    once = out.where("stays").groupBy(*keys).agg(F.min_by("doc", F.xxhash64(*whole)).alias("doc"))
    return kept.unionByName(once.select("doc.*"))


def digest(docs: DataFrame) -> DataFrame:
    """Fingerprints as 16 hexadecimal digits."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
