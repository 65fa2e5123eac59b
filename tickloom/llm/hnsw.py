"""Nearest neighbours by inner product, with a navigable small-world graph per shard.

Vectors that are equal bit by bit are one node with several ids. Nodes are dealt to
shards by hash. Each shard builds a hierarchical graph in numpy and stores it as flat
arrays: vectors, ids, and for every level the nodes and their neighbours. The largest
inner product becomes the nearest distance by one more coordinate, which makes all
vectors equally long; a query has zero there. Every shard answers every query, the
answers are merged, and the scores of the merged rows come from the original vectors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: Neighbours kept per node above the ground level (twice as many there), candidates while
#: building and while searching, nodes that a walk opens at a time.
LINKS, BUILD, SEARCH, BEAM = 16, 48, 96, 4
#: The fewest shards, vectors of a shard at most, queries per block.
SHARDS, SHARD, QUERIES = 6, 50_000, 4_096
SHARD_TYPE = ("shard int, vectors binary, length long, ids array<array<long>>, levels array<struct<nodes: binary, "
              "neighbours: binary, width: int>>")


class Graph:
    """Levels of (node to row, rows of neighbour numbers, -1 beyond the last)."""

    def __init__(self, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors = vectors
        self.levels = []
        for nodes, neighbours in levels:
            row = np.full(len(vectors), -1, np.int32)
            row[nodes] = np.arange(len(nodes), dtype=np.int32)
            self.levels.append((nodes, row, neighbours))
        self.entry = int(levels[-1][0][0])
        self.seen, self.stamp = np.zeros(len(vectors), np.int64), 0

    @staticmethod
    def build(points: np.ndarray, seed: int, links: int = LINKS, effort: int = BUILD) -> Graph:
        n = len(points)
        rng = np.random.default_rng(seed)
        height = np.minimum((-np.log(1 - rng.random(n)) / np.log(links)).astype(int), 12)
        order = np.argsort(-height, kind="stable")  # the highest first, so that an entry point exists
        levels = []
        for level in range(int(height.max()) + 1):
            nodes = np.sort(np.flatnonzero(height >= level)).astype(np.int32)
            levels.append((nodes, np.full((len(nodes), links * (1 if level else 2)), -1, np.int32)))
        graph = Graph(points, levels)
        graph.entry = int(order[0])
        for node in order[1:].tolist():
            graph._insert(node, int(height[node]), effort)
        return graph

    def _insert(self, node: int, height: int, effort: int) -> None:
        entry = np.array([self.entry])
        for level in range(len(self.levels) - 1, -1, -1):
            if level > height:
                entry = self.walk(self.vectors[node], entry, 1, level)
                continue
            entry = self.walk(self.vectors[node], entry, effort, level)
            chosen = self.spread(node, entry, self.levels[level][2].shape[1] // (1 if level else 2))
            _, row, neighbours = self.levels[level]
            neighbours[row[node], : len(chosen)] = chosen
            for other in chosen.tolist():
                line = neighbours[row[other]]
                if line[-1] < 0:
                    line[int((line >= 0).sum())] = node
                    continue
                held = np.append(line, node)
                held = held[np.argsort(-(self.vectors[held] @ self.vectors[other]), kind="stable")]
                line[:] = self.spread(other, held, len(line))

    def spread(self, node: int, near: np.ndarray, most: int) -> np.ndarray:
        """Of ``near``, nearest first, those that no chosen one is nearer to; the nearest
        others fill up."""
        if len(near) <= most:
            return near
        points = self.vectors[near]
        close, between = points @ self.vectors[node], points @ points.T
        top, chosen, at = np.full(len(near), -np.inf, np.float32), [], 0
        while at < len(near) and len(chosen) < most:
            chosen.append(at)
            top = np.maximum(top, between[at])
            later = np.flatnonzero(top[at + 1:] <= close[at + 1:])
            if not len(later):
                break
            at += 1 + int(later[0])
        rest = np.setdiff1d(np.arange(len(near)), chosen)[: most - len(chosen)]
        return near[np.concatenate([chosen, rest]).astype(int)]

    def walk(self, query: np.ndarray, entry: np.ndarray, effort: int, level: int) -> np.ndarray:
        """The ``effort`` nearest nodes that a best-first walk of one level meets, nearest
        first. All points are equally long, so the largest product is the nearest."""
        _, row, neighbours = self.levels[level]
        self.stamp += 1
        best = np.asarray(entry)
        self.seen[best] = self.stamp
        close = self.vectors[best] @ query
        order = np.argsort(-close, kind="stable")
        best, close, done = best[order], close[order], np.zeros(len(best), bool)
        while True:
            todo = np.flatnonzero(~done)[:BEAM if effort > 1 else 1]
            if not len(todo):
                return best
            done[todo] = True
            fresh = neighbours[row[best[todo]]].ravel()
            fresh = fresh[(fresh >= 0) & (self.seen[fresh] != self.stamp)]
            if len(todo) > 1:
                fresh = np.unique(fresh)
            if not len(fresh):
                continue
            self.seen[fresh] = self.stamp
            found = self.vectors[fresh] @ query
            best, close = np.concatenate([best, fresh]), np.concatenate([close, found])
            done = np.concatenate([done, np.zeros(len(fresh), bool)])
            order = np.argsort(-close, kind="stable")[:effort]
            best, close, done = best[order], close[order], done[order]

    def search(self, query: np.ndarray, effort: int) -> list[int]:
        entry = np.array([self.entry])
        for level in range(len(self.levels) - 1, 0, -1):
            entry = self.walk(query, entry, 1, level)
        return self.walk(query, entry, effort, 0).tolist()


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, in double precision."""
    v = F.col(embedding).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = F.col(embedding).isNotNull() & F.coalesce(sound, F.lit(False)) & F.exists(v, lambda x: x != 0)
    return vectors.where(kept).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def build_index(vectors: DataFrame, top: int, shard: int = SHARD, least: int = SHARDS) -> DataFrame:
    """One stored row per shard, for ``vectors`` (vec_id, v).

    A node keeps the ``top + 1`` smallest of its ids: more copies of one vector cannot
    be among the ``top`` answers to a query. A null id comes last.
    """
    ordered = Window.partitionBy("v", "_salt").orderBy(F.col("vec_id").asc_nulls_last())
    again = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last())
    salted = vectors.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    few = salted.withColumn("_n", F.row_number().over(ordered)).where(F.col("_n") <= top + 1)
    few = few.withColumn("_n", F.row_number().over(again)).where(F.col("_n") <= top + 1)
    nodes = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    stats = nodes.agg(F.count(F.lit(1)), F.max(dot(F.col("v"), F.col("v")))).first()
    count, longest = stats[0], stats[1] or 0.0
    shards = max(1, min(least, count), -(-count // shard))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort([min(i) if len(i) else -1 for i in rows["ids"]], kind="stable")
        points = np.array(rows["v"].tolist(), np.float64)[order]
        ids = [list(rows["ids"].iloc[i]) for i in order]
        tail = np.sqrt(np.maximum(longest - (points**2).sum(1), 0))[:, None]
        full = np.concatenate([points, tail], axis=1).astype(np.float32)
        graph = Graph.build(full, int(rows["shard"].iloc[0]))
        levels = [{"nodes": n.tobytes(), "neighbours": k.tobytes(), "width": k.shape[1]} for n, _, k in graph.levels]
        return pd.DataFrame([{"shard": int(rows["shard"].iloc[0]), "vectors": full.tobytes(), "length": full.shape[1],
                              "ids": ids, "levels": levels}])

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    # a task for every shard: small partitions of one stage would be put together
    dealt = dealt.repartition(4 * shards, "shard")
    return stored(dealt.groupBy("shard").applyInPandas(build, SHARD_TYPE), "graphs")


def load(row: dict) -> tuple[Graph, list[list[int]]]:
    vectors = np.frombuffer(row["vectors"], np.float32).reshape(-1, row["length"])
    levels = [(np.frombuffer(x["nodes"], np.int32), np.frombuffer(x["neighbours"], np.int32).reshape(-1, x["width"]))
              for x in row["levels"]]
    return Graph(vectors, levels), row["ids"]


def nearest(queries: DataFrame, vectors: DataFrame, top: int = 20, effort: int = SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` (vec_id, v) against ``vectors``
    (vec_id, v), both as ``usable`` gives them.

    A vector is no neighbour of its own id. Fewer candidates than ``top`` give fewer rows;
    ties go to the smaller id; ids that occur twice are candidates twice. A query row that
    is repeated is asked once; unlike vectors with one id are queries of their own, each
    with ranks from 1. Vectors must have one length. Queries go to the shards in blocks of
    bounded size.
    """
    graphs = build_index(vectors, top)
    asked = stored(queries.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("_times")).select("vec_id", "v", F.xxhash64("v").alias("vkey")), "queries")
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, -(-asked.count() // QUERIES)))))

    def answer(key, graph_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in graph_rows.to_dict("records"):
            graph, ids = load(row)
            for qid, v, vkey in zip(query_rows["vec_id"], query_rows["v"], query_rows["vkey"]):
                q = np.append(np.asarray(v, np.float32), np.float32(0))
                # the whole list of the walk: its order is single precision, the cut follows exact scores
                for node in graph.search(q, max(effort, top + 1)):
                    out += [(qid, vkey, int(i)) for i in ids[node] if i is not None and i != qid]
        return pd.DataFrame(out, columns=["query_id", "vkey", "vec_id"]).astype("int64")

    # every block meets every shard: the stated queries against all rows, in blocks
    shards = [r["shard"] for r in graphs.select("shard").collect()]
    blocks = [r["block"] for r in numbered.select("block").distinct().collect()]
    left = graphs.withColumn("block", F.explode(F.array(*[F.lit(b).cast("long") for b in blocks]) if blocks else F.array().cast("array<long>")))
    right = numbered.withColumn("shard", F.explode(F.array(*[F.lit(s) for s in shards]) if shards else F.array().cast("array<int>")))
    pairs = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(answer, "query_id long, vkey long, vec_id long")
    scored = (
        pairs.distinct().join(asked.select(F.col("vec_id").alias("query_id"), "vkey", F.col("v").alias("q")), ["query_id", "vkey"])
        .join(vectors, "vec_id").select("query_id", "vkey", "vec_id", dot(F.col("q"), F.col("v")).alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "vkey").orderBy(F.col("score").desc(), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def digest(embeddings: DataFrame, every: int = 20, top: int = 20) -> DataFrame:
    vectors = usable(embeddings, "vec_id", "embedding")
    return nearest(vectors.where(F.col("vec_id") % every == 0), vectors, top)

