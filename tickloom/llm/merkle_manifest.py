"""A Merkle manifest of a table with incremental witnesses.

Rows are leaves; every three consecutive nodes become one above (the last run of a level
may be shorter, even one node), up to a root. Leaves form a tree for each source, and the
roots of the sources, in order, form the tree above.

Witnesses grow while leaves are appended. An append puts a node into the open run of its
level; its own witness starts with the siblings that stand there already, and it extends
the witnesses of the leaves below those. A full run closes into a node that is appended
one level up. Leaves are cut into aligned blocks of 3 ** 8, each the work of one task of
bounded size. The root of a block is a further append, to a tree of block roots, which is
cut into blocks in its turn; what a block root collects there extends the witnesses of its
leaves. The roots of the sources go the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored
from tickloom.llm.runs import numbered
from tickloom.operators.joins import lookup_join

#: Nodes of a run, and levels of a block, which has 6,561 leaves then.
FAN, LEVELS = 3, 8
#: Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def join_digests(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Witnesses:
    """Appends digests from left to right and keeps the witness of every leaf."""

    def __init__(self):
        self.witness: list[list[str]] = []
        self.open: list[list[tuple[str, int, int]]] = [[]]

    def append(self, digest: str) -> None:
        self.witness.append([])
        self._place(digest, len(self.witness) - 1, len(self.witness), 0)

    def _place(self, digest: str, start: int, end: int, level: int) -> None:
        """A node over the leaves ``start`` to ``end`` joins the open run of ``level``."""
        run = self.open[level]
        for sibling, first, last in run:
            for leaf in range(first, last):
                self.witness[leaf].append(digest)
            for leaf in range(start, end):
                self.witness[leaf].append(sibling)
        run.append((digest, start, end))
        if len(run) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        if level + 1 == len(self.open):
            self.open.append([])
        self._place(join_digests([d for d, _, _ in run]), run[0][1], run[-1][2], level + 1)

    def finish(self, levels: int) -> str:
        """Closes what is open up to ``levels`` and returns the digest there."""
        for level in range(levels):
            if self.open[level]:
                self._close(level)
        return self.open[levels][0][0]


def height(nodes: int) -> int:
    """Levels between ``nodes`` leaves and their root."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def grow(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Witnesses for ``nodes`` (tree, place, size, digest, extra columns): the same columns
    with ``witness``, all sibling digests from below to the root joined, and ``root``.

    ``place`` counts the nodes of a tree from 0 to ``size`` - 1; a null tree is a tree.
    Each round makes one node out of 3 ** ``levels``, so the number of rounds is tiny.
    """
    columns, block = nodes.columns, FAN**levels

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        made = Witnesses()
        for digest in rows.column("digest").to_pylist():
            made.append(digest)
        # a block that is one of several rises by all its levels, a lone one to its root
        size = rows.column("size")[0].as_py()
        top = made.finish(levels if size > block else height(size))
        witness = pa.array(["".join(w) for w in made.witness], pa.string())
        return rows.select(columns).append_column("witness", witness).append_column("top", pa.array([top] * len(rows), pa.string()))

    schema = ", ".join(f"`{c}` {t}" for c, t in nodes.dtypes) + ", witness string, top string"
    of_block = F.floor(F.col("place") / block)
    made = stored(nodes.groupBy("tree", of_block.alias("_block")).applyInArrow(build, schema), "witnesses")
    many = made.where((F.col("place") % block == 0) & (F.col("size") > block)).select(
        "tree", of_block.alias("place"), F.ceil(F.col("size") / block).alias("size"), F.col("top").alias("digest"))
    if many.isEmpty():
        return made.withColumnRenamed("top", "root")
    above = grow(many, levels).select(
        *tree_key(), F.col("place").alias("block"), F.col("witness").alias("more"), "root")
    joined = lookup_join(made.select("*", *tree_key(), of_block.alias("block")), above, ["no_tree", "name", "block"], how="left", derived=True)
    return joined.select(*columns, F.concat("witness", F.coalesce("more", F.lit(""))).alias("witness"),
                         F.coalesce("root", "top").alias("root"))


def tree_key(tree: str = "tree") -> list[Column]:
    """A null tree joins to itself."""
    return [F.col(tree).isNull().alias("no_tree"), F.coalesce(tree, F.lit("")).alias("name")]


def leaf(text: Column | None = None) -> Column:
    """Digest of a row: every column as its length in bytes, a colon and the value, or a
    hyphen where it is null."""
    values = [F.col(c).cast("string") if c != "text" or text is None else text for c in FIELDS]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def siblings_at(place: int, size: int) -> Iterator[tuple[int, int]]:
    """For each level up to the root: how many siblings stand left and right."""
    while size > 1:
        run, at = divmod(place, FAN)
        yield at, min(FAN, size - run * FAN) - at - 1
        place, size = run, -(-size // FAN)


def fold(digest: str, witness: str, path: list[tuple[int, int]]) -> str:
    """The root that follows from a leaf, its witness and the places of the siblings."""
    at = 0
    for left, right in path:
        a, b = at + 64 * left, at + 64 * (left + right)
        digest = join_digests([witness[at:a], digest, witness[a:b]])
        at = b
    return digest


def manifest(docs: DataFrame, check: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, source,
    leaf, place and size in the tree of its source, tree_place and trees in the tree of the
    sources, subroot, root, witness (64 characters for each sibling, up to the root), and
    check_leaf, the leaf that ``check`` in place of the text gives.

    Leaves of a source ascend by doc_id, a null one first; rows with one doc_id by their
    leaf, so repeated rows lie next to each other and each is a leaf. A null source is a
    source of its own and comes first, the others go by their bytes. Null columns count in
    the leaf as told in ``leaf``; extra columns don't. An empty table has no row.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").alias("tree"), leaf().alias("digest"),
                       leaf(F.col("text") if check is None else check).alias("check_leaf"), F.lit(1).cast("long").alias("one"))
    placed = numbered(rows, "tree", ["doc_id", "digest"], "one", "leaves").drop("one", "before")
    sizes = placed.groupBy("tree").agg(F.count(F.lit(1)).alias("size")).select(*tree_key(), "size")
    sized = lookup_join(placed.select("*", *tree_key()), sizes, ["no_tree", "name"], how="left", derived=True)
    leaves = stored(grow(sized.select("tree", "place", "size", "digest", "doc_id", "check_leaf"), levels), "manifest")
    roots = leaves.where("place = 0").select(
        F.lit("").alias("forest"), F.col("tree").alias("source"), F.col("root").alias("digest"), F.lit(1).cast("long").alias("one"))
    ordered = stored(numbered(roots, "forest", ["source"], "one", "roots"), "roots")
    size = F.lit(ordered.count()).cast("long").alias("size")
    top = grow(ordered.select(F.col("forest").alias("tree"), "place", size, "digest", "source"), levels)
    above = top.select(*tree_key("source"), F.col("place").alias("tree_place"), F.col("size").alias("trees"),
                       F.col("witness").alias("more"), F.col("root").alias("all_root"))
    joined = lookup_join(leaves.select("*", *tree_key()), above, ["no_tree", "name"], how="left", derived=True)
    return joined.select(
        "doc_id", F.col("tree").alias("source"), F.col("digest").alias("leaf"), "place", "size", "tree_place", "trees",
        F.col("root").alias("subroot"), F.col("all_root").alias("root"), F.concat("witness", "more").alias("witness"), "check_leaf")


def verified(entries: DataFrame) -> DataFrame:
    """``entries`` of a manifest with proof_sha256 (digest of the witness), folded_root (what
    check_leaf and the witness lead to) and verified (whether that is the root)."""
    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            folded = []
            for digest, witness, *at in zip(*(batch.column(c).to_pylist() for c in (
                    "check_leaf", "witness", "place", "size", "tree_place", "trees"))):
                path = [*siblings_at(at[0], at[1]), *siblings_at(at[2], at[3])]
                folded.append(fold(digest, witness, path))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(folded, pa.string())], [*batch.schema.names, "folded_root"])

    schema = ", ".join(f"{c} {t}" for c, t in entries.dtypes) + ", folded_root string"
    return entries.mapInArrow(work, schema).select(
        "*", F.sha2("witness", 256).alias("proof_sha256"), (F.col("folded_root") == F.col("root")).alias("verified"))


def tampered(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` held against a copy in which every document whose doc_id has
    an even checksum has lost its line feeds; a null doc_id has none and stays."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(F.coalesce(even, F.lit(False)), F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return verified(manifest(docs, text)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _climb(name: str, levels: int) -> str:
    """SQL for one tree: from ``name``_0 (tree, k, digest) and ``name``_leaf_0 (id, tree, k,
    fold, proof) up ``levels`` levels; a tree that has reached its root stays as it is."""
    steps = []
    for i in range(levels):
        steps.append(f"""
{name}_run_{i} AS MATERIALIZED (
  SELECT tree, k, digest, count(*) OVER (PARTITION BY tree) > 1 AS open,
         coalesce(string_agg(digest, '') OVER (PARTITION BY tree, k // 3 ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(digest, '') OVER (PARTITION BY tree, k // 3 ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM {name}_{i}),
{name}_{i + 1} AS MATERIALIZED (
  SELECT tree, k // 3 AS k, CASE WHEN any_value(open) THEN sha256(string_agg(digest, '' ORDER BY k)) ELSE any_value(digest) END AS digest
  FROM {name}_run_{i} GROUP BY tree, k // 3),
{name}_leaf_{i + 1} AS MATERIALIZED (
  SELECT id, l.tree, l.k // 3 AS k, CASE WHEN open THEN sha256(a || fold || b) ELSE fold END AS fold, proof || CASE WHEN open THEN a || b ELSE '' END AS proof
  FROM {name}_leaf_{i} l JOIN {name}_run_{i} r ON l.tree = r.tree AND l.k = r.k)""")
    return ",".join(steps)


def _sql(levels: int = 20, source_levels: int = 10) -> str:
    """The whole query in DuckDB's SQL, for up to 3 ** levels rows of a source."""
    def leaf_of(text: str) -> str:
        values = [f"{c}::VARCHAR" if c != "text" else text for c in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || ({v}), '-')" for v in values) + ")"

    # unsigned CRC-32 bit by bit over the decimal digits: DuckDB has no function for it
    crc = """list_reduce([4294967295::BIGINT] || list_transform(range(1, strlen(digits) + 1), lambda p: ascii(substring(digits, p, 1))::BIGINT),
      lambda c, x: list_reduce([xor(c, x)] || list_transform(range(8), lambda q: 0::BIGINT),
        lambda s, z: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END))"""
    return f"""
WITH numbered AS (
  SELECT row_number() OVER () AS id, *, xor({crc}, 4294967295) AS crc FROM (SELECT *, doc_id::VARCHAR AS digits FROM documents)),
leaves AS MATERIALIZED (
  SELECT id, doc_id, source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {leaf_of('text')} AS leaf,
         {leaf_of("(CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS other
  FROM numbered),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM leaves),
t_0 AS MATERIALIZED (SELECT tree, k, leaf AS digest FROM placed),
t_leaf_0 AS MATERIALIZED (SELECT id, tree, k, other AS fold, '' AS proof FROM placed),{_climb('t', levels)},
s_0 AS MATERIALIZED (SELECT 0 AS tree, tree AS k, digest FROM t_{levels}),
s_leaf_0 AS MATERIALIZED (SELECT id, 0 AS tree, tree AS k, fold, proof FROM t_leaf_{levels}),{_climb('s', source_levels)}
SELECT doc_id, leaf, t_{levels}.digest AS subroot, s_{source_levels}.digest AS root, sha256(proof) AS proof_sha256,
       fold AS folded_root, fold = s_{source_levels}.digest AS verified
FROM placed JOIN s_leaf_{source_levels} USING (id) JOIN t_{levels} ON placed.tree = t_{levels}.tree CROSS JOIN s_{source_levels}
"""


MANIFEST_SQL = _sql()
