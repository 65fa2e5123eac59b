"""Mixing sources to target weights.

Every document gets a key by hash. Inside its source the documents are sorted by
that key, their sizes are added up along the order, and the source is cut where its
budget of words ends. A budget above the size of the source repeats it: first whole
passes, then the part before the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import running_start, stored, word_count
from tickloom.operators.joins import lookup_join

#: Hexadecimal digits of the key that make a range: 4,096 ranges for each source.
RANGE_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """Targets for ``sizes`` (src, source_size), one row per source.

    Sources in the order of ``src`` take ``weights`` in turn and share ``share`` times
    the sum of all sizes. None gets more than ``most`` times its size; what is over
    goes to the others by weight. With the sources sorted by ``most * size / weight``
    the ones that stop come first, and the level of the others follows from sums.
    """
    rank = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sizes.select("src", "source_size", weight.alias("weight"))
    by_stop = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = Window.partitionBy()
    level = (
        F.lit(share) * F.sum("source_size").over(total)
        - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level)
    free = F.col("level") * F.col("weight") <= most * F.col("source_size")
    cut = F.min(F.when(free, F.struct(F.col("source_size") / F.col("weight"), "src", "level"))).over(total)["level"]
    stop = (most * F.col("source_size")).cast("double")
    return levels.withColumn("cut", cut).select(
        "src", "source_size",
        F.when(F.col("cut").isNull() | (F.col("cut") * F.col("weight") > stop), stop)
        .otherwise(F.col("cut") * F.col("weight")).alias("target"),
    )


def _keyed(docs: DataFrame, size: Column | None) -> DataFrame:
    """``docs`` with the name of the source that sorts null last, the size and the key."""
    return docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source")).alias("src"),
        (word_count(F.col("text")) if size is None else size).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"),
    )


def _placed(docs: DataFrame, size, weights, share, most) -> DataFrame:
    thin = stored(_keyed(docs, size).select(
        F.col("doc.doc_id").alias("doc_id"), "src", "size", "key", F.substring("key", 1, RANGE_DIGITS).alias("range")), "mix")
    targets = source_targets(thin.groupBy("src").agg(F.sum("size").alias("source_size")), weights, share, most)
    budget = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("passes", passes).withColumn("rest", budget - F.col("passes") * F.col("source_size"))
    return running_start(thin, ["src"], "range", ["key", "doc_id", "size"], "size", "start").join(targets, "src")


def mix(docs: DataFrame, size: Column | None = None, weights: Sequence[int] = (3, 1, 2), share: float = 1.5,
        most: int = 2) -> DataFrame:
    """For each row of ``docs`` (doc_id, text, source): doc_id, size, source_size,
    target, start (words of its source before it in the order of the keys) and taken.

    ``taken`` counts words with repeats; its sum over a source is the target rounded
    to a whole word, so the document at the cut is taken in part. A null text has size
    0, a null source is a source of its own and comes last, a null ``doc_id`` sorts by
    the key of the empty string, equal rows take places next to each other. Of the
    input only the ids, sources and sizes are kept.
    """
    part = F.least(F.col("size"), F.greatest(F.col("rest") - F.col("start"), F.lit(0)))
    return _placed(docs, size, weights, share, most).select(
        "doc_id", "size", "source_size", "target", "start",
        (F.col("passes") * F.col("size") + part).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, size: Column | None = None, weights: Sequence[int] = (3, 1, 2),
                    share: float = 1.5, most: int = 2) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as often as it is taken, whole.

    The document at a source's cut counts as taken if at least half of it is. Texts do
    not move: every row is held against the key at which its source is cut. A document
    without words adds nothing to a mix and is not taken.
    """
    placed = _placed(docs, size, weights, share, most)
    at_cut = (F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("size"))
    cuts = stored(placed.where(at_cut).groupBy("src").agg(F.min(F.struct("key", "size", "start", "rest", "passes")).alias("cut")), "cuts")
    rows = lookup_join(_keyed(docs, size), cuts, ["src"], how="inner").where("size > 0")
    here, cut = F.struct("key", "size"), F.struct(F.col("cut.key").alias("key"), F.col("cut.size").alias("size"))
    copy = F.row_number().over(Window.partitionBy("src").orderBy("key")) - 1
    begin = F.col("cut.start") + copy * F.col("size")
    sure = rows.where(here != cut).withColumn("times", F.col("cut.passes") + (here < cut).cast("int"))
    edge = rows.where(here == cut).withColumn(
        "times", F.col("cut.passes") + (2 * (F.col("cut.rest") - begin) >= F.col("size")).cast("int"))
    every = sure.unionByName(edge).where("times > 0")
    return every.select("doc", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("doc.*")


#: The same in DuckDB's SQL over the table ``documents``.
MIX_SQL = """
WITH sized AS (
  SELECT doc_id, coalesce('0' || source, '1') AS src, md5(coalesce(doc_id::VARCHAR, '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
ranked AS (
  SELECT src, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY src) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY src),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, src
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY source_size / weight, src
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
cut AS (
  SELECT arg_min(level, (source_size / weight, src)) AS level FROM levels WHERE level * weight <= 2 * source_size),
targets AS (
  SELECT src, source_size, CASE WHEN cut.level IS NULL OR cut.level * weight > 2 * source_size
                                THEN (2 * source_size)::DOUBLE ELSE cut.level * weight END AS target
  FROM levels CROSS JOIN cut),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(round(target) / source_size)::BIGINT ELSE 0 END AS passes,
         round(target)::BIGINT AS budget FROM targets),
placed AS (
  SELECT doc_id, size, source_size, target, passes, budget - passes * source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY src ORDER BY key, doc_id NULLS FIRST, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN budgets USING (src))
SELECT doc_id, size, source_size, target, start,
       (passes * size + least(size, greatest(rest - start, 0)))::BIGINT AS taken
FROM placed
"""
