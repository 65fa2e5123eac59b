"""Places and running sums inside groups of any size, by a range sort and one carry a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import buckets_for, stored


def numbered(df: DataFrame, group: str, order: Sequence[str], weight: str, purpose: str = "numbered") -> DataFrame:
    """``df`` with ``place``, the number of rows of the same ``group`` before the row, and
    ``before``, the sum of their ``weight`` (a long).

    Rows come in the order of ``order``, nulls first; equal rows lie next to each other. A
    null group is a group. The whole table is range-sorted, so a group of any size spreads
    over tasks. Only the first group of a task can have begun in an earlier one, hence what
    is handed over is at most one row a task.
    """
    spark = df.sparkSession
    keys = [group, *order, "_row"]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    sorted_rows = rows.repartitionByRange(buckets_for(spark), *keys).sortWithinPartitions(*keys).drop("_row")
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()),
                           T.StructField("place", T.LongType()), T.StructField("before", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]):
        part, last, place, before = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(group)
            codes = values.dictionary_encode(null_encoding="encode").indices.to_numpy()
            weights = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            begins = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1))
            if last is not None and last[0] == values[0].as_py():
                first_place, first_before = place, before
            else:
                first_place = first_before = 0
            lengths = np.diff(np.append(begins, len(codes)))
            sums = np.cumsum(weights) - weights
            offset = np.repeat(begins, lengths)
            places, befores = np.arange(len(codes)) - offset, sums - sums[offset]
            places[:lengths[0]] += first_place
            befores[:lengths[0]] += first_before
            last, place, before = (values[-1].as_py(),), int(places[-1]) + 1, int(befores[-1] + weights[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(codes), part, np.int32)), pa.array(places), pa.array(befores)],
                [*batch.schema.names, "part", "place", "before"])

    table = stored(sorted_rows.mapInArrow(count, schema), purpose)
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        table.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
        .select(F.col(group).alias("_group"), F.col("part").alias("_part"), F.sum("n").over(earlier).alias("_n"),
                F.sum("w").over(earlier).alias("_w"))
        .where("_n > 0")
    )
    # at most one row for each task of the sort
    joined = table.join(F.broadcast(carry), (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")), "left")
    return joined.select(*df.columns, (F.col("place") + F.coalesce("_n", F.lit(0))).alias("place"),
                         (F.col("before") + F.coalesce("_w", F.lit(0))).alias("before"))
