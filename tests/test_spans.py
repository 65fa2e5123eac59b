"""Moments in disjoint spans, against plain loops, by blocks and by merging."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tickloom.operators import pointintime
from tickloom.operators import spans as sp

S = 10**9


def made(seed, unit):
    """Disjoint spans of some keys, with gaps, shared edges and open ends, and moments around them."""
    rnd = random.Random(seed)
    spans, rows = [], []
    for key in ["a", "b", "c", "d"]:
        at = sorted(rnd.sample(range(-50, 3000), 40))
        edges = [x * unit for x in at]
        for i in range(0, 38, 1 if key == "b" else 2):
            spans.append((key, edges[i], edges[i + 1], f"{key}{i}"))
        if key == "c":
            spans.append((key, None, edges[0], "from ever"))
        if key == "d":
            spans.append((key, edges[39], None, "for ever"))
        rows += [(key, rnd.choice(edges) + rnd.choice([-1, 0, 1, unit // 2])) for _ in range(150)] + [(key, -10**18), (key, 4 * 10**18), (key, None)]
    rows += [("none", 5), (None, 5), (None, None)]
    return spans, [(*r, i) for i, r in enumerate(rows)]


def holding(spans, key, at):
    if key is None or at is None:
        return None
    return next((v for k, a, b, v in spans if k == key and (a is None or a <= at) and (b is None or at < b)), None)


@pytest.mark.parametrize("unit", [1, 60 * S, 86_400 * S])
@pytest.mark.parametrize("limit,rows,few", [(None, None, 64), (None, None, 0), (-1, None, 64), (-1, 7, 0)])
def test_spans_hold_their_moments(spark, unit, limit, rows, few):
    spans, moments = made(unit % 97, unit)
    df = spark.createDataFrame(moments, "k string, t bigint, id bigint").repartition(3)
    table = spark.createDataFrame(spans, "k string, _from bigint, _to bigint, v string")
    out = sp.span_join(df, table, ["k"], "t", broadcast_bytes=limit, rows_per_segment=rows, few=few)
    assert out.columns == ["k", "t", "id", "v"]
    got = out.collect()
    assert len(got) == len(moments)
    assert {r["id"]: r["v"] for r in got} == {i: holding(spans, k, t) for k, t, i in moments}


def test_no_spans_and_unbounded_ones(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, t bigint")
    schema = "k string, _from bigint, _to bigint, v string"
    none = sp.span_join(df, spark.createDataFrame([], schema), ["k"], "t")
    assert none.columns == ["k", "t", "v"] and none.where("v is null").count() == 3
    ever = sp.span_join(df, spark.createDataFrame([("a", None, None, "x")], schema), ["k"], "t")
    assert sorted(map(str, ever.collect())) == sorted(map(str, spark.createDataFrame([("a", 1, "x"), ("b", 2, None), (None, 3, None)], "k string, t bigint, v string").collect()))


def test_many_versions_of_one_key(spark):
    """10^5 spans of a key: a row meets one block a level and no range over all versions."""
    n = 100_000
    table = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 60 * S).alias("_from"), ((F.col("id") + 1) * 60 * S).alias("_to"), F.col("id").alias("v"))
    df = spark.range(5_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 * 60 * S % (n * 60 * S) + 1).alias("t"))
    out = sp.span_join(df, table, ["k"], "t")
    assert out.where(F.col("v") != F.floor(F.col("t") / (60 * S))).count() == 0 and out.where("v is null").count() == 0
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString()
    join = re.search(r"BroadcastHashJoin (.*)", text)[1]
    assert "<" not in join.replace("<=>", "") and "SortMergeJoin" not in text  # equal numbers alone
    graph = out._jdf.queryExecution().executedPlan()

    def rows_out(node):
        found = [node.metrics().get("numOutputRows").get().value()] if "BroadcastHashJoin" in node.nodeName() else []
        if node.nodeName() == "AdaptiveSparkPlan":
            return rows_out(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return rows_out(node.plan())
        kids = node.children()
        return found + [x for i in range(kids.size()) for x in rows_out(kids.apply(i))]
    # a coverage of unit spans has two levels at most besides the key's own
    assert max(rows_out(graph)) <= 20 * 5_000


def test_a_span_is_at_most_two_blocks_a_level(spark):
    rnd = random.Random(4)
    spans = [(i, *sorted(rnd.sample(range(5_000), 2))) for i in range(200)]
    df = spark.createDataFrame([(i, a, b, True, str(i)) for i, a, b in spans], "k bigint, _a bigint, _b bigint, _in boolean, v string")
    held = {}
    for r in sp.cover(df, ["k"], ["v"], 5_000).where("_level >= 0").collect():
        held.setdefault(r["k"], []).append((r["_level"], r["_block"]))
    for i, a, b in spans:
        cells = sorted(c for level, block in held[i] for c in range(block << level, (block + 1) << level))
        assert cells == list(range(a, b))
        assert max(sum(1 for x, _ in held[i] if x == level) for level, _ in held[i]) <= 2


@pytest.mark.parametrize("limit", [0, 2_000, None])
def test_factors_of_other_securities_are_left_out(spark, monkeypatch, limit):
    """Beyond the broadcast limit no block is made, and only traded securities are folded."""
    days = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 40).cast("int") * 9)
    factors = spark.range(4_000).select((F.col("id") % 400).alias("security_id"), days.alias("ex_date"), F.lit(0.5).alias("factor"))
    df = spark.range(60).select((F.col("id") % 6).alias("security_id"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
                                F.lit(1.0).alias("price")).unionByName(spark.createDataFrame([(None, None, 1.0)], "security_id bigint, day date, price double"))
    want = {(r["security_id"], r["day"]): r["adjustment"] for r in pointintime.back_adjust(df, factors, "day").collect()}
    assert len(want) == 61 and len(set(want.values())) > 1
    made, folded, fold, cover = [], [], pointintime.adjustment_spans, sp.cover
    monkeypatch.setattr(sp, "cover", lambda *a: made.append(1) or cover(*a))
    monkeypatch.setattr(pointintime, "adjustment_spans", lambda f, *a: folded.append(f.select("security_id").distinct().count()) or fold(f, *a))
    out = pointintime.back_adjust(df, factors, "day", broadcast_bytes=limit)
    assert {(r["security_id"], r["day"]): r["adjustment"] for r in out.collect()} == want
    assert folded == [6 if limit == 2_000 else 400] and not made
