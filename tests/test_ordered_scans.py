"""Ordered operators against plain loops, with tiny segments and a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import asof, bars, ordering, quality
from tickloom.operators import segments as sg

S = 1_000_000_000
SCHEMA = "instrument_id bigint, ts_recv bigint, sequence bigint, flags int, price bigint, size bigint, kind int"


def feed(seed, n=300):
    rnd = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += rnd.choice([0, 1, S // 3, S, 45 * S, 4000 * S, 90_000 * S])
        rows.append((0 if rnd.random() < 0.4 else rnd.randrange(5), t, i, rnd.choice([0, 8, 32, 128, 160]),
                     rnd.randrange(1, 10**9), rnd.randrange(1, 9), rnd.randrange(2)))
    return rows


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rows = feed(request.param)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("target", [None, 3])
def test_event_ordinal(case, target):
    rows, df = case
    want = {}
    for part in by_key(rows).values():
        done = 0
        for r in part:
            want[r[2]] = done
            done += bool(r[3] & 128)
    got = quality.event_ordinal(df, rows_per_segment=target)
    assert {r["sequence"]: r["event_no"] for r in got.collect()} == want


@pytest.mark.parametrize("target", [None, 3])
def test_snapshot_ends(case, target):
    rows, df = case
    want = {b[2] for p in by_key(rows).values() for a, b in zip(p, p[1:]) if a[3] & 32 and not b[3] & 32}
    assert {r["sequence"] for r in quality.snapshot_ends(df, rows_per_segment=target).collect()} == want


@pytest.mark.parametrize("target", [None, 3])
def test_silences(case, target):
    rows, df = case
    want = sorted((k, a[1], b[1]) for k, p in by_key(rows).items() for a, b in zip(p, p[1:]) if b[1] - a[1] > 40 * S)
    got = quality.silences(df, ["instrument_id"], rows_per_segment=target).collect()
    assert sorted((r["instrument_id"], r["gap_start"], r["gap_end"]) for r in got) == want


@pytest.mark.parametrize("target", [None, 3])
def test_clock_faults(spark, target):
    rnd = random.Random(5)
    rows = [(rnd.randrange(3), i * S + rnd.randrange(-4, 4) * S, i, rnd.choice([0, 0, 8]), 1, 1, 0) for i in range(200)]
    want, top = {}, {}
    for r in rows:
        late = r[0] in top and r[1] < top[r[0]]
        if late or r[3] & 8:
            want[r[2]] = top[r[0]] - r[1] if late else 0
        top[r[0]] = max(top.get(r[0], r[1]), r[1])
    df = spark.createDataFrame(rows, SCHEMA)
    got = quality.clock_faults(df, ["instrument_id"], rows_per_segment=target).collect()
    assert {r["sequence"]: r["behind_ns"] for r in got} == want


@pytest.mark.parametrize("target", [None, 3])
def test_prevailing_quote(case, target):
    rows, df = case
    want = {}
    for part in by_key(rows).values():
        for r in part:
            if r[6] == 1:
                seen = [q for q in part if q[6] == 0 and q[1] <= r[1]]
                want[r[2]] = max(seen, key=lambda q: (q[1], q[2]))[4] if seen else None
    quotes = df.where("kind = 0").select("instrument_id", "ts_recv", "sequence", F.col("price").alias("bid"))
    trades = df.where("kind = 1").select("instrument_id", "ts_recv", "sequence")
    got = asof.prevailing_quote(trades, quotes, ["bid"], rows_per_segment=target).collect()
    assert {r["sequence"]: r["bid"] for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("target", [None, 3])
def test_row_numbers_and_chunks(case, target):
    rows, df = case
    order = sorted(rows, key=lambda r: (r[1], r[0], r[2]))
    got = {r["sequence"]: (r["row_no"], r["chunk_id"]) for r in ordering.chunk_ids(df, 7, rows_per_segment=target).collect()}
    assert got == {r[2]: (i, i // 7) for i, r in enumerate(order)}
    with pytest.raises(ValueError):
        ordering.chunk_ids(df, 0)


@pytest.mark.parametrize("target", [None, 2])
def test_filled_samples(spark, target):
    rnd = random.Random(9)
    rows = [(rnd.randrange(2), rnd.randrange(0, 400) * S + i, i, 0, 1, 1, 0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("bid", F.col("sequence") * 10)
    w = 60 * S
    want = {}
    for k, part in by_key(rows).items():
        last = {}
        for r in part:
            last[(r[1] // w + 1) * w] = r[2] * 10
        first, end = min(last), max(last)
        held = None
        for b in range(first, end + 1, w):
            held = last.get(b, held)
            want[k, b] = held
    got = bars.sample_quotes(df, "1m", ("instrument_id",), values=("bid",), forward_fill=True, rows_per_segment=target)
    assert {(r["instrument_id"], r["ts_recv"]): r["bid"] for r in got.collect()} == want


@pytest.mark.parametrize("width", ["1s", "1m", "1d"])
def test_bars(case, width):
    rows, df = case
    w = bars.WIDTHS[width]
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault((r[0], r[1] - r[1] % w), []).append(r)
    want = {k: (g[0][4], max(x[4] for x in g), min(x[4] for x in g), g[-1][4], sum(x[5] for x in g)) for k, g in groups.items()}
    got = bars.ohlcv(df, width, ("instrument_id",), ts="ts_recv").collect()
    assert {(r["instrument_id"], r["ts_event"]): (r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in got} == want


def test_bars_skip_null_prices_and_take_wide_sequences(spark):
    df = spark.createDataFrame([(1, 5, 1, 0, 2**63 - 1, 4, 0), (1, 6, 2, 0, 10, 3, 0)], SCHEMA)
    row = bars.ohlcv(df, "1s", ("instrument_id",), ts="ts_recv").first()
    assert (row["open"], row["volume"]) == (10, 3)
    wide = spark.createDataFrame([(1, 5, 2**33, 0, 10, 4, 0)], SCHEMA)
    assert bars.ohlcv(wide, "1s", ("instrument_id",), ts="ts_recv").first()["open"] == 10


def test_segments_of_a_burst_stay_small(spark):
    """Half of all rows lie in one second of one key, next to many small keys and empty ones."""
    n, target = 40_000, 1_000
    i = F.col("id")
    df = spark.range(n).select(
        F.when(i % 2 == 0, F.lit(-1)).when(i % 11 == 0, F.lit(None)).otherwise(i % 300).alias("k"),
        F.when(i % 2 == 0, 10**15 + i * 17).otherwise(i * S).alias("t"))
    cut = sg.segmented(df, ["k"], "t", target)
    counts = cut.groupBy("k", sg.SEGMENT).agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("b")).collect()
    assert max(r["n"] for r in counts) <= 2 * target
    assert len([r for r in counts if r["k"] == -1]) >= 12 and len([r for r in counts if r["k"] is None]) > 1
    assert {r[sg.SEGMENT] for r in counts if r["k"] not in (-1, None)} == {0}
    for k in (-1, None):
        own = sorted((r[sg.SEGMENT], r["a"], r["b"]) for r in counts if r["k"] == k)
        assert all(x[2] < y[1] for x, y in zip(own, own[1:]))
    whole = sg.segmented(df, [], "t", target).groupBy(sg.SEGMENT).count()
    assert whole.agg(F.max("count")).first()[0] <= 2 * target


def test_many_cut_points_are_looked_up_by_run(spark):
    cuts = F.array(*[F.array(*[F.lit(j * 10) for j in range(i, min(i + sg.STEP, 150))]) for i in range(0, 150, sg.STEP)])
    got = spark.range(0, 1600).select("id", sg.place(cuts, F.col("id")).alias("n")).collect()
    assert all(r["n"] == min(r["id"] // 10 + 1, 150) for r in got)


@pytest.mark.parametrize("run", [
    lambda df: quality.event_ordinal(df), lambda df: quality.snapshot_ends(df), lambda df: quality.silences(df, ["instrument_id"]),
    lambda df: quality.clock_faults(df, ["instrument_id"]), lambda df: asof.prevailing_quote(df.drop("price"), df, ["price"])])
def test_ordered_scans_start_no_job_of_their_own(spark, case, run):
    _, df = case
    spark.sparkContext.setJobGroup("ordered", "plans only")
    try:
        run(df)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("ordered")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_gaps_are_filled_in_stretches(spark):
    df = spark.createDataFrame([(1, 5 * S, 0, 7), (1, 20_000 * S, 1, 8)], "instrument_id bigint, ts_recv bigint, sequence bigint, bid bigint")
    got = bars.sample_quotes(df, "1s", keys=["instrument_id"], values=["bid"], forward_fill=True)
    assert got.count() == 19_996 and got.where("bid = 8").count() == 1 and got.select("ts_recv").distinct().count() == 19_996


def test_lag_flag(spark):
    def full(n, span):
        df = spark.range(n).select((F.col("id") * F.lit(span) / F.lit(max(n - 1, 1))).cast("bigint").alias("ts_recv"))
        return quality.lag_flag(df).first()["is_full"]

    assert not full(128, 5 * S)
    assert full(130, 5 * S)
    assert not full(130, S // 2)
    assert full(1_048_577, 10)


def test_reconnect_gap_of_an_empty_session(spark):
    log = spark.createDataFrame([("d", 10 * S, 15 * S), ("d", 20 * S, None), ("d", 26 * S, 30 * S)],
                                "dataset string, session_start bigint, last_ts bigint")
    for target in (None, 1):
        gaps = quality.reconnect_gaps(log, rows_per_segment=target).orderBy("gap_end").collect()
        assert [(r["gap_start"] // S, r["gap_end"] // S, r["gap_seconds"]) for r in gaps] == [(15, 20, 5.0), (20, 26, 6.0)]


def test_replay_in_order_and_errors(case):
    rows, df = case
    seen = []
    ordering.replay(df, lambda r: seen.append(r["sequence"]))
    assert seen == [r[2] for r in sorted(rows, key=lambda r: (r[1], r[0], r[2]))]
    with pytest.raises(ZeroDivisionError):
        ordering.replay(df, lambda r: 1 // 0)


def test_replay_by_key(case):
    rows, df = case

    def first_differences(batches):
        import pandas as pd
        last = {}
        for pdf in batches:
            out = []
            for k, t in zip(pdf.instrument_id, pdf.ts_recv):
                out.append(t - last.get(k, t))
                last[k] = t
            yield pd.DataFrame({"sequence": pdf.sequence, "step": out})

    got = {r["sequence"]: r["step"] for r in ordering.replay_by_key(df, first_differences, "sequence bigint, step bigint").collect()}
    want = {}
    for part in by_key(rows).values():
        for i, r in enumerate(part):
            want[r[2]] = r[1] - part[i - 1][1] if i else 0
    assert got == want


def test_a_task_holds_few_rows_of_a_scan(spark):
    """2.5 million rows without keys are more than two segments, none far above a million."""
    df = spark.range(2_500_000).select((F.col("id") * 1_000).alias("ts_recv"))
    sizes = [r["count"] for r in sg.segmented(df, (), "ts_recv").groupBy(sg.SEGMENT).count().collect()]
    assert sum(sizes) == 2_500_000 and len(sizes) >= 3 and max(sizes) <= 1_500_000
