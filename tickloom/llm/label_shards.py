"""Shards of equal row counts by balanced label propagation, in DataFrame functions alone.

Documents with equal texts are linked. Members of such a group are interchangeable, so the
state is one row per group and shard with a count. In each round the members of a group
in one shard ask to move to the shard that holds most of the group. Pairs of shards
exchange what asks to go both ways, and a shard with room takes more, the largest groups
first; how much passes between two shards is an 8 by 8 table on the driver, and prefix
sums over the requests decide which pass. A move only ever goes to a shard with more
of the group, so every one lowers the number of cut links. Where such moves end, the
groups that are still cut get new labels together and the rounds go on. Documents without
links fill the shards up to even counts at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import running_start, stored

LAW = "rows"
#: Ranges in which prefix sums are taken.
RANGES = 1024


def _spread(groups: DataFrame, shards: int) -> DataFrame:
    """(cls, shard, n) with the members of all groups dealt out in turn."""
    placed = running_start(groups, [], "range", ["cls"], "n", "start")
    turn = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    each = placed.select("cls", "n", "start", turn)
    # how many of start .. start + n - 1 leave the remainder shard
    first = F.pmod(F.col("shard") - F.col("start"), F.lit(shards))
    count = F.greatest(F.floor((F.col("n") - first + shards - 1) / shards), F.lit(0)).cast("long")
    return each.select("cls", F.col("shard").cast("int"), count.alias("n")).where("n > 0")


def _requests(state: DataFrame, targets: list[int]) -> DataFrame:
    """(cls, s, t, n, range): members in shard s that ask for the group's fullest shard
    t of ``targets``."""
    group = Window.partitionBy("cls")
    # equal counts go one way by a hash, so that in sum about as many pass each way
    full = F.struct("n", F.xxhash64("cls", "shard").alias("tie"), "shard")
    best = F.max(F.when(F.col("shard").isin(targets), full)).over(group)
    asking = state.withColumn("best", best).where(full < F.col("best"))
    size = (63 - F.floor(F.log2(F.col("best.n").cast("double")))).cast("long")  # large groups come first
    return asking.select("cls", F.col("shard").alias("s"), F.col("best.shard").alias("t"), "n",
                         (size * RANGES + F.pmod(F.xxhash64("cls"), F.lit(RANGES))).alias("range"))


def _passes(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Rows that may pass between each two shards: exchanges, then what there is room for."""
    allowed = {(s, t): min(n, asked.get((t, s), 0)) for (s, t), n in asked.items()}
    left = list(room)
    for (s, t), n in sorted(asked.items()):
        more = max(0, min(n - allowed[s, t], left[t]))
        allowed[s, t] += more
        left[t] -= more
    return allowed


def _held(state: DataFrame, shards: int) -> list[int]:
    held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [held.get(t, 0) for t in range(shards)]


def _rounds(state: DataFrame, shards: int, capacity: int) -> DataFrame:
    """Rounds of moves until two in a row move nothing. Every move lowers the number of
    cut links, so they come to an end."""
    idle = turn = 0
    while idle < 2:
        room = [max(0, capacity - n) for n in _held(state, shards)]
        open_ = [t for t in range(shards) if room[t]]
        # in turn to any shard, by exchange, and to the ones with room
        asking = stored(_requests(state, list(range(shards)) if turn % 2 == 0 else open_), "requests") if open_ or turn % 2 == 0 else None
        asked = {} if asking is None else {(r["s"], r["t"]): r["n"] for r in asking.groupBy("s", "t").agg(F.sum("n").alias("n")).collect()}
        passes = {k: n for k, n in _passes(asked, room).items() if n}
        turn += 1
        if not passes:
            idle += 1
            continue
        idle = 0
        table = F.array(*[F.lit(passes.get((s, t), 0)).cast("long") for s in range(shards) for t in range(shards)])
        allowed = F.element_at(table, F.col("s") * shards + F.col("t") + 1)
        moved = running_start(asking, ["s", "t"], "range", ["cls"], "n", "start").withColumn(
            "m", F.greatest(F.least(F.col("n"), allowed - F.col("start")), F.lit(0))).where("m > 0")
        changes = moved.select("cls", F.explode(F.array(
            F.struct(F.col("s").alias("shard"), (-F.col("m")).alias("n")), F.struct(F.col("t").alias("shard"), F.col("m").alias("n")))).alias("c"))
        state = stored(state.unionByName(changes.select("cls", "c.*")).groupBy("cls", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "shards")
    return state


def _chosen(value: Column, bounds: list) -> Column:
    """The first of ``bounds`` above ``value``, by its number; the last one for the rest."""
    out = F.lit(len(bounds) - 1)
    for t in reversed(range(len(bounds) - 1)):
        out = F.when(value < bounds[t], t).otherwise(out)
    return out


def _laid_again(state: DataFrame, shards: int, capacity: int) -> DataFrame | None:
    """``state`` with new labels for the groups that are cut though they fit a shard.

    Where no single move and no equal exchange helps, these groups are taken up together
    and laid along the room that the others leave, the largest first. Each gets the label
    of the shard in which its middle falls; what a shard can't hold goes where room is left.
    """
    per = state.groupBy("cls").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"))
    size = (63 - F.floor(F.log2(F.col("n").cast("double")))).cast("long")
    ranked = per.where((F.col("parts") > 1) & (F.col("n") <= capacity)).select(
        "cls", "n", (size * RANGES + F.pmod(F.xxhash64("cls"), F.lit(RANGES))).alias("range"))
    stuck = stored(ranked, "stuck")
    rows = stuck.agg(F.sum("n")).first()[0]
    if not rows:
        return None
    fixed = stored(state.join(stuck.select("cls"), "cls", "left_anti"), "fixed")
    room = [max(0, capacity - n) for n in _held(fixed, shards)]
    ends = [sum(room[:t + 1]) * rows / max(1, sum(room)) for t in range(shards)]
    laid = running_start(stuck, [], "range", ["cls"], "n", "start").withColumn("shard", _chosen(F.col("start") + F.col("n") / 2, ends))
    placed = running_start(stored(laid.drop("start"), "laid"), ["shard"], "range", ["cls"], "n", "start")
    fits = F.greatest(F.least(F.col("n"), F.element_at(F.array(*[F.lit(n).cast("long") for n in room]), F.col("shard") + 1) - F.col("start")), F.lit(0))
    placed = stored(placed.select("cls", "shard", "range", fits.alias("n"), (F.col("n") - fits).alias("over")), "laid")
    kept = placed.where("n > 0").select("cls", "shard", "n")
    left = [max(0, a - b) for a, b in zip(room, _held(kept, shards))]
    over = placed.where("over > 0").select("cls", "range", F.col("over").alias("n"))
    short = (over.agg(F.sum("n")).first()[0] or 0) - sum(left)
    left = [n + (t < short) for t, n in enumerate(left)]  # the rows that are over when all shards are full
    each = running_start(stored(over, "over"), [], "range", ["cls"], "n", "start")
    parts = []
    for t in range(shards):
        part = F.least(F.col("start") + F.col("n"), F.lit(sum(left[:t + 1]))) - F.greatest(F.col("start"), F.lit(sum(left[:t])))
        parts.append(F.struct(F.lit(t).alias("shard"), part.cast("long").alias("n")))
    rest = each.select("cls", F.explode(F.array(*parts)).alias("p")).select("cls", "p.*").where("n > 0")
    every = fixed.unionByName(kept).unionByName(rest).groupBy("cls", "shard").agg(F.sum("n").alias("n"))
    return stored(every.select("cls", F.col("shard").cast("int"), "n"), "shards")


def propagate(groups: DataFrame, shards: int, capacity: int) -> tuple[DataFrame, list[int]]:
    """Stored (cls, shard, n) for ``groups`` (cls, n, range), and the rows in each shard.

    Rounds of moves end where no move helps. Groups that are still cut then get new labels
    all at once, and the rounds go on from there, as long as that cuts fewer links.
    """
    def whole(found: DataFrame) -> int:  # grows as fewer links are cut
        return int(found.agg(F.sum(F.col("n").cast("decimal(38,0)") * F.col("n"))).first()[0] or 0)

    state = _rounds(stored(_spread(groups, shards), "shards"), shards, capacity)
    best = whole(state)
    while (again := _laid_again(state, shards, capacity)) is not None:
        again = _rounds(again, shards, capacity)
        now = whole(again)
        if now <= best:
            break
        state, best = again, now
    return state, _held(state, shards)


def shard_rows(docs: DataFrame, shards: int = 8) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot,
    grown_shard.

    Counts of rows differ by one at most. A null text is an empty one, so such rows are
    linked to each other; a group larger than a shard fills one and goes on in others;
    repeated rows are members of a group like any other. ``slot`` numbers the rows of a
    shard without gaps. ``grown_shard`` is null under this law.
    """
    spark: SparkSession = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    thin = stored(docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("cls")).withColumn("row", F.monotonically_increasing_id()), "rows")
    thin = thin.withColumn("range", F.pmod(F.xxhash64("row"), F.lit(RANGES)))
    total = thin.count()
    groups = stored(thin.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .withColumn("range", F.pmod(F.xxhash64("cls"), F.lit(RANGES))), "groups")
    state, held = propagate(groups, shards, total // shards)
    # the shards with most linked rows take the rows that are over
    over = sorted(range(shards), key=lambda t: -held[t])[: total % shards]
    lacking = [total // shards + (t in over) - held[t] for t in range(shards)]

    until = F.sum("n").over(Window.partitionBy("cls").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    parts = state.withColumn("until", until).groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("until", "shard"))).alias("parts"))
    parts = stored(parts, "parts")
    one = F.lit(1).alias("one")
    linked = stored(thin.select("*", one).join(groups.select("cls"), "cls", "left_semi"), "linked")
    ranked = running_start(linked, ["cls"], "range", ["row"], "one", "rank").join(parts, "cls")
    own = F.element_at(F.filter("parts", lambda p: p["until"] > F.col("rank")), 1)["shard"]
    alone = stored(thin.select("*", one).join(groups.select("cls"), "cls", "left_anti"), "alone")
    filled, end = F.when(F.lit(False), -1), 0
    for t, n in enumerate(lacking):
        end += n
        filled = filled.when(F.col("rank") < end, t)
    columns = ["doc_id", "size", "text_crc32", "row", "range", "shard", "one"]
    every = stored(ranked.withColumn("shard", own).select(columns).unionByName(
        running_start(alone, [], "range", ["row"], "one", "rank").withColumn("shard", filled).select(columns)), "sharded")
    return running_start(every, ["shard"], "range", ["row"], "one", "slot").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
