"""Balanced label propagation over linked documents.

Documents with equal texts are linked. Every linked document starts in a shard by its
hash; in each round a group's members move to the shard that can hold most of them, and
of equals the one where most of them are, as far as the quota of that shard has room:
a part of them if not all fit. Room is what the quota leaves and what the shard's own
members want to leave, so that full shards exchange members; a shard that others did not
relieve holds too many for a while, and takes fewer in the next round. The last
``STRICT`` of the ``rounds`` rounds count free room alone. Groups with most members in place come
first. Rounds are joins and aggregations of small rows (group, shard, count), not of documents. Documents
without links, and members that no quota could take, then fill the shards up, so that
the counts are at most one apart (the ``rows`` law).

A group larger than nine tenths of a shard is split into blocks first: it has to be cut
anyway. Its blocks are as large as the room that smaller groups leave in a shard, at least
a quarter of that; a smaller group is one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.textops import materialize, running_total, slim

SHARDS = 40
ROUNDS = 12
STRICT = 4
ROW_BYTES = 16
LAW = "rows"


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return slim(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        # Two hashes and the length stand for the text; a clash would only link two documents.
        F.xxhash64(text, F.octet_length(text), F.crc32(text.cast("binary"))).alias("group"),
        F.monotonically_increasing_id().alias("row"),
    )


def _moves(state: DataFrame, quota: DataFrame, rows: int, turn: int, exchange: bool) -> DataFrame:
    """One round over (block, shard, n): (block, to, amount), what of each block's minority has room."""
    load = state.groupBy("shard").agg(F.sum("n").alias("load"))
    room = quota.join(F.broadcast(load), "shard", "left")
    room = room.select("shard", (F.col("quota") - F.coalesce("load", F.lit(0))).alias("room"))
    room = materialize(room, "shard-room")
    members = state.groupBy("block").agg(F.sum("n").alias("members"), F.count(F.lit(1)).alias("pieces"))
    open_state = state.join(members.where(F.col("pieces") > 1), "block").join(F.broadcast(room), "shard")
    # Eighths, so that the roomiest shard does not draw every block of a round.
    free = F.greatest("room", F.lit(0))
    holds = F.floor(8 * F.least(F.col("members"), F.col("n") + free) / F.col("members"))
    tie = F.xxhash64("block", "shard", F.lit(turn))
    goal = open_state.groupBy("block").agg(
        F.max("members").alias("members"),
        F.max(F.struct(holds.alias("holds"), "n", tie.alias("tie"), F.col("shard").alias("to"))).alias("best"),
        F.collect_list(F.struct("shard", "n")).alias("pieces"),  # one per shard at most
    )
    goal = goal.select(
        "block", "best.to", (F.col("members") - F.col("best.n")).alias("moving"), F.col("best.n").alias("there"), "pieces"
    )
    goal = materialize(goal, "shard-moves")
    if exchange:
        leaving = goal.select("to", F.explode("pieces").alias("piece")).where(F.col("piece.shard") != F.col("to"))
        leaving = leaving.groupBy(F.col("piece.shard").alias("shard")).agg(F.sum("piece.n").alias("leaving"))
        room = room.join(F.broadcast(leaving), "shard", "left")  # one row per shard
        room = room.select("shard", (F.col("room") + F.coalesce("leaving", F.lit(0))).alias("room"))
    # Blocks with most members in place come first, by powers of two; of those, by hash.
    size = F.lit(63) - F.floor(F.log2("there"))
    moving = goal.withColumn("size", size).drop("pieces", "there")
    order = [F.xxhash64("block", F.lit(turn)), F.col("block")]
    queued = running_total(moving, ["to"], F.col("moving"), order[0], order, rows, "before", F.col("size"))
    allowed = queued.join(F.broadcast(room.withColumnRenamed("shard", "to")), "to")
    allowed = allowed.withColumn("amount", F.least(F.col("moving"), F.col("room") - F.col("before")))
    return allowed.where(F.col("amount") > 0).select("block", "to", "amount")


def _moved(state: DataFrame, moves: DataFrame) -> DataFrame:
    """The state after the moves; of a block's pieces the smallest leave first."""
    state = state.join(moves, "block", "left")
    source = F.when(F.col("shard") == F.col("to"), F.lit(0)).otherwise(F.col("n"))
    before = Window.partitionBy("block").orderBy("n", "shard").rowsBetween(Window.unboundedPreceding, -1)
    state = state.withColumn("before", F.coalesce(F.sum(source).over(before), F.lit(0)))
    leaves = F.least(source, F.greatest(F.coalesce("amount", F.lit(0)) - F.col("before"), F.lit(0)))
    parts = F.array(
        F.struct(F.col("shard").alias("shard"), (F.col("n") - leaves).alias("n")),
        F.struct(F.col("to").alias("shard"), leaves.alias("n")),
    )
    parts = state.select("block", F.explode(parts).alias("part")).select("block", "part.shard", "part.n")
    return parts.where(F.col("n") > 0).groupBy("block", "shard").agg(F.sum("n").alias("n"))


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``rounds`` bounds the propagation; a run ends earlier when nothing may move. Null texts
    are empty texts, linked with each other. Null and repeated ids are rows
    like others. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    base = materialize(_rows(docs), "shard-rows")
    total = base.count()
    quota = spark.range(shards).select(
        F.col("id").cast("int").alias("shard"),
        (F.lit(total // shards) + (F.col("id") < total % shards).cast("long")).cast("long").alias("quota"),
    )
    sizes = base.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    linked_groups = materialize(sizes.where(F.col("members") > 1), "shard-groups")
    tagged = base.join(linked_groups, "group", "left")
    tagged = materialize(tagged, "shard-tagged")
    linked, free = tagged.where("members IS NOT NULL"), tagged.where("members IS NULL")
    # Blocks: ranks in the group, cut where a shard would be full beside the smaller groups.
    whole = max(1, (total // shards) * 9 // 10)
    small = linked_groups.where(F.col("members") <= whole).agg(F.sum("members")).first()[0] or 0
    block_rows = max(1, min(whole, max((total - small) // shards, whole // 4)))
    ranked = running_total(linked, ["group"], F.lit(1), F.xxhash64("row"), [F.col("row")], total, "rank")
    part = F.when(F.col("members") > whole, F.floor(F.col("rank") / block_rows)).otherwise(F.lit(0))
    ranked = ranked.select(
        "doc_id", "size", "text_crc32", "row",
        F.xxhash64("group", part).alias("block"), (F.col("rank") - part * block_rows).alias("place"),
    )
    ranked = materialize(ranked, "shard-linked")
    start = F.pmod(F.xxhash64("row", "block"), F.lit(shards)).cast("int")
    state = ranked.groupBy("block", start.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    state = materialize(state, "shard-state")
    for turn in range(rounds):
        exchange = turn < rounds - STRICT
        moves = materialize(_moves(state, quota, total, turn, exchange), "shard-allowed")
        if moves.isEmpty():
            break
        state = materialize(_moved(state, moves), "shard-state")
    # Back to documents: each block's places are dealt out by the counts. A slot is the
    # number of the shard's members in blocks before, and the place in its own block.
    before = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    dealt = state.withColumn("low", F.coalesce(F.sum("n").over(before), F.lit(0)))
    dealt = materialize(dealt, "shard-dealt")
    # A piece of two or more is kept together before single members, which are cut anyway.
    alone = F.when(F.col("n") > 1, F.lit(0)).otherwise(F.lit(1))
    dealt = running_total(dealt, ["shard"], F.col("n"), F.xxhash64("block"), [F.col("block")], total, "start", alone)
    dealt = dealt.select(F.col("block").alias("b"), "shard", "n", "low", "start")
    inside = (F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + F.col("n"))
    home = ranked.join(dealt, (F.col("block") == F.col("b")) & inside)
    home = home.withColumn("slot", F.col("start") + F.col("place") - F.col("low"))
    slots = home.select("doc_id", "size", "text_crc32", "row", "shard", "slot").join(F.broadcast(quota), "shard")
    slots = materialize(slots, "shard-slots")
    stay = slots.where(F.col("slot") < F.col("quota"))
    pool = slots.where(F.col("slot") >= F.col("quota"))
    pool = pool.select("doc_id", "size", "text_crc32", "row").unionByName(free.select("doc_id", "size", "text_crc32", "row"))
    pool = materialize(pool, "shard-pool")
    pool = running_total(pool, [], F.lit(1), F.xxhash64("row"), [F.col("row")], total, "turn")
    taken = stay.groupBy("shard").agg(F.count(F.lit(1)).alias("taken"))
    gaps = quota.join(taken, "shard", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    gaps = gaps.withColumn("gap", F.col("quota") - F.col("taken"))
    over = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    gaps = gaps.withColumn("from", F.coalesce(F.sum("gap").over(over), F.lit(0)))
    gaps = materialize(gaps, "shard-gaps")
    fits = (F.col("turn") >= F.col("from")) & (F.col("turn") < F.col("from") + F.col("gap"))
    filled = pool.join(F.broadcast(gaps), fits)  # one row per shard: a bounded side
    filled = filled.withColumn("slot", F.col("taken") + F.col("turn") - F.col("from"))
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    return stay.select(columns).unionByName(filled.select(columns)).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
