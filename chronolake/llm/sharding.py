"""Shards of even size by balanced label propagation.

Documents that share a link key (equal texts, say) are neighbours. From an even start, each round counts the
shards of every link's members, and members move to the shard where the link has most of them. Moves are
swaps: as many documents go from one shard to another as come back, wanting to or being free to, so shard
sizes never change. Links larger than half a shard are dealt into parts first, since no shard can hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import before, buckets_for, cut, text_of

SHARDS, ROUNDS = 16, 4


def linked_rows(docs: DataFrame) -> DataFrame:
    """row, doc_id, size (UTF-8 bytes and 1), text_crc32 and the link of equal texts (their SHA-256)."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text_of(), 256)).alias("link"),
    ).withColumn("row", F.monotonically_increasing_id())


def numbered(df: DataFrame, group: list[str], rank: Column, n_buckets: int, name: str) -> DataFrame:
    """Adds ``name``: the row's place in its group from 0, by ``rank`` (from 0 on), then a hash of the row."""
    mixed = F.xxhash64("row", F.lit(17))
    df = df.withColumn("_rank", rank).withColumn("_hash", mixed)
    df = df.withColumn("_bucket", F.col("_rank") * n_buckets + F.floor((F.col("_hash") / 2.0**64 + 0.5) * n_buckets))
    order = [F.col("_bucket"), F.col("_hash"), F.col("row")]
    return before(df, group, "_bucket", order, F.lit(1), name).drop("_rank", "_hash", "_bucket")


def _quotas(wanted: dict[tuple[int, int], int], free: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """(group, first, behind, target) of the moves to make: places of a group's order that go to a target.

    Group s * SHARDS + t is the documents of s that want to t; group -1 - t the free documents of t. What
    wants from s to t is met by what wants back, then by free documents of t.
    """
    moves, lent = [], dict.fromkeys(free, 0)
    for (s, t), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
        go = min(n, wanted.get((t, s), 0))
        more = min(n - go, max(0, free.get(t, 0) - lent.get(t, 0)))
        if more:
            moves.append((-1 - t, lent[t], lent[t] + more, s))
            lent[t] += more
        if go + more:
            moves.append((s * SHARDS + t, 0, go + more, t))
    return moves


def _round(spark, state: DataFrame, n_buckets: int) -> tuple[DataFrame, int]:
    """The state (row, link, shard) after one round of swaps, and how many documents moved to a wanted shard."""
    linked = state.where("link is not null")
    here = linked.groupBy("link", "shard").agg(F.count("*").alias("n"))
    most = cut(
        here.groupBy("link").agg(
            F.max(F.struct("n", F.xxhash64("link", "shard").alias("tie"), "shard")).alias("best"),
            F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("held"),
        )
    )
    told = linked.join(most, "link").select(
        "row", F.col("best.shard").alias("target"), (F.col("best.n") - F.col("held")[F.col("shard")]).alias("gain")
    )
    drawn = cut(
        state.where("link is not null")
        .join(told, "row")
        .where("target <> shard")
        .select("row", "shard", "target", "gain", (F.col("shard") * SHARDS + F.col("target")).alias("grp"))
        .union(state.where("link is null").select("row", "shard", F.lit(None).cast("int"), F.lit(0).cast("long"), (-1 - F.col("shard")).alias("grp")))
    )
    counted = drawn.groupBy("grp").count().collect()  # one row for each pair of shards at most
    wanted = {divmod(r.grp, SHARDS): r["count"] for r in counted if r.grp >= 0}
    free = {-1 - r.grp: r["count"] for r in counted if r.grp < 0}
    moves = _quotas(wanted, free)
    if not moves:
        return state, 0
    # Links that gain most come first; gains count by their power of two.
    rank = F.lit(63) - F.floor(F.log2(F.greatest(F.col("gain"), F.lit(0)) + 1))
    placed = numbered(drawn, ["grp"], rank.cast("int"), n_buckets, "place")
    rows = ", ".join(f"({g}, {a}L, {b}L, {t})" for g, a, b, t in moves)
    quotas = F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS q(g, a, b, goal)"))
    went = placed.join(quotas, (F.col("grp") == F.col("g")) & (F.col("place") >= F.col("a")) & (F.col("place") < F.col("b")))
    new = state.join(went.select("row", "goal"), "row", "left").select("row", "link", F.coalesce("goal", "shard").alias("shard"))
    return cut(new), sum(b - a for g, a, b, _ in moves if g >= 0)


def shard_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs`` (doc_id, text, any others).

    The law is ``rows``: counts of any two shards differ by one at most. Documents of equal text are linked; a
    null text counts as empty. Repeated rows and doc_ids take a place each. Slots run from 0 in each shard.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = cut(linked_rows(docs))
    total = rows.count()
    n_buckets = buckets_for(total)
    start = numbered(rows.select("row", "link").withColumn("all", F.lit(0)), ["all"], F.lit(0), n_buckets, "place")
    room = max(1, total // SHARDS // 2)
    groups = cut(rows.groupBy("link").agg(F.count("*").alias("n")).where("n > 1"))
    parts = F.ceil(F.col("n") / room).cast("long")
    own = F.when(F.col("n").isNotNull(), F.xxhash64("link", F.pmod(F.xxhash64("row", F.lit(3)), parts)))
    state = cut(start.join(groups, "link", "left").select("row", own.alias("link"), F.pmod("place", F.lit(SHARDS)).cast("int").alias("shard")))
    for _ in range(rounds):
        state, moved = _round(spark, state, n_buckets)
        if not moved:
            break
    slots = numbered(state.select("row", "shard"), ["shard"], F.lit(0), n_buckets, "slot")
    return rows.join(slots, "row").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.lower(F.hex("link")).alias("text_sha256"),
    )


def cut_share(sharded: DataFrame) -> DataFrame:
    """Of the pairs of equal texts, how many there are and how many lie in two shards."""
    here = sharded.groupBy("text_sha256", "shard").agg(F.count("*").alias("n"))
    per = here.groupBy("text_sha256").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("same"))
    return per.agg(
        F.sum(F.col("all") * (F.col("all") - 1) / 2).cast("long").alias("pairs"),
        F.sum((F.col("all") * F.col("all") - F.col("same")) / 2).cast("long").alias("cut_pairs"),
    )
