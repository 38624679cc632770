"""Balanced label propagation: linked documents gather in shards whose sizes stay even."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import columns_of, written

#: Buckets by which movers are admitted; salts of the join that brings votes to documents.
BUCKETS, SALTS = 256, 8
SEED = 17


def propagate(nodes: DataFrame, links: DataFrame, quota: float, rounds: int | None = None) -> DataFrame:
    """(node, shard) for the linked nodes after label propagation under quotas.

    ``nodes`` (node, shard) is the start, ``links`` (node, link) says which
    nodes share something; ``quota`` is the number of linked nodes a shard
    admits. Nodes without a link take part in nothing: they give way when the
    shards are settled. Each round every link counts its members per shard
    and, being larger than one shard or not, names the shards it wants: the
    fullest ones, exactly as many as its size needs. A node outside them asks to
    move to the one that most of its links name. Rounds go on until no mover is
    admitted (or for ``rounds``): where a node has one link, every move brings
    it into a wanted shard, which then stays wanted, so that this ends. Shards admit movers up to their
    quota, in the order of a hash bucket, so only counts per (shard, bucket)
    are gathered. A link of very many nodes is at most one row per shard after
    the partial aggregation, and the votes go back to its nodes by a salted
    key.
    """
    linked = written(links.join(links.groupBy("link").count().where("count > 1").drop("count"), "link"), "links")
    nodes = nodes.join(linked.select("node").distinct(), "node")
    state = written(nodes, "labels")
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
    for turn in count() if rounds is None else range(rounds):
        members = linked.join(state, "node")
        counts = members.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("n"))
        of_link = Window.partitionBy("link")
        ranked = (
            counts.withColumn("all", F.sum("n").over(of_link))
            .withColumn("place", F.row_number().over(of_link.orderBy(F.desc("n"), F.xxhash64("link", "shard"))))
            .withColumn("want", F.ceil(F.col("all") / F.lit(quota)))
            .where("place <= want")
        )
        named = ranked.groupBy("link").agg(
            F.array_sort(F.collect_list(F.struct("place", "shard", "n"))).alias("named")
        )  # at most one entry per shard
        votes = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        asked = members.withColumn("salt", salt).join(votes, ["link", "salt"])
        at_home = F.exists("named", lambda v: v["shard"] == F.col("shard"))
        chosen = F.element_at("named", (F.pmod(F.xxhash64("node", F.lit(turn)), F.size("named")) + 1).cast("int"))
        wish = F.when(at_home, F.col("shard")).otherwise(chosen["shard"])
        weight = F.when(at_home, F.lit(1.0)).otherwise(chosen["n"] / F.size("named"))
        wishes = (
            asked.select("node", "shard", wish.alias("wish"), weight.alias("weight"))
            .groupBy("node", "shard", "wish")
            .agg(F.sum("weight").alias("weight"))
            .groupBy("node", "shard")
            .agg(F.max_by("wish", F.struct("weight", "wish")).alias("wish"))
        )
        movers = written(
            wishes.where("wish <> shard").withColumn("bucket", F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(BUCKETS))),
            "movers",
        )
        loads = state.groupBy("shard").count()
        leaving = movers.groupBy("shard").agg(F.count(F.lit(1)).alias("out"))
        room = (
            loads.join(leaving, "shard", "left")
            .select(F.col("shard").alias("wish"), (F.lit(quota) - F.col("count") + F.coalesce("out", F.lit(0))).alias("room"))
        )
        running = Window.partitionBy("wish").orderBy("bucket")
        admitted = (
            movers.groupBy("wish", "bucket")
            .count()
            .withColumn("sum", F.sum("count").over(running))
            .join(room, "wish", "left")
            .where(F.col("sum") <= F.coalesce("room", F.lit(quota)))
            .select("wish", "bucket")
        )
        moves = written(movers.join(admitted, ["wish", "bucket"]).select("node", F.col("wish").alias("moved")), "moves")
        if moves.isEmpty():
            break
        state = written(
            state.join(moves, "node", "left").select("node", F.coalesce("moved", "shard").cast("int").alias("shard")),
            "labels",
        )
    return state


def shard_documents(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", rounds: int | None = None
) -> DataFrame:
    """Deal documents into ``shards`` whose row counts differ by one at most, equal texts together.

    Columns: doc_id, size (UTF-8 bytes of the text, none for NULL, plus 16),
    text_crc32, law ("rows"), shard, slot (0, 1, ... within the shard),
    grown_shard (NULL: that belongs to another law). Documents with equal texts
    are linked; a NULL text links with nothing, empty texts are equal. The start
    is a hash of the id. After the propagation each shard keeps what its exact
    quota allows, linked documents first, and the overflow fills the free
    places in order, so that a cut link stays in neighbouring places. Rows that
    repeat an id are documents of their own; an empty table gives no rows.

    The final places come from one range sort of narrow rows, written with
    their positions; counts per shard and per partition are all that is
    gathered.
    """
    rows = columns_of(docs, doc_id=key, text=text)
    base = written(
        rows.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.md5(F.col("text").cast("binary")).alias("link"),
            F.monotonically_increasing_id().alias("node"),
        ),
        "shard-base",
    )
    start = F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(SEED)), F.lit(shards)).cast("int")
    linked = base.where("link IS NOT NULL").select("node", "link")
    state = propagate(base.select("node", start.alias("shard")), linked, base.count() / shards, rounds)
    placed = base.join(state.withColumnRenamed("shard", "label"), "node", "left").select(
        "*", F.col("label").isNull().alias("alone"), start.alias("start")
    )
    placed = placed.withColumn("label", F.coalesce("label", "start")).drop("start")
    return _settle(placed, shards)


def _settle(placed: DataFrame, shards: int) -> DataFrame:
    """Exact quotas: number the rows by label, keep each label's quota, deal the overflow to the free places."""
    order = ["label", "alone", "link", "doc_id", "text_crc32", "node"]
    sorted_rows = written(placed.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "shard-sorted")
    part = F.shiftright("at", 33)
    numbered = sorted_rows.withColumn("part", part).withColumn("at", F.col("at") - F.shiftleft(part, 33))
    # One row per (partition, label): the position of its first row within the label.
    pieces = numbered.groupBy("label", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("label").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    spark = placed.sparkSession
    held = {r["label"]: r["n"] for r in pieces.groupBy("label").agg(F.sum("n").alias("n")).collect()}  # one per shard
    total = sum(held.values())
    quota = [total // shards + (k < total % shards) for k in range(shards)]
    over = free = 0
    plan, gaps = [], []
    for k in range(shards):
        plan.append((k, quota[k], over))
        over += max(0, held.get(k, 0) - quota[k])
        kept = min(held.get(k, 0), quota[k])
        if kept < quota[k]:
            gaps.append((free, free + quota[k] - kept, k, kept))
        free += quota[k] - kept
    plans = spark.createDataFrame(plan, "label int, quota bigint, over_before bigint")
    gap_rows = spark.createDataFrame(gaps, "gap_from bigint, gap_to bigint, gap_shard int, kept bigint")
    ranked = (
        numbered.join(pieces.select("label", "part", "before"), ["label", "part"])
        .withColumn("rank", F.col("at") + F.col("before"))
        .join(F.broadcast(plans), "label")  # one row per shard
    )
    stays = ranked.where("rank < quota").select("*", F.col("label").alias("shard"), F.col("rank").alias("slot"))
    overflow = ranked.where("rank >= quota").withColumn("o", F.col("rank") - F.col("quota") + F.col("over_before"))
    filled = overflow.join(F.broadcast(gap_rows), F.expr("o >= gap_from AND o < gap_to")).select(
        *ranked.columns, F.col("gap_shard").alias("shard"), (F.col("o") - F.col("gap_from") + F.col("kept")).alias("slot")
    )
    return stays.unionByName(filled).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
