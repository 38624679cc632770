"""Mixing sources to target weights: repetition rates per source, whole copies plus one Bernoulli copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import WORD, columns_of, unit_hash, written

#: Weights of the sources in code-point order, repeating; share of all words to take; most repetitions of a source.
WEIGHTS, BUDGET, MOST = (5, 2, 1), 1.5, 2.0
SEED = "mix"
#: Sources up to which the table of targets is broadcast, so that no document moves; beyond it rows meet it by shuffle.
MOST_BROADCAST = 100_000


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, most: float = MOST
) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    The budget is shared by weight; a source stops at ``most`` times its size
    and what it leaves goes to the others by weight. With the sources in order
    of size per weight, those that stop come first: the share per unit of
    weight is fixed by the first source that stays below its stop. One row per
    source, so the windows over all sources are small.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    )
    stop = F.col("source_size") * F.lit(most)
    order = [(F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rated = (
        sizes.withColumn("weight", weight)
        .withColumn("before", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(rest))
        .withColumn("all", F.sum("source_size").over(whole))
        .withColumn("unit", (F.col("all") * F.lit(budget) - F.col("before") * F.lit(most)) / F.col("rest"))
        .withColumn("fits", F.col("unit") * F.col("weight") <= stop)
        .withColumn("level", F.max(F.when(F.col("fits"), F.col("unit"))).over(whole))
    )
    # "level" is missing only when every source stops.
    target = F.least(stop, F.coalesce(F.col("level") * F.col("weight"), stop))
    return rated.select("source", "source_size", target.alias("target"))


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """Every document once, with how often the mix takes it.

    Columns: doc_id, source, size (words; a NULL or empty text has none),
    source_size, target, copies. A document is taken floor(target /
    source_size) times, and once more when its hash is below the fraction; the
    hash depends on seed and id alone, so reruns agree. NULL is a source of its
    own and comes last; rows that repeat an id share its hash and get the same
    number of copies; a source without words, like an empty table, has target
    0. Only sums per source are shuffled; the table of targets has one row per
    source and is broadcast after its rows are counted, up to MOST_BROADCAST.
    """
    rows = columns_of(docs, doc_id=key, text=text, source=source).withColumn(
        "size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    )
    return _with_copies(rows.drop("text"), weights, budget, most, seed)


def _with_copies(rows: DataFrame, weights: Sequence[int], budget: float, most: float, seed: str) -> DataFrame:
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most)
    targets = written(targets.withColumnRenamed("source", "of_source"), "mix-targets")
    if targets.count() <= MOST_BROADCAST:
        targets = F.broadcast(targets)
    rate = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + F.when(unit_hash(F.col("doc_id"), seed) < rate - whole, 1).otherwise(0)
    return (
        rows.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
        .drop("of_source")
        .withColumn("copies", copies.cast("bigint"))
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The mix itself: every row of ``docs``, as often as it is taken, with all its columns.

    The rates are joined to the rows by source; copies are made by repeating
    the row where it stands, so no document is moved.
    """
    weights, budget, most, seed = (
        settings.get(k, d) for k, d in (("weights", WEIGHTS), ("budget", BUDGET), ("most", MOST), ("seed", SEED))
    )
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{key}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )
    taken = _with_copies(packed, weights, budget, most, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
