"""Exact row positions and hash cuts that never put a whole table in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import written

# monotonically_increasing_id() keeps the partition in the upper bits and the
# position inside the partition in the lower 33 bits.
_POSITION_BITS = 33

# Hex digits of an md5 per level of buckets, and levels: 4096 evenly filled buckets, of which those that hold a cut
# are divided by 4096 again. What is sorted in the end is one part in 16 million of the rows for each cut.
_DIGITS, _LEVELS = 3, 2


def global_row_number(df: DataFrame, order: Sequence, name: str = "row_number") -> DataFrame:
    """Number the rows 1..n in ``order``, which has to end in a unique key.

    The rows are range-partitioned by the sort and written to the shared folder
    with their partition and position; the number is partition offset +
    position. Only one count per partition travels, so no task ever sees the
    whole table. Places are written, not derived again, because a second run of
    a range sort may put its borders elsewhere.
    """
    placed = written(df.orderBy(*order).withColumn("__slot", F.monotonically_increasing_id()), "ordered")
    partition = F.shiftright("__slot", _POSITION_BITS)
    position = F.col("__slot") - F.shiftleft(partition, _POSITION_BITS)
    sizes = placed.groupBy(partition.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    return (
        placed.withColumn("__part", partition)
        .join(F.broadcast(offsets), "__part")  # one row per partition
        .withColumn(name, F.col("__offset") + position + 1)
        .drop("__slot", "__part", "__offset")
    )


def row_hash(key: str | Sequence[str], seed: int) -> Column:
    """Repeatable pseudo-random order: md5 of the key and the seed."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def cut_by_hash(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int,
    cuts: Callable[[Column], list[Column]],
    strata: Sequence[str] = (),
    name: str = "part",
) -> DataFrame:
    """Split each stratum at exact ranks of the hash order.

    ``cuts(n)`` gives ascending ranks for a stratum of ``n`` rows; a row whose
    rank is above ``j`` of them gets part ``j``. Hash buckets are counted
    first. A bucket lying wholly between two cuts settles its rows without
    ranking them; the few buckets that hold a cut are divided once more, and
    only what then holds a cut is sorted, so the table itself is not shuffled.
    ``strata`` must be class-like columns: 4096 counts per stratum travel.
    """
    strata = list(strata)
    keys = [key] if isinstance(key, str) else list(key)
    columns = [*df.columns, name]

    def part(rank: Column) -> Column:
        above = [F.when(rank > c, 1).otherwise(0) for c in cuts(F.col("__n"))]
        total = above[0]
        for a in above[1:]:
            total = total + a
        return total

    rows = df.withColumn("__hash", row_hash(key, seed)).withColumns({"__before": F.lit(0).cast("bigint"), "__n": F.lit(None).cast("bigint")})
    settled = []
    group: list[str] = list(strata)
    for level in range(_LEVELS):
        inside = list(group)
        bucket = f"__bucket{level}"
        group = [*group, bucket]
        rows = rows.withColumn(bucket, F.substring("__hash", 1 + level * _DIGITS, _DIGITS))
        counts = rows.groupBy(*group).agg(
            F.count(F.lit(1)).alias("__size"), F.max("__before").alias("__base"), F.max("__n").alias("__known")
        )
        whole = Window.partitionBy(*inside) if inside else Window.partitionBy(F.lit(1))
        running = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = (
            counts.withColumn("__end", F.col("__base") + F.sum("__size").over(running))
            .withColumn("__n", F.coalesce("__known", F.sum("__size").over(whole)))
            .withColumn("__offset", F.col("__end") - F.col("__size"))
            .withColumn("__first", part(F.col("__offset") + 1))
            .withColumn("__last", part(F.col("__end")))
            .select(*group, "__n", "__offset", "__first", "__last")
        )
        # Null-safe, so that a NULL stratum is kept as one of its own.
        condition = reduce(lambda a, b: a & b, [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group])
        kept = [c for c in rows.columns if c not in ("__before", "__n")]
        joined = rows.alias("l").join(F.broadcast(placed).alias("r"), condition)
        joined = joined.select(*[F.col(f"l.{c}") for c in kept], "r.__n", "r.__offset", "r.__first", "r.__last")
        settled.append(joined.where("__first = __last").withColumn(name, F.col("__first")).select(*columns))
        rows = joined.where("__first <> __last").withColumn("__before", F.col("__offset")).drop("__offset", "__first", "__last")
    rank = F.col("__before") + F.row_number().over(Window.partitionBy(*group).orderBy("__hash", *keys))
    ranked = rows.withColumn("__rank", rank).withColumn(name, part(F.col("__rank"))).select(*columns)
    return reduce(DataFrame.unionByName, [*settled, ranked])
