"""Repeatable samples, train/validation splits and folds.

Random choices follow the md5 of a row key and a seed, so they do not depend on
partitioning and can be repeated on any engine. Exact sizes come from hash cuts
or global row numbers, never from sorting a whole class in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.operators.ordering import cut_by_hash, global_row_number, row_hash

SEED = 60


def _share(n: Column, share: float) -> Column:
    return F.floor(n.cast("double") * F.lit(round(share, 12)))


def _label(part: str, *names: str) -> Column:
    out = F.when(F.col(part) == 0, names[0])
    for i, n in enumerate(names[1:], start=1):
        out = out.when(F.col(part) == i, n)
    return out


def sample_cap(df: DataFrame, n: int, key: str | Sequence[str], seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows when there are more, else all."""
    return cut_by_hash(df, key, seed, lambda size: [F.lit(n)], name="__part").where("__part = 0").drop("__part")


def random_split(df: DataFrame, key: str | Sequence[str], test_size: float, seed: int = SEED) -> DataFrame:
    """Train/validation by the hash of the key; needs no count and no shuffle."""
    place = F.conv(F.substring(row_hash(key, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return df.withColumn("split", F.when(place < F.lit(float(test_size)), "validation").otherwise("train"))


def stratified_split(
    df: DataFrame, key: str | Sequence[str], label: str, test_size: float, seed: int = SEED
) -> DataFrame:
    """The first floor(n * (1 - test_size)) of every class, in hash order, train."""
    out = cut_by_hash(df, key, seed, lambda n: [_share(n, 1 - test_size)], [label], "__part")
    return out.withColumn("split", _label("__part", "train", "validation")).drop("__part")


def three_way_split(
    df: DataFrame, key: str | Sequence[str], shares: tuple[float, float] = (0.6, 0.2), seed: int = SEED
) -> DataFrame:
    """Train, validation and test blocks of the shuffled rows."""
    first, second = shares
    out = cut_by_hash(df, key, seed, lambda n: [_share(n, first), _share(n, first + second)], name="__part")
    return out.withColumn("split", _label("__part", "train", "validation", "test")).drop("__part")


def _cut_in_order(
    df: DataFrame, order: Sequence[str], part: Callable[[Column, Column], Column], name: str, label: str | None = None
) -> DataFrame:
    """``df`` with the part each row falls in when its class is cut at ranks of the order.

    ``part(i, n)`` is the part of row ``i`` (from 0) of ``n``; parts rise with
    ``i``. Only the order columns and the label are sorted. What comes back to
    the rows is the first key of every part, by which each row places itself, so
    the rows themselves are neither shuffled nor written. ``order`` ends in a
    unique key; rows that are equal in it share the part of the last of them.
    """
    key = [F.col(f"`{c}`").alias(f"__o{i}") for i, c in enumerate(order)]
    group = F.lit(0) if label is None else F.col(f"`{label}`")
    narrow = df.select(group.alias("__class"), *key)
    numbered = global_row_number(narrow, ["__class", *[f"__o{i}" for i in range(len(order))]], "__rn")
    sizes = numbered.groupBy("__class").agg(F.min("__rn").alias("__start"), F.count(F.lit(1)).alias("__n"))
    same = F.col("r.__class").eqNullSafe(F.col("s.__class"))
    placed = numbered.alias("r").join(F.broadcast(sizes).alias("s"), same)  # one row per class
    columns = [F.col(f"r.__o{i}").alias(f"__o{i}") for i in range(len(order))]
    placed = placed.select("r.__class", F.struct(*columns).alias("__key"), part(F.col("__rn") - F.col("__start"), F.col("__n")).alias("__part"))
    firsts = placed.groupBy("__class", "__part").agg(F.min("__key").alias("__key"))
    firsts = firsts.groupBy("__class").agg(F.array_sort(F.collect_list(F.struct("__key", "__part"))).alias("__firsts"))  # one per part
    own = F.struct(*key)
    joined = df.withColumn("__own", own).withColumn("__class", group).alias("d").join(
        F.broadcast(firsts).alias("f"), F.col("d.__class").eqNullSafe(F.col("f.__class"))
    )
    reached = F.element_at(F.filter("__firsts", lambda f: f["__key"] <= F.col("__own")), -1)["__part"]
    return joined.select(*[F.col(f"d.`{c}`") for c in df.columns], reached.alias(name))


def time_split(df: DataFrame, order: Sequence[str], test_size: float) -> DataFrame:
    """The first int((1 - test_size) * n) rows in time order train, the rest validate."""

    def part(i: Column, n: Column) -> Column:
        return F.when(i < F.floor(F.lit(round(1 - test_size, 12)) * n), 0).otherwise(1)

    out = _cut_in_order(df, order, part, "__part")
    return out.withColumn("split", F.when(F.col("__part") == 0, "train").otherwise("validation")).drop("__part")


def group_split(df: DataFrame, group: Column) -> DataFrame:
    """Rows of the smallest and the largest group validate."""
    tagged = df.withColumn("__group", group)
    ends = tagged.agg(F.struct(F.min("__group").alias("lo"), F.max("__group").alias("hi")).alias("e")).scalar()
    edge = F.col("__group").isin(F.col("__ends.lo"), F.col("__ends.hi"))
    with_ends = tagged.withColumn("__ends", ends)
    return with_ends.withColumn("split", F.when(edge, "validation").otherwise("train")).drop("__group", "__ends")


def _negatives(positives: int, c_min: float) -> int:
    return int(positives / c_min - positives)


def undersample(
    df: DataFrame, key: str | Sequence[str], label: str, test_size: float, c_min: float = 0.1, seed: int = SEED
) -> DataFrame:
    """Stratified split whose training part keeps all positives and about (1/c_min - 1) negatives for each.

    Rows of the training part that are left out get the split ``dropped``. With
    fewer negatives than wanted all of them stay.
    """
    positives = df.where(F.col(label) == 1).count()
    keep = _negatives(int(round(1 - test_size, 12) * positives), c_min)

    def cuts(n: Column) -> list[Column]:
        train = _share(n, 1 - test_size)
        return [F.when(F.col(label) == 1, train).otherwise(F.least(train, F.lit(keep))), train]

    out = cut_by_hash(df, key, seed, cuts, [label], "__part")
    return out.withColumn("split", _label("__part", "train", "dropped", "validation")).drop("__part")


def block_fold(i: Column, n: Column, k: int) -> Column:
    """Fold of row ``i`` (from 0) of ``n``: contiguous blocks, the first n mod k one row longer."""
    size, longer = F.floor(n / F.lit(k)), n % k
    border = longer * (size + 1)
    early = F.floor(i / (size + 1))
    late = longer + F.floor((i - border) / F.nullif(size, F.lit(0)))
    return F.when(i < border, early).otherwise(late).cast("int")


def kfold(df: DataFrame, order: Sequence[str], k: int = 5, name: str = "fold") -> DataFrame:
    return _cut_in_order(df, order, lambda i, n: block_fold(i, n, k), name)


def stratified_kfold(df: DataFrame, label: str, order: Sequence[str], k: int = 5, name: str = "fold") -> DataFrame:
    """Contiguous blocks inside each class; NULL is a class."""
    return _cut_in_order(df, order, lambda i, n: block_fold(i, n, k), name, label)


def timeseries_kfold(df: DataFrame, order: Sequence[str], k: int = 5, name: str = "fold") -> DataFrame:
    """k validation blocks of floor(n / (k + 1)) rows at the end; fold f trains on every row before its block.

    Rows that never validate get fold -1, so the training rows of fold f are
    exactly those with a smaller fold number.
    """

    def part(i: Column, n: Column) -> Column:
        block = F.floor(n / F.lit(k + 1))
        place = i - (n - F.lit(k) * block)
        return F.when(place < 0, -1).otherwise(F.floor(place / F.greatest(block, F.lit(1)))).cast("int")

    return _cut_in_order(df, order, part, name)


def group_kfold(df: DataFrame, group: Column, name: str = "fold") -> DataFrame:
    """One fold per distinct group, in group order."""
    tagged = df.withColumn("__group", group)
    groups = global_row_number(tagged.select("__group").distinct(), ["__group"], "__rn")
    folds = groups.select("__group", (F.col("__rn") - 1).cast("int").alias(name))
    return tagged.join(folds, "__group").drop("__group")


def undersampled_kfold(
    df: DataFrame,
    key: str,
    label: str,
    order: Sequence[str],
    k: int = 5,
    c_min: float = 0.1,
    seed: int = SEED,
) -> DataFrame:
    """Stratified folds; for each fold the rows that train after undersampling and those that validate.

    One line per fold and row used in it: ``fold`` and ``split``.
    """
    folded = stratified_kfold(df, label, order, k, "__own")
    runs = folded.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    valid = runs.where(F.col("fold") == F.col("__own")).withColumn("split", F.lit("validation"))
    train = runs.where(F.col("fold") != F.col("__own"))
    found = folded.where(F.col(label) == 1).groupBy("__own").count().collect()  # k rows
    own = {r["__own"]: r["count"] for r in found}
    total = sum(own.values())
    quota = F.element_at(
        F.create_map(*[F.lit(x) for f in range(k) for x in (f, _negatives(total - own.get(f, 0), c_min))]), F.col("fold")
    )
    cut = cut_by_hash(
        train, key, seed, lambda n: [F.when(F.col(label) == 1, n).otherwise(F.least(n, quota))], ["fold", label], "__part"
    )
    kept = cut.where("__part = 0").withColumn("split", F.lit("train"))
    columns = [*df.columns, "fold", "split"]
    return kept.select(*columns).unionByName(valid.select(*columns))
