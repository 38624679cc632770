"""Fold membership as a relation of fold, row and role.

Each row carries one role per fold: ``training``, ``validation`` or NULL (not
used in that fold). Undersampling and the leakage guard change roles, fold by
fold, and whoever trains on a fold reads them, so neither can be skipped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import written
from driftwarden.operators.ordering import row_hash

TRAINING, VALIDATION = "training", "validation"
ROLES = "fold_roles"
#: Hex digits of the hash that one round of counting looks at.
_DIGITS = 3


def roles_of(own: Column, k: int, ordered: bool = False) -> Column:
    """One role per fold for rows that validate in fold ``own``; ordered folds train on earlier rows only."""

    def role(f: int) -> Column:
        train = own < f if ordered else F.coalesce(own != f, F.lit(True))
        return F.when(own == f, VALIDATION).when(train, TRAINING)

    return F.array(*[role(f) for f in range(k)])


def with_roles(df: DataFrame, fold: str, k: int, ordered: bool = False) -> DataFrame:
    return df.withColumn(ROLES, roles_of(F.col(f"`{fold}`"), k, ordered))


def _cut_hashes(hashes: DataFrame, quotas: dict[int, int]) -> dict[int, str]:
    """Per fold the hash of the last of its ``quotas`` rows in hash order.

    ``hashes`` (f, h) has a line per fold and row. Rows are counted by leading
    digits; only the buckets that hold a cut are looked into further, until a
    bucket is small. At most 4096 counts per fold reach the driver in a round.
    """
    left, prefix, found = dict(quotas), {f: "" for f in quotas}, {}
    for depth in range(1, 33):
        if not left:
            break
        here = reduce(lambda a, b: a | b, [(F.col("f") == f) & F.col("h").startswith(prefix[f]) for f in left])
        bucket = F.substring("h", 1, depth * _DIGITS)
        counts = hashes.where(here).groupBy("f", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.max("h").alias("last")).collect()
        for f in list(left):
            for b, n, last in sorted((r["b"], r["n"], r["last"]) for r in counts if r["f"] == f):
                if n < left[f]:
                    left[f] -= n
                    continue
                if n == left[f]:
                    found[f] = last
                    del left[f]
                else:
                    prefix[f] = b
                break
    return found


def undersampled(df: DataFrame, key: Sequence[str], label: str, k: int, c_min: float = 0.1, seed: int = 60) -> DataFrame:
    """In every fold only about (1 / c_min - 1) training negatives for each training positive keep their role.

    Those of least hash stay, the same rows as ``split.undersampled_kfold``
    keeps. Rows whose label is neither 0 nor 1 count as negatives. Nothing but
    counts by hash prefix is gathered; the rows are not shuffled.
    """
    positive = F.coalesce(F.col(f"`{label}`") == 1, F.lit(False))
    trains = [F.get(ROLES, F.lit(f)).eqNullSafe(TRAINING) for f in range(k)]
    sums = df.agg(*[F.count_if(t & positive).alias(f"p{f}") for f, t in enumerate(trains)], *[F.count_if(t & ~positive).alias(f"n{f}") for f, t in enumerate(trains)]).first()
    quotas = {f: int(sums[f"p{f}"] / c_min - sums[f"p{f}"]) for f in range(k)}
    cut = {f: q for f, q in quotas.items() if q < sums[f"n{f}"]}
    hashed = df.withColumn("__h", row_hash(list(key), seed))
    negatives = hashed.where(~positive).select(F.posexplode(ROLES).alias("f", "role"), F.col("__h").alias("h"))
    last = _cut_hashes(negatives.where(F.col("role") == TRAINING).select("f", "h"), {f: q for f, q in cut.items() if q > 0})

    def role(f: int) -> Column:
        own = F.get(ROLES, F.lit(f))
        if f not in cut:
            return own
        stays = F.col("__h") <= last[f] if f in last else F.lit(False)
        return F.when(positive | (own == VALIDATION) | stays, own)

    return hashed.withColumn(ROLES, F.array(*[role(f) for f in range(k)])).drop("__h")


def _mask(role: str, k: int) -> Column:
    """Bit f is set where the row has the role in fold f."""
    bits = [F.when(F.get(ROLES, F.lit(f)) == role, F.lit(1 << f)).otherwise(F.lit(0)) for f in range(k)]
    return reduce(lambda a, b: a + b, bits).cast("bigint")


def guarded(df: DataFrame, id_columns: Sequence[str], entity: str, order: Sequence[str], k: int) -> DataFrame:
    """The leakage guard inside every fold, for up to 62 folds.

    Of rows with the same ids only the last on each side of a fold stays, by
    ``order`` and then by the hash of all columns; then validation rows whose
    entity trains in the fold are taken out. NULL is an id and an entity like
    any other. Entities travel as one bit mask each.
    """
    if k > 62:
        raise ValueError("at most 62 folds")
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    masked = df.withColumns({"__train": _mask(TRAINING, k), "__valid": _mask(VALIDATION, k), "__tie": tie})
    later = Window.partitionBy(*[F.col(f"`{c}`") for c in id_columns]).orderBy(*[F.desc(f"`{c}`") for c in order], F.desc("__tie"))
    before = later.rowsBetween(Window.unboundedPreceding, -1)
    seen = {f"__{s}": F.col(f"__{s}").bitwiseAND(F.bitwise_not(F.coalesce(F.bit_or(f"__{s}").over(before), F.lit(0)))) for s in ("train", "valid")}
    last = written(masked.withColumns(seen), "last-per-id")
    entities = last.groupBy(F.col(f"`{entity}`").alias("__entity")).agg(F.bit_or("__train").alias("__of_entity")).where("__of_entity <> 0")
    joined = last.alias("d").join(entities.alias("e"), F.col(f"d.`{entity}`").eqNullSafe(F.col("e.__entity")), "left")
    train, valid = F.col("d.__train"), F.col("d.__valid").bitwiseAND(F.bitwise_not(F.coalesce("__of_entity", F.lit(0))))
    roles = [F.when(train.bitwiseAND(F.lit(1 << f)) != 0, TRAINING).when(valid.bitwiseAND(F.lit(1 << f)) != 0, VALIDATION) for f in range(k)]
    return joined.select(*[F.col(f"d.`{c}`") for c in df.columns if c != ROLES], F.array(*roles).alias(ROLES))


def members(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The relation in long form: the columns of each row with every ``fold`` and ``role`` it has."""
    return df.select(*columns, F.posexplode(ROLES).alias("fold", "role")).where("role IS NOT NULL")
