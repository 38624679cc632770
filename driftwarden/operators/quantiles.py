"""Distributed order statistics: exact percentiles and value buckets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000

# Value buckets are found in two steps of this many.
_FAN = 32


def _usable(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(F.col(value))


def exact_percentiles(
    values: DataFrame,
    groups: Sequence[str],
    probs: Sequence[float],
    value: str = "value",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Linearly interpolated percentiles per group: ``groups, p, percentile``.

    ``percentile_approx`` brackets every wanted rank within a guaranteed error;
    values below the bracket are only counted and values inside it are sorted.
    Sorting thus touches a sliver of the rows, where the built-in exact
    ``percentile`` would hold every distinct value of a group in one buffer.
    ``groups`` are feature-, set- or class-like: one bracket per group and
    probability is broadcast. Should a bracket miss its rank, the query fails.
    """
    if not groups:
        whole = values.withColumn("__whole", F.lit(0))
        return exact_percentiles(whole, ["__whole"], probs, value, accuracy).drop("__whole")
    groups = list(groups)
    margin = 4.0 / accuracy
    lows = [max(0.0, p - margin) for p in probs]
    highs = [min(1.0, p + margin) for p in probs]
    numeric = values.select(*groups, F.col(value).cast("double").alias("__v")).where(_usable("__v"))
    brackets = (
        numeric.groupBy(*groups)
        .agg(
            F.count(F.lit(1)).alias("__n"),
            F.percentile_approx("__v", [*lows, *highs], accuracy).alias("__cuts"),
        )
        .select(
            *groups,
            "__n",
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(float(p)).alias("p"),
                            F.col("__cuts")[i].alias("__lo"),
                            F.col("__cuts")[i + len(probs)].alias("__hi"),
                        )
                        for i, p in enumerate(probs)
                    ]
                )
            ),
        )
    )
    joined = numeric.join(F.broadcast(brackets), groups)
    # Three zones: below, inside and above the bracket. Only inside are values told apart; the zones beside it keep
    # their nearest value, which is all that interpolation can need of them.
    value_ = F.col("__v")
    zone = F.when(value_ < F.col("__lo"), 0).when(value_ <= F.col("__hi"), 1).otherwise(2)
    counted = (
        joined.withColumn("__zone", zone)
        .withColumn("__kept", F.when(F.col("__zone") == 1, value_))
        .groupBy(*groups, "p", "__n", "__zone", "__kept")
        .agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__first"), F.max("__v").alias("__last"))
    )
    running = (
        Window.partitionBy(*groups, "p")
        .orderBy("__zone", "__kept")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rank = (F.col("__n") - 1) * F.col("p")
    spans = (
        counted.withColumn("__end", F.sum("__c").over(running))
        .withColumn("__start", F.col("__end") - F.col("__c"))
        .withColumn("__rank", rank)
    )

    def at(position: Column) -> Column:
        inside = (F.col("__zone") == 1) & (F.col("__start") <= position) & (position < F.col("__end"))
        first, last = position == F.col("__start"), position == F.col("__end") - 1
        return F.max(F.when(inside | first, F.col("__first")).when(last, F.col("__last")))

    found = spans.groupBy(*groups, "p").agg(
        at(F.floor("__rank")).alias("__below"),
        at(F.ceil("__rank")).alias("__above"),
        F.first(F.col("__rank") - F.floor("__rank")).alias("__part"),
    )
    missed = F.col("__below").isNull() | F.col("__above").isNull()
    interpolated = F.when(missed, F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double")).otherwise(
        F.col("__below") + (F.col("__above") - F.col("__below")) * F.col("__part")
    )
    return found.select(*groups, "p", interpolated.alias("percentile"))


def value_cuts(values: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Per group, borders of about 1000 evenly filled value buckets, as two arrays.

    One row per group, so ``groups`` must be feature- or class-like.
    """
    steps = _FAN * _FAN
    # As SQL text: a thousand Column literals would take seconds to build.
    probs = ", ".join(f"{i / steps}D" for i in range(1, steps))
    cuts = values.groupBy(*groups).agg(F.expr(f"percentile_approx(`{value}`, array({probs}), {ACCURACY})").alias("__cuts"))
    coarse = F.transform(F.sequence(F.lit(_FAN), F.lit(steps - _FAN), F.lit(_FAN)), lambda i: F.get("__cuts", i - 1))
    fine = F.transform(
        F.sequence(F.lit(0), F.lit(_FAN - 1)), lambda g: F.slice(F.col("__cuts"), g * _FAN + 1, F.lit(_FAN - 1))
    )
    return cuts.select(*groups, coarse.alias("__coarse"), fine.alias("__fine"))


def bucket_of(value: str) -> Column:
    """Bucket number of ``value`` among the borders joined in from :func:`value_cuts`: how many lie below it."""

    def below(borders: Callable[[], Column]) -> Column:
        """Borders below the value, found by halving: five comparisons, not one per border."""
        halves = F.array(*[F.lit(_FAN >> i) for i in range(1, _FAN.bit_length())])
        return F.aggregate(
            halves, F.lit(0), lambda at, half: at + F.when(F.get(borders(), at + half - 1) < F.col(value), half).otherwise(F.lit(0))
        )

    # The first number is bound to a variable: it would be found once per comparison of the second.
    major = F.array(below(lambda: F.col("__coarse")))
    return F.get(F.transform(major, lambda m: m * _FAN + below(lambda: F.get("__fine", m))), F.lit(0))
