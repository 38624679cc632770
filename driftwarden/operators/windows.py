"""Rankings, top-k reports, and bands over time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.operators.ordering import global_row_number


def rolling_bands(
    df: DataFrame, series: Sequence[str], time: str, value: str, window_pct: float = 0.2, width: float = 2.5
) -> DataFrame:
    """Mean ± ``width`` population deviations over a moving window, and the points outside.

    With N points in a series and k = int(window_pct * N), point i sees the rows
    i-k … i+k-1 of its series. k differs between series, so the window sums are
    differences of running sums at two positions, fetched by equality on the
    position. Values are centred first, to keep the squares small. k = 0 gives
    NULL bands. A series has one row per period, which bounds its window.
    """
    series = list(series)
    whole = Window.partitionBy(*series)
    ordered = whole.orderBy(time)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    centred = F.col(value).cast("double") - F.col("__mean")
    base = (
        df.withColumn("__i", F.row_number().over(ordered) - 1)
        .withColumn("__n", F.count(F.lit(1)).over(whole))
        .withColumn("__mean", F.avg(F.col(value).cast("double")).over(whole))
        .withColumn("__s", F.sum(centred).over(running))
        .withColumn("__q", F.sum(centred * centred).over(running))
        .withColumn("__k", F.floor(F.lit(float(window_pct)) * F.col("__n")))
    )
    last = F.least(F.col("__i") + F.col("__k") - 1, F.col("__n") - 1)
    first = F.greatest(F.col("__i") - F.col("__k"), F.lit(0))
    base = base.withColumns({"__to": last, "__from": first - 1})
    sums = base.select(*series, F.col("__i").alias("__at"), F.col("__s").alias("__ss"), F.col("__q").alias("__qq"))
    upto = sums.toDF(*series, "__to", "__s_to", "__q_to")
    before = sums.toDF(*series, "__from", "__s_from", "__q_from")
    joined = base.join(upto, [*series, "__to"], "left").join(before, [*series, "__from"], "left")
    count = F.col("__to") - F.col("__from")
    some = F.col("__k") > 0
    mean = F.when(some, (F.col("__s_to") - F.coalesce("__s_from", F.lit(0.0))) / count)
    square = F.when(some, (F.col("__q_to") - F.coalesce("__q_from", F.lit(0.0))) / count)
    deviation = F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))
    out = joined.withColumns(
        {
            "upper": F.col("__mean") + mean + F.lit(width) * deviation,
            "lower": F.col("__mean") + mean - F.lit(width) * deviation,
        }
    )
    outside = (F.col(value) > F.col("upper")) | (F.col(value) < F.col("lower"))
    return out.withColumn("anomaly", F.coalesce(outside, F.lit(False))).select(
        *df.columns, "upper", "lower", "anomaly"
    )


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key. Spark keeps one candidate per key and task before the shuffle, so hot keys stay small."""
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__rn", F.row_number().over(latest)).where("__rn = 1").drop("__rn")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    earliest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(earliest)).where("__rn = 1").drop("__rn")


def latest_n(df: DataFrame, time: str, tie: str, n: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The newest ``n`` rows, overall or per key."""
    order = [F.desc(time), F.desc(tie)]
    if not by:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("__rn", rank).where(F.col("__rn") <= n).drop("__rn")


def variable_rank(importance: DataFrame) -> DataFrame:
    """Dense rank of the features by importance; the table has one row per feature."""
    return importance.withColumn("rank_variable", F.dense_rank().over(Window.orderBy(F.desc("importance"))))


def sort_by_period(df: DataFrame, period: str, *ties: str) -> DataFrame:
    return df.orderBy(period, *ties)


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


def top_categories(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Rows in the ``k`` most frequent levels."""
    return df.join(F.broadcast(top_values(df, column, k).select(column)), column, "left_semi")  # k rows


def top_segments_by_value(df: DataFrame, segment: str, first: Column, second: Column, k: int = 12) -> DataFrame:
    """Sums of two measures per segment, the ``k`` largest by the first, then the second."""
    sums = df.groupBy(segment).agg(F.sum(first).alias("first_value"), F.sum(second).alias("second_value"))
    return sums.orderBy(F.desc("first_value"), F.desc("second_value"), segment).limit(k)


def select_features(importance: DataFrame, mode: str, threshold: float, n_features: int | None = None) -> DataFrame:
    """``gain``: importance of at least ``threshold``; ``n_features``: the best int(threshold * n)."""
    if mode == "gain":
        return importance.where(F.col("importance") >= threshold)
    if mode != "n_features":
        raise ValueError(f"unknown mode {mode}")
    total = importance.count() if n_features is None else n_features
    return importance.orderBy(F.desc("importance"), "feature").limit(int(threshold * total))


def row_surrogate_id(df: DataFrame, order: Sequence[str], name: str = "row_id", prefix: str = "R_") -> DataFrame:
    """Dense ids ``R_0`` … ``R_n`` in the given order."""
    numbered = global_row_number(df, order, "__rn")
    return numbered.withColumn(name, F.concat(F.lit(prefix), (F.col("__rn") - 1).cast("string"))).drop("__rn")


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.distinct() if columns is None else df.select(*columns).distinct()
