"""Attribution tables: linear contributions, summaries, individual values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import union_all
from driftwarden.operators.metrics import reported_as
from driftwarden.spec import ModelSpec


@dataclass(frozen=True)
class Attribution:
    """Attributions as arrays: one line per row and class, ``shap`` in the order of ``features``.

    Sums over rows are taken element by element, so rows x features x classes
    lines are never made.
    """

    rows: DataFrame
    features: tuple[str, ...]


def long_form(shap: Attribution) -> DataFrame:
    """One line per row, feature and class."""
    columns = [c for c in shap.rows.columns if c != "shap"]
    listed = F.array(*[F.lit(f) for f in shap.features])
    pairs = F.inline(F.arrays_zip(listed.alias("feature"), F.col("shap").alias("value")))
    return shap.rows.select(*columns, pairs).toDF(*columns, "feature", "value")


def absolute_sums(shap: DataFrame | Attribution, keys: Sequence[str | Column]) -> DataFrame:
    """keys, feature, name_classes, s and n: sum and number of the absolute attributions."""
    if isinstance(shap, DataFrame):
        return shap.groupBy(*keys, "feature", "name_classes").agg(F.sum(F.abs("value")).alias("s"), F.count("value").alias("n"))
    cells = [F.get("shap", F.lit(i)) for i in range(len(shap.features))]
    sums = shap.rows.groupBy(*keys, "name_classes").agg(
        F.array(*[F.sum(F.abs(c)) for c in cells]).alias("s"), F.array(*[F.count(c) for c in cells]).alias("n")
    )
    listed = F.array(*[F.lit(f) for f in shap.features]).alias("feature")
    own = [c for c in sums.columns if c not in ("s", "n", "name_classes")]
    out = sums.select(*own, "name_classes", F.inline(F.arrays_zip(listed, "s", "n"))).toDF(*own, "name_classes", "feature", "s", "n")
    return out.select(*own, "feature", "name_classes", "s", "n")


def linear_shap(
    df: DataFrame, row_id: str, coefficients: Mapping[str, Mapping[str, float]], keep: Sequence[str] = ()
) -> DataFrame:
    """Exact attribution of a linear model: coefficient x (value - mean), one line per row, feature and class.

    ``coefficients`` maps a class name to its feature weights.
    """
    features = list(dict.fromkeys(f for weights in coefficients.values() for f in weights))
    means = df.agg(F.struct(*[F.avg(F.col(f).cast("double")).alias(f) for f in features]).alias("m")).scalar()
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(name).alias("name_classes"),
            (F.lit(float(w)) * (F.col(f).cast("double") - F.col(f"__means.{f}"))).alias("value"),
        )
        for name, weights in coefficients.items()
        for f, w in weights.items()
    ]
    return df.withColumn("__means", means).select(row_id, *keep, F.inline(F.array(*cells)))


def shap_summary(shap: DataFrame | Attribution, spec: ModelSpec, values: Sequence[str]) -> DataFrame:
    """Mean absolute attribution per feature and class, with the class mean as ``all``; all rows and per segment."""
    partial = absolute_sums(shap, [spec.segment])
    labelled = partial.withColumn("__label", reported_as(spec.segment, values))
    means = labelled.groupBy("__label", "feature", "name_classes").agg((F.sum("s") / F.sum("n")).alias("value"))
    overall = means.groupBy("__label", "feature").agg(F.avg("value").alias("value"))
    lines = means.unionByName(overall.withColumn("name_classes", F.lit("all")))
    kind = F.when(F.col("__label") == "all", "explainer_by_all").otherwise("explainer_by_subpoblation")
    return lines.select(
        "feature",
        "value",
        kind.alias("type_metric"),
        F.col("__label").alias("segment"),
        F.lit("shap_abs").alias("metric"),
        "name_classes",
    )


def best_features(importance: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most important features with their place as ``feature_0`` … ``feature_{k-1}``."""
    top = importance.orderBy(F.desc("importance"), "feature").limit(k)
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature")) - 1
    return top.withColumn("place", place).select(
        "feature", "importance", F.concat(F.lit("feature_"), F.col("place").cast("string")).alias("name")
    )


def shap_individual(shap: DataFrame | Attribution, row_id: str, best: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """One line per row and class with the attributions of the best features as columns."""
    if isinstance(shap, Attribution):
        place = {r["name"]: shap.features.index(r["feature"]) for r in best.collect() if r["feature"] in shap.features}  # k rows
        cells = {f"feature_{i}": F.get("shap", F.lit(place.get(f"feature_{i}"))) for i in range(k)}
        return shap.rows.groupBy(*by, row_id, "name_classes").agg(*[F.max(c).alias(n) for n, c in cells.items()])
    named = shap.join(F.broadcast(best.select("feature", "name")), "feature")  # k rows
    return named.groupBy(*by, row_id, "name_classes").agg(
        *[F.max(F.when(F.col("name") == f"feature_{i}", F.col("value"))).alias(f"feature_{i}") for i in range(k)]
    )


def gain_lines(importance: DataFrame) -> DataFrame:
    """Importances in the shape of the other explainer lines."""
    return importance.select(
        "feature",
        F.col("importance").cast("double").alias("value"),
        F.lit("explainer_by_all").alias("type_metric"),
        F.lit("all").alias("segment"),
        F.lit("gain").alias("metric"),
        F.lit("all").alias("name_classes"),
    )


def explainer_mart(
    summary: DataFrame, linear: DataFrame, importance: DataFrame | None, spec: ModelSpec
) -> DataFrame:
    """All attribution lines; importances belong to training runs only."""
    parts = [summary, linear]
    if importance is not None and spec.source == "training":
        parts.append(gain_lines(importance))
    return union_all(parts)
