"""Profiles, data quality, crosstabs, catalogues and associations."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import conform, melt, melt_text, ratio, written
from driftwarden.functions.scalars import equal_width_bands
from driftwarden.operators.metrics import reported_as
from driftwarden.operators.quantiles import exact_percentiles
from driftwarden.spec import FEATURE_SCHEMA, ModelSpec

# Send the helper functions themselves: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def dataset_profile(df: DataFrame, spec: ModelSpec, approximate: bool = False) -> DataFrame:
    """One row describing a modelling table: sizes, period range, distinct keys."""

    def distinct(columns: Sequence[str]) -> Column:
        if approximate:
            return F.approx_count_distinct(F.struct(*columns))
        return F.count_distinct(*[F.col(c) for c in columns])

    return df.agg(
        distinct([spec.name_target]).alias("n_classes"),
        F.min(spec.period).cast("string").substr(1, 10).alias("periodo_min"),
        F.max(spec.period).cast("string").substr(1, 10).alias("periodo_max"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(spec.features)).cast("bigint").alias("n_features"),
        distinct(spec.id_features).alias("n_ids"),
        distinct(spec.obs_features or spec.id_features).alias("n_obs"),
    )


# ------------------------------------------------------------------ data quality

QUALITY_METRICS = [
    "missing_count",
    "missing_percentage",
    "unique_count",
    "unique_percentage",
    "infinite_count",
    "infinite_percentage",
    "percentile_25",
    "percentile_50",
    "percentile_75",
    "min",
    "max",
    "mean",
    "std",
    "new_in_current_values_count",
    "unused_in_current_values_count",
]
# The metrics compared between the two sets.
DELTA_METRICS = [m for m in QUALITY_METRICS if m != "infinite_percentage"]

_UNBOUNDED = float("inf")


def _present(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None))


def data_quality_profile(
    df: DataFrame, cat_features: Sequence[str], cont_features: Sequence[str], set_column: str = "set_data"
) -> DataFrame:
    """Per feature and set (``reference``/``current``): gaps, levels, infinities, quartiles, moments, level turnover.

    Moments of all columns come from one aggregation per set; distinct values
    from one grouping of the long form, whose partial counts absorb hot values.
    """
    cat, cont = list(cat_features), list(cont_features)

    def described(column: str, kind: str) -> Column:
        numeric = kind == "num"
        value = _present(column) if numeric else F.col(column).cast("string")
        infinite = F.count_if(F.abs(value) == _UNBOUNDED) if numeric else F.lit(None)
        moments = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}
        return F.struct(
            F.lit(column).alias("feature"),
            F.lit(kind).alias("feature_type"),
            (F.count(F.lit(1)) - F.count(value)).cast("double").alias("missing_count"),
            F.count(F.lit(1)).cast("double").alias("n"),
            infinite.cast("double").alias("infinite_count"),
            *[(f(value) if numeric else F.lit(None)).cast("double").alias(m) for m, f in moments.items()],
        )

    structs = [described(c, "cat") for c in cat] + [described(c, "num") for c in cont]
    basics = df.groupBy(set_column).agg(F.array(*structs).alias("f")).select(set_column, F.inline("f"))

    # -0.0 and 0.0 are one value; the text form would tell them apart.
    texts = melt_text(
        df.select(set_column, *cat, *[(_present(c) + F.lit(0.0)).alias(c) for c in cont]), [set_column], cat + cont
    ).where(F.col("value").isNotNull())
    in_reference, in_current = (F.count_if(F.col(set_column) == s) for s in ("reference", "current"))
    levels = texts.groupBy("feature", "value").agg(in_reference.alias("r"), in_current.alias("c"))
    turnover = levels.groupBy("feature").agg(
        F.count_if(F.col("r") > 0).alias("reference"),
        F.count_if(F.col("c") > 0).alias("current"),
        F.count_if(F.col("r") == 0).alias("new"),
        F.count_if(F.col("c") == 0).alias("unused"),
    )

    profile = basics.join(F.broadcast(turnover), "feature", "left")  # one row per feature
    if cont:
        numbers = melt(df, [set_column], cont, "feature")
        quartiles = (
            exact_percentiles(numbers, [set_column, "feature"], [0.25, 0.5, 0.75])
            .groupBy(set_column, "feature")
            .agg(
                *[
                    F.max(F.when(F.col("p") == q, F.col("percentile"))).alias(f"percentile_{int(100 * q)}")
                    for q in (0.25, 0.5, 0.75)
                ]
            )
        )
        profile = profile.join(F.broadcast(quartiles), [set_column, "feature"], "left")
    else:
        profile = profile.withColumns({f"percentile_{q}": F.lit(None).cast("double") for q in (25, 50, 75)})
    own = F.coalesce(F.when(F.col(set_column) == "reference", F.col("reference")).otherwise(F.col("current")), F.lit(0))
    only_current = (F.col(set_column) == "current") & (F.col("feature_type") == "cat")
    derived = profile.withColumns(
        {
            "missing_percentage": ratio(100 * F.col("missing_count"), F.col("n")),
            "unique_count": own.cast("double"),
            "unique_percentage": ratio(100 * own, F.col("n")),
            "infinite_percentage": ratio(100 * F.col("infinite_count"), F.col("n")),
            "new_in_current_values_count": F.when(only_current, F.coalesce("new", F.lit(0))).cast("double"),
            "unused_in_current_values_count": F.when(only_current, F.coalesce("unused", F.lit(0))).cast("double"),
        }
    )
    return derived.select(set_column, "feature", "feature_type", *QUALITY_METRICS)


def data_quality_delta(profile: DataFrame, set_column: str = "set_data") -> DataFrame:
    """Absolute reference/current gap of each metric as ``difference_*``; level turnover as is, absent as 0."""

    def side(metric: str, name: str) -> Column:
        return F.max(F.when(F.col(set_column) == name, F.col(metric)))

    columns = []
    for m in DELTA_METRICS:
        if m.endswith("_in_current_values_count"):
            gap = F.coalesce(F.max(m), F.lit(0.0))
        else:
            gap = F.abs(side(m, "current") - side(m, "reference"))
        columns.append(gap.alias(f"difference_{m}"))
    return profile.groupBy("feature").agg(*columns)


def new_and_unused_values(df: DataFrame, column: str, set_column: str = "set_data") -> DataFrame:
    """Levels present on one side only, tagged ``new`` (current only) or ``unused`` (reference only)."""
    sides = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count_if(F.col(set_column) == "reference").alias("r"), F.count_if(F.col(set_column) == "current").alias("c")
    )
    status = F.when(F.col("r") == 0, "new").when(F.col("c") == 0, "unused")
    return sides.where((F.col("r") == 0) != (F.col("c") == 0)).select("value", status.alias("status"))


# ---------------------------------------------------------------------- crosstabs


def _class_counts(long: DataFrame, keys: Sequence[str], label: str, codes: Mapping, n: str | None = None) -> DataFrame:
    """One count column per class code."""
    weight = F.lit(1) if n is None else F.col(n)
    return long.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(label) == code, weight).otherwise(0)).alias(name) for code, name in codes.items()],
    )


def crosstab_by_column(
    long: DataFrame, label: str, codes: Mapping, keys: Sequence[str] = ("feature", "group_feature"), n: str | None = None
) -> DataFrame:
    """Share of each class inside every feature group; absent classes count zero."""
    names = list(codes.values())
    present = long.where(F.col("group_feature").isNotNull() & F.col(label).isin(*codes))
    counts = _class_counts(present, keys, label, codes, n)
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    shares = counts.select(*keys, *[ratio(F.col(c), total).alias(c) for c in names])
    return melt(shares, list(keys), names, "name_classes")


# The ten band labels.
BANDS = [f"P{10 * i:03d}" for i in range(1, 11)]


def crosstab_by_index(
    long: DataFrame, band: str, keys: Sequence[str] = ("feature", "group_feature"), n: str | None = None
) -> DataFrame:
    """Distribution of the score bands inside every feature group, over the bands that occur at all."""
    present = long.where(F.col("group_feature").isNotNull() & F.col(band).isNotNull())
    counts = _class_counts(present, keys, band, {b: b for b in BANDS}, n)
    per_band = melt(counts, list(keys), BANDS)
    outer = [k for k in keys if k != "group_feature"]
    in_group = F.sum("value").over(Window.partitionBy(*keys))
    in_band = F.sum("value").over(Window.partitionBy(*outer, "metric"))
    shares = per_band.withColumns({"__group": in_group, "__band": in_band}).where(F.col("__band") > 0)
    return shares.select(*keys, "metric", ratio(F.col("value"), F.col("__group")).alias("value"))


def top_levels(long: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent levels of every feature of a long table."""
    counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "value"))
    return counts.withColumn("rn", rank).where(F.col("rn") <= k).select("feature", "value", "n")


def data_distribution_mart(df: DataFrame, spec: ModelSpec, k: int = 10) -> DataFrame:
    """Class shares and score-band distributions per group of every feature, for the production rows.

    Numeric features are cut into ten bands, categorical ones reduced to their
    ``k`` largest levels. All features go through one long table, which shrinks
    at once to counts per (feature, group, label, prediction, bands).
    """
    predict = df.where(F.col("set_analysis") == "predict")
    cuts = [f"{c}_cut" for c in spec.sub_cols]
    banded = equal_width_bands(predict, spec.cont_features, suffix="__group")
    keep = [spec.name_target, spec.name_prediction, *cuts]
    source = banded.select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
        *spec.cat_features,
        *[F.col(f"{c}__group").alias(c) for c in spec.cont_features],
    )
    ids = [f"__k{i}" for i in range(len(keep))]
    long = melt_text(source, ids, [*spec.cat_features, *spec.cont_features]).withColumnRenamed("value", "group_feature")
    counts = long.groupBy("feature", "group_feature", *ids).agg(F.count(F.lit(1)).alias("n"))
    if spec.cat_features:
        sizes = counts.where(F.col("group_feature").isNotNull() & F.col("feature").isin(*spec.cat_features))
        sizes = sizes.groupBy("feature", "group_feature").agg(F.sum("n").alias("size"))
        rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("size"), "group_feature"))
        largest = sizes.withColumn("rn", rank).where(F.col("rn") <= k).select("feature", "group_feature")
        kept = counts.join(F.broadcast(largest), ["feature", "group_feature"], "left_semi")  # k rows per feature
        counts = kept.unionByName(counts.where(F.col("feature").isin(*spec.cont_features)))
    counts = written(counts, "group-counts")  # read once per label and class; no longer depends on the row count
    codes = dict(enumerate(spec.sub_cols))
    parts = []
    for flag, label in (("name_target", "__k0"), ("name_prediction", "__k1")):
        shares = crosstab_by_column(counts, label, codes, n="n")
        parts.append(
            shares.withColumns(
                {"flg_target": F.lit(flag), "metric": F.lit("WG"), "type_metric": F.lit("report_general")}
            )
        )
    for i, c in enumerate(spec.sub_cols):
        bands = crosstab_by_index(counts, f"__k{i + 2}", n="n").withColumns(
            {"name_classes": F.lit(c), "type_metric": F.lit("report_detail")}
        )
        flags = F.explode(F.array(F.lit(spec.name_target), F.lit(spec.name_prediction)))
        parts.append(bands.withColumn("flg_target", flags))
    out = conform(parts[0], FEATURE_SCHEMA)
    for p in parts[1:]:
        out = out.unionByName(conform(p, FEATURE_SCHEMA))
    return out


# ------------------------------------------------------------------- associations


def pearson(a: Column, b: Column) -> Column:
    """Correlation over the rows where both are present; NULL when one of them is constant."""
    x, y = a.cast("double"), b.cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair below the diagonal, each over the rows where both are present.

    One pass: every partition adds up its cross products by matrix products,
    NULLs masked, and leaves one row per pair; values are centred first, so
    that the sums stay small. NULL when one of the two is constant.
    """
    features = list(features)
    numeric = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    centres = [v or 0.0 for v in numeric.agg(*[F.avg(f"x{i}") for i in range(len(features))]).first()]

    def products(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, len(centres), len(centres)))
        for batch in batches:
            x = batch.to_numpy(float) - np.array(centres)
            here = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
            square = x * x
            total += np.stack([here.T @ here, x.T @ here, here.T @ x, square.T @ here, here.T @ square, x.T @ x])
        i, j = np.tril_indices(len(centres), -1)
        cells = total[:, i, j]
        yield pd.DataFrame({"i": i, "j": j, **{n: cells[k] for k, n in enumerate(("n", "a", "b", "aa", "bb", "ab"))}})

    fields = "i int, j int, n double, a double, b double, aa double, bb double, ab double"
    sums = numeric.mapInPandas(products, fields).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
    spread = [F.col("n") * F.col(c + c) - F.col(c) * F.col(c) for c in "ab"]
    # Rounding leaves a constant column a trace of spread.
    flat = [v <= 1e-13 * F.col("n") * F.col(c + c) for v, c in zip(spread, "ab", strict=True)]
    value = F.when(~(flat[0] | flat[1]), (F.col("n") * F.col("ab") - F.col("a") * F.col("b")) / F.sqrt(spread[0] * spread[1]))
    names = F.array(*[F.lit(f) for f in features])
    return sums.select(
        F.get(names, F.col("i")).alias("feature"), F.get(names, F.col("j")).alias("other_feature"), value.alias("value")
    )


def linear_association(df: DataFrame, spec: ModelSpec, features: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Absolute correlation of each numeric feature with the label and each class probability, all and per segment."""
    against = [(spec.name_target, "all")] + [(c, c) for c in spec.sub_cols]
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(name).alias("name_classes"),
            F.abs(pearson(F.col(f), F.col(c))).alias("value"),
        )
        for f in features
        for c, name in against
    ]
    columns = dict.fromkeys([*features, *[c for c, _ in against]])
    labelled = df.select(reported_as(spec.segment, values).alias("__label"), *columns)
    per_label = labelled.groupBy("__label").agg(F.array(*cells).alias("cells"))
    out = per_label.select(F.col("__label").alias("segment"), F.inline("cells"))
    kind = F.when(F.col("segment") == "all", "explainer_by_all").otherwise("explainer_by_subpoblation")
    return out.withColumns({"type_metric": kind, "metric": F.lit("linear")}).select(
        "feature", "value", "type_metric", "segment", "metric", "name_classes"
    )


# --------------------------------------------------------------------- catalogues


def mean_fold_importance(importance: DataFrame) -> DataFrame:
    return importance.groupBy("feature").agg(F.avg("importance").alias("importance"))


def collect_nonempty(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Per key the first non-empty value and how many there are.

    Only the first of the collected values is ever used, so no list is built.
    """
    filled = F.when(F.col(value).isNotNull() & (F.col(value) != ""), F.col(order))
    return df.groupBy(key).agg(
        F.min_by(F.col(value), filled).alias("first_value"), F.count(filled).alias("n_values")
    )


def latest_training(df: DataFrame, key: str, time: str, condition: Column) -> DataFrame:
    """Newest time of the qualifying runs per project."""
    return df.where(condition).groupBy(key).agg(F.max(time).alias("period_of_training"))


def period_aggregate(df: DataFrame, label: str, period: str, feature: str, categorical: bool) -> DataFrame:
    """One point per class and period: rows at the feature's most common level, or the feature's mean."""
    if not categorical:
        return df.groupBy(F.col(label).alias("class"), period).agg(F.avg(feature).alias("value"))
    common = (
        df.where(F.col(feature).isNotNull())
        .groupBy(feature)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), feature)
        .limit(1)
        .select(feature)
        .scalar()
    )
    at_level = df.where(F.col(feature) == common)
    return at_level.groupBy(F.col(label).alias("class"), period).agg(F.count(F.lit(1)).cast("double").alias("value"))


def target_rate_catalog(df: DataFrame, target: str, table_name: str, attributes: Mapping[str, str]) -> DataFrame:
    """One row per training table: its positive rate and who owns it."""
    return df.agg(F.avg(F.col(target).cast("double")).alias("tasa_target")).select(
        F.lit(table_name).alias("table_name"), "tasa_target", *[F.lit(v).alias(k) for k, v in attributes.items()]
    )


def variable_catalog(
    df: DataFrame, importance: DataFrame, features: Sequence[str], table_name: str, entity: str, temporal: Sequence[str]
) -> DataFrame:
    """One row per variable: gaps, dependence on time, rank by importance."""
    flags = df.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in features])
    gaps = melt(flags, [], list(features), "column_name", "has_null")
    rank = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))
    ranks = importance.select("feature", rank.alias("rank_variable"))
    return gaps.join(F.broadcast(ranks), gaps.column_name == ranks.feature, "left").select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        F.lit(entity).alias("fs_entidad"),
        F.col("column_name").alias("fs_feature"),
        F.col("column_name").isin(*temporal).alias("flag_dep_temporal"),
        (F.col("has_null") == 1).alias("flag_nulos"),
        "rank_variable",
    )
