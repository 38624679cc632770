"""Monitoring tables of every period at once, from sums that are taken in one pass over the scored rows.

Each function takes ``by``, the columns that tell the runs of a monitoring job
apart (the period), and gives the lines of every run. The reference is described
once; what a run adds are its own sums. A run's lines are those that the batch
job gives for its rows alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import melt, melt_text, ratio, together, union_all, written
from driftwarden.functions.scalars import band_label, band_number
from driftwarden.operators import drift as D
from driftwarden.operators import explain as E
from driftwarden.operators import metrics as M
from driftwarden.operators import partial_sums as S
from driftwarden.operators import profile as P
from driftwarden.operators import value_counts as V
from driftwarden.operators.value_counts import same
from driftwarden.spec import ModelSpec

LABEL, PREDICTION = D.LABEL, D.PREDICTION


@dataclass
class Sums:
    """The tables everything is folded from; all of them add up over batches of rows."""

    cells: DataFrame
    scores: DataFrame
    counts: DataFrame


def added(parts: Sequence[Sums], by: Sequence[str]) -> Sums:
    """The sums of several batches of rows."""
    return Sums(
        S.merged_cells([p.cells for p in parts], by),
        S.merged_scores([p.scores for p in parts], by),
        V.merged([p.counts for p in parts], by),
    )


def reference_limits(rows: DataFrame, spec: ModelSpec) -> DataFrame:
    """The range of the reference's scores, one line per class."""
    return M.class_scores(rows, spec).groupBy("name_classes").agg(F.min("score").alias("r_lo"), F.max("score").alias("r_hi"))


def side_counts(rows: DataFrame, spec: ModelSpec, side: str, by: Sequence[str]) -> DataFrame:
    """Value counts of the features, the label and the prediction of rows that belong to one side."""
    named = rows.withColumns({LABEL: F.col(spec.name_target), PREDICTION: F.col(spec.name_prediction), "__side": F.lit(side)})
    return V.value_counts(named, [*spec.cat_features, LABEL, PREDICTION], spec.cont_features, "__side", by)


def sums_of(rows: DataFrame, spec: ModelSpec, by: Sequence[str]) -> Sums:
    """The sums of scored production rows."""
    return Sums(S.cell_sums(rows, spec, by), S.score_sums(rows, spec, by), side_counts(rows, spec, V.CURRENT, by))


def kept(sums: Sums) -> Sums:
    named = {"cells": sums.cells, "scores": sums.scores, "value-counts": sums.counts}
    return Sums(*together(sums.cells.sparkSession, *[partial(written, df, name) for name, df in named.items()]))


def performance_lines(sums: Sums, limits: DataFrame, spec: ModelSpec, by: Sequence[str]) -> DataFrame:
    """The performance mart of every run; score bands span the run and the reference."""
    own = S.score_limits(sums.scores, by)
    borders = own.join(F.broadcast(limits), "name_classes", "left")  # one line per class
    borders = borders.select(*by, "name_classes", F.least("lo", "r_lo").alias("lo"), F.greatest("hi", "r_hi").alias("hi"))
    return S.performance_mart(sums.cells, sums.scores, spec, by, limits=borders)


def _with_bands(rows: DataFrame, columns: Sequence[str], limits: DataFrame, by: Sequence[str], suffix: str) -> DataFrame:
    """Band labels of ``columns`` between the ``lo_``/``hi_`` limits of each run."""
    joined = rows.alias("v").join(F.broadcast(limits).alias("l"), same("v", "l", by))  # one line per run
    bands = [
        band_label(band_number(F.col(f"v.{c}").cast("double"), F.col(f"lo_{c}"), F.col(f"hi_{c}"), 10)).alias(f"{c}{suffix}") for c in columns
    ]
    return joined.select("v.*", *bands)


def distribution_lines(rows: DataFrame, limits: DataFrame, spec: ModelSpec, by: Sequence[str], k: int = 10) -> DataFrame:
    """Class shares and score-band shares per group of every feature and run.

    Numeric features are cut into ten bands of their run, categories reduced to
    their ``k`` largest. What is counted is one level at a time (label,
    prediction, the band of one class), never the cross of all of them.
    """
    ends = [f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in (*spec.cont_features, *spec.sub_cols) for n, f in (("lo", F.min), ("hi", F.max))]
    own = rows.groupBy(*by).agg(*ends)
    wide = limits.agg(*[F.max(F.when(F.col("name_classes") == c, F.col(f"r_{n}"))).alias(f"r_{n}_{c}") for c in spec.sub_cols for n in ("lo", "hi")])
    own = own.crossJoin(F.broadcast(wide))  # one line
    own = own.withColumns({f"lo_{c}": F.least(f"lo_{c}", f"r_lo_{c}") for c in spec.sub_cols})
    own = written(own.withColumns({f"hi_{c}": F.greatest(f"hi_{c}", f"r_hi_{c}") for c in spec.sub_cols}), "run-limits")
    named = rows.select(*by, *dict.fromkeys([*spec.features, *spec.sub_cols]), F.col(spec.name_target).alias(LABEL), F.col(spec.name_prediction).alias(PREDICTION))
    banded = _with_bands(named, [*spec.cont_features, *spec.sub_cols], own, by, "__band")
    levels = F.array(
        F.struct(F.lit("name_target").alias("flag"), F.col(LABEL).cast("string").alias("level")),
        F.struct(F.lit("name_prediction").alias("flag"), F.col(PREDICTION).cast("string").alias("level")),
        *[F.struct(F.lit(f"class {c}").alias("flag"), F.col(f"{c}__band").alias("level")) for c in spec.sub_cols],
    )
    source = banded.select(*by, levels.alias("levels"), *spec.cat_features, *[F.col(f"{c}__band").alias(c) for c in spec.cont_features])
    source = source.select(*by, F.inline("levels"), *spec.features)
    long = melt_text(source, [*by, "flag", "level"], list(spec.features)).withColumnRenamed("value", "group_feature")
    counts = long.where("group_feature IS NOT NULL").groupBy(*by, "feature", "group_feature", "flag", "level").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "group-counts")
    if spec.cat_features:
        sizes = counts.where((F.col("flag") == "name_target") & F.col("feature").isin(*spec.cat_features))
        sizes = sizes.groupBy(*by, "feature", "group_feature").agg(F.sum("n").alias("size"))
        rank = F.row_number().over(Window.partitionBy(*by, "feature").orderBy(F.desc("size"), "group_feature"))
        largest = sizes.withColumn("rn", rank).where(F.col("rn") <= k)
        inside = counts.alias("v").join(F.broadcast(largest).alias("l"), same("v", "l", [*by, "feature", "group_feature"]), "left_semi")  # k each
        counts = inside.unionByName(counts.where(F.col("feature").isin(*spec.cont_features)))
    keys = [*by, "feature", "group_feature"]
    codes = {str(i): c for i, c in enumerate(spec.sub_cols)}
    labels = counts.where(F.col("flag").isin("name_target", "name_prediction") & F.col("level").isin(*codes))
    per_class = labels.groupBy(*keys, "flag").agg(*[F.sum(F.when(F.col("level") == i, F.col("n")).otherwise(0)).alias(c) for i, c in codes.items()])
    total = sum((F.col(c) for c in spec.sub_cols[1:]), F.col(spec.sub_cols[0]))
    shares = per_class.select(*keys, F.col("flag").alias("flg_target"), *[ratio(F.col(c), total).alias(c) for c in spec.sub_cols])
    shares = melt(shares, [*keys, "flg_target"], list(spec.sub_cols), "name_classes")
    shares = shares.withColumns({"metric": F.lit("WG"), "type_metric": F.lit("report_general")})

    bands = counts.where(F.col("flag").startswith("class ") & F.col("level").isNotNull())
    per_band = bands.groupBy(*keys, "flag").agg(*[F.sum(F.when(F.col("level") == b, F.col("n")).otherwise(0)).alias(b) for b in P.BANDS])
    long_bands = melt(per_band, [*keys, "flag"], P.BANDS)
    in_group = F.sum("value").over(Window.partitionBy(*keys, "flag"))
    # Bands that occur for some group of the feature; ten lines per feature, class and run.
    occurring = bands.select(*by, "feature", "flag", F.col("level").alias("metric")).distinct()
    detail = long_bands.withColumn("all", in_group).alias("v").join(
        F.broadcast(occurring).alias("o"), same("v", "o", [*by, "feature", "flag", "metric"]), "left_semi"
    )
    detail = detail.select(*keys, F.expr("substring(flag, 7)").alias("name_classes"), "metric", ratio(F.col("value"), F.col("all")).alias("value"))
    flags = F.explode(F.array(F.lit(spec.name_target), F.lit(spec.name_prediction)))
    detail = detail.withColumns({"type_metric": F.lit("report_detail")}).withColumn("flg_target", flags)
    columns = [*keys, "name_classes", "flg_target", "metric", "value", "type_metric"]
    return shares.select(*columns).unionByName(detail.select(*columns))


def shap_lines(shap: DataFrame | E.Attribution, segments: DataFrame, spec: ModelSpec, by: Sequence[str]) -> DataFrame:
    """Mean absolute attribution per run, segment, feature and class, with the class mean as ``all``."""
    partial = E.absolute_sums(shap, [*by, F.col(spec.segment).alias("segment")])
    means = S.labelled(partial, segments, by).groupBy(*by, "segment", "feature", "name_classes").agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("value")
    )
    overall = means.groupBy(*by, "segment", "feature").agg(F.avg("value").alias("value")).withColumn("name_classes", F.lit("all"))
    kind = F.when(F.col("segment") == "all", "explainer_by_all").otherwise("explainer_by_subpoblation")
    return means.unionByName(overall).withColumns({"type_metric": kind, "metric": F.lit("shap_abs")})


def association_lines(
    rows: DataFrame, segments: DataFrame, spec: ModelSpec, features: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Absolute correlation of each numeric feature with the label and each class probability, per run and segment.

    Every segment's sums of products are taken once, over rows where both sides
    are present; ``all`` adds them up, so no row is read twice.
    """
    against = [(spec.name_target, "all")] + [(c, c) for c in spec.sub_cols]
    centre = rows.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(c) for c in dict.fromkeys([*features, *[c for c, _ in against]])]).first()

    def value(c: str) -> Column:
        return F.col(f"`{c}`").cast("double") - F.lit(float(centre[c] or 0.0))  # small sums

    cells = []
    for f in features:
        for c, name in against:
            x, y = F.when(value(c).isNotNull(), value(f)), F.when(value(f).isNotNull(), value(c))
            sums = {"n": F.count(x + y), "a": F.sum(x), "b": F.sum(y), "aa": F.sum(x * x), "bb": F.sum(y * y), "ab": F.sum(x * y)}
            cells.append(F.struct(F.lit(f).alias("feature"), F.lit(name).alias("name_classes"), *[s.cast("double").alias(k) for k, s in sums.items()]))
    partial = rows.groupBy(*by, F.col(spec.segment).alias("segment")).agg(F.array(*cells).alias("cells"))
    partial = partial.select(*by, "segment", F.inline("cells"))
    keys = [*by, "segment", "feature", "name_classes"]
    whole = S.labelled(partial, segments, by).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
    spread = [F.col("n") * F.col(c + c) - F.col(c) * F.col(c) for c in "ab"]
    flat = [v <= 1e-13 * F.col("n") * F.col(c + c) for v, c in zip(spread, "ab", strict=True)]
    found = F.when(~(flat[0] | flat[1]), F.abs(F.col("n") * F.col("ab") - F.col("a") * F.col("b")) / F.sqrt(spread[0] * spread[1]))
    kind = F.when(F.col("segment") == "all", "explainer_by_all").otherwise("explainer_by_subpoblation")
    return whole.select(*keys, found.alias("value"), kind.alias("type_metric"), F.lit("linear").alias("metric"))


def board_lines(performance: DataFrame, general: DataFrame, explainer: DataFrame, by: Sequence[str]) -> DataFrame:
    """One leaderboard row per run, picked out of its marts."""
    overall = F.col("type_metric") == "performance_by_all"
    names = ["log_loss", "accuracy", "roc_auc_score", "gini", "precision", "recall", "f1_score"]
    board = performance.groupBy(*by).agg(*[F.avg(F.when(overall & (F.col("metric") == n), F.col("value"))).alias(n) for n in names])
    total = (F.col("type_metric") == "explainer_by_all") & (F.col("metric") == "shap_abs") & (F.col("name_classes") == "all")
    shares = explainer.where(total).groupBy(*by).agg(
        F.avg((F.col("value") > 0).cast("double")).alias("fi_shap_0"), F.avg((F.col("value") > 0.5).cast("double")).alias("fi_shap_0_5")
    )
    drift = general.select(
        *by,
        F.col("share_drifted_features").alias("feature_drift"),
        F.col("real_drift").alias("target_drift"),
        "prediction_drift",
    )
    keys = ["name_classes", "percentil", "segment"]
    pairs = performance.where(F.col("metric").isin("target_rlt", "prediction_rlt")).groupBy(*by, *keys).agg(
        F.max(F.when(F.col("metric") == "target_rlt", F.col("value"))).alias("t"),
        F.max(F.when(F.col("metric") == "prediction_rlt", F.col("value"))).alias("p"),
    )
    gaps = pairs.groupBy(*by).agg(F.avg(F.abs(F.col("t") - F.col("p"))).alias("kpi_mae"))
    for more in (shares, drift, gaps):  # one line per run
        columns = [c for c in more.columns if c not in by]
        joined = board.alias("a").join(F.broadcast(more).alias("b"), same("a", "b", by), "left")
        board = joined.select("a.*", *[F.col(f"b.{c}") for c in columns])
    return board.withColumns({n: F.lit(None).cast("double") for n in ("cpu_usage_percent", "ram_usage_percent")})


def period_marts(
    scored: DataFrame,
    spec: ModelSpec,
    shap: DataFrame | E.Attribution | None = None,
    numeric_features: Sequence[str] = (),
    coded: DataFrame | None = None,
    by: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Every mart of every period of a scored frame: training rows are the reference, predicted rows the runs.

    ``scored`` should be a written table; its predicted rows are read once for
    the performance sums, once for the scores and once for the value counts, the
    training rows once for their counts and once for their range of scores,
    whatever the number of periods. ``shap`` holds attributions of the predicted
    rows with their segment and period, ``coded`` these rows with encoded
    features. NULL periods are a period of their own.
    """
    by = list(by) or [spec.period]
    predict, reference = (scored.where(F.col("set_analysis") == s) for s in ("predict", "training"))
    limits = written(reference_limits(reference, spec), "reference-limits")
    own = sums_of(predict, spec, by)
    counts = own.counts.unionByName(side_counts(reference, spec, V.REFERENCE, by))
    sums = kept(Sums(own.cells, own.scores, counts))
    performance = written(performance_lines(sums, limits, spec, by), "performance")
    drift = D.drift_of(sums.counts, spec.cat_features, spec.cont_features, by)
    general = written(drift.general, "drift-general")
    marts = {
        "perf__general_metrics": performance,
        "drift__general": general,
        "drift__specific": drift.specific,
        "feature__distribution": distribution_lines(predict, limits, spec, by),
    }
    if shap is not None:
        segments = S.reported_segments(sums.cells, by)
        association = association_lines(predict if coded is None else coded, segments, spec, numeric_features, by)
        attributions = shap_lines(shap, segments, spec, by)
        explainer = written(attributions.unionByName(association.select(*attributions.columns)), "explainer")
        marts["feature__explainer_general"] = explainer
        marts["leaderboard"] = board_lines(performance, general, explainer, by)
    return marts
