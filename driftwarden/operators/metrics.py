"""Classification quality and value metrics, for all rows and per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import conform, melt, ratio, ratio_or_zero, union_all
from driftwarden.operators.quantiles import bucket_of, value_cuts
from driftwarden.spec import METRIC_SCHEMA, ModelSpec

# Double epsilon: probabilities are kept this far from 0 and 1.
EPSILON = 2.220446049250313e-16
N_CUTOFFS = 50

CLASS_METRICS = [
    "recall",
    "precision",
    "f1_score",
    "false_positive_rate",
    "false_negative_rate",
    "true_positive_rate",
    "true_negative_rate",
    "selection_rate",
]
GENERAL_METRICS = ["log_loss", "accuracy", "roc_auc_score", "gini", "count"]


def top_segments(df: DataFrame, segment: str, k: int = 3) -> DataFrame:
    """The most frequent segment values."""
    return (
        df.where(F.col(segment).isNotNull())
        .groupBy(segment)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), segment)
        .limit(k)
    )


def segment_values(df: DataFrame, spec: ModelSpec) -> list[str]:
    """The segments to report: those of the spec, else the top three."""
    if spec.segment_values is not None:
        return list(spec.segment_values)
    return [r[spec.segment] for r in top_segments(df, spec.segment).collect()]


def reported_as(segment: str, values: Sequence[str]) -> Column:
    """The labels a row, or a partial sum, counts under: ``all`` and its own segment if listed.

    A segment that is itself named ``all`` has no line of its own and counts once.
    """
    own = F.array_distinct(F.array(F.lit("all"), F.col(segment).cast("string")))
    return F.explode(F.when(F.col(segment).isin(*values), own).otherwise(F.array(F.lit("all"))))


def grouping_all_and_segment(df: DataFrame, segment: str, values: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Additive measures once over all rows and once per listed segment.

    The rows are summed per segment first; the ``all`` line adds up those
    partial sums, so no row is duplicated.
    """
    partial = df.groupBy(segment).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    labelled = partial.withColumn("__label", reported_as(segment, values)).drop(segment)
    return (
        labelled.groupBy("__label")
        .agg(*[F.sum(n).alias(n) for n in sums])
        .withColumnRenamed("__label", "segment")
    )


def row_log_loss(spec: ModelSpec) -> Column:
    p = F.element_at(F.array(*[F.col(c) for c in spec.sub_cols]), F.col(spec.name_target) + 1)
    return -F.ln(F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1.0 - EPSILON)))


def _correct(spec: ModelSpec) -> Column:
    return F.when(F.col(spec.name_target) == F.col(spec.name_prediction), 1).otherwise(0)


def metric_log_loss(df: DataFrame, spec: ModelSpec, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(row_log_loss(spec)).alias("log_loss"))


def metric_accuracy(df: DataFrame, spec: ModelSpec, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(_correct(spec)).alias("accuracy"))


def metric_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("count"))


def class_scores(df: DataFrame, spec: ModelSpec, keep: Sequence[str] = ()) -> DataFrame:
    """One row per scored row and class: ``name_classes, score, y`` and the kept columns."""
    per_class = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("name_classes"),
                    F.col(c).cast("double").alias("score"),
                    F.when(F.col(spec.name_target) == i, 1).otherwise(0).alias("y"),
                )
                for i, c in enumerate(spec.sub_cols)
            ]
        )
    )
    return df.select(*keep, per_class)


def class_auc(df: DataFrame, spec: ModelSpec, by: Sequence[str] = (), labels: Column | None = None) -> DataFrame:
    """Rank AUC of every class against the rest: ``by, name_classes, auc, support, n``.

    Rows shrink to counts per distinct score, which carry all ties. Running
    counts are taken inside evenly filled score buckets, and each bucket is
    lifted by the negatives of the buckets below it, so that the widest sort is
    one bucket. ``labels`` optionally replaces the counts' ``by`` by several
    reporting labels (the ``all`` line), after the rows have shrunk.
    """
    by = list(by)
    scores = class_scores(df, spec, by)
    counts = scores.groupBy(*by, "name_classes", "score").agg(
        F.sum("y").cast("double").alias("pos"), F.sum(1 - F.col("y")).cast("double").alias("neg")
    )
    if labels is not None:
        counts = (
            counts.withColumn("segment_label", labels)
            .groupBy("segment_label", "name_classes", "score")
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        )
        by = ["segment_label"]
    return auc_of_counts(counts, by, value_cuts(scores, ["name_classes"], "score"))


def auc_of_counts(counts: DataFrame, by: Sequence[str], cuts: DataFrame) -> DataFrame:
    """``class_auc`` from the counts ``by, name_classes, score, pos, neg`` and the borders of the score buckets."""
    placed = counts.join(F.broadcast(cuts), "name_classes").withColumn("__bucket", bucket_of("score"))
    placed = placed.select(*by, "name_classes", "__bucket", "score", "pos", "neg")
    running = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(*by, "name_classes", "__bucket").orderBy("score").rowsBetween(*running)
    won = F.col("pos") * (F.sum("neg").over(inside) - F.col("neg") / 2)
    buckets = (
        placed.withColumn("won", won)
        .groupBy(*by, "name_classes", "__bucket")
        .agg(*[F.sum(c).alias(c) for c in ("won", "pos", "neg")])
    )
    below = Window.partitionBy(*by, "name_classes").orderBy("__bucket").rowsBetween(*running)
    lifted = F.col("won") + F.col("pos") * (F.sum("neg").over(below) - F.col("neg"))
    return (
        buckets.withColumn("won", lifted)
        .groupBy(*by, "name_classes")
        .agg(*[F.sum(c).alias(c) for c in ("won", "pos", "neg")])
        .select(
            *by,
            "name_classes",
            ratio(F.col("won"), F.col("pos") * F.col("neg")).alias("auc"),
            F.col("pos").alias("support"),
            (F.col("pos") + F.col("neg")).alias("n"),
        )
    )


def metric_auc(df: DataFrame, spec: ModelSpec, by: Sequence[str] = (), labels: Column | None = None) -> DataFrame:
    """AUC of the second class for two classes, else one-vs-rest weighted by class size.

    NULL as soon as a class is absent, since its rank statistic is undefined.
    """
    per_class = class_auc(df, spec, by, labels)
    keys = ["segment_label"] if labels is not None else list(by)
    if spec.n_classes <= 2:
        return per_class.where(F.col("name_classes") == spec.sub_cols[-1]).select(
            *keys, F.col("auc").alias("roc_auc_score")
        )
    weighted = F.sum(F.col("auc") * F.col("support")) / F.sum("support")
    complete = F.count("auc") == spec.n_classes
    return per_class.groupBy(*keys).agg(F.when(complete, weighted).alias("roc_auc_score"))


def gini(auc: Column) -> Column:
    return F.lit(2.0) * auc - F.lit(1.0)


def metric_gini(df: DataFrame, spec: ModelSpec, by: Sequence[str] = ()) -> DataFrame:
    return metric_auc(df, spec, by).withColumn("gini", gini(F.col("roc_auc_score")))


def _tagged(df: DataFrame, kind: str) -> DataFrame:
    """Type tag and the fixed columns of lines that belong to no band."""
    suffix = F.when(F.col("segment") == "all", "all").otherwise("subpoblation")
    return df.withColumns(
        {"type_metric": F.concat(F.lit(f"{kind}_by_"), suffix), "percentil": F.lit("all")}
    )


def general_metrics(df: DataFrame, spec: ModelSpec, values: Sequence[str]) -> DataFrame:
    """Log-loss, accuracy, AUC, Gini and count, overall and per segment."""
    sums = grouping_all_and_segment(
        df,
        spec.segment,
        values,
        {"__loss": row_log_loss(spec), "__hits": _correct(spec), "count": F.lit(1)},
    )
    auc = metric_auc(df, spec, [spec.segment], reported_as(spec.segment, values))
    wide = sums.join(auc, sums.segment == auc.segment_label, "left").select(
        "segment",
        ratio(F.col("__loss"), F.col("count")).alias("log_loss"),
        ratio(F.col("__hits"), F.col("count")).alias("accuracy"),
        "roc_auc_score",
        gini(F.col("roc_auc_score")).alias("gini"),
        "count",
    )
    long = melt(wide, ["segment"], GENERAL_METRICS)
    return conform(_tagged(long, "performance").withColumn("name_classes", F.lit("all")), METRIC_SCHEMA)


def kpi_value(df: DataFrame, spec: ModelSpec, values: Sequence[str]) -> DataFrame:
    """Mean (``_rlt``) and sum (``_abs``) of label, prediction, and both times the KPI."""
    target, prediction, kpi = (F.col(c).cast("double") for c in (spec.name_target, spec.name_prediction, spec.kpi))
    measures = {
        "kpi_w_target": kpi * target,
        "kpi_w_prediction": kpi * prediction,
        "target": target,
        "prediction": prediction,
    }
    sums = grouping_all_and_segment(
        df,
        spec.segment,
        values,
        measures | {f"__n_{n}": F.when(c.isNotNull(), 1).otherwise(0) for n, c in measures.items()},
    )
    wide = sums.select(
        "segment",
        *[ratio(F.col(n), F.col(f"__n_{n}")).alias(f"{n}_rlt") for n in measures],
        *[F.col(n).alias(f"{n}_abs") for n in measures],
    )
    long = melt(wide, ["segment"], [f"{n}_{k}" for k in ("rlt", "abs") for n in measures])
    return conform(_tagged(long, "value").withColumn("name_classes", F.lit("all")), METRIC_SCHEMA)


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """The eight class metrics from the four cells; zero where a denominator is zero."""
    recall = ratio_or_zero(tp, tp + fn)
    return {
        "recall": recall,
        "precision": ratio_or_zero(tp, tp + fp),
        "f1_score": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        "false_positive_rate": ratio_or_zero(fp, fp + tn),
        "false_negative_rate": ratio_or_zero(fn, tp + fn),
        "true_positive_rate": recall,
        "true_negative_rate": ratio_or_zero(tn, fp + tn),
        "selection_rate": ratio_or_zero(tp + fp, tp + fp + fn + tn),
    }


def class_confusion_metrics(df: DataFrame, spec: ModelSpec, values: Sequence[str]) -> DataFrame:
    """One-vs-rest metrics of every class predicted at least once in the group.

    The rows shrink to the confusion matrix per segment; everything after works
    on classes x classes counts.
    """
    cells = df.groupBy(spec.segment, spec.name_target, spec.name_prediction).agg(F.count(F.lit(1)).alias("n"))
    labelled = cells.withColumn("label", reported_as(spec.segment, values))
    per_class = labelled.select(
        "label",
        "n",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("name_classes"),
                        (F.col(spec.name_target) == i).alias("real"),
                        (F.col(spec.name_prediction) == i).alias("said"),
                    )
                    for i, c in enumerate(spec.sub_cols)
                ]
            )
        ).alias("cell"),
    )
    real, said = F.col("cell.real"), F.col("cell.said")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    counted = per_class.groupBy(F.col("label").alias("segment"), F.col("cell.name_classes").alias("name_classes")).agg(
        total(real & said).alias("tp"),
        total(~real & said).alias("fp"),
        total(real & ~said).alias("fn"),
        total(~real & ~said).alias("tn"),
    )
    predicted = counted.where(F.col("tp") + F.col("fp") > 0)
    wide = predicted.select("segment", "name_classes", *_rate_columns())
    return conform(_tagged(melt(wide, ["segment", "name_classes"], CLASS_METRICS), "performance"), METRIC_SCHEMA)


def _rate_columns() -> list[Column]:
    cells = (F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return [c.alias(n) for n, c in rates(*cells).items()]


def cutoff_metrics(df: DataFrame, spec: ModelSpec, values: Sequence[str], n_cutoffs: int = N_CUTOFFS) -> DataFrame:
    """The class metrics of ``score > cutoff`` for evenly spaced cutoffs in [0, 1].

    Cutoff j is j/(n-1), and a score passes it exactly when
    j < ceil(score * (n-1)). Counting rows per that number leaves a few hundred
    counts, from which all cutoffs follow.
    """
    steps = n_cutoffs - 1
    scores = class_scores(df, spec, [spec.segment]).withColumn("b", F.ceil(F.lit(float(steps)) * F.col("score")))
    counts = scores.groupBy(spec.segment, "name_classes", "b", "y").agg(F.count(F.lit(1)).alias("n"))
    spread = counts.withColumn("segment_label", reported_as(spec.segment, values)).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.lit(steps)))
    )

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    passes, real = F.col("j") < F.col("b"), F.col("y") == 1
    cells = spread.groupBy(F.col("segment_label").alias("segment"), "name_classes", "j").agg(
        total(passes & real).alias("tp"),
        total(passes & ~real).alias("fp"),
        total(~passes & real).alias("fn"),
        total(~passes & ~real).alias("tn"),
    )
    wide = cells.select(
        "segment", "name_classes", (F.col("j") / F.lit(float(steps))).alias("cutoff"), *_rate_columns()
    )
    long = melt(wide, ["segment", "name_classes", "cutoff"], CLASS_METRICS)
    return conform(_tagged(long, "performance_w_cutoff"), METRIC_SCHEMA)


def decile_capture(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Per class and score band: rows, label mean/sum, probability mean/sum.

    Bands without rows are listed with a zero count.
    """
    names = ["count", "target_rlt", "target_abs", "prediction_rlt", "prediction_abs"]
    per_class = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("name_classes"),
                        F.col(f"{c}_cut").alias("band"),
                        F.col(spec.name_target).cast("double").alias("t"),
                        F.col(c).cast("double").alias("p"),
                    )
                    for c in spec.sub_cols
                ]
            )
        )
    )
    sums = per_class.groupBy("name_classes", "band").agg(
        F.count("t").alias("n"), F.sum("t").alias("t"), F.sum("p").alias("p")
    )
    bands = F.array(*[F.lit(f"P{10 * i:03d}") for i in range(1, 11)])
    spread = sums.withColumn("percentil", F.explode(bands)).withColumn("own", F.col("band") == F.col("percentil"))
    wide = (
        spread.groupBy("name_classes", "percentil")
        .agg(*[F.sum(F.when(F.col("own"), F.col(c)).otherwise(0)).alias(c) for c in ("n", "t", "p")])
        .select(
            "name_classes",
            "percentil",
            F.col("n").alias("count"),
            ratio(F.col("t"), F.col("n")).alias("target_rlt"),
            F.col("t").alias("target_abs"),
            ratio(F.col("p"), F.col("n")).alias("prediction_rlt"),
            F.col("p").alias("prediction_abs"),
        )
    )
    long = melt(wide, ["name_classes", "percentil"], names)
    tags = {"type_metric": F.lit("captura_by_all"), "segment": F.lit("all")}
    return conform(long.withColumns(tags), METRIC_SCHEMA)


def general_metric_mart(df: DataFrame, spec: ModelSpec, values: Sequence[str] | None = None) -> DataFrame:
    """Every performance and value line of the production rows, stacked."""
    predict = df.where(F.col("set_analysis") == "predict")
    values = segment_values(predict, spec) if values is None else values
    return union_all(
        [
            general_metrics(predict, spec, values),
            kpi_value(predict, spec, values),
            class_confusion_metrics(predict, spec, values),
            cutoff_metrics(predict, spec, values),
            decile_capture(predict, spec),
        ]
    )


def fold_metrics(df: DataFrame, spec: ModelSpec, fold: str = "fold", split: str = "split") -> DataFrame:
    """Log-loss, accuracy, AUC and Gini per fold for training and validation rows."""
    by = [fold, split]
    sums = df.groupBy(*by).agg(F.avg(row_log_loss(spec)).alias("log_loss"), F.avg(_correct(spec)).alias("accuracy"))
    wide = sums.join(metric_gini(df, spec, by), by)
    return melt(wide, by, ["log_loss", "accuracy", "roc_auc_score", "gini"])


def metric_kpi_mae(mart: DataFrame) -> DataFrame:
    """Mean absolute gap between real and predicted rates, paired by class, band and segment."""
    keys = ["name_classes", "percentil", "segment"]
    pairs = mart.where(F.col("metric").isin("target_rlt", "prediction_rlt")).groupBy(*keys).agg(
        F.max(F.when(F.col("metric") == "target_rlt", F.col("value"))).alias("t"),
        F.max(F.when(F.col("metric") == "prediction_rlt", F.col("value"))).alias("p"),
    )
    return pairs.agg(F.avg(F.abs(F.col("t") - F.col("p"))).alias("kpi_mae"))


def binary_model_metrics(df: DataFrame, spec: ModelSpec, model: str) -> DataFrame:
    """One row: AUC of the positive class, the model's name and the number of rows."""
    auc = class_auc(df, spec).where(F.col("name_classes") == spec.sub_cols[-1])
    return auc.select(
        F.col("auc").alias("roc_auc"), F.lit(model).alias("model"), F.col("n").cast("bigint").alias("dataset_size")
    )
