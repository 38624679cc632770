"""Performance and value lines from sums that add up: per period, over several batches, in one pass.

Two tables carry everything. ``cells`` has one line per group, segment, label
and prediction with counts and sums; ``scores`` one per group, segment, class and
distinct score with the rows of the class and of the others. Tables of several
batches are merged by adding, so the lines of a period are the same whether its
rows came at once or in parts, and every mart line is a fold of the merged tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwarden.common import conform, melt, ratio, union_all, written
from driftwarden.functions.scalars import band_label, band_number
from driftwarden.operators import metrics as M
from driftwarden.operators.quantiles import value_cuts
from driftwarden.operators.value_counts import same
from driftwarden.spec import METRIC_SCHEMA, ModelSpec

CELL_SUMS = ("n", "loss", "n_loss", "kpi_t", "n_kpi_t", "kpi_p", "n_kpi_p")
SCORE_SUMS = ("pos", "neg", "t", "n_t")
SEGMENTS = 3


def cell_sums(df: DataFrame, spec: ModelSpec, by: Sequence[str] = ()) -> DataFrame:
    """by, segment, target, prediction and the sums of ``CELL_SUMS``."""
    target, prediction, kpi = (F.col(c).cast("double") for c in (spec.name_target, spec.name_prediction, spec.kpi))
    loss = M.row_log_loss(spec)
    sums = {"loss": loss, "kpi_t": kpi * target, "kpi_p": kpi * prediction}
    keys = [F.col(spec.segment).alias("segment"), F.col(spec.name_target).alias("target"), F.col(spec.name_prediction).alias("prediction")]
    return df.groupBy(*by, *keys).agg(
        F.count(F.lit(1)).alias("n"), *[f.alias(n) for name, c in sums.items() for n, f in ((name, F.sum(c)), (f"n_{name}", F.count(c)))]
    ).select(*by, "segment", "target", "prediction", *CELL_SUMS)


def score_sums(df: DataFrame, spec: ModelSpec, by: Sequence[str] = ()) -> DataFrame:
    """by, segment, name_classes, score and the sums of ``SCORE_SUMS``; ties of a score are one line."""
    target = F.col(spec.name_target).cast("double")
    rows = M.class_scores(df.withColumn("__t", target), spec, [*by, spec.segment, "__t"])
    return rows.groupBy(*by, F.col(spec.segment).alias("segment"), "name_classes", "score").agg(
        F.sum("y").cast("double").alias("pos"),
        F.sum(1 - F.col("y")).cast("double").alias("neg"),
        F.sum("__t").alias("t"),
        F.count("__t").alias("n_t"),
    )


def merged_cells(tables: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    return _added(tables, [*by, "segment", "target", "prediction"], CELL_SUMS)


def merged_scores(tables: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    return _added(tables, [*by, "segment", "name_classes", "score"], SCORE_SUMS)


def _added(tables: Sequence[DataFrame], keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def reported_segments(cells: DataFrame, by: Sequence[str] = (), k: int = SEGMENTS) -> DataFrame:
    """by, segment: the ``k`` most frequent segments of every group, ties by name."""
    sizes = cells.where("segment IS NOT NULL").groupBy(*by, "segment").agg(F.sum("n").alias("size"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("size"), "segment"))
    return sizes.withColumn("place", rank).where(F.col("place") <= k).select(*by, "segment")


def labelled(df: DataFrame, segments: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every line under ``all`` and, if its segment is reported, under that; the label replaces the segment."""
    listed = segments.withColumn("__listed", F.lit(True))
    joined = df.alias("d").join(F.broadcast(listed).alias("s"), same("d", "s", [*by, "segment"]), "left")  # k per group
    own = F.array_distinct(F.array(F.lit("all"), F.col("d.segment").cast("string")))
    label = F.explode(F.when(F.col("__listed"), own).otherwise(F.array(F.lit("all"))))
    return joined.select(label.alias("label"), *[F.col(f"d.{c}") for c in df.columns if c != "segment"]).withColumnRenamed("label", "segment")


def _tagged(df: DataFrame, kind: str) -> DataFrame:
    suffix = F.when(F.col("segment") == "all", "all").otherwise("subpoblation")
    return df.withColumns({"type_metric": F.concat(F.lit(f"{kind}_by_"), suffix), "percentil": F.lit("all")})


def _shaped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    groups = T.StructType([df.schema[b] for b in by])
    return conform(df, T.StructType([*groups.fields, *METRIC_SCHEMA.fields]))


def general_lines(cells: DataFrame, scores: DataFrame, spec: ModelSpec, by: Sequence[str] = ()) -> DataFrame:
    """Log-loss, accuracy, AUC, Gini and count of labelled sums."""
    hit = F.when(F.col("target") == F.col("prediction"), F.col("n")).otherwise(0)
    sums = cells.groupBy(*by, "segment").agg(F.sum("loss").alias("loss"), F.sum(hit).alias("hits"), F.sum("n").alias("count"))
    # The AUC operator takes counts per score; all and segments lie side by side as groups of their own.
    auc = auc_lines(scores, spec, [*by, "segment"])
    wide = sums.alias("a").join(auc.alias("b"), same("a", "b", [*by, "segment"]), "left").select(
        *[F.col(f"a.{c}") for c in (*by, "segment")],
        ratio(F.col("loss"), F.col("count")).alias("log_loss"),
        ratio(F.col("hits"), F.col("count")).alias("accuracy"),
        "roc_auc_score",
        M.gini(F.col("roc_auc_score")).alias("gini"),
        "count",
    )
    long = melt(wide, [*by, "segment"], M.GENERAL_METRICS)
    return _shaped(_tagged(long, "performance").withColumn("name_classes", F.lit("all")), by)


def auc_lines(scores: DataFrame, spec: ModelSpec, by: Sequence[str]) -> DataFrame:
    """AUC of every group as ``metric_auc`` defines it, from counts per distinct score."""
    counts = scores.groupBy(*by, "name_classes", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    per_class = M.auc_of_counts(counts, by, value_cuts(scores, ["name_classes"], "score"))
    if spec.n_classes <= 2:
        return per_class.where(F.col("name_classes") == spec.sub_cols[-1]).select(*by, F.col("auc").alias("roc_auc_score"))
    weighted = F.sum(F.col("auc") * F.col("support")) / F.sum("support")
    return per_class.groupBy(*by).agg(F.when(F.count("auc") == spec.n_classes, weighted).alias("roc_auc_score"))


def value_lines(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean (``_rlt``) and sum (``_abs``) of label, prediction, and both times the KPI."""

    def weighted(c: str) -> tuple[Column, Column]:
        value = F.col(c).cast("double")
        return F.sum(F.col("n") * value), F.sum(F.when(value.isNotNull(), F.col("n")).otherwise(0))

    t, n_t = weighted("target")
    p, n_p = weighted("prediction")
    measures = {
        "kpi_w_target": (F.sum("kpi_t"), F.sum("n_kpi_t")),
        "kpi_w_prediction": (F.sum("kpi_p"), F.sum("n_kpi_p")),
        "target": (t, n_t),
        "prediction": (p, n_p),
    }
    wide = cells.groupBy(*by, "segment").agg(
        *[ratio(total, n).alias(f"{name}_rlt") for name, (total, n) in measures.items()],
        *[total.alias(f"{name}_abs") for name, (total, _) in measures.items()],
    )
    long = melt(wide, [*by, "segment"], [f"{n}_{k}" for k in ("rlt", "abs") for n in measures])
    return _shaped(_tagged(long, "value").withColumn("name_classes", F.lit("all")), by)


def _total(condition: Column, n: str = "n") -> Column:
    return F.sum(F.when(condition, F.col(n)).otherwise(0))


def _rates() -> list[Column]:
    return [c.alias(n) for n, c in M.rates(*(F.col(x) for x in ("tp", "fp", "fn", "tn"))).items()]


def confusion_lines(cells: DataFrame, spec: ModelSpec, by: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest metrics of every class predicted at least once in the group."""
    per_class = cells.select(
        *by,
        "segment",
        "n",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("name_classes"), (F.col("target") == i).alias("real"), (F.col("prediction") == i).alias("said"))
                    for i, c in enumerate(spec.sub_cols)
                ]
            )
        ),
    )
    real, said = F.col("real"), F.col("said")
    counted = per_class.groupBy(*by, "segment", "name_classes").agg(
        _total(real & said).alias("tp"),
        _total(~real & said).alias("fp"),
        _total(real & ~said).alias("fn"),
        _total(~real & ~said).alias("tn"),
    )
    wide = counted.where(F.col("tp") + F.col("fp") > 0).select(*by, "segment", "name_classes", *_rates())
    return _shaped(_tagged(melt(wide, [*by, "segment", "name_classes"], M.CLASS_METRICS), "performance"), by)


def cutoff_lines(scores: DataFrame, by: Sequence[str] = (), n_cutoffs: int = M.N_CUTOFFS) -> DataFrame:
    """The class metrics of ``score > cutoff``: score passes cutoff j of n when j < ceil(score * (n - 1))."""
    steps = n_cutoffs - 1
    step = F.ceil(F.lit(float(steps)) * F.col("score")).alias("b")
    counts = scores.groupBy(*by, "segment", "name_classes", step).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    spread = counts.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    passes = F.col("j") < F.col("b")
    cells = spread.groupBy(*by, "segment", "name_classes", "j").agg(
        _total(passes, "pos").alias("tp"),
        _total(passes, "neg").alias("fp"),
        _total(~passes, "pos").alias("fn"),
        _total(~passes, "neg").alias("tn"),
    )
    wide = cells.select(*by, "segment", "name_classes", (F.col("j") / F.lit(float(steps))).alias("cutoff"), *_rates())
    return _shaped(_tagged(melt(wide, [*by, "segment", "name_classes", "cutoff"], M.CLASS_METRICS), "performance_w_cutoff"), by)


def score_limits(scores: DataFrame, by: Sequence[str] = (), reference: DataFrame | None = None) -> DataFrame:
    """by, name_classes, lo, hi: the range of the scores of every group, together with that of the reference's sums."""
    own = scores.groupBy(*by, "name_classes").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    if reference is None:
        return own
    base = reference.groupBy("name_classes").agg(F.min("score").alias("r_lo"), F.max("score").alias("r_hi"))
    joined = own.join(F.broadcast(base), "name_classes", "left")  # one row per class
    return joined.select(*by, "name_classes", F.least("lo", "r_lo").alias("lo"), F.greatest("hi", "r_hi").alias("hi"))


def capture_lines(scores: DataFrame, limits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class and score band: rows, label mean and sum, probability mean and sum; empty bands count zero.

    ``scores`` are the sums of all segments; bands are ten of equal width between ``limits``.
    """
    joined = scores.alias("v").join(F.broadcast(limits).alias("l"), same("v", "l", [*by, "name_classes"]))  # groups x classes
    band = band_label(band_number(F.col("score"), F.col("lo"), F.col("hi"), 10))
    keys = [F.col(f"v.{c}").alias(c) for c in (*by, "name_classes")]
    sums = joined.groupBy(*keys, band.alias("band")).agg(
        F.sum("n_t").alias("n"), F.sum("t").alias("t"), F.sum(F.col("score") * (F.col("pos") + F.col("neg"))).alias("p")
    )
    bands = F.array(*[F.lit(f"P{10 * i:03d}") for i in range(1, 11)])
    spread = sums.withColumn("percentil", F.explode(bands)).withColumn("own", F.col("band") == F.col("percentil"))
    added = spread.groupBy(*by, "name_classes", "percentil").agg(*[_total(F.col("own"), c).alias(c) for c in ("n", "t", "p")])
    wide = added.select(
        *by,
        "name_classes",
        "percentil",
        F.col("n").alias("count"),
        ratio(F.col("t"), F.col("n")).alias("target_rlt"),
        F.col("t").alias("target_abs"),
        ratio(F.col("p"), F.col("n")).alias("prediction_rlt"),
        F.col("p").alias("prediction_abs"),
    )
    names = ["count", "target_rlt", "target_abs", "prediction_rlt", "prediction_abs"]
    tags = {"type_metric": F.lit("captura_by_all"), "segment": F.lit("all")}
    return _shaped(melt(wide, [*by, "name_classes", "percentil"], names).withColumns(tags), by)


def performance_mart(
    cells: DataFrame,
    scores: DataFrame,
    spec: ModelSpec,
    by: Sequence[str] = (),
    reference: DataFrame | None = None,
    limits: DataFrame | None = None,
) -> DataFrame:
    """Every performance and value line of every group, stacked.

    ``cells`` and ``scores`` are read several times: hand in written tables.
    ``reference`` are the score sums of the reference rows, which take part in
    the borders of the score bands; ``limits`` gives the borders instead. NULL
    groups are groups, rows without a segment count under ``all`` only.
    """
    if spec.segment_values is None:
        segments = reported_segments(cells, by)
    else:
        segments = cells.where(F.col("segment").isin(*spec.segment_values)).select(*by, "segment").distinct()
    own_cells = written(labelled(cells, segments, by), "labelled-cells")
    own_scores = written(labelled(scores, segments, by), "labelled-scores")
    borders = score_limits(scores, by, reference) if limits is None else limits
    return union_all(
        [
            general_lines(own_cells, own_scores, spec, by),
            value_lines(own_cells, by),
            confusion_lines(own_cells, spec, by),
            cutoff_lines(own_scores, by),
            capture_lines(scores, borders, by),
        ]
    )
