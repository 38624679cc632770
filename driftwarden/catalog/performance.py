"""Scored frame, classification metrics, value capture."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.registry import PER_CLASS, PREDICT, SCORED, melt_sql, query, rounded
from driftwarden.operators import columns as C
from driftwarden.operators import metrics as M
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import build_scored, probability_frame, scored_frame, stored_scored

AUC_PER_CLASS = """ranked AS (
  SELECT {by}, name_classes, y,
         rank() OVER (PARTITION BY {by}, name_classes ORDER BY score)
         + (count(*) OVER (PARTITION BY {by}, name_classes, score) - 1) / 2.0::DOUBLE AS r FROM {source}),
auc AS (
  SELECT {by}, name_classes, sum(y) AS support, count(*) AS n,
         (sum(CASE WHEN y = 1 THEN r ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE)
         / nullif(CAST(sum(y) AS DOUBLE) * (count(*) - sum(y)), 0) AS auc
  FROM ranked GROUP BY {by}, name_classes),
auc_all AS (
  SELECT {by}, CASE WHEN count(auc) = 3 THEN sum(auc * support) / sum(support) END AS roc_auc_score
  FROM auc GROUP BY {by})"""

LABEL_AUC = f"{PER_CLASS}, {AUC_PER_CLASS.format(by='label', source='per_class')}"

LOSS = (
    "-ln(least(greatest(CASE target WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 2.220446049250313e-16), "
    "1.0::DOUBLE - 2.220446049250313e-16))"
)
HIT = "CASE WHEN target = prediction THEN 1.0::DOUBLE ELSE 0 END"


def predicted(spark, sf_dir):
    return stored_scored(spark, sf_dir).where("set_analysis = 'predict'")


@query("scored_frame", f"{SCORED} SELECT * FROM scored")
def _scored(spark, sf_dir):
    return scored_frame(spark, sf_dir)


INDICATORS = ", ".join(
    f"CASE WHEN {c} = {i} THEN 1 ELSE 0 END AS {c}_{i}" for c in ("target", "prediction") for i in range(3)
)


@query(
    "build_scored",
    f"""{SCORED} SELECT row_id, entity_id, periodo, o_orderpriority, c_mktsegment, o_totalprice, c_acctbal,
    target, prediction, p0, p1, p2, set_analysis, kpi, segment, {INDICATORS}, p0_cut, p1_cut, p2_cut FROM scored""",
)
def _build_scored(spark, sf_dir):
    rows = probability_frame(spark, sf_dir)
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    early, late = rows.where(F.col("o_orderdate") < cut), rows.where(F.col("o_orderdate") >= cut)
    return build_scored(early.drop("o_orderdate"), late.drop("o_orderdate"), SPEC)


@query(
    "project_scored",
    f"""{SCORED} SELECT row_id, entity_id, periodo, o_orderpriority, c_mktsegment, o_totalprice, c_acctbal,
    target, prediction, p0, p1, p2, set_analysis, kpi, segment, p0_cut, p1_cut, p2_cut FROM scored""",
)
def _project_scored(spark, sf_dir):
    return C.project_scored(scored_frame(spark, sf_dir), SPEC)


@query("argmax_label", f"{SCORED} SELECT row_id, prediction FROM scored")
def _argmax(spark, sf_dir):
    return scored_frame(spark, sf_dir).select("row_id", "prediction")


@query("class_indicators", f"{SCORED} SELECT row_id, {INDICATORS} FROM scored")
def _indicators(spark, sf_dir):
    out = C.class_indicators(scored_frame(spark, sf_dir), SPEC)
    return out.select("row_id", *[f"{c}_{i}" for c in ("target", "prediction") for i in range(3)])


@query("equal_width_bands", f"{SCORED} SELECT row_id, p0_cut, p1_cut, p2_cut FROM scored")
def _bands(spark, sf_dir):
    return scored_frame(spark, sf_dir).select("row_id", "p0_cut", "p1_cut", "p2_cut")


@query(
    "tag_sets",
    """SELECT o_orderkey, 'training' AS set_analysis FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
    UNION ALL SELECT o_orderkey, 'predict' FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""",
)
def _tag_sets(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    early, late = orders.where(F.col("o_orderdate") < cut), orders.where(F.col("o_orderdate") >= cut)
    return C.tag_sets(early.select("o_orderkey"), late.select("o_orderkey"))


@query("metric_log_loss", f"{SCORED} SELECT set_analysis, round(avg({LOSS}), 6) AS log_loss FROM scored GROUP BY 1")
def _log_loss(spark, sf_dir):
    return rounded(M.metric_log_loss(scored_frame(spark, sf_dir), SPEC, ["set_analysis"]))


@query("metric_accuracy", f"{SCORED} SELECT set_analysis, round(avg({HIT}), 6) AS accuracy FROM scored GROUP BY 1")
def _accuracy(spark, sf_dir):
    return rounded(M.metric_accuracy(scored_frame(spark, sf_dir), SPEC, ["set_analysis"]))


@query("metric_count", f'{SCORED} SELECT set_analysis, segment, count(*) AS "count" FROM scored GROUP BY ALL')
def _count(spark, sf_dir):
    return M.metric_count(scored_frame(spark, sf_dir), ["set_analysis", "segment"])


BY_SET = f"""{SCORED}, by_set AS (
  SELECT set_analysis, 'p0' AS name_classes, p0 AS score, CAST(target = 0 AS INTEGER) AS y FROM scored
  UNION ALL SELECT set_analysis, 'p1', p1, CAST(target = 1 AS INTEGER) FROM scored
  UNION ALL SELECT set_analysis, 'p2', p2, CAST(target = 2 AS INTEGER) FROM scored),
{AUC_PER_CLASS.format(by='set_analysis', source='by_set')}"""


@query("metric_auc", f"{BY_SET} SELECT set_analysis, round(roc_auc_score, 6) AS roc_auc_score FROM auc_all")
def _auc(spark, sf_dir):
    return rounded(M.metric_auc(stored_scored(spark, sf_dir), SPEC, ["set_analysis"]))


@query(
    "class_auc",
    f"""{BY_SET} SELECT set_analysis, name_classes, round(auc, 6) AS auc, CAST(support AS DOUBLE) AS support,
    CAST(n AS DOUBLE) AS n FROM auc""",
)
def _class_auc(spark, sf_dir):
    return rounded(M.class_auc(stored_scored(spark, sf_dir), SPEC, ["set_analysis"]))


@query(
    "metric_gini",
    f"""{BY_SET} SELECT set_analysis, round(roc_auc_score, 6) AS roc_auc_score,
    round(2 * roc_auc_score - 1, 6) AS gini FROM auc_all""",
)
def _gini(spark, sf_dir):
    return rounded(M.metric_gini(stored_scored(spark, sf_dir), SPEC, ["set_analysis"]))


def tagged_sql(kind: str, source: str, classes: str = "name_classes", percentil: str = "'all'", cutoff: str = "NULL"):
    return f"""SELECT metric, value,
    CASE WHEN segment = 'all' THEN '{kind}_by_all' ELSE '{kind}_by_subpoblation' END AS type_metric,
    {classes} AS name_classes, {percentil} AS percentil, CAST({cutoff} AS DOUBLE) AS cutoff, segment
    FROM ({source})"""


GENERAL_CTE = f"""{LABEL_AUC}, general AS (
  SELECT l.label AS segment, avg({LOSS}) AS log_loss, avg({HIT}) AS accuracy, any_value(a.roc_auc_score) AS roc_auc_score,
         any_value(2 * a.roc_auc_score - 1) AS gini, count(*) AS "count"
  FROM labelled l JOIN auc_all a ON l.label = a.label GROUP BY l.label)"""
GENERAL = tagged_sql(
    "performance", melt_sql("general", ["segment"], M.GENERAL_METRICS).replace("CAST(count AS", 'CAST("count" AS'), "'all'"
)

KPI_CTE = """kpis AS (SELECT label AS segment,
  avg(kpi * target) AS kpi_w_target_rlt, avg(kpi * prediction) AS kpi_w_prediction_rlt, avg(target) AS target_rlt,
  avg(prediction) AS prediction_rlt, sum(kpi * target) AS kpi_w_target_abs,
  sum(kpi * prediction) AS kpi_w_prediction_abs, sum(target) AS target_abs, sum(prediction) AS prediction_abs
  FROM labelled GROUP BY label)"""
KPI_NAMES = [f"{n}_{k}" for k in ("rlt", "abs") for n in ("kpi_w_target", "kpi_w_prediction", "target", "prediction")]
KPI = tagged_sql("value", melt_sql("kpis", ["segment"], KPI_NAMES), "'all'")

RATES = """coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_score, coalesce(fp / nullif(fp + tn, 0), 0) AS false_positive_rate,
  coalesce(fn / nullif(tp + fn, 0), 0) AS false_negative_rate, coalesce(tp / nullif(tp + fn, 0), 0) AS true_positive_rate,
  coalesce(tn / nullif(fp + tn, 0), 0) AS true_negative_rate, (tp + fp) / (tp + fp + fn + tn) AS selection_rate"""


def cells(said: str) -> str:
    return f"""CAST(sum(CASE WHEN y = 1 AND {said} THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN y = 0 AND {said} THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN y = 1 AND NOT ({said}) THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
  CAST(sum(CASE WHEN y = 0 AND NOT ({said}) THEN 1 ELSE 0 END) AS DOUBLE) AS tn"""


CONFUSION_CTE = f"""confusion AS (SELECT label AS segment, name_classes, {cells('said = 1')} FROM per_class
  GROUP BY label, name_classes HAVING sum(said) > 0),
class_rates AS (SELECT segment, name_classes, {RATES} FROM confusion)"""
CONFUSION = tagged_sql("performance", melt_sql("class_rates", ["segment", "name_classes"], M.CLASS_METRICS))

CUTOFF_CTE = f"""cutoffs AS (SELECT j, j / 49.0::DOUBLE AS cutoff FROM (SELECT unnest(range(0, 50)) AS j)),
cut_cells AS (SELECT label AS segment, name_classes, cutoff, {cells('score > cutoff')} FROM per_class, cutoffs
  GROUP BY label, name_classes, cutoff),
cut_rates AS (SELECT segment, name_classes, cutoff, {RATES} FROM cut_cells)"""
CUTOFF = tagged_sql(
    "performance_w_cutoff",
    melt_sql("cut_rates", ["segment", "name_classes", "cutoff"], M.CLASS_METRICS),
    cutoff="cutoff",
)

CAPTURE_NAMES = ["count", "target_rlt", "target_abs", "prediction_rlt", "prediction_abs"]
CAPTURE_CTE = """band_list AS (SELECT 'P' || lpad(CAST(10 * i AS VARCHAR), 3, '0') AS percentil
  FROM (SELECT unnest(range(1, 11)) AS i)),
capture_rows AS (SELECT 'p0' AS name_classes, p0_cut AS percentil, target, p0 AS p FROM pred
  UNION ALL SELECT 'p1', p1_cut, target, p1 FROM pred UNION ALL SELECT 'p2', p2_cut, target, p2 FROM pred),
captured AS (SELECT c.name_classes, b.percentil, count(r.target) AS "count", avg(r.target) AS target_rlt,
  coalesce(sum(r.target), 0) AS target_abs, avg(r.p) AS prediction_rlt, coalesce(sum(r.p), 0) AS prediction_abs
  FROM (SELECT DISTINCT name_classes FROM capture_rows) c CROSS JOIN band_list b
  LEFT JOIN capture_rows r ON r.name_classes = c.name_classes AND r.percentil = b.percentil GROUP BY 1, 2)"""
CAPTURE = f"""SELECT metric, value, 'captura_by_all' AS type_metric, name_classes, percentil,
  CAST(NULL AS DOUBLE) AS cutoff, 'all' AS segment FROM ({melt_sql('captured', ['name_classes', 'percentil'], CAPTURE_NAMES)
  .replace('CAST(count AS', 'CAST("count" AS')})"""

MART_CTE = f"{GENERAL_CTE}, {KPI_CTE}, {CONFUSION_CTE}, {CUTOFF_CTE}, {CAPTURE_CTE}"
MART = " UNION ALL ".join([GENERAL, KPI, CONFUSION, CUTOFF, CAPTURE])


def value_rounded(source: str, digits: int) -> str:
    return f"SELECT * REPLACE (round(value, {digits}) AS value) FROM ({source})"


@query("general_metrics", f"{GENERAL_CTE} {value_rounded(GENERAL, 6)}")
def _general(spark, sf_dir):
    rows = predicted(spark, sf_dir)
    return rounded(M.general_metrics(rows, SPEC, M.segment_values(rows, SPEC)), 6, ["value"])


@query("kpi_value", f"{PREDICT}, {KPI_CTE} {value_rounded(KPI, 3)}")
def _kpi(spark, sf_dir):
    rows = predicted(spark, sf_dir)
    return rounded(M.kpi_value(rows, SPEC, M.segment_values(rows, SPEC)), 3, ["value"])


@query(
    "grouping_all_and_segment",
    f"""{PREDICT} SELECT label AS segment, CAST(count(*) AS BIGINT) AS n, round(sum(kpi), 2) AS kpi_sum
    FROM labelled GROUP BY label""",
)
def _grouping(spark, sf_dir):
    rows = predicted(spark, sf_dir)
    sums = {"n": F.lit(1), "kpi_sum": F.col("kpi")}
    return rounded(M.grouping_all_and_segment(rows, "segment", M.segment_values(rows, SPEC), sums), 2)


@query(
    "top_segments",
    "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, c_mktsegment LIMIT 3",
)
def _top_segments(spark, sf_dir):
    return M.top_segments(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_mktsegment")


@query("class_confusion_metrics", f"{PER_CLASS}, {CONFUSION_CTE} {value_rounded(CONFUSION, 6)}")
def _confusion(spark, sf_dir):
    rows = predicted(spark, sf_dir)
    return rounded(M.class_confusion_metrics(rows, SPEC, M.segment_values(rows, SPEC)))


@query(
    "cutoff_metrics",
    f"{PER_CLASS}, {CUTOFF_CTE} SELECT * REPLACE (round(value, 6) AS value, round(cutoff, 6) AS cutoff) FROM ({CUTOFF})",
)
def _cutoff(spark, sf_dir):
    rows = predicted(spark, sf_dir)
    return rounded(M.cutoff_metrics(rows, SPEC, M.segment_values(rows, SPEC)))


@query("decile_capture", f"{PREDICT}, {CAPTURE_CTE} {value_rounded(CAPTURE, 6)}")
def _capture(spark, sf_dir):
    return rounded(M.decile_capture(predicted(spark, sf_dir), SPEC))


@query(
    "general_metric_mart",
    f"{MART_CTE} SELECT * REPLACE (round(value, 3) AS value, round(cutoff, 6) AS cutoff) FROM ({MART})",
)
def general_metric_mart(spark, sf_dir):
    mart = M.general_metric_mart(stored_scored(spark, sf_dir), SPEC)
    return rounded(rounded(mart, 3, ["value"]), 6, ["cutoff"])


FOLD_SQL = f"""{SCORED}, folded AS (SELECT *, CAST(row_id % 5 AS INTEGER) AS fold,
  CASE WHEN set_analysis = 'training' THEN 'training' ELSE 'validation' END AS split,
  CAST(row_id % 5 AS INTEGER) || '/' || set_analysis AS fs FROM scored),
by_fold AS (SELECT fs, 'p0' AS name_classes, p0 AS score, CAST(target = 0 AS INTEGER) AS y FROM folded
  UNION ALL SELECT fs, 'p1', p1, CAST(target = 1 AS INTEGER) FROM folded
  UNION ALL SELECT fs, 'p2', p2, CAST(target = 2 AS INTEGER) FROM folded),
{AUC_PER_CLASS.format(by='fs', source='by_fold')},
wide AS (SELECT fold, split, avg({LOSS}) AS log_loss, avg({HIT}) AS accuracy, any_value(roc_auc_score) AS roc_auc_score,
  any_value(2 * roc_auc_score - 1) AS gini FROM folded JOIN auc_all ON folded.fs = auc_all.fs GROUP BY fold, split)"""


@query(
    "fold_metrics",
    f"""{FOLD_SQL} SELECT * REPLACE (round(value, 6) AS value) FROM
    ({melt_sql('wide', ['fold', 'split'], ['log_loss', 'accuracy', 'roc_auc_score', 'gini'])})""",
)
def _fold(spark, sf_dir):
    rows = scored_frame(spark, sf_dir).withColumn("fold", (F.col("row_id") % 5).cast("int"))
    rows = rows.withColumn("split", F.when(F.col("set_analysis") == "training", "training").otherwise("validation"))
    return rounded(M.fold_metrics(rows, SPEC))


@query(
    "metric_kpi_mae",
    f"""{MART_CTE}, mart AS ({MART}), pairs AS (
    SELECT name_classes, percentil, segment, max(CASE WHEN metric = 'target_rlt' THEN value END) AS t,
    max(CASE WHEN metric = 'prediction_rlt' THEN value END) AS p FROM mart
    WHERE metric IN ('target_rlt', 'prediction_rlt') GROUP BY ALL)
    SELECT round(avg(abs(t - p)), 6) AS kpi_mae FROM pairs""",
)
def _kpi_mae(spark, sf_dir):
    rows = predicted(spark, sf_dir)
    mart = M.kpi_value(rows, SPEC, M.segment_values(rows, SPEC)).unionByName(M.decile_capture(rows, SPEC))
    return rounded(M.metric_kpi_mae(mart))


@query(
    "toy_model_metrics",
    f"""{SCORED}, two AS (SELECT 1 AS one, 'p1' AS name_classes, p0 AS score, CAST(target = 0 AS INTEGER) AS y FROM scored),
    {AUC_PER_CLASS.format(by='one', source='two')}
    SELECT round(auc, 6) AS roc_auc, 'gradient boosting' AS model, n AS dataset_size FROM auc""",
)
def _toy_metrics(spark, sf_dir):
    rows = scored_frame(spark, sf_dir)
    two = rows.select(
        F.when(F.col("target") == 0, 1).otherwise(0).alias("target"), (1 - F.col("p0")).alias("q0"), F.col("p0").alias("q1")
    )
    return rounded(M.binary_model_metrics(two, SPEC.with_(sub_cols=("q0", "q1")), "gradient boosting"))
