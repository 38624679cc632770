"""Attribution tables of a linear model with given weights, and importance reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.profiling import IMPORTANCE_SQL, LINEAR, fold_importance
from driftwarden.catalog.registry import PREDICT, query, rounded
from driftwarden.operators import explain as E
from driftwarden.operators import metrics as M
from driftwarden.operators import profile as P
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import stored_scored

WEIGHTS = {
    "p0": {"o_totalprice": 1e-4, "c_acctbal": -2e-4},
    "p1": {"o_totalprice": -3e-4, "c_acctbal": 5e-5},
    "p2": {"o_totalprice": 2e-5, "c_acctbal": 1e-4},
}

SHAP = f"""{PREDICT}, shap AS ({' UNION ALL '.join(
    f"SELECT row_id, segment, '{f}' AS feature, '{c}' AS name_classes, {w!r}::DOUBLE * ({f} - avg({f}) OVER ()) AS value FROM pred"
    for c, ws in WEIGHTS.items() for f, w in ws.items())})"""


def linear(spark, sf_dir):
    rows = stored_scored(spark, sf_dir).where("set_analysis = 'predict'")
    return rows, E.linear_shap(rows, "row_id", WEIGHTS, ["segment"])


@query("shap_values", f"{SHAP} SELECT row_id, segment, feature, name_classes, round(value, 6) AS value FROM shap")
def _shap(spark, sf_dir):
    return rounded(linear(spark, sf_dir)[1])


SUMMARY = f"""{SHAP}, shap_labelled AS (SELECT 'all' AS label, * FROM shap
  UNION ALL SELECT segment, * FROM shap WHERE segment IN (SELECT segment FROM top3)),
means AS (SELECT label, feature, name_classes, avg(abs(value)) AS value FROM shap_labelled GROUP BY ALL),
summary AS (SELECT label, feature, name_classes, value FROM means
  UNION ALL SELECT label, feature, 'all', avg(value) FROM means GROUP BY label, feature),
summary_lines AS (SELECT feature, value, CASE WHEN label = 'all' THEN 'explainer_by_all' ELSE 'explainer_by_subpoblation' END
  AS type_metric, label AS segment, 'shap_abs' AS metric, name_classes FROM summary)"""


@query("shap_summary", f"{SUMMARY} SELECT * REPLACE (round(value, 6) AS value) FROM summary_lines")
def _summary(spark, sf_dir):
    rows, shap = linear(spark, sf_dir)
    return rounded(E.shap_summary(shap, SPEC, M.segment_values(rows, SPEC)))


# Importance of a feature: its mean absolute attribution over rows and classes.
def shap_importance(shap):
    return shap.groupBy("feature").agg(F.avg(F.abs("value")).alias("importance"))


@query(
    "shap_individual",
    f"""{SHAP}, placed AS (SELECT feature, row_number() OVER (ORDER BY importance DESC, feature) - 1 AS place
      FROM (SELECT feature, avg(abs(value)) AS importance FROM shap GROUP BY feature))
    SELECT row_id, name_classes, {', '.join(
        f'round(max(CASE WHEN place = {i} THEN value END), 6) AS feature_{i}' for i in range(10))}
    FROM shap JOIN placed USING (feature) GROUP BY row_id, name_classes""",
)
def _individual(spark, sf_dir):
    _, shap = linear(spark, sf_dir)
    return rounded(E.shap_individual(shap, "row_id", E.best_features(shap_importance(shap))))


@query(
    "explainer_mart",
    f"""{SUMMARY}, gains AS (SELECT feature, avg(abs(value)) AS value FROM shap GROUP BY feature)
    SELECT * REPLACE (round(value, 6) AS value) FROM (SELECT * FROM summary_lines UNION ALL {LINEAR}
    UNION ALL SELECT feature, value, 'explainer_by_all', 'all', 'gain', 'all' FROM gains)""",
)
def _mart(spark, sf_dir):
    rows, shap = linear(spark, sf_dir)
    values = M.segment_values(rows, SPEC)
    association = P.linear_association(rows, SPEC, SPEC.cont_features, values)
    return rounded(E.explainer_mart(E.shap_summary(shap, SPEC, values), association, shap_importance(shap), SPEC))


@query(
    "best_features",
    f"""{IMPORTANCE_SQL}, placed AS (SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) - 1 AS i
      FROM importance) SELECT feature, round(importance, 6) AS importance, 'feature_' || i AS name FROM placed WHERE i < 10""",
)
def _best(spark, sf_dir):
    return rounded(E.best_features(P.mean_fold_importance(fold_importance(spark, sf_dir))))
