"""Profiles, data quality, crosstabs, associations, catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.registry import PREDICT, SCORED, melt_sql, query, rounded
from driftwarden.common import melt_text
from driftwarden.operators import metrics as M
from driftwarden.operators import profile as P
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import read, scored_frame, stored_scored

# Line items in two sets by ship date, with gaps, infinities and a month level that differs between the sets.
SIDES_SQL = """WITH sides AS (
  SELECT *, CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 'reference' ELSE 'current' END AS set_data,
    nullif(l_tax, 0) AS tax, CASE WHEN l_quantity = 50 THEN CAST('inf' AS DOUBLE) ELSE l_quantity END AS qty,
    strftime(l_shipdate, '%Y-%m') AS ship_month, nullif(l_returnflag, 'A') AS flag FROM lineitem)"""
CAT, CONT = ["flag", "l_linestatus", "ship_month"], ["l_extendedprice", "l_discount", "tax"]


def lineitem_sides(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    return li.withColumns(
        {
            "set_data": F.when(early, "reference").otherwise("current"),
            "tax": F.nullif(F.col("l_tax"), F.lit(0.0)),
            "qty": F.when(F.col("l_quantity") == 50, F.lit(float("inf"))).otherwise(F.col("l_quantity").cast("double")),
            "ship_month": F.date_format("l_shipdate", "yyyy-MM"),
            "flag": F.nullif(F.col("l_returnflag"), F.lit("A")),
        }
    )


def quality_ctes(source: str, cat: list[str], cont: list[str]) -> str:
    """One SELECT per feature; the result is the CTE ``profile``."""
    blocks = []
    for c in cat:
        others = (
            f"(SELECT count(*) FROM (SELECT {c} FROM {source} WHERE set_data = 'current' AND {c} IS NOT NULL EXCEPT "
            f"SELECT {c} FROM {source} WHERE set_data = 'reference'))",
            f"(SELECT count(*) FROM (SELECT {c} FROM {source} WHERE set_data = 'reference' AND {c} IS NOT NULL EXCEPT "
            f"SELECT {c} FROM {source} WHERE set_data = 'current'))",
        )
        blocks.append(
            f"""SELECT set_data, '{c}' AS feature, 'cat' AS feature_type, count(*) - count({c}) AS missing_count,
            100.0::DOUBLE * (count(*) - count({c})) / count(*) AS missing_percentage, count(DISTINCT {c}) AS unique_count,
            100.0::DOUBLE * count(DISTINCT {c}) / count(*) AS unique_percentage, NULL AS infinite_count,
            NULL AS infinite_percentage, NULL AS percentile_25, NULL AS percentile_50, NULL AS percentile_75,
            NULL AS min, NULL AS max, NULL AS mean, NULL AS std,
            CASE WHEN set_data = 'current' THEN {others[0]} END AS new_in_current_values_count,
            CASE WHEN set_data = 'current' THEN {others[1]} END AS unused_in_current_values_count
            FROM {source} GROUP BY set_data"""
        )
    for c in cont:
        blocks.append(
            f"""SELECT set_data, '{c}' AS feature, 'num' AS feature_type, count(*) - count({c}) AS missing_count,
            100.0::DOUBLE * (count(*) - count({c})) / count(*) AS missing_percentage, count(DISTINCT {c}) AS unique_count,
            100.0::DOUBLE * count(DISTINCT {c}) / count(*) AS unique_percentage,
            count(CASE WHEN isinf({c}::DOUBLE) THEN 1 END) AS infinite_count,
            100.0::DOUBLE * count(CASE WHEN isinf({c}::DOUBLE) THEN 1 END) / count(*) AS infinite_percentage,
            quantile_cont({c}::DOUBLE, 0.25) AS percentile_25, quantile_cont({c}::DOUBLE, 0.5) AS percentile_50,
            quantile_cont({c}::DOUBLE, 0.75) AS percentile_75, min({c}) AS min, max({c}) AS max, avg({c}) AS mean,
            stddev_samp({c}) AS std, NULL AS new_in_current_values_count, NULL AS unused_in_current_values_count
            FROM {source} GROUP BY set_data"""
        )
    return f"profile AS ({' UNION ALL '.join(blocks)})"


def delta_cte() -> str:
    gaps = []
    for m in P.DELTA_METRICS:
        if m.endswith("_in_current_values_count"):
            gaps.append(f"coalesce(max({m}), 0) AS difference_{m}")
        else:
            gaps.append(
                f"abs(max(CASE WHEN set_data = 'current' THEN {m} END) - "
                f"max(CASE WHEN set_data = 'reference' THEN {m} END)) AS difference_{m}"
            )
    return f"delta AS (SELECT feature, {', '.join(gaps)} FROM profile GROUP BY feature)"


@query(
    "data_quality_profile",
    f"""{SIDES_SQL}, {quality_ctes('sides', CAT, CONT)} SELECT set_data, feature, feature_type,
    {', '.join(f'round(CAST({m} AS DOUBLE), 6) AS {m}' for m in P.QUALITY_METRICS)} FROM profile""",
)
def _quality(spark, sf_dir):
    return rounded(P.data_quality_profile(lineitem_sides(spark, sf_dir), CAT, CONT))


@query(
    "data_quality_infinite",
    """WITH q AS (SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 'reference' ELSE 'current' END AS set_data,
      l_quantity FROM lineitem)
    SELECT set_data, 'qty' AS feature, CAST(count(CASE WHEN l_quantity = 50 THEN 1 END) AS DOUBLE) AS infinite_count,
    round(100.0::DOUBLE * count(CASE WHEN l_quantity = 50 THEN 1 END) / count(*), 6) AS infinite_percentage
    FROM q GROUP BY set_data""",
)
def _quality_inf(spark, sf_dir):
    profile = P.data_quality_profile(lineitem_sides(spark, sf_dir), [], ["qty"])
    return rounded(profile.select("set_data", "feature", "infinite_count", "infinite_percentage"))


@query(
    "data_quality_delta",
    f"""{SIDES_SQL}, {quality_ctes('sides', CAT, CONT)}, {delta_cte()} SELECT feature,
    {', '.join(f'round(CAST(difference_{m} AS DOUBLE), 6) AS difference_{m}' for m in P.DELTA_METRICS)} FROM delta""",
)
def _delta(spark, sf_dir):
    return rounded(P.data_quality_delta(P.data_quality_profile(lineitem_sides(spark, sf_dir), CAT, CONT)))


@query(
    "new_and_unused_values",
    f"""{SIDES_SQL}, new_values AS (SELECT ship_month FROM sides WHERE set_data = 'current' EXCEPT
      SELECT ship_month FROM sides WHERE set_data = 'reference'),
    unused AS (SELECT ship_month FROM sides WHERE set_data = 'reference' EXCEPT
      SELECT ship_month FROM sides WHERE set_data = 'current')
    SELECT ship_month AS value, 'new' AS status FROM new_values UNION ALL SELECT ship_month, 'unused' FROM unused""",
)
def _new_unused(spark, sf_dir):
    return P.new_and_unused_values(lineitem_sides(spark, sf_dir), "ship_month")


@query(
    "dataset_profile",
    f"""{SCORED} SELECT count(DISTINCT target) AS n_classes, CAST(min(periodo) AS VARCHAR) AS periodo_min,
    CAST(max(periodo) AS VARCHAR) AS periodo_max, count(*) AS n_rows, CAST(4 AS BIGINT) AS n_features,
    (SELECT count(*) FROM (SELECT DISTINCT row_id, entity_id, periodo FROM scored)) AS n_ids,
    count(DISTINCT entity_id) AS n_obs FROM scored""",
)
def _dataset_profile(spark, sf_dir):
    return P.dataset_profile(scored_frame(spark, sf_dir), SPEC)


# ---------------------------------------------------------------------- crosstabs

GROUPED_SQL = f"""{PREDICT}, feat AS (
  SELECT 'o_orderpriority' AS feature, o_orderpriority AS group_feature, target, prediction, p0_cut, p1_cut, p2_cut FROM pred
  UNION ALL SELECT 'c_mktsegment', c_mktsegment, target, prediction, p0_cut, p1_cut, p2_cut FROM pred
  UNION ALL SELECT 'o_totalprice', 'P' || lpad(CAST(10 * CAST(least(greatest(ceil((o_totalprice - min(o_totalprice) OVER ())
    / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()) * 10.0), 1), 10) AS INTEGER) AS VARCHAR), 3, '0'),
    target, prediction, p0_cut, p1_cut, p2_cut FROM pred
  UNION ALL SELECT 'c_acctbal', 'P' || lpad(CAST(10 * CAST(least(greatest(ceil((c_acctbal - min(c_acctbal) OVER ())
    / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()) * 10.0), 1), 10) AS INTEGER) AS VARCHAR), 3, '0'),
    target, prediction, p0_cut, p1_cut, p2_cut FROM pred)"""


def shares_sql(label: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT feature, group_feature, 'p{i}' AS name_classes,
        CAST(sum(CASE WHEN {label} = {i} THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS value
        FROM feat GROUP BY feature, group_feature"""
        for i in range(3)
    )


def bands_sql(i: int) -> str:
    return f"""SELECT g.feature, g.group_feature, 'p{i}' AS name_classes, b.band AS metric,
      CAST(count(CASE WHEN f.p{i}_cut = b.band THEN 1 END) AS DOUBLE) / count(*) AS value
      FROM (SELECT DISTINCT feature, group_feature FROM feat) g
      JOIN (SELECT DISTINCT feature, p{i}_cut AS band FROM feat) b ON g.feature = b.feature
      JOIN feat f ON f.feature = g.feature AND f.group_feature = g.group_feature
      GROUP BY g.feature, g.group_feature, b.band"""


def priority_long(spark, sf_dir):
    pred = scored_frame(spark, sf_dir).where("set_analysis = 'predict'")
    ids = ["target", "prediction", "p0_cut"]
    long = melt_text(pred, ids, ["o_orderpriority", "c_mktsegment"])
    return long.withColumnRenamed("value", "group_feature").withColumn("target", F.col("target").cast("int"))


@query(
    "crosstab_by_column",
    f"""{GROUPED_SQL} SELECT * REPLACE (round(value, 6) AS value) FROM ({shares_sql('target')})
    WHERE feature IN ('o_orderpriority', 'c_mktsegment')""",
)
def _by_column(spark, sf_dir):
    return rounded(P.crosstab_by_column(priority_long(spark, sf_dir), "target", dict(enumerate(SPEC.sub_cols))))


@query(
    "crosstab_by_index",
    f"""{GROUPED_SQL} SELECT feature, group_feature, metric, round(value, 6) AS value FROM ({bands_sql(0)})
    WHERE feature IN ('o_orderpriority', 'c_mktsegment')""",
)
def _by_index(spark, sf_dir):
    return rounded(P.crosstab_by_index(priority_long(spark, sf_dir), "p0_cut"))


DISTRIBUTION = f"""SELECT feature, group_feature, name_classes, 'name_target' AS flg_target, 'WG' AS metric, value,
  'report_general' AS type_metric FROM ({shares_sql('target')})
UNION ALL SELECT feature, group_feature, name_classes, 'name_prediction', 'WG', value, 'report_general'
  FROM ({shares_sql('prediction')})
UNION ALL SELECT feature, group_feature, name_classes, flag, metric, value, 'report_detail' FROM
  ({bands_sql(0)} UNION ALL {bands_sql(1)} UNION ALL {bands_sql(2)}) d, (SELECT unnest(['target', 'prediction']) AS flag)"""


@query(
    "data_distribution_mart",
    f"{GROUPED_SQL} SELECT * REPLACE (round(value, 6) AS value) FROM ({DISTRIBUTION})",
)
def _distribution(spark, sf_dir):
    return rounded(P.data_distribution_mart(stored_scored(spark, sf_dir), SPEC))


# ------------------------------------------------------------- series, association

CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    "correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature, '{b}' AS other_feature, round(corr({a}, {b}), 6) AS value FROM lineitem"
        for i, a in enumerate(CORR)
        for b in CORR[:i]
    ),
)
def _correlation(spark, sf_dir):
    return rounded(P.correlation_matrix(read(spark, sf_dir, "lineitem"), CORR))


LINEAR = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, abs(corr({f}, {c})) AS value,
    CASE WHEN label = 'all' THEN 'explainer_by_all' ELSE 'explainer_by_subpoblation' END AS type_metric,
    label AS segment, 'linear' AS metric, '{'all' if c == 'target' else c}' AS name_classes FROM labelled GROUP BY label"""
    for f in ("o_totalprice", "c_acctbal")
    for c in ("target", "p0", "p1", "p2")
)


@query("linear_association", f"{PREDICT} SELECT * REPLACE (round(value, 6) AS value) FROM ({LINEAR})")
def _linear(spark, sf_dir):
    rows = stored_scored(spark, sf_dir).where("set_analysis = 'predict'")
    return rounded(P.linear_association(rows, SPEC, SPEC.cont_features, M.segment_values(rows, SPEC)))


@query(
    "period_aggregate",
    f"""{SCORED} SELECT target AS "class", periodo, CAST(count(*) AS DOUBLE) AS value FROM scored
    WHERE o_orderpriority = (SELECT o_orderpriority FROM scored GROUP BY 1 ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
    GROUP BY target, periodo""",
)
def _period_cat(spark, sf_dir):
    return P.period_aggregate(scored_frame(spark, sf_dir), "target", "periodo", "o_orderpriority", True)


@query(
    "period_aggregate_numeric",
    f"""{SCORED} SELECT target AS "class", periodo, round(avg(CAST(round(o_totalprice * 100) AS BIGINT)), 4) AS value
    FROM scored GROUP BY target, periodo""",
)
def _period_num(spark, sf_dir):
    # In cents: sums of integers are the same in both engines, so rounding meets the same numbers.
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    rows = scored_frame(spark, sf_dir).withColumn("cents", cents)
    return rounded(P.period_aggregate(rows, "target", "periodo", "cents", False), 4)


# --------------------------------------------------------------------- catalogues

# Importance per brand and fold, from the parts table.
IMPORTANCE_SQL = """WITH folds AS (SELECT p_brand AS feature, p_size % 5 AS fold, avg(p_retailprice) AS importance
  FROM part GROUP BY 1, 2), importance AS (SELECT feature, avg(importance) AS importance FROM folds GROUP BY feature)"""


def fold_importance(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return part.groupBy(F.col("p_brand").alias("feature"), (F.col("p_size") % 5).alias("fold")).agg(
        F.avg("p_retailprice").alias("importance")
    )


@query("mean_fold_importance", f"{IMPORTANCE_SQL} SELECT feature, round(importance, 6) AS importance FROM importance")
def _mean_importance(spark, sf_dir):
    return rounded(P.mean_fold_importance(fold_importance(spark, sf_dir)))


@query(
    "collect_nonempty",
    """WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN ''
      ELSE event_type END AS path FROM events)
    SELECT user_id, arg_min(path, event_id) FILTER (path IS NOT NULL AND path <> '') AS first_value,
    count(*) FILTER (path IS NOT NULL AND path <> '') AS n_values FROM e GROUP BY user_id""",
)
def _collect(spark, sf_dir):
    third = F.col("event_id") % 3
    path = F.when(third == 0, None).when(third == 1, "").otherwise(F.col("event_type"))
    return P.collect_nonempty(read(spark, sf_dir, "events").withColumn("path", path), "user_id", "path", "event_id")


@query(
    "latest_training",
    "SELECT o_custkey, max(o_orderdate) AS period_of_training FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
)
def _latest_training(spark, sf_dir):
    return P.latest_training(read(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", F.col("o_orderstatus") == "F")


@query(
    "target_rate_catalog",
    f"""{SCORED} SELECT 'orders_status' AS table_name, round(avg(CASE WHEN target = 2 THEN 1.0::DOUBLE ELSE 0 END), 6)
    AS tasa_target, 'customer' AS tipo_persona, 'orders' AS producto, 'binary' AS model_objective FROM scored""",
)
def _target_rate(spark, sf_dir):
    rows = scored_frame(spark, sf_dir).withColumn("positive", (F.col("target") == 2).cast("int"))
    attributes = {"tipo_persona": "customer", "producto": "orders", "model_objective": "binary"}
    return rounded(P.target_rate_catalog(rows, "positive", "orders_status", attributes))


VARIABLES = ["o_totalprice", "priority", "o_orderstatus", "o_orderdate"]
VARIABLES_SQL = """WITH o AS (SELECT *, nullif(o_orderpriority, '3-MEDIUM') AS priority FROM orders),
  imp AS (SELECT 'o_totalprice' AS feature, count(DISTINCT o_totalprice) AS importance FROM o
    UNION ALL SELECT 'priority', count(DISTINCT priority) FROM o
    UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM o
    UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate) FROM o),
  ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank_variable FROM imp)"""


@query(
    "variable_catalog",
    f"""{VARIABLES_SQL}, gaps AS ({' UNION ALL '.join(
        f"SELECT '{v}' AS column_name, count(*) > count({v}) AS flag_nulos FROM o" for v in VARIABLES)})
    SELECT 'orders' AS table_name, column_name, 'order' AS fs_entidad, column_name AS fs_feature,
    column_name IN ('o_orderdate') AS flag_dep_temporal, flag_nulos, rank_variable
    FROM gaps LEFT JOIN ranked ON column_name = feature""",
)
def _variables(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("priority", F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")))
    # Stand-in importance: how many distinct values a variable has.
    distinct = melt_text(orders, [], VARIABLES).where(F.col("value").isNotNull()).distinct()
    importance = distinct.groupBy("feature").agg(F.count(F.lit(1)).alias("importance"))
    return P.variable_catalog(orders, importance, VARIABLES, "orders", "order", ["o_orderdate"])
