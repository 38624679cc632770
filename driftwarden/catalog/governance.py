"""Leaderboard, registries and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.connectors import LOG, event_log
from driftwarden.catalog.drift import LABEL_DRIFT, specific_ctes
from driftwarden.catalog.explaining import SHAP, SUMMARY, WEIGHTS, shap_importance
from driftwarden.catalog.modelling import SMALL
from driftwarden.catalog.performance import MART, MART_CTE
from driftwarden.catalog.profiling import CORR, DISTRIBUTION, GROUPED_SQL, LINEAR
from driftwarden.catalog.registry import PREDICT, SCORED, query, rounded
from driftwarden.common import scratch_path
from driftwarden.operators import drift as D
from driftwarden.operators import explain as E
from driftwarden.operators import metrics as M
from driftwarden.operators import training as T
from driftwarden.plans import jobs
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import read, scored_frame, stored_scored
from driftwarden.sources import resource_log
from driftwarden.streaming.monitor import monitor_stream


def tail(text: str, head: str) -> str:
    """The common table expressions of ``text`` beyond those of ``head``."""
    assert text.startswith(head)
    return text[len(head) :]


# Every mart of the fixture scores with the fixed linear attributions.
ALL_CTES = f"""{MART_CTE}{tail(SUMMARY, PREDICT)}{tail(GROUPED_SQL, PREDICT)}, sides AS (SELECT *,
  CASE WHEN set_analysis = 'training' THEN 'reference' ELSE 'current' END AS set_data FROM scored),
{specific_ctes()}, {LABEL_DRIFT}, mart AS ({MART}),
explainer AS (SELECT * FROM summary_lines UNION ALL {LINEAR}
  UNION ALL SELECT feature, avg(abs(value)), 'explainer_by_all', 'all', 'gain', 'all' FROM shap GROUP BY feature),
general AS (SELECT 1)"""
ALL_CTES = ALL_CTES.rsplit(",\ngeneral AS", 1)[0]

BOARD = f"""{ALL_CTES}, log AS ({LOG.removeprefix('WITH log AS (')},
pairs AS (SELECT name_classes, percentil, segment, max(CASE WHEN metric = 'target_rlt' THEN value END) AS t,
  max(CASE WHEN metric = 'prediction_rlt' THEN value END) AS p FROM mart
  WHERE metric IN ('target_rlt', 'prediction_rlt') GROUP BY ALL),
board AS (SELECT {', '.join(f"avg(value) FILTER (metric = '{m}' AND type_metric = 'performance_by_all') AS {m}"
    for m in ('log_loss', 'accuracy', 'roc_auc_score', 'gini', 'precision', 'recall', 'f1_score'))} FROM mart),
totals AS (SELECT value FROM explainer WHERE type_metric = 'explainer_by_all' AND metric = 'shap_abs' AND name_classes = 'all')"""
BOARD_COLUMNS = """round(log_loss, 6) AS log_loss, round(accuracy, 6) AS accuracy, round(roc_auc_score, 6) AS roc_auc_score,
  round(gini, 6) AS gini, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
  (SELECT round(avg(CASE WHEN value > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) FROM totals) AS fi_shap_0,
  (SELECT round(avg(CASE WHEN value > 0.5 THEN 1.0::DOUBLE ELSE 0 END), 6) FROM totals) AS fi_shap_0_5,
  (SELECT round(avg(exist_drift), 6) FROM tests) AS feature_drift, (SELECT round(real_drift, 6) FROM label_drift) AS target_drift,
  (SELECT round(prediction_drift, 6) FROM label_drift) AS prediction_drift,
  (SELECT round(avg(abs(t - p)), 6) FROM pairs) AS kpi_mae,
  (SELECT round(avg((cpu_usage_m_1 + cpu_usage_0 + cpu_usage_s_1) / 3), 6) FROM log) AS cpu_usage_percent,
  (SELECT round(avg(memory_usage_available / memory_usage_total), 6) FROM log) AS ram_usage_percent"""


def fixture_marts(spark, sf_dir):
    rows = stored_scored(spark, sf_dir)
    predict = rows.where("set_analysis = 'predict'")
    shap = E.linear_shap(predict, "row_id", WEIGHTS, ["segment"])
    costs = resource_log.resource_cost_mart(resource_log.parse_resource_log(spark, event_log(spark, sf_dir)))
    return jobs.governance_marts(rows, SPEC, shap, shap_importance(shap), SPEC.cont_features, "row_id", costs)


@query("leaderboard", f"{BOARD} SELECT {BOARD_COLUMNS} FROM board")
def _board(spark, sf_dir):
    return rounded(fixture_marts(spark, sf_dir)["leaderboard"])


@query(
    "evaluate_marts",
    f"""{ALL_CTES} SELECT 'perf__general_metrics' AS mart, metric, type_metric, name_classes, round(value, 3) AS value FROM mart
    UNION ALL SELECT 'feature__explainer_general', metric, type_metric, name_classes, round(value, 3) FROM explainer
    UNION ALL SELECT 'feature__distribution', metric, type_metric, name_classes, round(value, 3) FROM ({DISTRIBUTION})
    UNION ALL SELECT 'drift__specific', metric, type_metric, feature, round(value, 3) FROM specific""",
)
def _evaluate(spark, sf_dir):
    marts = fixture_marts(spark, sf_dir)
    marts["drift__specific"] = marts["drift__specific"].withColumnRenamed("feature", "name_classes")
    names = ("perf__general_metrics", "feature__explainer_general", "feature__distribution", "drift__specific")
    lines = [
        marts[n].select(F.lit(n).alias("mart"), "metric", "type_metric", "name_classes", "value") for n in names
    ]
    out = lines[0]
    for part in lines[1:]:
        out = out.unionByName(part)
    return rounded(out, 3)


@query(
    "run_registry",
    """SELECT c_custkey AS id_modelo, 'segment' AS key, c_mktsegment AS value FROM customer
    UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
    UNION ALL SELECT c_custkey, 'name', c_name FROM customer""",
)
def _registry(spark, sf_dir):
    return jobs.run_registry(customer_runs(spark, sf_dir), "c_custkey", "constants")


def customer_runs(spark, sf_dir):
    constants = F.create_map(
        F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"), F.lit("name"), F.col("c_name")
    )
    return read(spark, sf_dir, "customer").withColumn("constants", constants)


@query("compare_runs", "SELECT c_custkey AS id_modelo, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def _compare(spark, sf_dir):
    registry = jobs.run_registry(customer_runs(spark, sf_dir), "c_custkey", "constants")
    return jobs.compare_runs(registry, ["segment", "nation"])


# -------------------------------------------------------------------- exploration


@query(
    "eda_levels",
    """SELECT feature, group_feature, class, n, round(n / CAST(sum(n) OVER (PARTITION BY feature, group_feature) AS DOUBLE), 6)
    AS share FROM (
      SELECT 'l_shipmonth' AS feature, strftime(l_shipdate, '%Y-%m') AS group_feature, l_returnflag AS class, count(*) AS n
        FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') IN (SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem GROUP BY 1
          ORDER BY count(*) DESC, 1 LIMIT 11) GROUP BY ALL
      UNION ALL SELECT 'l_linestatus', l_linestatus, l_returnflag, count(*) FROM lineitem GROUP BY ALL)""",
)
def _levels(spark, sf_dir):
    line = read(spark, sf_dir, "lineitem").withColumn("l_shipmonth", F.date_format("l_shipdate", "yyyy-MM"))
    return rounded(jobs.level_counts_by_class(line, ["l_shipmonth", "l_linestatus"], "l_returnflag"))


SUMMARY_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, l_returnflag AS class, count({c}) AS n, round(avg({c}), 6) AS mean,
    round(stddev_samp({c}), 6) AS std, {', '.join(f'round(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS q{int(100 * q)}'
    for q in jobs.QUANTILES)} FROM lineitem GROUP BY l_returnflag"""
    for c in ("l_quantity", "l_extendedprice")
)


@query("eda_numeric_summary", SUMMARY_SQL)
def _numeric(spark, sf_dir):
    return rounded(jobs.numeric_summary(read(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], "l_returnflag"))


DENSITY = ["l_discount", "l_quantity", "l_tax"]
DENSITY_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, class, x, density FROM (
    WITH s AS (SELECT l_returnflag AS class, CAST(count(*) AS DOUBLE) AS n, min({c}) AS mn, max({c}) AS mx,
      stddev_samp({c}) * count(*) ** -0.2::DOUBLE AS h, (SELECT count(*) FROM lineitem) AS total FROM lineitem GROUP BY 1),
    g AS (SELECT s.*, mn - 3 * h + (mx + 3 * h - (mn - 3 * h)) * (i / 49.0::DOUBLE) AS x FROM s, (SELECT unnest(range(0, 50)) AS i)),
    v AS (SELECT l_returnflag AS class, {c} AS y, count(*) AS c FROM lineitem GROUP BY ALL)
    SELECT g.class, round(x, 6) AS x, round(sum(c * exp(-0.5::DOUBLE * ((x - y) / h) ** 2)) / any_value(total * h * sqrt(2 * pi())), 6)
    AS density FROM g JOIN v ON g.class = v.class GROUP BY g.class, x)"""
    for c in DENSITY
)


@query("eda_density", DENSITY_SQL)
def _density(spark, sf_dir):
    return rounded(jobs.kernel_densities(read(spark, sf_dir, "lineitem"), DENSITY, "l_returnflag"))


# Amounts in cents: sums of integers are the same in both engines, so rounding meets the same numbers.
SERIES_SQL = f"""{SCORED}, s AS (
  SELECT 'o_totalprice' AS feature, CAST(target AS VARCHAR) AS class, periodo,
    avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS value FROM scored GROUP BY ALL
  UNION ALL SELECT 'c_acctbal', CAST(target AS VARCHAR), periodo, avg(CAST(round(c_acctbal * 100) AS BIGINT)) FROM scored GROUP BY ALL
  UNION ALL SELECT 'o_orderpriority', CAST(target AS VARCHAR), periodo, count(*) FROM scored WHERE o_orderpriority =
    (SELECT o_orderpriority FROM scored GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) GROUP BY ALL
  UNION ALL SELECT 'c_mktsegment', CAST(target AS VARCHAR), periodo, count(*) FROM scored WHERE c_mktsegment =
    (SELECT c_mktsegment FROM scored GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY feature, class ORDER BY periodo) - 1 AS i,
  CAST(floor(0.2::DOUBLE * count(*) OVER (PARTITION BY feature, class)) AS BIGINT) AS k FROM s),
w AS (SELECT a.feature, a.class, a.periodo, any_value(a.value) AS value, avg(b.value) AS m, stddev_pop(b.value) AS d
  FROM p a LEFT JOIN p b ON a.feature = b.feature AND a.class = b.class AND b.i BETWEEN a.i - a.k AND a.i + a.k - 1
  GROUP BY a.feature, a.class, a.periodo)"""


@query(
    "eda_timeseries",
    f"""{SERIES_SQL} SELECT feature, class, periodo, round(value, 4) AS value, round(m + 2.5::DOUBLE * d, 2) AS upper,
    round(m - 2.5::DOUBLE * d, 2) AS lower, coalesce(value > m + 2.5::DOUBLE * d OR value < m - 2.5::DOUBLE * d, false) AS anomaly
    FROM w""",
)
def _timeseries(spark, sf_dir):
    cents = {c: F.round(F.col(c) * 100).cast("bigint") for c in SPEC.cont_features}
    rows = stored_scored(spark, sf_dir).withColumns(cents)
    series = jobs.eda_tables(rows, SPEC, "target")["timeseries"]
    return rounded(rounded(series, 4, ["value"]), 2, ["upper", "lower"])


# ------------------------------------------------------------------------ training


def modelling_table(spark, sf_dir):
    rows = scored_frame(spark, sf_dir).select(
        "row_id", "entity_id", "periodo", "segment", "kpi", "target", "o_orderpriority", "c_mktsegment", "o_totalprice", "c_acctbal"
    )
    finished = (F.col("target") == 0).cast("int")
    return rows.withColumns({"finished": finished, "weekday": (F.col("row_id") % 7).cast("double")})


JOB_SPEC = SPEC.with_(
    name_target="finished",
    sub_cols=("q0", "q1"),
    cont_features=("o_totalprice", "c_acctbal", "weekday"),
    parameters={**SMALL, "test_size": 0.33, "seed": 60},
)
STEPS = {"preprocess": {"steps_cat": ("null", "le"), "steps_cont": ("null", "ms")}}


@query("train_job")
def _train_job(spark, sf_dir):
    steps = STEPS | {
        "feature_selection": {"mode": "n_features", "threshold": 0.8, "n_folds": 3},
        "tuning": {"n_trials": 2},
        "training": {"n_folds": 3},
    }
    return jobs.train_job(modelling_table(spark, sf_dir), JOB_SPEC, steps, scratch_path(spark, "models")).fold_metrics


@query("evaluate_job")
def _evaluate_job(spark, sf_dir):
    trained = jobs.train_job(modelling_table(spark, sf_dir), JOB_SPEC, STEPS)
    marts = jobs.evaluate(trained)
    root = scratch_path(spark, "marts")
    paths = jobs.write_marts(marts, trained.spec.with_(source="training"), root, "2024-05-01 10:30:00", "2001-08-01")
    sizes = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n")).withColumn("mart", F.lit(p.rsplit("/", 1)[1])) for p in paths]
    out = sizes[0]
    for s in sizes[1:]:
        out = out.unionByName(s)
    return out


@query("monitor_job")
def _monitor_job(spark, sf_dir):
    rows = modelling_table(spark, sf_dir)
    border = F.lit("2001-07-01").cast("date")
    training, production = rows.where(F.col("periodo") < border), rows.where(F.col("periodo") >= border)
    trained = jobs.train_job(training, JOB_SPEC, STEPS)
    root = scratch_path(spark, "marts")
    jobs.monitor_periods(trained, training, production, root, "2024-05-01 10:30:00")
    board = spark.read.parquet(f"{root}/mg_poc_leaderboard")
    return board.select("periodo_execution_mg", "log_loss", "accuracy", "roc_auc_score", "feature_drift")


@query("predict_job")
def _predict_job(spark, sf_dir):
    trained = jobs.train_job(modelling_table(spark, sf_dir), JOB_SPEC, STEPS)
    batch = modelling_table(spark, sf_dir).drop("c_acctbal")
    customer = read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "entity_id")
    named = {"customer": (customer, "entity_id")}
    enriched = jobs.enrich_features(batch, ["customer:c_acctbal"], named)
    source = enriched.withColumnRenamed("customer__c_acctbal", "c_acctbal")
    return jobs.predict_job(source, trained, scratch_path(spark, "predictions"), "2001-08-01", extra=["segment"])


@query(
    "monitor_stream",
    f"{MART_CTE} SELECT * REPLACE (round(value, 3) AS value, round(cutoff, 6) AS cutoff) FROM ({MART})",
)
def _stream(spark, sf_dir):
    rows = stored_scored(spark, sf_dir)
    arriving_path = scratch_path(spark, "arriving")
    rows.where("set_analysis = 'predict'").write.parquet(arriving_path)
    arriving = spark.readStream.schema(rows.schema).parquet(arriving_path)
    root = scratch_path(spark, "stream-marts")

    def build(scored, spec):
        return {"perf__general_metrics": M.general_metric_mart(scored, spec)}

    reference = rows.where("set_analysis = 'training'")
    running = monitor_stream(arriving, reference, SPEC, build, root, scratch_path(spark, "stream-checkpoint"))
    running.awaitTermination()
    mart = spark.read.parquet(f"{root}/perf__general_metrics").drop("batch_id")
    return rounded(rounded(mart, 3, ["value"]), 6, ["cutoff"])
