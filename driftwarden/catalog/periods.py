"""Monitoring of every period in one pass, and of periods whose rows arrive in parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.catalog.drift import BIN_LINES, CAT, CONT, GENERAL_NAMES, general_lines, hist_ctes, ks_ctes
from driftwarden.catalog.performance import CAPTURE, CAPTURE_CTE, CONFUSION, CUTOFF, GENERAL, KPI, MART_CTE
from driftwarden.catalog.profiling import DISTRIBUTION, delta_cte, quality_ctes
from driftwarden.catalog.registry import PREDICT, SCORED, melt_sql, query, rounded
from driftwarden.common import scratch_path, union_all
from driftwarden.operators import profile as P
from driftwarden.plans import jobs
from driftwarden.plans.periods import period_marts
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import stored_scored
from driftwarden.sources import marts as stored
from driftwarden.streaming.monitor import monitor_stream_periods

EXECUTION = "2024-05-01 10:30:00"
SETS = ("p0", "p1", "p2")


def _cut(c: str) -> str:
    """The band of a score among those of its period and of the training rows."""
    low, high = f"least(min({c}) OVER run, t.lo_{c})", f"greatest(max({c}) OVER run, t.hi_{c})"
    part = f"ceil(({c} - {low}) / ({high} - {low}) * 10.0)"
    return f"'P' || lpad(CAST(10 * CAST(least(greatest({part}, 1), 10) AS INTEGER) AS VARCHAR), 3, '0') AS {c}_cut"


# The production rows of every period under labels ``period/all`` and ``period/segment``.
PERIOD_PREDICT = f"""{SCORED}, ends AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in SETS)}
  FROM scored WHERE set_analysis = 'training'),
pred AS (SELECT s.* EXCLUDE (p0_cut, p1_cut, p2_cut), {', '.join(map(_cut, SETS))}
  FROM scored s, ends t WHERE set_analysis = 'predict' WINDOW run AS (PARTITION BY periodo)),
top3 AS (SELECT periodo, segment FROM pred GROUP BY periodo, segment
  QUALIFY row_number() OVER (PARTITION BY periodo ORDER BY count(*) DESC, segment) <= 3),
labelled AS (SELECT CAST(periodo AS VARCHAR) || '/all' AS label, pred.* FROM pred
  UNION ALL SELECT CAST(periodo AS VARCHAR) || '/' || segment, pred.* FROM pred SEMI JOIN top3 USING (periodo, segment))"""


def _per_period(text: str) -> str:
    """Class names of the capture table with the period in front."""
    for c in SETS:
        text = text.replace(f"'{c}' AS name_classes, {c}_cut", f"CAST(periodo AS VARCHAR) || '/{c}' AS name_classes, {c}_cut")
        text = text.replace(f"SELECT '{c}', {c}_cut", f"SELECT CAST(periodo AS VARCHAR) || '/{c}', {c}_cut")
    return text


PERIOD_CTES = PERIOD_PREDICT + _per_period(MART_CTE[len(PREDICT) :])
_LABELLED = " UNION ALL ".join([GENERAL, KPI, CONFUSION, CUTOFF]).replace("segment = 'all'", "ends_with(segment, '/all')")
PERIOD_MART = f"""SELECT CAST(left(segment, 10) AS DATE) AS periodo, metric, value, type_metric, name_classes, percentil, cutoff,
  substr(segment, 12) AS segment FROM ({_LABELLED})
UNION ALL SELECT CAST(left(name_classes, 10) AS DATE), metric, value, type_metric, substr(name_classes, 12), percentil, cutoff, segment
  FROM ({CAPTURE})"""

# Every period's rows beside a copy of the training rows.
RUNS = """runs AS (SELECT DISTINCT periodo AS run FROM pred),
sides AS (SELECT run, 'reference' AS set_data, s.* FROM runs, scored s WHERE set_analysis = 'training'
  UNION ALL SELECT periodo, 'current', s.* FROM scored s WHERE set_analysis = 'predict')"""


def _of_run(feature: str) -> str:
    """A quoted feature name that becomes ``period/feature``."""
    return f"' || CAST(run AS VARCHAR) || '/{feature}"


def _chi(columns: dict[str, str], name: str) -> str:
    long = " UNION ALL ".join(
        f"SELECT CAST(run AS VARCHAR) || '/{f}' AS feature, set_data, CAST({c} AS VARCHAR) AS value FROM sides" for f, c in columns.items()
    )
    return f"""{name}_cells AS (SELECT feature, value, CAST(count(CASE WHEN set_data = 'reference' THEN 1 END) AS DOUBLE) AS r,
  CAST(count(CASE WHEN set_data = 'current' THEN 1 END) AS DOUBLE) AS c FROM ({long}) WHERE value IS NOT NULL GROUP BY ALL),
{name}_sizes AS (SELECT feature, sum(r) AS nr, sum(c) AS nc, count(*) AS k FROM {name}_cells GROUP BY feature),
{name} AS (SELECT feature, sum((r - nr * (r + c) / (nr + nc)) ** 2 / (nr * (r + c) / (nr + nc))
  + (c - nc * (r + c) / (nr + nc)) ** 2 / (nc * (r + c) / (nr + nc))) AS statistic, any_value(k) - 1 AS freedom
  FROM {name}_cells JOIN {name}_sizes USING (feature) GROUP BY feature),
{name}_p AS (SELECT feature, CASE freedom WHEN 2 THEN exp(-statistic / 2)
  WHEN 4 THEN exp(-statistic / 2) * (1 + statistic / 2) END AS p FROM {name})"""


def _quality() -> str:
    """The profile of both sides of every run."""
    text = quality_ctes("sides", CAT, CONT)
    text = text.replace("WHERE set_data =", "WHERE run = o.run AND set_data =").replace("FROM sides GROUP BY set_data", "FROM sides o GROUP BY run, set_data")
    for f in (*CAT, *CONT):
        text = text.replace(f"SELECT set_data, '{f}' AS feature", f"SELECT set_data, CAST(run AS VARCHAR) || '/{f}' AS feature")
    return text


_CODED = {c: f"dense_rank() OVER (PARTITION BY run ORDER BY {c}) - 1" for c in CAT} | {c: c for c in CONT}
_DIFFERENCES = [f"difference_{m}" for m in P.DELTA_METRICS]
DRIFT_CTES = f"""{RUNS}, {ks_ctes('sides', {_of_run(f): e for f, e in _CODED.items()})},
{_chi({c: c for c in CAT}, 'chi')}, {_chi({'target': 'target', 'prediction': 'prediction'}, 'lab')},
tests AS (SELECT feature, p_val_distance AS p_value_drift, CAST(p_val_distance < 0.05 AS INTEGER) AS exist_drift FROM ks
    WHERE {' OR '.join(f"ends_with(feature, '/{c}')" for c in CONT)}
  UNION ALL SELECT feature, p, CAST(p < 0.05 AS INTEGER) FROM chi_p),
drift_general AS (SELECT left(feature, 10) AS run, count(*) AS n_features, sum(exist_drift) AS n_drifted_features,
  avg(exist_drift) AS share_drifted_features, CAST(avg(exist_drift) >= 0.5 AS INTEGER) AS dataset_drift,
  any_value(real_drift) AS real_drift, any_value(prediction_drift) AS prediction_drift
  FROM tests JOIN (SELECT left(feature, 10) AS r, max(CASE WHEN ends_with(feature, '/target') THEN p END) AS real_drift,
    max(CASE WHEN ends_with(feature, '/prediction') THEN p END) AS prediction_drift FROM lab_p GROUP BY 1) l
  ON l.r = left(feature, 10) GROUP BY 1),
{_quality()}, {delta_cte()}, {hist_ctes('sides', {_of_run(f): e for f, e in _CODED.items()})},
merged AS (SELECT t.feature, p_value_drift, exist_drift, distance, p_val_distance, {', '.join(_DIFFERENCES)}
  FROM tests t LEFT JOIN delta USING (feature) LEFT JOIN ks USING (feature)),
specific AS ({melt_sql('merged', ['feature'], ['p_value_drift', 'exist_drift', *_DIFFERENCES, 'distance', 'p_val_distance'])}
  UNION ALL SELECT feature, metric, value FROM ({BIN_LINES}))"""


def _groups() -> str:
    """Feature groups of every period: numbers in ten bands of their period."""
    rows = [f"SELECT CAST(periodo AS VARCHAR) || '/{c}' AS feature, {c} AS group_feature, target, prediction, p0_cut, p1_cut, p2_cut FROM pred" for c in CAT]
    for c in CONT:
        low, high = f"min({c}) OVER (PARTITION BY periodo)", f"max({c}) OVER (PARTITION BY periodo)"
        # A column with one value in a period falls in the middle band.
        number = f"CASE WHEN {high} = {low} THEN 5 ELSE CAST(least(greatest(ceil(({c} - {low}) / ({high} - {low}) * 10.0), 1), 10) AS INTEGER) END"
        band = f"'P' || lpad(CAST(10 * {number} AS VARCHAR), 3, '0')"
        rows.append(f"SELECT CAST(periodo AS VARCHAR) || '/{c}', {band}, target, prediction, p0_cut, p1_cut, p2_cut FROM pred")
    return f"feat AS ({' UNION ALL '.join(rows)})"


# Numbers are written alike by both engines only as whole ones: cutoffs count their steps.
PERIODS_SQL = f"""{PERIOD_CTES}, {DRIFT_CTES}, {_groups()},
lines AS (SELECT 'perf__general_metrics' AS mart, periodo, segment || '/' || type_metric || coalesce('/' || CAST(round(cutoff * 49) AS INTEGER)::VARCHAR, '') AS subject,
    name_classes || '/' || percentil AS part, metric, value FROM ({PERIOD_MART})
  UNION ALL SELECT 'drift__general', CAST(run AS DATE), 'all', 'all', metric, value FROM ({melt_sql('drift_general', ['run'], GENERAL_NAMES)})
  UNION ALL SELECT 'drift__specific', CAST(left(feature, 10) AS DATE), substr(feature, 12), 'all', metric, value FROM specific
  UNION ALL SELECT 'feature__distribution', CAST(left(feature, 10) AS DATE), substr(feature, 12) || '/' || group_feature || '/' || type_metric,
    name_classes || '/' || flg_target, metric, value FROM ({DISTRIBUTION}))
SELECT mart, periodo, subject, part, metric, round(value, 3) AS value FROM lines"""


def _lines(marts: dict[str, DataFrame], period: str) -> DataFrame:
    """All marts in one narrow shape."""
    step = F.coalesce(F.concat(F.lit("/"), F.round(F.col("cutoff") * 49).cast("int").cast("string")), F.lit(""))
    subjects = {
        "perf__general_metrics": (F.concat("segment", F.lit("/"), "type_metric", step), F.concat_ws("/", "name_classes", "percentil")),
        "drift__general": (F.lit("all"), F.lit("all")),
        "drift__specific": (F.col("feature"), F.lit("all")),
        "feature__distribution": (F.concat_ws("/", "feature", "group_feature", "type_metric"), F.concat_ws("/", "name_classes", "flg_target")),
    }
    marts = marts | {"drift__general": general_lines(marts["drift__general"], [period])}
    parts = [
        marts[name].select(F.lit(name).alias("mart"), F.col(period).alias("periodo"), a.alias("subject"), b.alias("part"), "metric", "value")
        for name, (a, b) in subjects.items()
    ]
    return rounded(union_all(parts), 3)


@query("monitor_periods", PERIODS_SQL)
def _monitor_periods(spark, sf_dir):
    # The job is run twice under one execution: the second run replaces the lines of the first.
    rows = stored_scored(spark, sf_dir)
    root = scratch_path(spark, "marts")
    spec = SPEC.with_(source="predict")
    for _ in range(2):
        marts = period_marts(rows, spec)
        named = {n: df.withColumnRenamed("periodo", "periodo_execution_mg") for n, df in marts.items()}
        jobs.write_marts(named, spec, root, EXECUTION, None)
    back = {n: stored.read_mart(spark, root, jobs.MARTS[n]) for n in marts}
    back["perf__general_metrics"] = back["perf__general_metrics"].withColumnRenamed("subpoblation_features", "segment")
    return _lines(back, "periodo_execution_mg")


@query("monitor_stream_periods", PERIODS_SQL.replace("FROM lines", "FROM lines WHERE mart <> 'feature__distribution'"))
def _monitor_stream_periods(spark, sf_dir):
    # Every period's rows are dealt over three files, and each file arrives as a batch of its own.
    rows = stored_scored(spark, sf_dir)
    arriving_path = scratch_path(spark, "arriving")
    predict = rows.where("set_analysis = 'predict'")
    predict.repartitionByRange(3, F.xxhash64("row_id")).write.parquet(arriving_path)
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(arriving_path)
    root = scratch_path(spark, "stream-marts")
    reference = rows.where("set_analysis = 'training'")
    running = monitor_stream_periods(arriving, reference, SPEC, root, scratch_path(spark, "stream-checkpoint"))
    running.awaitTermination()
    marts = {n: spark.read.parquet(f"{root}/{n}") for n in ("perf__general_metrics", "drift__general", "drift__specific")}
    empty = spark.createDataFrame([], "periodo date, feature string, group_feature string, type_metric string, name_classes string, flg_target string, metric string, value double")
    return _lines(marts | {"feature__distribution": empty}, "periodo")
