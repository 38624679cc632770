"""Drift tests, histograms and drift tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.profiling import DISTRIBUTION, GROUPED_SQL, delta_cte, quality_ctes
from driftwarden.catalog.registry import SCORED, melt_sql, query, rounded
from driftwarden.common import melt, union_all
from driftwarden.operators import columns as C
from driftwarden.operators import drift as D
from driftwarden.operators import profile as P
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import read, stored_scored

SIDES = f"""{SCORED}, sides AS (SELECT *,
  CASE WHEN set_analysis = 'training' THEN 'reference' ELSE 'current' END AS set_data FROM scored)"""
CAT, CONT = list(SPEC.cat_features), list(SPEC.cont_features)


def ks_ctes(source: str, columns: dict[str, str], name: str = "ks") -> str:
    """CTE ``name``: feature, distance, p_val_distance for the given value expressions."""
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, set_data, CAST({e} AS DOUBLE) AS value FROM {source}" for f, e in columns.items()
    )
    return f"""{name}_long AS ({long}),
{name}_counts AS (SELECT feature, value, count(CASE WHEN set_data = 'reference' THEN 1 END) AS r,
  count(CASE WHEN set_data = 'current' THEN 1 END) AS c FROM {name}_long WHERE value IS NOT NULL GROUP BY feature, value),
{name}_run AS (SELECT feature, sum(r) OVER w AS rr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY feature) AS n,
  sum(c) OVER (PARTITION BY feature) AS m FROM {name}_counts WINDOW w AS (PARTITION BY feature ORDER BY value)),
{name}_gap AS (SELECT feature, any_value(CAST(n AS DOUBLE)) AS n, any_value(CAST(m AS DOUBLE)) AS m,
  max(abs(CAST(rr AS DOUBLE) / n - CAST(cc AS DOUBLE) / m)) AS distance FROM {name}_run GROUP BY feature),
{name} AS (SELECT feature, distance, CASE WHEN distance * sqrt(n * m / (n + m)) < 0.04 THEN 1.0::DOUBLE ELSE
  least(greatest(list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0 END)
    * exp(-2.0::DOUBLE * k * k * distance * distance * n * m / (n + m)))), 0.0), 1.0) END AS p_val_distance FROM {name}_gap)"""


def chi_ctes(source: str, columns: list[str], name: str = "chi") -> str:
    """CTE ``name``: feature, statistic, p (closed form, for an even number of degrees of freedom)."""
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, set_data, CAST({c} AS VARCHAR) AS value FROM {source}" for c in columns
    )
    return f"""{name}_long AS ({long}),
{name}_cells AS (SELECT feature, value, CAST(count(CASE WHEN set_data = 'reference' THEN 1 END) AS DOUBLE) AS r,
  CAST(count(CASE WHEN set_data = 'current' THEN 1 END) AS DOUBLE) AS c FROM {name}_long WHERE value IS NOT NULL GROUP BY ALL),
{name}_sizes AS (SELECT feature, sum(r) AS nr, sum(c) AS nc, count(*) AS k FROM {name}_cells GROUP BY feature),
{name} AS (SELECT feature, sum((r - nr * (r + c) / (nr + nc)) ** 2 / (nr * (r + c) / (nr + nc))
  + (c - nc * (r + c) / (nr + nc)) ** 2 / (nc * (r + c) / (nr + nc))) AS statistic, any_value(k) - 1 AS freedom
  FROM {name}_cells JOIN {name}_sizes USING (feature) GROUP BY feature),
{name}_p AS (SELECT feature, statistic, CASE freedom WHEN 2 THEN exp(-statistic / 2)
  WHEN 4 THEN exp(-statistic / 2) * (1 + statistic / 2) END AS p FROM {name})"""


def tests_cte(source: str = "sides", cat: list[str] = CAT, cont: list[str] = CONT) -> str:
    return f"""{ks_ctes(source, {c: c for c in cont}, 'kn')}, {chi_ctes(source, cat)},
tests AS (SELECT feature, 'num' AS feature_type, distance AS statistic, p_val_distance AS p_value_drift,
    CAST(p_val_distance < 0.05 AS INTEGER) AS exist_drift FROM kn
  UNION ALL SELECT feature, 'cat', statistic, p, CAST(p < 0.05 AS INTEGER) FROM chi_p)"""


def sides(spark, sf_dir):
    return D.as_reference_and_current(stored_scored(spark, sf_dir))


LINE_SQL = """WITH sides AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '1998-07-01' THEN 'reference' ELSE 'current' END
  AS set_data FROM lineitem)"""
LINE_CONT = ["l_quantity", "l_extendedprice", "l_discount"]


def line_sides(spark, sf_dir):
    early = F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    side = F.when(early, "reference").otherwise("current")
    return read(spark, sf_dir, "lineitem").withColumn("set_data", side)


@query(
    "ks_drift",
    f"""{LINE_SQL}, {ks_ctes('sides', {c: c for c in LINE_CONT})} SELECT feature, round(distance, 6) AS distance,
    round(p_val_distance, 6) AS p_val_distance, CAST(p_val_distance < 0.01 AS INTEGER) AS is_drift FROM ks""",
)
def _ks(spark, sf_dir):
    return rounded(D.ks_drift(line_sides(spark, sf_dir), LINE_CONT)).orderBy(F.desc("distance"))


@query(
    "feature_drift_test",
    f"""{SIDES}, {tests_cte()} SELECT feature, feature_type, round(statistic, 6) AS statistic,
    round(p_value_drift, 6) AS p_value_drift, exist_drift FROM tests""",
)
def _tests(spark, sf_dir):
    return rounded(D.feature_drift_test(sides(spark, sf_dir), CAT, CONT))


LABEL_DRIFT = f"""{chi_ctes('sides', ['target', 'prediction'], 'lab')}, label_drift AS (
  SELECT max(CASE WHEN feature = 'target' THEN p END) AS real_drift,
  max(CASE WHEN feature = 'prediction' THEN p END) AS prediction_drift FROM lab_p)"""


@query(
    "target_prediction_drift",
    f"""{SIDES}, {LABEL_DRIFT} SELECT round(real_drift, 6) AS real_drift, round(prediction_drift, 6) AS prediction_drift
    FROM label_drift""",
)
def _label_drift(spark, sf_dir):
    return rounded(D.target_prediction_drift(sides(spark, sf_dir), SPEC))


@query(
    "drift_summary",
    f"""{SIDES}, {tests_cte()}, {LABEL_DRIFT} SELECT count(*) AS n_features,
    CAST(sum(exist_drift) AS BIGINT) AS n_drifted_features, round(avg(exist_drift), 6) AS share_drifted_features,
    avg(exist_drift) >= 0.5 AS dataset_drift, (SELECT round(prediction_drift, 6) FROM label_drift) AS prediction_drift,
    (SELECT round(real_drift, 6) FROM label_drift) AS real_drift FROM tests""",
)
def _summary(spark, sf_dir):
    rows = sides(spark, sf_dir)
    return rounded(D.drift_summary(D.feature_drift_test(rows, CAT, CONT), D.target_prediction_drift(rows, SPEC)))


def hist_ctes(source: str, columns: dict[str, str]) -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, set_data, CAST({e} AS DOUBLE) AS value FROM {source}" for f, e in columns.items()
    )
    return f"""hist_long AS ({long}),
limits AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM hist_long GROUP BY feature),
bin_rows AS (SELECT feature, set_data, lo, hi, CAST(least(greatest(ceil((value - lo) / (hi - lo) * 10.0), 1), 10) AS INTEGER) - 1
  AS b FROM hist_long JOIN limits USING (feature)),
hist AS (SELECT s.feature, s.set_data, CAST(i AS INTEGER) AS bin, count(r.b) AS n,
  any_value(s.lo + i * (s.hi - s.lo) / 10.0) AS edge_low, any_value(s.lo + (i + 1) * (s.hi - s.lo) / 10.0) AS edge_high
  FROM (SELECT DISTINCT feature, set_data, lo, hi FROM bin_rows) s CROSS JOIN (SELECT unnest(range(0, 10)) AS i)
  LEFT JOIN bin_rows r ON r.feature = s.feature AND r.set_data = s.set_data AND r.b = i GROUP BY s.feature, s.set_data, i)"""


@query(
    "feature_histograms",
    f"""{LINE_SQL}, {hist_ctes('sides', {c: c for c in LINE_CONT})}
    SELECT feature, set_data, bin, n, round(edge_low, 6) AS edge_low, round(edge_high, 6) AS edge_high FROM hist""",
)
def _histograms(spark, sf_dir):
    return rounded(D.feature_histograms(line_sides(spark, sf_dir), LINE_CONT))


BIN_LINES = """SELECT feature, 'hist_' || CASE WHEN set_data = 'reference' THEN 'ref' ELSE 'current' END || '_' || bin AS metric,
  CAST(n AS DOUBLE) AS value, 'drift_bins' AS type_metric FROM hist"""


@query("explode_hist_bins", f"{LINE_SQL}, {hist_ctes('sides', {c: c for c in LINE_CONT})} {BIN_LINES}")
def _bins(spark, sf_dir):
    return D.explode_hist_bins(D.histogram_arrays(D.feature_histograms(line_sides(spark, sf_dir), LINE_CONT)))


def specific_ctes(source: str = "sides", cat: list[str] = CAT, cont: list[str] = CONT) -> str:
    """Everything up to the CTE ``specific``; categories are coded by the order of the reference's levels."""
    # Known levels in order, then one place that all levels the reference lacks share.
    known = {c: f"({c} IN (SELECT {c} FROM {source} WHERE set_data = 'reference'))" for c in cat}
    coded = {
        c: f"dense_rank() OVER (ORDER BY CASE WHEN {k} THEN 0 ELSE 1 END, CASE WHEN {k} THEN {c} END) - 1" for c, k in known.items()
    } | {c: c for c in cont}
    differences = [f"difference_{m}" for m in P.DELTA_METRICS]
    wide = ["p_value_drift", "exist_drift", *differences, "distance", "p_val_distance"]
    return f"""{tests_cte(source, cat, cont)}, {quality_ctes(source, cat, cont)}, {delta_cte()}, {ks_ctes(source, coded)},
{hist_ctes(source, coded)}, merged AS (SELECT t.feature, p_value_drift, exist_drift, distance, p_val_distance,
  {', '.join(differences)} FROM tests t LEFT JOIN delta USING (feature) LEFT JOIN ks USING (feature)),
specific AS (SELECT feature, metric, value, 'drift_indicator' AS type_metric FROM ({melt_sql('merged', ['feature'], wide)})
  UNION ALL {BIN_LINES})"""


@query(
    "specific_drift_mart",
    f"{SIDES}, {specific_ctes()} SELECT * REPLACE (round(value, 6) AS value) FROM specific",
)
def _specific(spark, sf_dir):
    return rounded(D.specific_drift_mart(sides(spark, sf_dir), CAT, CONT))


@query(
    "merge_drift_tables",
    f"""{SIDES}, {specific_ctes()} SELECT feature, round(p_value_drift, 6) AS p_value_drift, exist_drift,
    round(distance, 6) AS distance, round(CAST(difference_mean AS DOUBLE), 6) AS difference_mean FROM merged""",
)
def _merge(spark, sf_dir):
    rows = sides(spark, sf_dir)
    tests = D.feature_drift_test(rows, CAT, CONT)
    deltas = P.data_quality_delta(P.data_quality_profile(rows, CAT, CONT))
    distances = D.ks_drift(D.encoded(rows, CAT), CAT + CONT)
    merged = D.merge_drift_tables(tests, distances, deltas)
    return rounded(merged.select("feature", "p_value_drift", "exist_drift", "distance", "difference_mean"))


GENERAL_NAMES = ["n_features", "n_drifted_features", "share_drifted_features", "dataset_drift", "real_drift", "prediction_drift"]
GENERAL_CTES = """drift_general AS (SELECT count(*) AS n_features, sum(exist_drift) AS n_drifted_features,
  avg(exist_drift) AS share_drifted_features, CAST(avg(exist_drift) >= 0.5 AS INTEGER) AS dataset_drift,
  (SELECT real_drift FROM label_drift) AS real_drift, (SELECT prediction_drift FROM label_drift) AS prediction_drift FROM tests)"""


def general_lines(general, by=()):
    """The general drift row in long form."""
    whole = general.withColumn("dataset_drift", F.col("dataset_drift").cast("int"))
    return melt(whole, list(by), GENERAL_NAMES).withColumn("feature", F.lit("all"))


@query(
    "feature_drift_job",
    f"""{GROUPED_SQL}, sides AS (SELECT *, CASE WHEN set_analysis = 'training' THEN 'reference' ELSE 'current' END AS set_data
      FROM scored), {specific_ctes()}, {LABEL_DRIFT}, {GENERAL_CTES}
    SELECT 'drift__specific' AS mart, feature, metric, round(value, 6) AS value FROM specific
    UNION ALL SELECT 'drift__general', 'all', metric, round(value, 6) FROM ({melt_sql('drift_general', [], GENERAL_NAMES)})
    UNION ALL SELECT 'feature__distribution', feature, metric, round(value, 6) FROM ({DISTRIBUTION})""",
)
def _job(spark, sf_dir):
    parts = D.feature_drift_job(stored_scored(spark, sf_dir), SPEC)
    columns = ["feature", "metric", "value"]
    parts["drift__general"] = general_lines(parts["drift__general"])
    return rounded(union_all([df.select(F.lit(m).alias("mart"), *columns) for m, df in parts.items()]))


# One month of orders against the next.
MONTHS = """WITH sides AS (SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-04-01' THEN 'reference' ELSE 'current' END AS set_data,
  o_orderpriority, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-05-01')"""


@query(
    "period_drift_job",
    f"""{MONTHS}, {ks_ctes('sides', {'o_totalprice': 'o_totalprice', 'o_orderpriority':
        'dense_rank() OVER (ORDER BY o_orderpriority) - 1', 'o_orderstatus': 'dense_rank() OVER (ORDER BY o_orderstatus) - 1'})}
    SELECT feature, round(distance, 6) AS distance, round(p_val_distance, 6) AS p_val_distance,
    feature IN (SELECT f FROM (SELECT 'o_orderstatus' AS f, count(DISTINCT o_orderstatus) AS k FROM sides
      WHERE set_data = 'reference' UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM sides
      WHERE set_data = 'reference' UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice) FROM sides
      WHERE set_data = 'reference') WHERE k <= 4) AS is_binary FROM ks""",
)
def _period_job(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("periodo", F.trunc("o_orderdate", "MM"))
    pair = C.next_period_pair(orders, "periodo", F.lit("1998-03-01").cast("date"))
    parts = D.period_drift_job(pair, ["o_orderpriority", "o_orderstatus"], ["o_totalprice"])
    few = parts["bin_features"].select("feature", F.lit(True).alias("is_binary"))
    out = parts["drift__distance"].join(few, "feature", "left")
    out = out.withColumn("is_binary", F.coalesce("is_binary", F.lit(False)))
    return rounded(out.select("feature", "distance", "p_val_distance", "is_binary"))
