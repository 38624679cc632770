"""Marts of all periods at once against each period on its own, sums in parts, reruns, awkward groups."""

import random
import threading
from collections import Counter
from functools import partial

import pytest
from pyspark.sql import functions as F

from driftwarden.catalog.explaining import WEIGHTS, shap_importance
from driftwarden.common import together, written
from driftwarden.functions.scalars import equal_width_bands
from driftwarden.operators import drift as D
from driftwarden.operators import explain as E
from driftwarden.operators import metrics as M
from driftwarden.operators import partial_sums as S
from driftwarden.operators import profile as P
from driftwarden.operators import value_counts as V
from driftwarden.plans import jobs, periods
from driftwarden.plans.scored import ORDERS_SPEC as SPEC
from driftwarden.plans.scored import stored_scored
from driftwarden.sources.marts import read_mart

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return stored_scored(spark, SF)


def lines(frame, columns):
    return Counter(tuple(round(v, 7) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in frame.collect())


def test_every_period_has_the_lines_of_its_rows_alone(spark, rows):
    predict = rows.where("set_analysis = 'predict'")
    shap = written(E.linear_shap(predict, "row_id", WEIGHTS, ["segment", "periodo"]), "shap")
    marts = {n: written(df, "mart") for n, df in periods.period_marts(rows, SPEC, shap, SPEC.cont_features).items()}
    known = [r["periodo"] for r in marts["leaderboard"].select("periodo").orderBy("periodo").collect()]
    assert known == [r[0] for r in predict.select("periodo").distinct().orderBy("periodo").collect()] and len(known) > 5
    for period in (known[0], known[-2]):
        mine = F.col("periodo") == F.lit(period)
        alone = rows.where(mine | (F.col("set_analysis") == "training")).drop("p0_cut", "p1_cut", "p2_cut")
        alone = written(equal_width_bands(alone, SPEC.sub_cols), "alone")
        own = shap.where(mine)
        want = jobs.governance_marts(alone, SPEC, own, shap_importance(own), SPEC.cont_features, "row_id")
        for name, mart in marts.items():
            columns = [c for c in mart.columns if c != "periodo"]
            other = want[name].where("metric <> 'gain'") if name == "feature__explainer_general" else want[name]
            assert lines(mart.where(mine), columns) == lines(other, columns), name


def test_sums_in_parts_are_the_sums_of_the_whole(spark, rows):
    predict = rows.where("set_analysis = 'predict'")
    by = [SPEC.period]
    parts = [periods.sums_of(predict.where(F.pmod("row_id", F.lit(3)) == k), SPEC, by) for k in range(3)]
    together, whole = periods.added(parts, by), periods.sums_of(predict, SPEC, by)
    for name in ("cells", "scores", "counts"):
        a, b = getattr(together, name), getattr(whole, name)
        assert lines(a.select(b.columns), b.columns) == lines(b, b.columns)


def test_a_repeated_run_leaves_each_line_once(spark, rows, tmp_path):
    mart = M.decile_capture(rows, SPEC)
    for execution, period, n in (("2024-05-01 10:30:00", "2000-01-01", 1), ("2024-05-01 10:30:00", "2000-01-01", 1), ("2024-05-01 10:30:00", "2000-02-01", 2), ("2024-06-01 10:30:00", "2000-02-01", 3)):
        jobs.append_mart(mart, "mg_perf__general_metrics", SPEC, str(tmp_path), execution, period)
        back = read_mart(spark, str(tmp_path), "mg_perf__general_metrics")
        assert back.count() == n * mart.count() and "run_key" not in back.columns


def test_training_and_monitoring_jobs(spark, tmp_path):
    rng = random.Random(3)
    data = []
    for i in range(400):
        month, x = f"2024-0{1 + i % 5}-01", rng.gauss(0, 1)
        data.append((i, month, rng.choice(["n", "s", "w"]), rng.choice(["a", "b"]), x, int(x + rng.gauss(0, 0.3) > 0), 10.0))
    table = spark.createDataFrame(data, "id int, periodo string, segment string, c string, x double, y int, kpi double")
    table = table.withColumn("periodo", F.col("periodo").cast("date"))
    spec = SPEC.with_(
        id_features=("id", "periodo"), cat_features=("c",), cont_features=("x",), name_target="y", sub_cols=("q0", "q1"),
        obs_features=("id",), parameters={"n_estimators": 2, "max_depth": 2},
    )
    border = F.lit("2024-04-01").cast("date")
    training, production = table.where(F.col("periodo") < border), table.where(F.col("periodo") >= border)
    trained = jobs.train_job(training, spec, {"preprocess": {"steps_cat": ("null", "le"), "steps_cont": ("null", "ss")}})
    root = str(tmp_path / "marts")
    for _ in range(2):
        done = jobs.monitor_periods(trained, training, production, root, "2024-07-01 08:00:00")
        assert done == ["2024-04-01", "2024-05-01"]
    board = read_mart(spark, root, "mg_leaderboard")
    assert sorted(str(r["periodo_execution_mg"]) for r in board.collect()) == done
    # One period by itself has the same figures.
    alone = jobs.monitor(trained, training, production.where(F.col("periodo") == border))["leaderboard"].first()
    mine = board.where(F.col("periodo_execution_mg") == border).first()
    for name in ("log_loss", "accuracy", "roc_auc_score", "gini", "feature_drift", "target_drift", "fi_shap_0", "kpi_mae"):
        assert mine[name] == pytest.approx(alone[name], rel=1e-9, nan_ok=True), name
    individual = read_mart(spark, root, "mg_feature__explainer_individual")
    assert individual.count() == 2 * production.count()


# Value counts ------------------------------------------------------------------------------------------------------


def two_sides(spark, seed, n=400):
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), -0.0, 0.0]
    data = [
        ("reference" if i % 3 else "current", i % 4 if i % 11 else None, rng.choice(["a", "b", "c", None]), rng.choice([*odd, rng.gauss(0, 1), rng.gauss(0, 1)]), float(rng.randrange(6)))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "set_data string, run int, c string, x double, y double")


def test_folds_equal_the_operators_on_rows(spark):
    rows = two_sides(spark, 1)
    counts = written(V.value_counts(rows, ["c"], ["x", "y"]), "counts")
    names = P.QUALITY_METRICS
    got = V.quality(counts).withColumnRenamed("side", "set_data")
    want = P.data_quality_profile(rows, ["c"], ["x", "y"])

    def plain(frame):
        out = {}
        for r in frame.collect():
            out[r["set_data"], r["feature"]] = [None if v is None or v != v or abs(v) == float("inf") else round(v, 9) for v in (r[m] for m in names)]
        return out

    assert plain(got) == plain(want)
    finite = rows.withColumn("x", F.when(F.abs("x") < 1e9, F.col("x")))
    counts = written(V.value_counts(finite, ["c"], ["x", "y"]), "counts")
    got = {r["feature"]: r["distance"] for r in V.distances(V.ranked(counts)).collect()}
    want = {r["feature"]: r["distance"] for r in D.ks_drift(finite, ["x", "y"]).collect()}
    assert got.keys() == want.keys() and all(got[f] == pytest.approx(want[f], abs=1e-12) for f in got)
    got = {(r["feature"], r["side"], r["bin"]): r["n"] for r in V.histograms(counts).collect()}
    want = {(r["feature"], r["set_data"], r["bin"]): r["n"] for r in D.feature_histograms(finite, ["x", "y"]).collect()}
    assert got == want
    chi = V.chi_square(V.against_reference(counts)).first()
    old = D.chi_square_drift(finite, ["c"]).first()
    assert chi["statistic"] == pytest.approx(old["statistic"], abs=1e-9) and chi["freedom"] == old["freedom"]


def test_distance_of_every_group_by_its_definition(spark):
    rows = two_sides(spark, 2).where("NOT isnan(x) AND abs(x) < 1e9")
    data = rows.collect()
    counts = V.value_counts(rows, [], ["x", "y"], by=["run"])
    got = {(r["run"], r["feature"]): r["distance"] for r in V.distances(V.ranked(counts, ["run"]), ["run"]).collect()}
    for feature in ("x", "y"):
        base = [r[feature] for r in data if r["set_data"] == "reference"]
        for run in {r["run"] for r in data if r["set_data"] == "current"}:
            own = [r[feature] for r in data if r["set_data"] == "current" and r["run"] == run]
            want = max(abs(sum(b <= v for b in base) / len(base) - sum(o <= v for o in own) / len(own)) for v in [*base, *own])
            assert got[run, feature] == pytest.approx(want, abs=1e-12)  # run None is a group


def test_a_level_the_reference_lacks_is_far_from_it(spark):
    data = [("reference", "a")] * 90 + [("reference", "b")] * 10 + [("current", "a")] * 10 + [("current", "z")] * 90
    rows = spark.createDataFrame(data, "set_data string, c string")
    found = D.specific_drift_mart(rows, ["c"], []).where("metric = 'distance'").first()
    assert found["value"] == pytest.approx(0.9)
    assert D.ks_drift(D.encoded(rows, ["c"]), ["c"]).first()["distance"] == pytest.approx(0.9)


def test_value_counts_of_awkward_frames(spark):
    empty = spark.createDataFrame([], "set_data string, c string, x double")
    assert V.value_counts(empty, ["c"], ["x"]).collect() == []
    assert D.specific_drift_mart(empty, ["c"], ["x"]).collect() == []
    only = spark.createDataFrame([("current", "a", 1.0), ("other", "b", 2.0)], "set_data string, c string, x double")
    counts = V.value_counts(only, ["c"], ["x"])
    assert counts.agg(F.sum("n")).first()[0] == 2
    assert {r["metric"] for r in D.specific_drift_mart(only, ["c"], ["x"]).collect()} >= {"exist_drift", "difference_mean"}


def test_the_rows_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = two_sides(spark, 5).where("NOT isnan(x) AND abs(x) < 1e9")
    n = rows.count()
    D.specific_drift_mart(rows.mapInPandas(passed, rows.schema), ["c"], ["x", "y"]).collect()
    assert seen.value == n


def test_performance_of_two_classes_and_listed_segments(spark):
    rng = random.Random(9)
    data = [(i % 3, rng.choice("uvw"), i % 2, round(rng.random(), 2), 1.0 + i) for i in range(300)]
    rows = spark.createDataFrame(data, "run int, segment string, target int, p1 double, kpi double")
    rows = rows.withColumn("p0", 1 - F.col("p1")).withColumn("prediction", (F.col("p1") > 0.5).cast("int"))
    spec = SPEC.with_(sub_cols=("p0", "p1"), segment_values=("u", "w"), cat_features=(), cont_features=())
    mart = S.performance_mart(written(S.cell_sums(rows, spec, ["run"]), "cells"), written(S.score_sums(rows, spec, ["run"]), "scores"), spec, ["run"])
    mart = written(mart, "mart")
    for run in range(3):
        alone = rows.where(F.col("run") == run).withColumn("set_analysis", F.lit("predict"))
        alone = equal_width_bands(alone, ["p0", "p1"])
        want = M.general_metric_mart(alone, spec)
        assert lines(mart.where(F.col("run") == run).drop("run"), want.columns) == lines(want, want.columns)


def test_independent_jobs_run_at_the_same_time(spark):
    meet = threading.Barrier(3, timeout=60)

    def job(n):
        meet.wait()
        return spark.range(n).count()

    assert together(spark, *[partial(job, n) for n in (1, 2, 3)]) == [1, 2, 3]
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1, lambda: 1 / 0)
