"""Training, attribution and saving."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from driftwarden.operators import explain as E
from driftwarden.operators import text_features as TF
from driftwarden.operators import training as T
from driftwarden.operators import wide_text as W
from driftwarden.plans import jobs
from driftwarden.spec import ModelSpec

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(7)
    n = 600
    a, b, c = draw.normal(size=n), draw.integers(0, 5, size=n), draw.random(n)
    y = ((a + 0.5 * b + draw.normal(scale=0.3, size=n)) > 1).astype(int)
    z = y + (c > 0.7)
    data = [tuple(map(float, r[:3])) + (int(r[3]), int(r[4]), i) for i, r in enumerate(zip(a, b, c, y, z))]
    return spark.createDataFrame(data, "a double, b double, c double, y int, z int, id int").checkpoint()


def test_attributions_add_up_to_the_boosted_margin(spark, rows):
    model = T.train_tabular(rows, FEATURES, "y", 2, {"n_estimators": 4, "max_depth": 3, "l_rate": 0.3})
    shap = T.tree_shap(model, rows, "id", FEATURES, ["q0", "q1"]).where("name_classes = 'q1'")
    totals = {r["id"]: r["s"] for r in shap.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    scored = model.transform(rows).withColumn("raw", vector_to_array("rawPrediction"))
    margins = {r["id"]: r["raw"][1] for r in scored.select("id", "raw").collect()}
    base = {round(margins[i] - totals[i], 9) for i in margins}
    assert len(base) == 1
    assert totals.keys() == margins.keys()


def test_forest_attributions_sum_to_zero_over_classes(spark, rows):
    model = T.train_tabular(rows, FEATURES, "z", 3, {"n_estimators": 3, "max_depth": 3})
    shap = T.tree_shap(model, rows, "id", FEATURES, ["q0", "q1", "q2"])
    over = shap.groupBy("id", "feature").agg(F.sum("value").alias("s")).agg(F.max(F.abs("s"))).first()[0]
    assert over == pytest.approx(0, abs=1e-9)
    scored = T.score(model, rows, ["q0", "q1", "q2"])
    sums = shap.groupBy("id", "name_classes").agg(F.sum("value").alias("s")).where("name_classes = 'q2'")
    base = scored.join(sums, "id").select((F.col("q2") - F.col("s")).alias("b")).agg(F.max("b") - F.min("b")).first()[0]
    assert base == pytest.approx(0, abs=1e-9)


def test_one_leaf_matches_all_coalitions():
    """Three features, two of them on one path, against the definition of the Shapley value."""
    leaf = T.Leaf(np.array([2.0]), [0, 2], [[("<=", 1.0, True)], [("<=", 0.0, False)]], np.array([0.3, 0.6]))
    x = np.array([[0.5, 9.0, 1.0], [2.0, 9.0, 1.0], [0.5, 9.0, -1.0]])
    got = T.leaf_attribution(x, [leaf])[:, :, 0]
    for row, g in zip(x, got):
        o = {0: float(row[0] <= 1.0), 2: float(row[2] > 0.0)}
        z = {0: 0.3, 2: 0.6}

        def v(known):
            return 2.0 * np.prod([o[f] if f in known else z[f] for f in (0, 2)])

        assert g[0] == pytest.approx(0.5 * (v({0}) - v(set())) + 0.5 * (v({0, 2}) - v({2})))
        assert g[2] == pytest.approx(0.5 * (v({2}) - v(set())) + 0.5 * (v({0, 2}) - v({0})))
        assert g[1] == 0


def test_importance_sums_to_one(spark, rows):
    model = T.train_tabular(rows, FEATURES, "y", 2, {"n_estimators": 3, "max_depth": 3})
    importance = T.gain_importance(model, spark, FEATURES).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1)
    assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)


def test_points_are_repeatable_and_in_range():
    assert T.random_points("LGB", 5, 1) == T.random_points("LGB", 5, 1)
    for p in T.random_points("XGB", 50, 2):
        assert 2 <= p["maxDepth"] <= 8 and 0.3 <= p["subsamplingRate"] <= 1.0


def test_text_model_learns(spark):
    good = [("muy buena atencion rapida", 1)] * 20
    bad = [("pesimo servicio lento", 0)] * 20
    df = spark.createDataFrame(good + bad, "t string, y int")
    model = T.train_text(df, "t", "y", max_iter=20)
    assert isinstance(model, PipelineModel)
    scored = T.score(model, df, ["p0", "p1"])
    assert scored.where("y = 1").agg(F.min("p1")).first()[0] > 0.5


def test_tuning_judges_on_the_named_rows(spark, rows):
    marked = rows.withColumn("held", F.col("id") % 4 == 0)
    model, study = T.tune(marked, FEATURES, "y", 2, "XGB", 2, {"n_estimators": 2}, validation="held")
    assert len(study.values) == 2 and all(v > 0 for v in study.values) and isinstance(model, PipelineModel)
    text = spark.createDataFrame(
        [("muy buena atencion", 1, i % 5 == 0) for i in range(20)] + [("pesimo servicio", 0, i % 5 == 0) for i in range(20)],
        "t string, y int, held boolean",
    )
    _, study = T.tune_text(text, "t", "y", "held", n_trials=2, max_iter=5)
    assert [set(p) for p in study.points] == [{"C"}, {"C"}]


def test_log_term_frequency_trains_and_reloads(spark, tmp_path):
    texts = [("uno uno uno dos", 1), ("dos tres", 0), ("uno tres tres", 1), ("", 0), (None, 0), ("dos dos", 0)]
    df = spark.createDataFrame([(i, t or "", y) for i, (t, y) in enumerate(texts)], "id int, t string, y int")
    model = T.train_text(df, "t", "y", max_iter=20, sublinear=True)
    model.save(str(tmp_path / "text"))
    again = PipelineModel.load(str(tmp_path / "text"))
    got = {(r["id"], r["token"]): r["weight"] for r in TF.term_weights(again, df, "id").collect()}
    want = {(r["id"], r["token"]): r["weight"] for r in TF.tfidf(df, "id", "t").collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    plain = {(r["id"], r["token"]): r["weight"] for r in TF.term_weights(T.train_text(df, "t", "y", max_iter=2), df, "id").collect()}
    assert plain[(0, "uno")] > got[(0, "uno")]
    scores = [T.score(m, df, ["q0", "q1"]).orderBy("id").select("q1").collect() for m in (model, again)]
    assert scores[0] == scores[1]


def test_log_term_frequency_of_dense_and_absent_vectors(spark):
    rows = [(0, Vectors.dense([0.0, 1.0, np.e])), (1, Vectors.sparse(3, {})), (2, None)]
    df = spark.createDataFrame(rows, T_.StructType().add("i", T_.IntegerType()).add("v", VectorUDT()))
    out = {r["i"]: r["w"] for r in TF.LogTermFrequency("v", "w").transform(df).collect()}
    assert out == {0: Vectors.sparse(3, {1: 1.0, 2: 2.0}), 1: Vectors.sparse(3, {}), 2: None}


def test_ordered_folds_train_on_earlier_rows_only(spark, rows):
    folded = rows.withColumn("fold_of", (F.col("id") % 4 - 1).cast("int"))
    models = T.cross_validate(folded, FEATURES, "y", 2, "fold_of", 3, {"n_estimators": 2}, ordered=True)
    scored = T.score_folds(models, folded, "fold_of", ["q0", "q1"], ordered=True)
    sizes = {r["fold"]: r["n"] for r in scored.where("split = 'training'").groupBy("fold").agg(F.count("id").alias("n")).collect()}
    per = {r["fold_of"]: r["count"] for r in folded.groupBy("fold_of").count().collect()}
    assert sizes == {i: sum(n for f, n in per.items() if f < i) for i in range(3)}


def test_train_and_reload(spark, rows, tmp_path):
    from driftwarden.sources.models import load_models, model_path

    spec = ModelSpec(
        id_features=("id", "periodo"), cat_features=("g",), cont_features=("a", "b", "c"), name_target="y",
        sub_cols=("q0", "q1"), segment="g", kpi_features=("c",), parameters={"n_estimators": 3, "max_depth": 2, "l_rate": 0.3},
    )
    table = rows.withColumns({"g": F.when(F.col("b") > 2, "hi").otherwise("lo"), "periodo": F.lit("2020-01-01")})
    trained = jobs.train_job(table, spec, {"preprocess": {"steps_cat": ("null", "le")}}, str(tmp_path))
    metrics = {(r["split"], r["metric"]): r["value"] for r in trained.fold_metrics.collect()}
    assert metrics[("training", "roc_auc_score")] > 0.8
    assert metrics[("validation", "gini")] == pytest.approx(2 * metrics[("validation", "roc_auc_score")] - 1)
    saved = load_models(spark, model_path(str(tmp_path), spec).rsplit("/", 1)[0])
    assert len(saved) == 1
    again = next(iter(saved.values()))
    assert again.spec == trained.spec
    first = T.score(again.model, again.preprocessor.transform(table), ["q0", "q1"]).count()
    assert first == 600


def test_attributions_as_arrays_have_the_same_sums(spark, rows):
    model = T.train_tabular(rows, FEATURES, "y", 2, {"n_estimators": 3, "max_depth": 3})
    tagged = rows.withColumn("segment", F.when(F.col("id") % 3 == 0, "u").when(F.col("id") % 3 == 1, "v"))
    wide = E.Attribution(T.tree_attribution(model, tagged, "id", FEATURES, ["q0", "q1"], ["segment"]), tuple(FEATURES))
    long = T.tree_shap(model, tagged, "id", FEATURES, ["q0", "q1"], ["segment"])
    assert wide.rows.count() * len(FEATURES) == long.count()
    spec = ModelSpec(id_features=("id",), cat_features=(), cont_features=tuple(FEATURES), sub_cols=("q0", "q1"))

    def lines(frame):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in frame.collect())

    assert lines(E.shap_summary(wide, spec, ["u"])) == lines(E.shap_summary(long, spec, ["u"]))
    best = E.best_features(T.gain_importance(model, spark, FEATURES), 2)
    assert lines(E.shap_individual(wide, "id", best)) == lines(E.shap_individual(long, "id", best))


def test_tokens_are_counted_inside_their_rows(spark):
    rows = [(1, "Ab ab cd"), (2, None), (3, ""), (None, "xx yy"), (None, "xx"), (1, "cd zz"), (4, "ab"), (5, "a")]
    counted = TF.token_counts(spark.createDataFrame(rows, "d int, t string"), "d", "t")
    got = {(r["d"], r["token"]): r["tf"] for r in counted.collect()}
    assert got == {(1, "ab"): 2, (1, "cd"): 2, (1, "zz"): 1, (None, "xx"): 2, (None, "yy"): 1, (4, "ab"): 1}
    assert counted.count() == len(got)
    # Only documents in several rows are grouped by token: a task keeps no table of all its documents' tokens.
    whole = counted._jdf.queryExecution().optimizedPlan()
    while "Union" not in whole.nodeName():
        whole = whole.children().head()
    plans = [whole.children().apply(i).toString() for i in range(whole.children().size())]
    grouped = [re.search(r"Aggregate \[d#\d+, token#", p) is not None for p in plans]
    assert sorted(grouped) == [False, True]


def test_damped_counts_of_a_batch_stay_arrow_arrays():
    kinds = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    batch = pa.array(
        [
            {"type": 1, "size": None, "indices": None, "values": [0.0, 1.0, np.e]},
            {"type": 0, "size": 9, "indices": [2, 5, 7], "values": [np.e, 0.0, 1.0]},
            None,
            {"type": 0, "size": 9, "indices": [], "values": []},
        ],
        kinds,
    )
    want = [
        {"type": 0, "size": 3, "indices": [1, 2], "values": [1.0, 2.0]},
        {"type": 0, "size": 9, "indices": [2, 7], "values": [2.0, 1.0]},
        None,
        {"type": 0, "size": 9, "indices": [], "values": []},
    ]
    assert TF._damped(batch).to_pylist() == want and TF._damped(batch[1:3]).to_pylist() == want[1:3]
    assert TF._damped(batch[:0]).to_pylist() == []


def test_vocabulary_beyond_the_driver_gives_the_same_text_model(spark, tmp_path, monkeypatch):
    draw = np.random.default_rng(5)
    likely = 1 / np.arange(1, 121)
    texts = [""]
    for i in range(1, 150):
        shares = likely * np.where(np.arange(120) % 3 == i % 3, 2.0, 1.0)
        texts.append(" ".join(draw.choice([f"w{k}" for k in range(120)], draw.integers(0, 30), p=shares / shares.sum())))
    df = spark.createDataFrame([(i, t, i % 3 if i % 5 else 0) for i, t in enumerate(texts)], "id int, t string, y int").repartition(3).checkpoint()
    settings = {"min_df": 2, "max_iter": 7, "sublinear": True}
    held = T.train_text(df, "t", "y", **settings)
    # Few tokens in a block and in a part, so that all of what is shared out has several pieces.
    for name, value in {"_BLOCK_TOKENS": 300, "_PART_COEFFICIENTS": 60}.items():
        monkeypatch.setattr(W, name, value)
    monkeypatch.setattr(T, "DRIVER_COEFFICIENTS", 0)
    wide = T.train_text(df, "t", "y", **settings)
    assert not any(hasattr(s, "vocabulary") or hasattr(s, "coefficientMatrix") for s in wide.stages)
    wide.save(str(tmp_path / "wide"))
    wide = PipelineModel.load(str(tmp_path / "wide"))
    last, (counter, regression) = wide.stages[-1], (held.stages[1], held.stages[-1])
    assert last.getOrDefault("objectiveHistory") == pytest.approx(list(regression.summary.objectiveHistory), abs=1e-12)
    assert last.getOrDefault("intercepts") == pytest.approx(list(regression.interceptVector.toArray()), abs=1e-9)
    got = {r["token"]: r["coefficients"] for r in last.terms.collect()}
    want = dict(zip(counter.vocabulary, regression.coefficientMatrix.toArray().T))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(list(want[k]), abs=1e-9) for k in want)

    def lines(model):
        scored = T.score(model, df, ["p0", "p1", "p2"]).join(model.transform(df).select("id", "prediction"), "id")
        return {r["id"]: tuple(r[c] for c in ("t", "y", "p0", "p1", "p2", "prediction")) for r in scored.collect()}

    a, b = lines(wide), lines(held)
    assert a.keys() == b.keys() and all(a[i][:2] == b[i][:2] and a[i][2:] == pytest.approx(b[i][2:], abs=1e-9) for i in b)
    weights = [{(r["id"], r["token"]): r["weight"] for r in TF.term_weights(m, df, "id").collect()} for m in (wide, held)]
    assert weights[0].keys() == weights[1].keys() and all(weights[0][k] == pytest.approx(v, abs=1e-12) for k, v in weights[1].items())


def test_wide_text_model_of_one_class_and_of_no_class(spark, monkeypatch):
    df = spark.createDataFrame([(0, "uno dos", 1), (1, "dos", 1), (2, "", 1)], "id int, t string, y int")
    held = T.score(T.train_text(df, "t", "y", max_iter=3), df, ["p0", "p1"]).orderBy("id").collect()
    monkeypatch.setattr(T, "DRIVER_COEFFICIENTS", 0)
    assert T.score(T.train_text(df, "t", "y", max_iter=3), df, ["p0", "p1"]).orderBy("id").collect() == held
    with pytest.raises(ValueError, match="1 labels"):
        T.train_text(df.withColumn("y", F.when(F.col("id") > 0, F.col("y"))), "t", "y", max_iter=3)
