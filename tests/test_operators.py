"""Hand-made frames: ties, empty groups, hot keys, constants, gaps."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from driftwarden.functions import scalars as X
from driftwarden.functions import text as TX
from driftwarden.operators import columns as C
from driftwarden.operators import drift as D
from driftwarden.operators import encode as N
from driftwarden.operators.chain import encode_preprocess
from driftwarden.operators import metrics as M
from driftwarden.operators import ordering as O
from driftwarden.operators import profile as P
from driftwarden.operators import split as S
from driftwarden.operators import windows as W
from driftwarden.operators.joins import feedback_join
from driftwarden.operators.quantiles import bucket_of, exact_percentiles, value_cuts
from driftwarden.spec import ModelSpec

TWO = ModelSpec(id_features=("id",), cat_features=(), cont_features=("x",), sub_cols=("p0", "p1"))

# Ten parcels: late or not, "depot/van", weight and distance.
PARCELS = [(i % 3 == 0, f"depot {i % 2}/van {i}", 0.5 * i + 0.25, 12.0 - i) for i in range(10)]


def two_class(spark, rows):
    """rows: (target, p1, segment)"""
    data = [(i, t, 1 - p, p, 1 if p > 0.5 else 0, s, 1.0) for i, (t, p, s) in enumerate(rows)]
    return spark.createDataFrame(data, "id int, target int, p0 double, p1 double, prediction int, segment string, kpi double")


def brute_auc(rows):
    pos = [p for t, p, *_ in rows if t == 1]
    neg = [p for t, p, *_ in rows if t == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_counts_ties_half(spark):
    draw = random.Random(1)
    rows = [(draw.randint(0, 1), draw.choice([0.1, 0.2, 0.2, 0.5, 0.5, 0.5, 0.9]), "a") for _ in range(200)]
    got = M.metric_auc(two_class(spark, rows), TWO).first()[0]
    assert got == pytest.approx(brute_auc(rows))


def test_auc_over_many_distinct_scores(spark):
    draw = random.Random(2)
    rows = [(int(draw.random() < 0.3), draw.random() ** 4, "a") for _ in range(3000)]
    got = M.metric_auc(two_class(spark, rows), TWO).first()[0]
    assert got == pytest.approx(brute_auc(rows))


def test_auc_with_one_hot_score_and_all_tied(spark):
    hot = [(i % 3 == 0, 0.25, "a") for i in range(900)] + [(1, 0.7, "a"), (0, 0.1, "a")]
    hot = [(int(t), p, s) for t, p, s in hot]
    assert M.metric_auc(two_class(spark, hot), TWO).first()[0] == pytest.approx(brute_auc(hot))
    tied = [(i % 2, 0.5, "a") for i in range(10)]
    assert M.metric_auc(two_class(spark, tied), TWO).first()[0] == 0.5


def test_single_class_has_no_auc(spark):
    rows = [(1, 0.3, "a"), (1, 0.8, "a")]
    general = {r["metric"]: r["value"] for r in M.general_metrics(two_class(spark, rows), TWO, []).collect()}
    assert general["roc_auc_score"] is None and general["gini"] is None
    assert general["count"] == 2 and general["accuracy"] == 0.5


def test_log_loss_is_finite_at_zero_and_one(spark):
    rows = two_class(spark, [(1, 0.0, "a"), (1, 1.0, "a")])
    loss = M.metric_log_loss(rows, TWO).first()[0]
    assert loss == pytest.approx(-math.log(M.EPSILON) / 2, rel=1e-6)


def test_cutoffs_at_zero_and_one(spark):
    rows = two_class(spark, [(1, 1.0, "a"), (0, 0.0, "a"), (1, 0.5, "a")])
    lines = M.cutoff_metrics(rows, TWO, ["a", "missing"]).where("name_classes = 'p1'").collect()
    recall = {round(r["cutoff"], 6): r["value"] for r in lines if r["metric"] == "recall" and r["segment"] == "all"}
    assert len(recall) == M.N_CUTOFFS and recall[0.0] == 1.0 and recall[1.0] == 0.0
    ordered = [recall[k] for k in sorted(recall)]
    assert ordered == sorted(ordered, reverse=True)
    assert {r["segment"] for r in lines} == {"all", "a"}


def test_rates_complement(spark):
    draw = random.Random(3)
    rows = [(draw.randint(0, 1), draw.random(), draw.choice("ab")) for _ in range(100)]
    lines = M.class_confusion_metrics(two_class(spark, rows), TWO, ["a", "b"]).collect()
    value = {(r["segment"], r["name_classes"], r["metric"]): r["value"] for r in lines}
    for (s, c, m), v in value.items():
        if m == "true_positive_rate":
            assert v + value[(s, c, "false_negative_rate")] == pytest.approx(1)
            assert v == value[(s, c, "recall")]


def test_unpredicted_class_has_no_lines(spark):
    rows = two_class(spark, [(1, 0.9, "a"), (0, 0.8, "a")])
    assert {r["name_classes"] for r in M.class_confusion_metrics(rows, TWO, []).collect()} == {"p1"}


# ------------------------------------------------------------------- percentiles


@pytest.mark.parametrize("kind", ["even", "skewed", "few", "constant"])
def test_exact_percentiles_equal_numpy(spark, kind):
    draw = np.random.default_rng(4)
    values = {
        "even": draw.normal(size=5001),
        "skewed": np.concatenate([np.zeros(4000), draw.exponential(size=1999) ** 3]),
        "few": np.array([3.0, 1.0]),
        "constant": np.full(50, 7.5),
    }[kind]
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame([("f", float(v)) for v in values] + [("f", None), ("f", float("nan"))], "feature string, value double")
    got = {r["p"]: r["percentile"] for r in exact_percentiles(df, ["feature"], probs, accuracy=200).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.percentile(values, 100 * p))


# ------------------------------------------------------------- order, cuts, splits


def test_global_row_number_with_a_hot_period(spark):
    rows = [(i, 5 if i % 3 else i % 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, period int").repartition(7)
    numbered = {r["id"]: r["rn"] for r in O.global_row_number(df, ["period", "id"], "rn").collect()}
    expected = {i: n for n, (_, i) in enumerate(sorted((p, i) for i, p in rows), start=1)}
    assert numbered == expected


def test_hash_cut_is_exact_with_a_null_stratum(spark):
    rows = [(i, None if i % 10 == 0 else i % 3) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, label int")
    out = S.stratified_split(df, "id", "label", 0.33)
    counts = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for label in (None, 0, 1, 2):
        n = sum(1 for _, c in rows if c == label)
        assert counts[(label, "train")] == math.floor(n * 0.67)
        assert counts[(label, "train")] + counts[(label, "validation")] == n
    assert out.select("id").distinct().count() == 5000


@pytest.mark.parametrize("n", [0, 1, 17, 300, 1000])
def test_sample_cap_sizes(spark, n):
    df = spark.range(300)
    assert S.sample_cap(df, n, "id").count() == min(n, 300)


def test_splits_do_not_depend_on_partitions(spark):
    a = S.three_way_split(spark.range(1000).repartition(3), "id")
    b = S.three_way_split(spark.range(1000).repartition(11), "id")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {r["split"]: r["count"] for r in a.groupBy("split").count().collect()} == {"train": 600, "validation": 200, "test": 200}


def test_kfold_blocks(spark):
    folds = [r["fold"] for r in S.kfold(spark.range(11), ["id"], 3).orderBy("id").collect()]
    assert folds == [0] * 4 + [1] * 4 + [2] * 3
    small = [r["fold"] for r in S.kfold(spark.range(2), ["id"], 5).orderBy("id").collect()]
    assert small == [0, 1]
    series = [r["fold"] for r in S.timeseries_kfold(spark.range(10), ["id"], 3).orderBy("id").collect()]
    assert series == [-1, -1, -1, -1, 0, 0, 1, 1, 2, 2]


def test_undersample_keeps_all_positives(spark):
    df = spark.range(2000).withColumn("y", (F.col("id") % 50 == 0).cast("int"))
    out = S.undersample(df, "id", "y", 0.5)
    counts = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert counts[(1, "train")] == 20 and counts[(0, "train")] == 180
    assert counts[(1, "validation")] == 20 and counts[(0, "validation")] == 980


# ------------------------------------------------------------------ bands, series


def test_bands_on_edges_constants_and_gaps(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (5.0, 1.0), (10.0, 1.0), (None, 1.0)], "x double, c double")
    out = X.equal_width_bands(df, ["x", "c"]).collect()
    assert [r["x_cut"] for r in out] == ["P010", "P010", "P050", "P100", None]
    assert {r["c_cut"] for r in out} == {"P050"}


@pytest.mark.parametrize("n", [0, 1, 4, 5, 30])
def test_rolling_bands_against_slices(spark, n):
    values = [float((7 * i) % 11) for i in range(n)]
    if n > 10:
        values[n // 2] = 500.0
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "series string, t int, v double")
    got = {r["t"]: r for r in W.rolling_bands(df, ["series"], "t", "v").collect()}
    assert len(got) == n
    k = int(n * 0.2)
    for i in range(n):
        if k == 0:
            assert got[i]["upper"] is None and got[i]["anomaly"] is False
            continue
        window = values[max(0, i - k) : min(i + k, n)]
        upper = np.mean(window) + 2.5 * np.std(window)
        assert got[i]["upper"] == pytest.approx(upper)
        assert got[i]["anomaly"] == (values[i] > upper or values[i] < np.mean(window) - 2.5 * np.std(window))


# -------------------------------------------------------------------------- drift


def test_ks_against_brute_force(spark):
    draw = np.random.default_rng(5)
    a = np.concatenate([draw.normal(size=700), np.zeros(350)])
    b = np.concatenate([draw.normal(0.2, size=400), np.zeros(300)])
    rows = [("reference", float(v)) for v in a] + [("current", float(v)) for v in b] + [("current", None)]
    got = D.ks_drift(spark.createDataFrame(rows, "set_data string, x double"), ["x"]).first()
    points = np.unique(np.concatenate([a, b]))
    gaps = np.abs(np.searchsorted(np.sort(a), points, "right") / len(a) - np.searchsorted(np.sort(b), points, "right") / len(b))
    assert got["distance"] == pytest.approx(gaps.max())


def test_equal_sets_do_not_drift(spark):
    rows = [(s, float(i % 13), str(i % 4)) for s in ("reference", "current") for i in range(100)]
    df = spark.createDataFrame(rows, "set_data string, x double, c string")
    got = {r["feature"]: r for r in D.feature_drift_test(df, ["c"], ["x"]).collect()}
    assert got["x"]["statistic"] == pytest.approx(0) and got["x"]["p_value_drift"] == pytest.approx(1)
    assert got["c"]["statistic"] == pytest.approx(0, abs=1e-9) and got["c"]["exist_drift"] == 0


@pytest.mark.parametrize(("statistic", "freedom", "p"), [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (200.0, 3, 0.0)])
def test_chi_square_tail(statistic, freedom, p):
    assert D._upper_gamma(freedom / 2, statistic / 2) == pytest.approx(p, abs=1e-9)


def test_quality_profile_of_a_set_without_values(spark):
    rows = [("reference", 1.0, "a"), ("reference", float("nan"), "b"), ("current", None, "c"), ("current", None, None)]
    df = spark.createDataFrame(rows, "set_data string, x double, c string")
    got = {(r["set_data"], r["feature"]): r for r in P.data_quality_profile(df, ["c"], ["x"]).collect()}
    assert got[("current", "x")]["missing_count"] == 2 and got[("current", "x")]["percentile_50"] is None
    assert got[("reference", "x")]["missing_count"] == 1 and got[("reference", "x")]["mean"] == 1.0
    assert got[("current", "c")]["new_in_current_values_count"] == 1
    assert got[("current", "c")]["unused_in_current_values_count"] == 2


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert P.correlation_matrix(df, ["a", "b"]).first()["value"] is None


# ----------------------------------------------------------------------- encoders


def test_encoders_keep_missing_and_unseen_apart(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("NaN",)], "c string")
    later = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    fill = N.NullCategory(["c"])
    fitted = N.LabelEncode(["c"]).fit(fill.transform(train))
    codes = [r["c"] for r in fitted.transform(fill.transform(later)).collect()]
    assert sorted(codes) == [0, 0, 2]  # a, unseen -> a, missing_value


def test_segment_named_all_counts_once(spark):
    df = spark.createDataFrame([("all", 1), ("a", 2), ("b", 4)], "segment string, x int")
    got = M.grouping_all_and_segment(df, "segment", ["all", "a"], {"x": F.col("x")})
    assert {r["segment"]: r["x"] for r in got.collect()} == {"all": 7, "a": 2}


def test_pareto_keeps_missing_and_is_strict(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",)] * 1 + [("missing_value",)] * 1, "c string")
    out = {r["c"] for r in N.ParetoBucket(["c"], 0.8).fit(df).transform(df).collect()}
    assert out == {"OTROS", "missing_value"}  # the share of "a" is 0.8, which is not below 0.8


def test_multi_label_encode_refuses_unseen(spark):
    df = spark.createDataFrame([("a",)], "c string")
    fitted = N.MultiLabelEncode(["c"], handle_unknown=False).fit(df)
    with pytest.raises(Exception, match="unseen level"):
        fitted.transform(spark.createDataFrame([("b",)], "c string")).collect()


def test_one_hot_limits_levels(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="more than 5 levels"):
        N.OneHot(["c"], max_levels=5).fit(df)


def test_preprocessor_survives_saving(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("a", 5.0)], "c string, x double")
    for k, fit in enumerate((encode_preprocess, N.fit_stages)):
        fitted = fit(df, ["c"], ["x"], steps_cat=("null", "le"), steps_cont=("null", "ms"))
        fitted.save(str(tmp_path / f"pre{k}"))
        again = N.Preprocessor.load(str(tmp_path / f"pre{k}"))
        assert sorted(map(tuple, fitted.transform(df).collect())) == sorted(map(tuple, again.transform(df).collect()))


def test_chain_and_classifier_are_one_pipeline_for_spark_ml(spark, tmp_path):
    data = [("a", 1.0, 0), ("b", None, 1), ("a", 5.0, 0), (None, 2.0, 1), ("c", 9.0, 1)]
    df = spark.createDataFrame(data, "c string, x double, y int")
    for k, steps in enumerate((("null", "le"), ("null", "pareto", "ohe"))):
        fitted = N.fit_stages(df, ["c"], ["x"], steps_cat=steps, steps_cont=("null", "outlier", "ss"))
        assembler = VectorAssembler(inputCols=fitted.output_columns, outputCol="features")
        trees = DecisionTreeClassifier(labelCol="y").fit(assembler.transform(fitted.transform(df)))
        path = str(tmp_path / f"pipeline{k}")
        PipelineModel([fitted, assembler, trees]).save(path)
        again = PipelineModel.load(path)
        assert [s.uid for s in again.stages] == [fitted.uid, assembler.uid, trees.uid]
        assert again.stages[0].cont_features == ["x"] and again.stages[0].cat_features == fitted.cat_features
        one, two = (PipelineModel(m).transform(df).select("features", "prediction") for m in ([fitted, assembler, trees], again.stages))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_settings_of_a_stage_are_params(spark, tmp_path):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "c string")
    stage = N.ParetoBucket(["c"], 0.65)
    stage.save(str(tmp_path / "stage"))
    stage = N.ParetoBucket.load(str(tmp_path / "stage"))
    assert stage.getOrDefault("threshold") == 0.65 and stage.getInputCols() == ["c"]

    def levels(model):
        return {r["c"] for r in model.transform(df).collect()}

    # A grid sets other values without touching the stage itself.
    assert levels(stage.fit(df, {stage.threshold: 0.95})) == {"a", "b", "OTROS"}
    assert levels(stage.fit(df)) == {"a", "OTROS"}
    for other in (N.LabelEncode(["c"], "own"), N.Impute(["c"], "mean"), N.ClipOutliers(["c"], 2.0), N.OneHot(["c"], 7),
                  N.MultiLabelEncode(exclude=["z"], suffix="_x", handle_unknown=False)):
        path = str(tmp_path / type(other).__name__)
        other.save(path)
        again = type(other).load(path)
        assert {p.name: v for p, v in again.extractParamMap().items()} == {p.name: v for p, v in other.extractParamMap().items()}


# --------------------------------------------------------------- columns and joins


def test_example_rows(spark):
    rows = [(int(late), place, weight, km) for late, place, weight, km in PARCELS]
    df = spark.createDataFrame(rows, "late int, place string, weight double, km double")
    wide = C.split_to_columns(df, "place", ["depot", "van"], "/")
    assert {r["depot"] for r in wide.collect()} == {"depot 0", "depot 1"}
    out = C.interaction_features(wide, [("weight", "km")], "late")
    assert out.columns == ["target", "weight", "km", "weight_km"]
    assert out.first()["weight_km"] == pytest.approx(0.25 * 12)


def test_model_id_is_fifteen_digits():
    spec = TWO.with_(id_training="2024-01-01")
    assert len(C.model_id(spec)) == 15 and C.model_id(spec).isdigit()
    assert C.model_id(spec) != C.model_id(spec.with_(version="0.2.0"))


def test_feedback_join_drops_foreign_periods_only_in_the_fallback(spark):
    data = spark.createDataFrame([(1, "2020-01-01", 5.0)], "id int, periodo string, x double")
    hit = spark.createDataFrame([(1, "2020-01-01", 1)], "id int, periodo string, y int")
    miss = spark.createDataFrame([(1, "1999-01-01", 1)], "id int, periodo string, y int")
    for outcomes in (hit, miss):
        out = feedback_join(data, outcomes, ["id", "periodo"])
        assert [tuple(r) for r in out.select("id", "periodo", "x", "y").collect()] == [(1, "2020-01-01", 5.0, 1)]


def test_argmax_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(0.4, 0.4, 0.2), (0.1, 0.1, 0.8)], "a double, b double, c double")
    assert [r[0] for r in df.select(X.argmax_label(["a", "b", "c"])).collect()] == [0, 2]


# --------------------------------------------------------------------------- text


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("😀 [x] <b>Canción</b> (y) https://a.example.com/q?z=1 me@mail.com @me #tag abc123 “ñandú”", "cancion nandu"),
        ("Größe MÜLLER a.b", "groe muller b"),
        ("el la de the and", ""),
        ("   ", ""),
        (None, None),
    ],
)
def test_clean_text(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "t string")
    words = [w for w in TX.stop_words() if w != "b"]
    assert df.select(TX.clean_text(F.col("t"), words)).first()[0] == clean


def test_fast_patterns_remove_what_the_plain_ones_do(spark):
    draw = random.Random(6)
    alphabet = "ab1.@#&:/ -_?=é９\t\n"
    texts = [("".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40))),) for _ in range(2000)]
    df = spark.createDataFrame(texts, "t string")
    for plain, fast in TX._FAST.items():
        both = df.select("t", F.regexp_replace("t", plain, " ").alias("a"), F.regexp_replace("t", fast, " ").alias("b"))
        assert both.where("a <> b").head(3) == [], plain


def test_exact_forms_follow_python(spark):
    df = spark.createDataFrame([("ﬁn Ångström &eacute;&amp;<p>x</p>",)], "t string")
    folded, text = df.select(TX.fold_accents_exact("t"), TX.strip_html_exact("t")).first()
    assert folded == "fin Angstrom &eacute;&amp;<p>x</p>"
    assert text == "ﬁn Ångström é&x"


def test_cleaning_in_the_engine_equals_the_library(spark):
    draw = random.Random(8)
    bits = ["&eacute;", "&#233;", "&#xE9", "&amp;lt;", "&notit;", "&bogus;", "&#0;", "&#128;", "&#55296;", "&#99999999999999999999999;", "&#x1F600;", "&copyright", "& ", "&", "&;", "&#", "&#x;", "&#65534;", "&#11;", "ﬁ", "½", "Ĳ", "é", "e\u0301", "Å", "ﬃ", "№", "Ａ", "①", "日", "ab", " ", "&CounterClockwiseContourIntegral;", "&ampx", "<b>", "</b>"]
    texts = [("".join(draw.choice(bits) for _ in range(draw.randint(0, 12))),) for _ in range(1500)] + [(None,), ("",)]
    df = spark.createDataFrame(texts, "t string")
    plain = df.select("t", TX.fold_accents(F.col("t")).alias("a"), TX.fold_accents_exact("t").alias("b"))
    assert plain.where("NOT (a <=> b)").head(3) == []
    no_tags = df.withColumn("t", F.regexp_replace("t", "</?b>", " "))  # a reference cut by a tag is none for the parser
    both = no_tags.select("t", TX.strip_html(F.col("t")).alias("a"), TX.strip_html_exact("t").alias("b"))
    assert both.where("NOT (a <=> b)").head(3) == []
    words = ["ab"]
    whole = no_tags.select("t", TX.clean_text(F.col("t"), words).alias("a"), TX.clean_text(F.col("t"), words, exact=True).alias("b"))
    assert whole.where("NOT (a <=> b)").head(3) == []


def test_buckets_count_the_borders_below_by_halving(spark):
    values = [(float(v % 700), "a") for v in range(2000)] + [(5.0, "b")] * 3 + [(None, "b"), (float("inf"), "a"), (-1.5, "a")]
    df = spark.createDataFrame(values, "v double, g string")
    placed = df.join(value_cuts(df, ["g"], "v"), "g").withColumn("bucket", bucket_of("v"))
    flat = F.flatten("__fine")
    # Coarse borders lie between the fine ones of two neighbouring groups.
    want = F.size(F.filter("__coarse", lambda b: b < F.col("v"))) + F.size(F.filter(flat, lambda b: b < F.col("v")))
    assert placed.where(~F.col("bucket").eqNullSafe(want) & F.col("v").isNotNull()).count() == 0
    assert placed.where("v IS NULL").first()["bucket"] == 0
    assert placed._jdf.queryExecution().optimizedPlan().toString().count("filter(") == 0
