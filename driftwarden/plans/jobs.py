"""Batch jobs: train a model, evaluate or monitor it, predict, explore."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwarden.common import melt, melt_text, ratio, union_all, written
from driftwarden.functions.scalars import argmax_label
from driftwarden.operators import columns as C
from driftwarden.operators import drift as D
from driftwarden.operators import explain as E
from driftwarden.operators import folds as N
from driftwarden.operators import metrics as M
from driftwarden.operators import profile as P
from driftwarden.operators import split as S
from driftwarden.operators import training as T
from driftwarden.operators import value_counts as V
from driftwarden.operators.chain import encode_preprocess
from driftwarden.operators.encode import Preprocessor
from driftwarden.operators.joins import enrich_features, leakage_guard
from driftwarden.operators.quantiles import exact_percentiles
from driftwarden.operators.value_counts import same
from driftwarden.operators.windows import rolling_bands, select_features
from driftwarden.plans.periods import period_marts
from driftwarden.plans.scored import build_scored
from driftwarden.sources.marts import append_mart
from driftwarden.sources.models import SavedModel, save_model
from driftwarden.sources.resource_log import resource_usage
from driftwarden.spec import ModelSpec

# Which mart each table goes to.
MARTS = {
    "perf__general_metrics": "mg_perf__general_metrics",
    "feature__explainer_general": "mg_feature__explainer",
    "feature__explainer_individual": "mg_feature__explainer_individual",
    "feature__distribution": "mg_feature__distribution",
    "drift__general": "mg_features__drift_general",
    "drift__specific": "mg_features__drift_specific",
    "leaderboard": "mg_leaderboard",
    "perf__training_validation": "mg_perf_metadata_training_validation",
    "perf__hpo_trials": "mg_perf_metadata_hpo_trials",
    "metadata__constants": "mg_metadata_constants",
    "metadata__costs": "mg_metadata_modelo_costos",
}


# -------------------------------------------------------------------- leaderboard


def leaderboard(
    performance: DataFrame, general_drift: DataFrame, explainer: DataFrame, costs: DataFrame | None = None
) -> DataFrame:
    """One row per model run, picked out of its marts."""
    overall = F.col("type_metric") == "performance_by_all"

    def metric(name: str) -> Column:
        return F.avg(F.when(overall & (F.col("metric") == name), F.col("value"))).alias(name)

    names = ["log_loss", "accuracy", "roc_auc_score", "gini", "precision", "recall", "f1_score"]
    board = performance.agg(*[metric(n) for n in names])
    total = (
        (F.col("type_metric") == "explainer_by_all") & (F.col("metric") == "shap_abs") & (F.col("name_classes") == "all")
    )
    shares = explainer.where(total).agg(
        F.avg((F.col("value") > 0).cast("double")).alias("fi_shap_0"),
        F.avg((F.col("value") > 0.5).cast("double")).alias("fi_shap_0_5"),
    )
    # Each of these tables has exactly one row; its cells are read as scalar subqueries.
    cells = {c: shares.select(c).scalar() for c in ("fi_shap_0", "fi_shap_0_5")}
    for name, source in (
        ("feature_drift", "share_drifted_features"),
        ("target_drift", "real_drift"),
        ("prediction_drift", "prediction_drift"),
    ):
        cells[name] = general_drift.select(source).scalar()
    cells["kpi_mae"] = M.metric_kpi_mae(performance).scalar()
    usage = None if costs is None else resource_usage(costs)
    for name in ("cpu_usage_percent", "ram_usage_percent"):
        cells[name] = F.lit(None).cast("double") if usage is None else usage.select(name).scalar()
    return board.withColumns(cells)


def run_registry(runs: DataFrame, id_column: str, constants: str) -> DataFrame:
    """Constants of every model run, long: ``id_modelo, key, value``."""
    return runs.select(F.col(id_column).alias("id_modelo"), F.explode(constants).alias("key", "value"))


def compare_runs(registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run with the named constants as columns."""
    return registry.groupBy("id_modelo").pivot("key", list(keys)).agg(F.max("value"))


def spec_constants(spark: SparkSession, spec: ModelSpec) -> DataFrame:
    """The registry lines of one training."""
    values = {
        k: str(v) for k, v in {**vars(spec), **spec.parameters}.items() if k not in ("parameters", "hpo", "group")
    }
    one = spark.range(1).select(
        F.lit(C.model_id(spec)).alias("id_modelo"),
        F.create_map(*[F.lit(x) for kv in values.items() for x in kv]).alias("constants"),
    )
    return run_registry(one, "id_modelo", "constants")


# --------------------------------------------------------------------- governance


def governance_marts(
    scored: DataFrame,
    spec: ModelSpec,
    shap: DataFrame | E.Attribution,
    importance: DataFrame,
    numeric_features: Sequence[str],
    row_id: str,
    costs: DataFrame | None = None,
    coded: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every table of one evaluation of a scored frame (training rows and predicted rows).

    ``shap`` holds the attributions of the predicted rows with their segment;
    ``coded`` the predicted rows with encoded features, if they differ from
    ``scored``.
    """
    predict = scored.where(F.col("set_analysis") == "predict")
    values = M.segment_values(predict, spec)
    # The marts are small; those the leaderboard reads again are kept as tables.
    performance = written(M.general_metric_mart(scored, spec, values), "performance")
    association = P.linear_association(predict if coded is None else coded, spec, numeric_features, values)
    explainer = written(E.explainer_mart(E.shap_summary(shap, spec, values), association, importance, spec), "explainer")
    marts = {
        "perf__general_metrics": performance,
        "feature__explainer_general": explainer,
        "feature__explainer_individual": E.shap_individual(shap, row_id, E.best_features(importance)),
        **D.feature_drift_job(scored, spec),
    }
    marts["leaderboard"] = leaderboard(performance, marts["drift__general"], explainer, costs)
    return marts


@dataclass
class Training:
    """What a training run leaves behind."""

    spec: ModelSpec
    preprocessor: Preprocessor
    model: PipelineModel
    rows: DataFrame
    encoded: DataFrame
    fold_metrics: DataFrame
    importance: DataFrame
    history: DataFrame | None = None
    study: T.Study | None = None
    models: list[PipelineModel] = field(default_factory=list)


def default_period(df: DataFrame, period: str) -> DataFrame:
    """The period column, set to the first of the current month where the table has none."""
    if period in df.columns:
        return df.withColumn(period, F.col(period).cast("date"))
    return df.withColumn(period, F.trunc(F.current_date(), "MM"))


def prepare(df: DataFrame, spec: ModelSpec) -> DataFrame:
    return default_period(C.drop_duplicate_columns(C.sanitize_columns(df)), spec.period)


def split_rows(df: DataFrame, spec: ModelSpec, method: str, key: Sequence[str], test_size: float, seed: int) -> DataFrame:
    """``split`` column by the configured method; rows dropped by undersampling are gone."""
    order = [spec.period, *[k for k in key if k != spec.period]]
    if method == "stratified":
        return S.stratified_split(df, key, spec.name_target, test_size, seed)
    if method == "normal":
        return S.random_split(df, key, test_size, seed)
    if method == "undersampling":
        return S.undersample(df, key, spec.name_target, test_size, seed=seed).where("split <> 'dropped'")
    if method == "timeseries":
        return S.time_split(df, order, test_size)
    if method == "group":
        return S.group_split(df, F.month(spec.period))
    raise ValueError(f"unknown split method {method}")


def fold_roles(
    df: DataFrame, spec: ModelSpec, method: str, key: Sequence[str], k: int, guard: bool = False, c_min: float = 0.1, seed: int = S.SEED
) -> tuple[DataFrame, int]:
    """``df`` with a role per fold and row, and the number of folds.

    Undersampling thins the training negatives of every fold, the guard takes
    repeated ids and validation entities that train out of every fold.
    """
    order = [spec.period, *[c for c in key if c != spec.period]]
    if method in ("stratified", "undersampling"):
        folded = S.stratified_kfold(df, spec.name_target, order, k, "__own")
    elif method == "timeseries":
        folded = S.timeseries_kfold(df, order, k, "__own")
    elif method == "group":
        folded = S.group_kfold(df, F.month(spec.period), "__own")
        k = folded.agg(F.max("__own")).first()[0] + 1
    else:
        folded = S.kfold(df, order, k, "__own")
    out = N.with_roles(folded, "__own", k, method == "timeseries").drop("__own")
    if method == "undersampling":
        out = N.undersampled(written(out, "fold-roles"), key, spec.name_target, k, c_min, seed)
    if guard:
        entity = next(c for c in spec.id_features if c != spec.period)
        out = N.guarded(out, key, entity, [spec.period], k)
    return out, k


def train_job(
    df: DataFrame,
    spec: ModelSpec,
    steps: Mapping[str, Mapping] | None = None,
    root: str | None = None,
    keep: str = "first",
) -> Training:
    """Preprocess, select features, tune and train, as far as the steps ask for it; then save.

    ``steps`` may hold ``preprocess`` (steps_cat, steps_cont, constants),
    ``split`` (method, leakage_guard), ``feature_selection`` (mode, threshold),
    ``tuning`` (n_trials, kind) and ``training`` (n_folds). The prepared rows are
    written once, since every fit reads them many times. ``keep`` chooses the
    model of the first fold or the ``best`` one.
    """
    steps = {k: dict(v) for k, v in (steps or {}).items()}
    settings = T.DEFAULTS | dict(spec.parameters)
    spark = df.sparkSession
    key = list(spec.id_features)
    choice = steps.get("split", {})
    rows = prepare(df, spec)
    cut = split_rows(rows, spec, choice.get("method", "stratified"), key, settings["test_size"], settings["seed"])
    if choice.get("leakage_guard"):
        entity = next(c for c in spec.id_features if c != spec.period)
        sides = [cut.where(F.col("split") == s) for s in ("train", "validation")]
        # The hash of all other columns decides between rows of the same period.
        tie = F.xxhash64(*[F.col(c) for c in cut.columns])
        train, valid = leakage_guard(*[s.withColumn("__tie", tie) for s in sides], key, entity, [spec.period, "__tie"])
        train, valid = train.drop("__tie"), valid.drop("__tie")
        cut = train.unionByName(valid)
    rows = written(cut, "training-rows")

    pre = steps.get("preprocess", {})

    def preprocessed(cat: Sequence[str], cont: Sequence[str]) -> tuple[Preprocessor, DataFrame]:
        fitted = encode_preprocess(
            rows.where("split = 'train'"),
            cat,
            cont,
            pre.get("steps_cat", ("null", "pareto", "le")),
            pre.get("steps_cont", ("skip",)),
            pre.get("constants"),
        )
        coded = fitted.transform(rows).withColumn("validation", F.col("split") == "validation")
        return fitted, written(coded, "encoded-rows")

    params = {k: settings[k] for k in ("seed", "l_rate", "n_estimators", "max_depth")}

    def fit_folds(coded: DataFrame, features: Sequence[str], n_folds: int) -> tuple[list[PipelineModel], DataFrame]:
        if n_folds <= 2:
            model = T.train_tabular(coded, features, spec.name_target, spec.n_classes, params, "validation")
            scored = T.score(model, coded, spec.sub_cols).withColumns(
                {"fold": F.lit(0), "split": F.when(F.col("validation"), "validation").otherwise("training")}
            )
            return [model], scored
        method, guard = choice.get("method", "stratified"), bool(choice.get("leakage_guard"))
        folded, n = fold_roles(coded, spec, method, key, n_folds, guard, seed=settings["seed"])
        folded = written(folded, "folds")
        models = T.train_members(folded, features, spec.name_target, spec.n_classes, n, params)
        return models, T.score_members(models, folded, spec.sub_cols)

    fitted, coded = preprocessed(spec.cat_features, spec.cont_features)
    if "feature_selection" in steps:
        wanted = steps["feature_selection"]
        models, _ = fit_folds(coded, fitted.output_columns, wanted.get("n_folds", 5))
        per_fold = union_all([T.gain_importance(m, spark, fitted.output_columns) for m in models])
        mean = P.mean_fold_importance(per_fold)
        chosen = select_features(mean, wanted["mode"], wanted["threshold"], len(spec.features))
        names = {r["feature"].split("_ohe_")[0] for r in chosen.select("feature").collect()}
        spec = spec.with_(
            cat_features=tuple(c for c in spec.cat_features if c in names),
            cont_features=tuple(c for c in spec.cont_features if c in names),
        )
        fitted, coded = preprocessed(spec.cat_features, spec.cont_features)
    features = fitted.output_columns

    study = None
    if "tuning" in steps:
        wanted = steps["tuning"]
        _, study = T.tune(
            coded,
            features,
            spec.name_target,
            spec.n_classes,
            wanted.get("kind", "XGB"),
            wanted["n_trials"],
            params,
            validation="validation",
        )
        best = dict(study.best)
        params = params | {"max_depth": best.pop("maxDepth", params["max_depth"])} | best

    models, scored = fit_folds(coded, features, steps.get("training", {}).get("n_folds", 0))
    scored = written(scored.withColumn(spec.name_prediction, argmax_label(spec.sub_cols)), "fold-scores")
    folds = written(M.fold_metrics(scored, spec), "fold-metrics")
    model = models[0]
    if keep == "best" and len(models) > 1:
        losses = folds.where("metric = 'log_loss' AND split = 'validation'").orderBy("value")
        model = models[losses.first()["fold"]]
    history = None
    if hasattr(T.classifier_of(model), "evaluateEachIteration"):
        history = T.training_history(model, coded.where("NOT validation"), coded.where("validation"))
    result = Training(
        spec, fitted, model, rows, coded, folds, T.gain_importance(model, spark, features), history, study, models
    )
    if root is not None:
        save_model(SavedModel(model, fitted, spec), root)
    return result


def scored_sides(
    trained: Training | SavedModel, reference: DataFrame, current: DataFrame, spec: ModelSpec
) -> tuple[DataFrame, DataFrame]:
    """Both sides scored, as one written frame with the features as they came in, and the current rows encoded."""
    fitted, model = trained.preprocessor, trained.model
    features = fitted.output_columns
    sides = []
    for side in (reference, current):
        raw = prepare(side, spec).drop("split", "validation")
        named = raw.withColumns({f"__raw_{c}": F.col(c) for c in spec.features})
        sides.append(written(T.score(model, fitted.transform(named), spec.sub_cols), "scored-side"))

    def restored(side: DataFrame) -> DataFrame:
        """Scores with the features as they came in."""
        out = side.drop(*[f for f in features if f not in spec.id_features])
        return out.withColumnsRenamed({f"__raw_{c}": c for c in spec.features})

    scored = written(build_scored(restored(sides[0]), restored(sides[1]), spec), "scored")
    # Named fields: NULL ids and ids that hold a separator stay apart.
    key = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in spec.id_features]), {"ignoreNullFields": "false"})
    coded = sides[1].withColumn(ROW_ID, key)
    if spec.segment in spec.features:
        coded = coded.withColumn(spec.segment, F.col(f"__raw_{spec.segment}"))
    return scored, coded


#: Column that names a row in the individual attributions.
ROW_ID = "row_key"


def governance_run(
    trained: Training | SavedModel, reference: DataFrame, current: DataFrame, source: str, costs: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Score both sides, keep the scored rows as a table, and build every mart from it."""
    spec = trained.spec.with_(source=source)
    spark = reference.sparkSession
    features = trained.preprocessor.output_columns
    scored, coded = scored_sides(trained, reference, current, spec)
    values = M.segment_values(scored.where("set_analysis = 'predict'"), spec)
    spec = spec.with_(segment_values=tuple(values))
    numeric = [f for f in features if f != spec.segment]
    shap = E.Attribution(written(T.tree_attribution(trained.model, coded, ROW_ID, features, spec.sub_cols, [spec.segment]), "shap"), tuple(features))
    importance = T.gain_importance(trained.model, spark, features)
    marts = governance_marts(scored, spec, shap, importance, numeric, ROW_ID, costs, coded)
    if source == "training":
        marts["metadata__constants"] = spec_constants(spark, spec)
        marts["perf__hpo_trials"] = T.trials_table(spark, getattr(trained, "study", None))
        if getattr(trained, "history", None) is not None:
            marts["perf__training_validation"] = trained.history
        if costs is not None:
            marts["metadata__costs"] = costs
    return marts


def evaluate(trained: Training, costs: DataFrame | None = None) -> dict[str, DataFrame]:
    """Marts of the validation rows against the training rows."""
    train, valid = (trained.rows.where(F.col("split") == s) for s in ("train", "validation"))
    return governance_run(trained, train, valid, "training", costs)


def monitor(trained: Training | SavedModel, training_rows: DataFrame, production: DataFrame) -> dict[str, DataFrame]:
    """Marts of one production batch against the newest training period."""
    reference = C.latest_period(prepare(training_rows, trained.spec), trained.spec.period)
    return governance_run(trained, reference, production, "predict")


def period_run(trained: Training | SavedModel, reference: DataFrame, production: DataFrame) -> dict[str, DataFrame]:
    """The marts of every period of the production rows against one reference, in one pass over either."""
    spec = trained.spec.with_(source="predict")
    features = trained.preprocessor.output_columns
    scored, coded = scored_sides(trained, reference, production, spec)
    keep = list(dict.fromkeys([spec.segment, spec.period]))
    shap = E.Attribution(written(T.tree_attribution(trained.model, coded, ROW_ID, features, spec.sub_cols, keep), "shap"), tuple(features))
    numeric = [f for f in features if f != spec.segment]
    marts = period_marts(scored, spec, shap, numeric, coded)
    best = E.best_features(T.gain_importance(trained.model, reference.sparkSession, features))
    marts["feature__explainer_individual"] = E.shap_individual(shap, ROW_ID, best, by=[spec.period])
    return marts


def monitor_periods(
    trained: Training | SavedModel, training_rows: DataFrame, production: DataFrame, root: str, execution: str
) -> list[str]:
    """Monitor every period of the production table and store its marts; returns the periods.

    All periods are scored, summed and written together: the reference (the
    newest training period) is scored and counted once, and a repeated run
    replaces its lines.
    """
    spec = trained.spec.with_(source="predict")
    rows = prepare(production, spec)
    reference = C.latest_period(prepare(training_rows, spec), spec.period)
    marts = period_run(trained, reference, rows)
    named = {name: df.withColumnRenamed(spec.period, "periodo_execution_mg") for name, df in marts.items()}
    write_marts(named, spec, root, execution, None)
    return [str(r[spec.period]) for r in C.read_period_batches(rows, spec.period).collect()]


def write_marts(marts: Mapping[str, DataFrame], spec: ModelSpec, root: str, execution: str, period: str | None) -> list[str]:
    """Append each table to its mart; returns the paths written."""
    paths = [append_mart(df, MARTS[name], spec, root, execution, period) for name, df in marts.items()]
    return [p for p in paths if p is not None]


def predict_job(
    source: DataFrame,
    saved: Training | SavedModel,
    path: str,
    period: str,
    feature_refs: Sequence[str] = (),
    tables: Mapping[str, tuple[DataFrame, str]] | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Enrich, encode, score and store a batch below ``path``, one folder per period."""
    spec = saved.spec
    enriched = enrich_features(source, feature_refs, tables or {})
    keep = [*spec.id_features, *extra]
    scored = T.score(saved.model, saved.preprocessor.transform(enriched), spec.sub_cols)
    out = scored.select(*dict.fromkeys(c for c in keep if c in scored.columns), *spec.sub_cols)
    out = out.withColumn(spec.name_prediction, argmax_label(spec.sub_cols)).withColumn("period", F.lit(period))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    return source.sparkSession.read.parquet(path)


# --------------------------------------------------------------------- exploration

# How many levels the relative and the absolute charts show.
RELATIVE_LEVELS, ABSOLUTE_LEVELS = 10, 11
QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def level_counts_by_class(df: DataFrame, features: Sequence[str], label: str, k: int = ABSOLUTE_LEVELS) -> DataFrame:
    """Rows per class in the ``k`` largest levels of each feature, and the class shares inside each level."""
    counts = melt_text(df, [label], list(features)).where(F.col("value").isNotNull())
    counts = counts.groupBy("feature", "value", label).agg(F.count(F.lit(1)).alias("n"))
    levels = counts.groupBy("feature", "value").agg(F.sum("n").alias("total"))
    rank = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("total"), "value"))
    top = levels.withColumn("rank", rank).where(F.col("rank") <= k)
    joined = counts.join(F.broadcast(top), ["feature", "value"])  # k rows per feature
    return joined.select(
        "feature", F.col("value").alias("group_feature"), F.col(label).cast("string").alias("class"), "n",
        ratio(F.col("n"), F.col("total")).alias("share"),
    )


def numeric_summary(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Count, mean, deviation and quartiles per feature and class."""
    long = melt(df, [label], list(features), "feature")
    basics = long.groupBy("feature", label).agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    quantiles = exact_percentiles(long, ["feature", label], QUANTILES).groupBy("feature", label).agg(
        *[F.max(F.when(F.col("p") == q, F.col("percentile"))).alias(f"q{int(100 * q)}") for q in QUANTILES]
    )
    joined = basics.join(quantiles, ["feature", label])
    return joined.withColumn(label, F.col(label).cast("string")).withColumnRenamed(label, "class")


def kernel_densities(
    df: DataFrame, features: Sequence[str], label: str, points: int = 50, cut: float = 3.0
) -> DataFrame:
    """Gaussian density per feature and class on an even grid, with the usual n**(-1/5) bandwidth.

    The grid spans each class's range, ``cut`` bandwidths further on both sides,
    and classes weigh in with their share of the feature's rows. The rows are
    read once, into counts of distinct values for all features; each value then
    adds its bumps to all grid points at once. A class with one value or without
    spread has no density.
    """
    tagged = df.select(F.col(label).alias("class"), F.lit(V.CURRENT).alias("__side"), *[F.col(f"`{c}`").alias(f"__x{i}") for i, c in enumerate(features)])
    counts = V.value_counts(tagged, [], [f"__x{i}" for i in range(len(features))], "__side", ["class"]).where("number IS NOT NULL")
    counts = written(counts.select("class", "feature", "number", "n"), "value-counts")
    n, x = F.col("n"), F.col("number")
    shape = counts.groupBy("feature", "class").agg(
        F.sum("n").alias("rows"), F.min("number").alias("lo"), F.max("number").alias("hi"), (F.sum(n * x) / F.sum("n")).alias("mean")
    )
    shape = written(shape.withColumn("total", F.sum("rows").over(Window.partitionBy("feature"))), "value-shape")  # features x classes
    keys = ["feature", "class"]
    off = counts.alias("v").join(F.broadcast(shape).alias("s"), same("v", "s", keys))
    spread = off.groupBy("v.feature", "v.class").agg(F.sqrt(F.try_divide(F.sum(n * F.pow(x - F.col("mean"), 2)), F.sum("n") - 1)).alias("s"))
    wide = shape.alias("a").join(F.broadcast(spread).alias("b"), same("a", "b", keys)).select("a.*", "b.s")
    wide = wide.withColumn("h", F.col("s") * F.pow(F.col("rows").cast("double"), F.lit(-0.2))).where("h > 0")
    wide = wide.withColumns({"lo": F.col("lo") - cut * F.col("h"), "hi": F.col("hi") + cut * F.col("h")})
    joined = counts.alias("v").join(F.broadcast(wide).alias("s"), same("v", "s", keys))
    grid = [F.col("lo") + (F.col("hi") - F.col("lo")) * F.lit(i / (points - 1)) for i in range(points)]
    bumps = [F.sum(n * F.exp(-0.5 * F.pow((g - x) / F.col("h"), F.lit(2)))).alias(f"d{i}") for i, g in enumerate(grid)]
    sums = joined.groupBy(F.col("v.feature").alias("feature"), F.col("v.class").alias("class"), "lo", "hi", "h", "total").agg(*bumps)
    norm = F.col("total") * F.col("h") * F.lit(2.5066282746310002)  # sqrt(2 pi)
    cells = F.array(*[F.struct(g.alias("x"), (F.col(f"d{i}") / norm).alias("density")) for i, g in enumerate(grid)])
    names = F.array(*[F.lit(f) for f in features])
    name = F.get(names, F.substring("feature", F.lit(4), F.length("feature")).cast("int")).alias("feature")
    return sums.select(name, F.col("class").cast("string").alias("class"), F.inline(cells))


def kernel_density(df: DataFrame, feature: str, label: str, points: int = 50, cut: float = 3.0) -> DataFrame:
    """The densities of one feature."""
    return kernel_densities(df, [feature], label, points, cut).drop("feature")


def eda_tables(df: DataFrame, spec: ModelSpec, label: str, window_pct: float = 0.2) -> dict[str, DataFrame]:
    """The data behind the exploration charts of one label (set, target or prediction)."""
    series = [
        P.period_aggregate(df, label, spec.period, f, f in spec.cat_features)
        .withColumn("feature", F.lit(f))
        .withColumn("class", F.col("class").cast("string"))
        for f in spec.features
    ]
    bands = rolling_bands(union_all(series), ["feature", "class"], spec.period, "value", window_pct)
    tables = {"timeseries": bands}
    if spec.cont_features:
        tables["correlation"] = P.correlation_matrix(df, spec.cont_features)
        tables["numeric_summary"] = numeric_summary(df, spec.cont_features, label)
        tables["density"] = kernel_densities(df, spec.cont_features, label)
    if spec.cat_features:
        tables["levels"] = level_counts_by_class(df, spec.cat_features, label)
    return tables
