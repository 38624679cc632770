"""Training, tuning, scoring and attribution with Spark ML."""

from __future__ import annotations

import math
import random
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.common import melt, scratch_path, union_all
from driftwarden.operators import wide_text
from driftwarden.operators.explain import Attribution, long_form
from driftwarden.operators.folds import ROLES, VALIDATION
from driftwarden.operators.text_features import LogTermFrequency

# Send the helper functions themselves: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Defaults of a training.
DEFAULTS = {"seed": 60, "test_size": 0.33, "l_rate": 0.06, "n_estimators": 3000, "max_depth": 5}

# Fixed value: tokens times classes up to which a text model is held by the driver; its search holds some 25 numbers of each.
DRIVER_COEFFICIENTS = 1 << 18

# Searched ranges per model kind as (type, low, high, logarithmic).
SEARCH_SPACES = {
    "LGB": {
        "maxDepth": ("int", 3, 9, False),
        "maxBins": ("int", 2, 500, False),
        "minInstancesPerNode": ("int", 1, 10_000, False),
        "subsamplingRate": ("float", 0.1, 1.0, True),
    },
    "XGB": {
        "maxDepth": ("int", 2, 8, False),
        "maxBins": ("int", 2, 500, False),
        "subsamplingRate": ("float", 0.3, 1.0, True),
    },
    "CTB": {
        "maxDepth": ("int", 2, 6, False),
        "minInstancesPerNode": ("int", 1, 1_000, False),
        "subsamplingRate": ("float", 0.04, 1.0, False),
    },
    "RL": {"C": ("float", 1e-10, 1e3, True)},
}


def tabular_estimator(features: Sequence[str], label: str, n_classes: int, params: Mapping | None = None) -> Pipeline:
    """Boosted trees for two classes, a random forest for more (boosting is binary in Spark ML)."""
    p = dict(params or {})
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    common = {"labelCol": label, "featuresCol": "features", "seed": p.pop("seed", DEFAULTS["seed"])}
    rounds = p.pop("n_estimators", DEFAULTS["n_estimators"])
    common["maxDepth"] = p.pop("max_depth", DEFAULTS["max_depth"])
    validation = p.pop("validation", None)
    rate = p.pop("l_rate", DEFAULTS["l_rate"])
    if n_classes <= 2:
        classifier = GBTClassifier(maxIter=rounds, stepSize=rate, checkpointInterval=10, **common, **p)
        if validation:
            classifier = classifier.setValidationIndicatorCol(validation)
    else:
        classifier = RandomForestClassifier(numTrees=rounds, checkpointInterval=10, **common, **p)
    return Pipeline(stages=[assembler, classifier])


def train_tabular(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    n_classes: int,
    params: Mapping | None = None,
    validation: str | None = None,
) -> PipelineModel:
    """Fit on ``df``. ``validation`` names a boolean column whose rows only steer early stopping."""
    settings = dict(params or {})
    if validation and n_classes <= 2:
        settings["validation"] = validation
    elif validation:
        df = df.where(~F.col(validation))
    return tabular_estimator(features, label, n_classes, settings).fit(df)


def train_text(
    df: DataFrame,
    text: str,
    label: str,
    min_df: float = 1,
    use_idf: bool = True,
    max_iter: int = 100,
    c: float = 1.0,
    sublinear: bool = False,
) -> PipelineModel:
    """Token counts or 1 + ln(counts), idf + 1 weights, rows of length one, multinomial logistic regression.

    The features are those of ``text_features.tfidf``. ``c`` is the inverse penalty on the summed loss; Spark's penalty is on the mean loss.
    A vocabulary too large for the driver gives the same model with its tokens and coefficients in a table (``wide_text``).
    """
    tokenizer = wide_text.tokenizer(text)
    # Every token counts: the vocabulary is as large as the texts make it, not Spark's default.
    found = tokenizer.transform(df).select(F.explode("tokens").alias("token")).distinct().count()
    classes = (df.agg(F.max(F.col(label).cast("double"))).first()[0] or 0.0) + 1.0
    if found * classes > DRIVER_COEFFICIENTS:
        return PipelineModel([wide_text.fit(df, text, label, int(classes), min_df, use_idf, max_iter, c, sublinear)])
    counter = CountVectorizer(inputCol="tokens", outputCol="counts", minDF=min_df, vocabSize=max(found, 1))
    counting = Pipeline(stages=[tokenizer, counter]).fit(df)
    counted = counting.transform(df)
    idf = IDF(inputCol="counts", outputCol="weighted").fit(counted).idf.toArray()
    weights = Vectors.dense(idf + 1.0 if use_idf else np.ones_like(idf))
    frequency = [LogTermFrequency("counts", "frequencies")] if sublinear else []
    weigher = ElementwiseProduct(scalingVec=weights, inputCol="frequencies" if sublinear else "counts", outputCol="weighted")
    features = [*frequency, weigher, Normalizer(p=2.0, inputCol="weighted", outputCol="features")]
    vectors = PipelineModel(features).transform(counted).select("features", label)
    regression = LogisticRegression(
        labelCol=label, family="multinomial", maxIter=max_iter, regParam=1.0 / (c * vectors.count()), standardization=False
    )
    return PipelineModel([*counting.stages, *features, regression.fit(vectors)])


def classifier_of(model: PipelineModel):
    return model.stages[-1]


def score(model: PipelineModel, df: DataFrame, sub_cols: Sequence[str]) -> DataFrame:
    """``df`` with one probability column per class."""
    kept = df.columns
    probability = vector_to_array("probability")
    scored = model.transform(df).withColumn("__p", probability)
    return scored.select(*kept, *[F.col("__p")[i].alias(c) for i, c in enumerate(sub_cols)])


def gain_importance(model: PipelineModel, spark: SparkSession, features: Sequence[str], spread=None) -> DataFrame:
    """Importance per feature, descending; of a linear model |weight| x spread, the mean over classes."""
    last = classifier_of(model)
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        values = np.abs(last.coefficientMatrix.toArray()).mean(axis=0) * (1.0 if spread is None else np.asarray(spread))
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def training_history(model: PipelineModel, train: DataFrame, valid: DataFrame) -> DataFrame:
    """Loss per iteration for training and validation rows, long."""
    last = classifier_of(model)
    spark = train.sparkSession
    if hasattr(last, "evaluateEachIteration"):
        prepare = PipelineModel(model.stages[:-1])
        losses = [last.evaluateEachIteration(prepare.transform(side)) for side in (train, valid)]
        rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(*losses))]
        wide = spark.createDataFrame(rows, "iteration int, training double, validation double")
        return melt(wide, ["iteration"], ["training", "validation"])
    rows = [(i, float(v)) for i, v in enumerate(last.summary.objectiveHistory)]
    return melt(spark.createDataFrame(rows, "iteration int, training double"), ["iteration"], ["training"])


# ------------------------------------------------------------------------ tuning


def random_points(kind: str, n: int, seed: int) -> list[dict]:
    """``n`` repeatable random points of the search space of a model kind."""
    draw = random.Random(seed)
    points = []
    for _ in range(n):
        point = {}
        for name, (kind_of, low, high, logarithmic) in SEARCH_SPACES[kind].items():
            u = draw.random()
            value = math.exp(math.log(low) + u * (math.log(high) - math.log(low))) if logarithmic else low + u * (high - low)
            point[name] = int(round(value)) if kind_of == "int" else value
        points.append(point)
    return points


@dataclass
class Study:
    points: list[dict]
    values: list[float]

    @property
    def best(self) -> dict:
        return self.points[int(np.argmin(self.values))]


def tune(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    n_classes: int,
    kind: str = "LGB",
    n_trials: int = 5,
    params: Mapping | None = None,
    previous: Study | None = None,
    parallelism: int = 2,
    validation: str | None = None,
) -> tuple[PipelineModel, Study]:
    """Random search for the lowest validation log-loss; the best point of an earlier study goes first.

    ``validation`` names a boolean column whose rows are judged on and never
    trained on; without it the rows are split at random.
    """
    settings = DEFAULTS | dict(params or {})
    points = random_points(kind, n_trials - (previous is not None), settings["seed"])
    if previous is not None:
        points.insert(0, previous.best)
    estimator = tabular_estimator(
        features, label, n_classes, {k: settings[k] for k in ("seed", "l_rate", "n_estimators", "max_depth")}
    )
    classifier = estimator.getStages()[-1]
    grid = [{classifier.getParam(n): v for n, v in point.items()} for point in points]
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="logLoss")
    if validation is not None:
        train, judged = df.where(~F.col(validation)), df.where(F.col(validation))
        fits = [estimator.fit(train, setting) for setting in grid]
        losses = [float(judge.evaluate(m.transform(judged))) for m in fits]
        return fits[int(np.argmin(losses))], Study(points, losses)
    search = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=judge,
        trainRatio=1 - settings["test_size"],
        parallelism=parallelism,
        seed=settings["seed"],
    ).fit(df)
    return search.bestModel, Study(points, [float(v) for v in search.validationMetrics])


def tune_text(
    df: DataFrame,
    text: str,
    label: str,
    validation: str,
    n_trials: int = 5,
    seed: int = DEFAULTS["seed"],
    previous: Study | None = None,
    **settings,
) -> tuple[PipelineModel, Study]:
    """The text model's search: the penalty of its regression, judged by log-loss on the ``validation`` rows."""
    points = random_points("RL", n_trials - (previous is not None), seed)
    if previous is not None:
        points.insert(0, previous.best)
    train, judged = df.where(~F.col(validation)), df.where(F.col(validation))
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="logLoss")
    fits = [train_text(train, text, label, c=point["C"], **settings) for point in points]
    losses = [float(judge.evaluate(m.transform(judged))) for m in fits]
    return fits[int(np.argmin(losses))], Study(points, losses)


def trials_table(spark: SparkSession, study: Study | None) -> DataFrame:
    """Trials and their numeric parameters, long; one line of NULLs without a study."""
    schema = "trial int, state_trial string, value_trial double, parameter string, value double"
    if study is None:
        return spark.createDataFrame([(None,) * 5], schema)
    rows = [
        (i, "COMPLETE", value, f"params_{name}", float(setting))
        for i, (point, value) in enumerate(zip(study.points, study.values))
        for name, setting in point.items()
    ]
    return spark.createDataFrame(rows, schema)


def melt_trials(trials: DataFrame) -> DataFrame:
    """Wide trials (``number, value, state, params_*``) as one line per numeric parameter."""
    numeric = ("int", "bigint", "float", "double")
    parameters = [n for n, t in trials.dtypes if n.startswith("params_") and t in numeric]
    named = trials.select(
        F.col("number").alias("trial"), F.col("state").alias("state_trial"), F.col("value").alias("value_trial"), *parameters
    )
    return melt(named, ["trial", "state_trial", "value_trial"], parameters, "parameter")


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    n_classes: int,
    fold: str,
    n_folds: int,
    params: Mapping | None = None,
    ordered: bool = False,
) -> list[PipelineModel]:
    """One model per fold of the ``fold`` column, trained on the rows of the other folds.

    With ``ordered`` folds a model sees only the folds before its own, rows of
    fold -1 included, never a later one. The fold's own rows steer early
    stopping, as the validation rows of a single fit do.
    """
    models = []
    for i in range(n_folds):
        rows = df.where(F.col(fold) <= i) if ordered else df
        marked = rows.withColumn("__validation", F.col(fold) == i)
        models.append(train_tabular(marked, features, label, n_classes, params, "__validation"))
    return models


def score_folds(
    models: Sequence[PipelineModel], df: DataFrame, fold: str, sub_cols: Sequence[str], ordered: bool = False
) -> DataFrame:
    """Every model's scores on its own training and validation rows, tagged ``fold`` and ``split``."""
    parts = []
    for i, m in enumerate(models):
        side = F.when(F.col(fold) == i, "validation").otherwise("training")
        rows = df.where(F.col(fold) <= i) if ordered else df
        tagged = rows.withColumn("split", side).withColumn("fold_run", F.lit(i))
        parts.append(score(m, tagged, sub_cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop(*([fold] if fold in df.columns else [])).withColumnRenamed("fold_run", "fold")


def train_members(
    df: DataFrame, features: Sequence[str], label: str, n_classes: int, n_folds: int, params: Mapping | None = None
) -> list[PipelineModel]:
    """One model per fold from the roles of the rows: training rows fit, validation rows steer early stopping."""
    models = []
    for f in range(n_folds):
        role = F.get(ROLES, F.lit(f))
        rows = df.where(role.isNotNull()).withColumn("__validation", role == VALIDATION)
        models.append(train_tabular(rows, features, label, n_classes, params, "__validation"))
    return models


def score_members(models: Sequence[PipelineModel], df: DataFrame, sub_cols: Sequence[str]) -> DataFrame:
    """Every model's scores on the rows that have a role in its fold, tagged ``fold`` and ``split``."""
    parts = []
    for f, m in enumerate(models):
        role = F.get(ROLES, F.lit(f))
        rows = df.where(role.isNotNull()).withColumns({"split": role, "fold": F.lit(f)}).drop(ROLES)
        parts.append(score(m, rows, sub_cols))
    return union_all(parts)


# ------------------------------------------------------------------ tree attribution


@dataclass
class Leaf:
    """A leaf: its output per class, and per feature on its path the tests and the share of rows passing them."""

    value: np.ndarray
    features: list[int]
    tests: list[list[tuple[str, object, bool]]]
    shares: np.ndarray


def tree_leaves(model: PipelineModel, spark: SparkSession) -> list[Leaf]:
    """Leaves of a tree ensemble, read from its saved node table (size of the model, not of the data)."""
    last = classifier_of(model)
    path = scratch_path(spark, "trees")
    last.write().save(path)
    boosted = hasattr(last, "evaluateEachIteration")
    weights = last.treeWeights
    nodes: dict[tuple[int, int], object] = {
        (r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in spark.read.parquet(f"{path}/data").collect()
    }
    leaves: list[Leaf] = []

    def walk(tree: int, node, tests: dict[int, list], shares: dict[int, float]) -> None:
        if node["leftChild"] < 0:
            if boosted:
                out = node["prediction"] * weights[tree]
                value = np.array([-out, out])
            else:
                stats = np.array(node["impurityStats"])
                value = stats / stats.sum() / len(weights)
            order = list(tests)
            leaves.append(Leaf(value, order, [tests[f] for f in order], np.array([shares[f] for f in order])))
            return
        split = node["split"]
        f, bound = split["featureIndex"], split["leftCategoriesOrThreshold"]
        test = ("<=", bound[0]) if split["numCategories"] < 0 else ("in", tuple(bound))
        for child, goes_left in ((node["leftChild"], True), (node["rightChild"], False)):
            below = nodes[(tree, child)]
            walk(
                tree,
                below,
                tests | {f: [*tests.get(f, []), (*test, goes_left)]},
                shares | {f: shares.get(f, 1.0) * below["rawCount"] / node["rawCount"]},
            )

    for tree in sorted({t for t, _ in nodes}):
        walk(tree, nodes[(tree, 0)], {}, {})
    return leaves


def leaf_attribution(x: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Shapley values (rows x features x classes) of the sum of leaf outputs.

    For one leaf the game is a product over the features of its path: a known
    feature contributes whether the row passes its tests, an unknown one the
    share of training rows that do. The sum over coalitions is a polynomial in
    the coalition size, built feature by feature.
    """
    n_classes = len(leaves[0].value)
    out = np.zeros((*x.shape, n_classes))
    for leaf in leaves:
        m = len(leaf.features)
        if m == 0:
            continue
        passes = np.ones((x.shape[0], m))
        for j, (f, tests) in enumerate(zip(leaf.features, leaf.tests)):
            for kind, bound, goes_left in tests:
                left = x[:, f] <= bound if kind == "<=" else np.isin(x[:, f], bound)
                passes[:, j] *= left == goes_left
        weights = [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]
        for j, f in enumerate(leaf.features):
            by_size = np.zeros((x.shape[0], m))
            by_size[:, 0] = 1.0
            for k in range(m):
                if k != j:
                    known = np.roll(by_size, 1, axis=1) * passes[:, [k]]
                    known[:, 0] = 0.0
                    by_size = by_size * leaf.shares[k] + known
            share = (by_size @ weights) * (passes[:, j] - leaf.shares[j])
            out[:, f, :] += share[:, None] * leaf.value[None, :]
    return out


def tree_attribution(
    model: PipelineModel, df: DataFrame, row_id: str, features: Sequence[str], sub_cols: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Attribution of a tree ensemble's output: one line per row and class, with an array over the features.

    The leaves travel to the tasks with the function; the rows stay where they are.
    """
    names, classes, columns = list(features), list(sub_cols), [row_id, *keep]
    leaves = tree_leaves(model, df.sparkSession)

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = leaf_attribution(batch[names].to_numpy(dtype="float64"), leaves)
            for i, c in enumerate(classes):
                part = batch[columns].copy()
                part["name_classes"] = c
                part["shap"] = list(values[:, :, i])
                yield part

    source = df.select(*columns, *[F.col(f).cast("double").alias(f) for f in names])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*columns).schema.fields)
    return source.mapInPandas(attribute, f"{kept}, name_classes string, shap array<double>")


def tree_shap(
    model: PipelineModel, df: DataFrame, row_id: str, features: Sequence[str], sub_cols: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The same attributions with one line per row, feature and class."""
    return long_form(Attribution(tree_attribution(model, df, row_id, features, sub_cols, keep), tuple(features)))
