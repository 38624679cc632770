"""Feature encoders and scalers as ``pyspark.ml`` stages: fit on training rows, apply anywhere.

Numeric stages keep one small dictionary per column, so applying them is plain
column arithmetic. Categorical stages keep a table of levels, written to the
shared folder at fit time; Spark sees its real size and broadcasts it in the
lookup only when it is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import melt, melt_text, written
from driftwarden.operators.columns import clean_name
from driftwarden.operators.ordering import global_row_number
from driftwarden.operators.quantiles import exact_percentiles

MISSING = "missing_value"
OTHERS = "OTROS"
# Texts that stand for an absent category.
NULL_TEXTS = ("nan", "none", "nd", "nat")


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, n`` for every non-null level of the columns, in one pass."""
    long = melt_text(df, [], list(columns)).where(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(counts: DataFrame) -> dict[str, str]:
    """Most frequent level per feature, the smallest of equals."""
    best = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "value"))
    return {r["feature"]: r["value"] for r in counts.withColumn("rn", best).where("rn = 1").collect()}


def null_category(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull() | F.lower(text).isin(*NULL_TEXTS), MISSING).otherwise(text)


def cumulative_share(counts: DataFrame) -> DataFrame:
    """Running share of the levels of each feature, most frequent first, ties by value.

    Levels of equal frequency form a block. Blocks are few (their sizes sum to
    the row count), so running totals are taken over blocks and the place inside
    a block comes from the row's global position.
    """
    ordered = global_row_number(counts, ["feature", F.desc("n"), "value"], "__rank")
    blocks = ordered.groupBy("feature", "n").agg(F.min("__rank").alias("__start"), F.count(F.lit(1)).alias("__levels"))
    frame = Window.partitionBy("feature").orderBy(F.desc("n"))
    rows = F.col("n") * F.col("__levels")
    blocks = blocks.select(
        "feature",
        "n",
        "__start",
        (F.sum(rows).over(frame) - rows).alias("__before"),
        F.sum(rows).over(Window.partitionBy("feature")).alias("__total"),
    )
    running = F.col("__before") + (F.col("__rank") - F.col("__start") + 1) * F.col("n")
    # At most sqrt(2 * rows) different frequencies per feature: small enough to broadcast at any table size.
    return ordered.join(F.broadcast(blocks), ["feature", "n"]).select(
        "feature", "value", "n", (running / F.col("__total")).alias("cumulative_share")
    )


def level_codes(counts: DataFrame) -> DataFrame:
    """``feature, value, code``: the sorted levels of each feature numbered from 0."""
    ordered = global_row_number(counts.select("feature", "value"), ["feature", "value"], "__rank")
    starts = ordered.groupBy("feature").agg(F.min("__rank").alias("__start"))
    return ordered.join(F.broadcast(starts), "feature").select(  # one row per feature
        "feature", "value", (F.col("__rank") - F.col("__start")).alias("code")
    )


def attach_level(df: DataFrame, levels: DataFrame, column: str, wanted: str, name: str) -> DataFrame:
    """Look ``column`` up among the levels; ``name`` is NULL where it is not listed."""
    table = levels.where(F.col("feature") == column).select(
        F.col("value").alias("__value"), F.col(wanted).alias(name)
    )
    return df.join(table, F.col(f"`{column}`").cast("string") == F.col("__value"), "left").drop("__value")


# --------------------------------------------------------------------------- stages


class StageWriter(MLWriter):
    """Params and uid as Spark ML metadata; level table and inner stages in folders beside it."""

    def __init__(self, stage: "FittedStage"):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        levels, inner = self.stage.levels, self.stage.stages
        beside = {"levels": levels is not None, "stages": len(inner)}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=beside)
        if levels is not None:
            levels.write.parquet(f"{path}/levels")
        for i, stage in enumerate(inner):
            stage.write().session(self.sparkSession).save(f"{path}/stages/{i}")


class StageReader(MLReader):
    def __init__(self, kind: type["FittedStage"]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "FittedStage":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        if metadata["levels"]:
            stage.levels = self.sparkSession.read.parquet(f"{path}/levels")
        inner = range(metadata["stages"])
        stage.stages = [DefaultParamsReader.loadParamsInstance(f"{path}/stages/{i}", self.sparkSession) for i in inner]
        return stage


class FittedStage(Model, HasInputCols, MLReadable, MLWritable):
    """A fitted stage: its columns and a dictionary of scalars as Params, and possibly a level table.

    A ``PipelineModel`` of such stages is saved and loaded by Spark ML like any other.
    """

    scalars = Param(Params._dummy(), "scalars", "fitted numbers and settings by name")
    stages: Sequence["FittedStage"] = ()

    def __init__(self, columns: Sequence[str] = (), values: dict | None = None, levels: DataFrame | None = None):
        super().__init__()
        self._set(inputCols=list(columns), scalars=values or {})
        self.levels = levels

    @property
    def columns(self) -> list[str]:
        return self.getInputCols()

    @property
    def values(self) -> dict:
        return self.getOrDefault(self.scalars)

    @property
    def output_columns(self) -> list[str]:
        return self.columns

    def write(self) -> StageWriter:
        return StageWriter(self)

    @classmethod
    def read(cls) -> StageReader:
        return StageReader(cls)


class Passthrough(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df


class NullCategory(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: null_category(F.col(c)) for c in self.columns})


class ParetoBucketModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.columns:
            kept = F.col("__kept").isNotNull() | F.coalesce(F.col(c) == MISSING, F.lit(False))
            looked_up = attach_level(df, self.levels, c, "value", "__kept")
            df = looked_up.withColumn(c, F.when(kept, F.col(c)).otherwise(OTHERS)).drop("__kept")
        return df


class LabelEncodeModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        fallback = self.values["mode"]
        if self.values["unseen"] == "batch":
            fallback = modes(level_counts(df, self.columns))
        codes = self.values["codes"]
        for c in self.columns:
            df = attach_level(df, self.levels, c, "code", "__code")
            if self.values["unseen"] == "batch":
                default = codes.get(c, {}).get(fallback.get(c))
                if default is None:
                    default = _code_of(self.levels, c, fallback.get(c))
            else:
                default = codes[c]
            df = df.withColumn(c, F.coalesce("__code", F.lit(default)).cast("bigint")).drop("__code")
        return df


def _code_of(levels: DataFrame, feature: str, value: str | None) -> int | None:
    row = levels.where((F.col("feature") == feature) & (F.col("value") == value)).first()
    if row is None:
        row = levels.where((F.col("feature") == feature) & (F.col("value") == MISSING)).first()
    return None if row is None else row["code"]


class MultiLabelEncodeModel(FittedStage):
    @property
    def output_columns(self) -> list[str]:
        return [c + self.values["suffix"] for c in self.columns]

    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.columns:
            df = attach_level(df, self.levels, c, "code", "__code")
            code = F.col("__code").cast("double")
            if not self.values["handle_unknown"]:
                message = F.concat(F.lit(f"unseen level in {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
                code = F.when(code.isNull(), F.raise_error(message).cast("double")).otherwise(code)
            df = df.withColumn(c + self.values["suffix"], code).drop("__code")
        return df


class OneHotModel(FittedStage):
    @property
    def output_columns(self) -> list[str]:
        return [name for name, _, _ in self.values["dummies"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        flags = {}
        for name, column, value in self.values["dummies"]:
            hit = F.col(column).isNull() if value is None else F.col(column).cast("string") == value
            flags[name] = F.coalesce(hit, F.lit(False)).cast("int")
        return df.withColumns(flags).drop(*self.columns)


class LevelChain(FittedStage):
    """A composed chain of categorical steps: one lookup per column, a default for levels that are not listed."""

    def _transform(self, df: DataFrame) -> DataFrame:
        kind = self.values["type"]
        if self.values["fill"]:
            df = df.withColumns({c: null_category(F.col(f"`{c}`")) for c in self.columns})
        if not self.values["lookup"]:
            return df
        for c in self.columns:
            table = self.levels.where(F.col("feature") == c).select(F.col("value").alias("__value"), F.col("out").alias("__out"), F.lit(True).alias("__hit"))
            joined = df.join(table, F.col(f"`{c}`").cast("string") == F.col("__value"), "left")
            out = F.when(F.col("__hit"), F.col("__out")).otherwise(F.lit(self.values["default"].get(c)))
            df = joined.withColumn(c, out.cast(kind)).drop("__value", "__out", "__hit")
        return df


class CategoryTypeModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.columns:
            df = attach_level(df, self.levels, c, "value", "__kept")
            df = df.withColumn(c, F.coalesce("__kept", F.lit(self.values["mode"][c]))).drop("__kept")
        return df


class ImputeModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.values["fill"]
        return df.withColumns(
            {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(fills.get(c)).cast("double")) for c in self.columns}
        )


class ScaleModel(FittedStage):
    """(x - center) / width, with a width of zero read as one."""

    def _transform(self, df: DataFrame) -> DataFrame:
        center, width = self.values["center"], self.values["width"]
        return df.withColumns(
            {c: (F.col(c).cast("double") - F.lit(center[c])) / F.lit(width[c] or 1.0) for c in self.columns}
        )


class ClipOutliersModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        low, high = self.values["low"], self.values["high"]
        value = {c: F.col(c).cast("double") for c in self.columns}
        return df.withColumns(
            {c: F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(low[c])), F.lit(high[c]))) for c, v in value.items()}
        )


class _Stage(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, columns: Sequence[str] = (), **settings):
        super().__init__()
        self._set(inputCols=list(columns), **settings)

    @property
    def columns(self) -> list[str]:
        return self.getInputCols()


class ParetoBucket(_Stage):
    """Keep the frequent levels while their running share is below ``threshold``; the rest become one level."""

    threshold = Param(Params._dummy(), "threshold", "running share below which levels are kept", TypeConverters.toFloat)

    def __init__(self, columns: Sequence[str] = (), threshold: float = 0.8):
        super().__init__(columns, threshold=threshold)

    def _fit(self, df: DataFrame) -> ParetoBucketModel:
        threshold = self.getOrDefault(self.threshold)
        shares = cumulative_share(level_counts(df, self.columns))
        kept = shares.where(F.col("cumulative_share") < threshold).select("feature", "value")
        return ParetoBucketModel(self.columns, {"threshold": threshold}, written(kept, "pareto"))


class LabelEncode(_Stage):
    """Sorted training levels as 0..n-1; a level unseen in training takes the code of the most frequent one.

    ``unseen='training'`` uses the training mode, which makes a row's code
    independent of its neighbours; ``'batch'`` uses the mode of the rows given;
    ``'own'`` gives them the next free code.
    """

    unseen = Param(Params._dummy(), "unseen", "code of an unseen level: training, batch or own", TypeConverters.toString)

    def __init__(self, columns: Sequence[str] = (), unseen: str = "training"):
        super().__init__(columns, unseen=unseen)

    def _fit(self, df: DataFrame) -> LabelEncodeModel:
        unseen = self.getOrDefault(self.unseen)
        counts = written(level_counts(df, self.columns), "level-counts")  # the one pass over the rows
        common = modes(counts)
        levels = written(level_codes(counts), "codes")
        if unseen == "own":
            free = {r["feature"]: r["count"] for r in levels.groupBy("feature").count().collect()}  # one per column
            return LabelEncodeModel(self.columns, {"mode": common, "codes": {c: free.get(c, 0) for c in self.columns}, "unseen": "own"}, levels)
        listed = [F.col("feature").eqNullSafe(c) & F.col("value").eqNullSafe(v) for c, v in common.items()]
        condition = listed[0]
        for c in listed[1:]:
            condition = condition | c
        code = {r["feature"]: r["code"] for r in levels.where(condition).collect()}
        if unseen == "batch":
            codes = {c: {common[c]: code[c]} for c in common}
        else:
            codes = {c: code.get(c) for c in self.columns}
        return LabelEncodeModel(self.columns, {"mode": common, "codes": codes, "unseen": unseen}, levels)


class MultiLabelEncode(_Stage):
    """Label codes for many columns as double; nulls and unseen levels stay NULL. Without columns: all texts."""

    exclude = Param(Params._dummy(), "exclude", "columns left as they are", TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "added to the names of the coded columns", TypeConverters.toString)
    handleUnknown = Param(Params._dummy(), "handleUnknown", "unseen levels are allowed", TypeConverters.toBoolean)
    every = Param(Params._dummy(), "every", "all text columns instead of the named ones", TypeConverters.toBoolean)

    def __init__(
        self,
        columns: Sequence[str] | None = None,
        exclude: Sequence[str] = (),
        suffix: str = "",
        handle_unknown: bool = True,
    ):
        every = columns is None
        super().__init__(columns or (), exclude=list(exclude), suffix=suffix, handleUnknown=handle_unknown, every=every)

    def _fit(self, df: DataFrame) -> MultiLabelEncodeModel:
        chosen = [n for n, t in df.dtypes if t == "string"] if self.getOrDefault(self.every) else self.columns
        columns = [c for c in chosen if c not in self.getOrDefault(self.exclude)]
        levels = written(level_codes(level_counts(df, columns)), "codes")
        settings = {"suffix": self.getOrDefault(self.suffix), "handle_unknown": self.getOrDefault(self.handleUnknown)}
        return MultiLabelEncodeModel(columns, settings, levels)


def one_hot_of(counts: DataFrame, columns: Sequence[str]) -> OneHotModel:
    """The dummies of listed levels (``feature, value``) and one for NULL."""
    rows = counts.select("feature", "value").collect()  # max_levels per column
    dummies = []
    for c in columns:
        values = sorted(r["value"] for r in rows if r["feature"] == c)
        dummies += [(clean_name(f"{c}_ohe_{v}"), c, v) for v in values]
        dummies.append((clean_name(f"{c}_ohe_nan"), c, None))
    return OneHotModel(columns, {"dummies": dummies})


class OneHot(_Stage):
    """A 0/1 column per training level and one for NULL.

    Levels become columns of the schema, so their number is limited by
    ``max_levels`` per column and fitting fails beyond it; bucket first.
    """

    maxLevels = Param(Params._dummy(), "maxLevels", "most levels of a column", TypeConverters.toInt)

    def __init__(self, columns: Sequence[str] = (), max_levels: int = 1000):
        super().__init__(columns, maxLevels=max_levels)

    def _fit(self, df: DataFrame) -> OneHotModel:
        most = self.getOrDefault(self.maxLevels)
        counts = level_counts(df, self.columns)
        sizes = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
        if not sizes.where(F.col("n") > most).isEmpty():
            raise ValueError(f"more than {most} levels per column: bucket the levels before one-hot encoding")
        return one_hot_of(counts, self.columns)


class CategoryType(_Stage):
    """Keep training levels; anything else becomes the most frequent training level."""

    def _fit(self, df: DataFrame) -> CategoryTypeModel:
        counts = written(level_counts(df, self.columns), "level-counts")
        return CategoryTypeModel(self.columns, {"mode": modes(counts)}, counts.select("feature", "value"))


def percentiles_of(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float]]:
    """Exact percentiles per column; a few numbers per column reach the driver."""
    found: dict[str, dict[float, float]] = {c: {} for c in columns}
    long = melt(df, [], list(columns), "feature")
    for r in exact_percentiles(long, ["feature"], probs).collect():
        found[r["feature"]][r["p"]] = r["percentile"]
    return found


class Impute(_Stage):
    """Fill numeric gaps with the mean, the median or the most frequent value."""

    strategy = Param(Params._dummy(), "strategy", "mean, median or most_frequent", TypeConverters.toString)

    def __init__(self, columns: Sequence[str] = (), strategy: str = "median"):
        super().__init__(columns, strategy=strategy)
        if strategy not in ("mean", "median", "most_frequent"):
            raise ValueError(f"unknown strategy {strategy}")

    def _fit(self, df: DataFrame) -> ImputeModel:
        strategy = self.getOrDefault(self.strategy)
        if strategy == "mean":
            present = [F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in self.columns]
            fill = df.agg(*present).first().asDict()
        elif strategy == "median":
            fill = {c: v.get(0.5) for c, v in percentiles_of(df, self.columns, [0.5]).items()}
        else:
            long = melt(df, [], self.columns, "feature").where(F.col("value").isNotNull() & ~F.isnan("value"))
            counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
            fill = modes(counts)
        return ImputeModel(self.columns, {"fill": fill, "strategy": strategy})


class StandardScale(_Stage):
    """(x - mean) / population standard deviation."""

    def _fit(self, df: DataFrame) -> ScaleModel:
        row = df.agg(
            *[F.avg(c).alias(f"m_{c}") for c in self.columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in self.columns],
        ).first()
        return ScaleModel(
            self.columns,
            {"center": {c: row[f"m_{c}"] for c in self.columns}, "width": {c: row[f"s_{c}"] for c in self.columns}},
        )


class RobustScale(_Stage):
    """(x - median) / interquartile range."""

    def _fit(self, df: DataFrame) -> ScaleModel:
        # A column of NULLs only has no percentiles: it is left as it is, with width one.
        q = {c: v or {0.25: 0.0, 0.5: 0.0, 0.75: 1.0} for c, v in percentiles_of(df, self.columns, [0.25, 0.5, 0.75]).items()}
        return ScaleModel(
            self.columns,
            {"center": {c: q[c][0.5] for c in q}, "width": {c: q[c][0.75] - q[c][0.25] for c in q}},
        )


class MinMaxScale(_Stage):
    """(x - min) / (max - min)."""

    def _fit(self, df: DataFrame) -> ScaleModel:
        row = df.agg(
            *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in self.columns],
            *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in self.columns],
        ).first()
        low = {c: row[f"lo_{c}"] or 0.0 for c in self.columns}  # nothing but NULLs: left as they are
        return ScaleModel(self.columns, {"center": low, "width": {c: (row[f"hi_{c}"] or 0.0) - low[c] for c in self.columns}})


class ClipOutliers(_Stage):
    """Clamp to [Q1 - r*IQR, Q3 + r*IQR]."""

    outlierRange = Param(Params._dummy(), "outlierRange", "interquartile ranges beyond the quartiles that are kept", TypeConverters.toFloat)

    def __init__(self, columns: Sequence[str] = (), outlier_range: float = 1.5):
        super().__init__(columns, outlierRange=outlier_range)

    def _fit(self, df: DataFrame) -> ClipOutliersModel:
        q = {c: v or {0.25: 0.0, 0.75: 0.0} for c, v in percentiles_of(df, self.columns, [0.25, 0.75]).items()}
        reach = {c: self.getOrDefault(self.outlierRange) * (q[c][0.75] - q[c][0.25]) for c in q}
        return ClipOutliersModel(
            self.columns,
            {"low": {c: q[c][0.25] - reach[c] for c in q}, "high": {c: q[c][0.75] + reach[c] for c in q}},
        )


# Step names a configuration may list, and the defaults of their settings.
CATEGORICAL_STEPS = {
    "skip": lambda cols, k: Passthrough(cols),
    "null": lambda cols, k: NullCategory(cols),
    "pareto": lambda cols, k: ParetoBucket(cols, k["cat_pareto"]),
    "le": lambda cols, k: LabelEncode(cols),
    "ohe": lambda cols, k: OneHot(cols),
    "type": lambda cols, k: CategoryType(cols),
}
NUMERIC_STEPS = {
    "skip": lambda cols, k: Passthrough(cols),
    "null": lambda cols, k: Impute(cols, k["num_fill_null"]),
    "ss": lambda cols, k: StandardScale(cols),
    "rs": lambda cols, k: RobustScale(cols),
    "ms": lambda cols, k: MinMaxScale(cols),
    "outlier": lambda cols, k: ClipOutliers(cols, k["num_outlier_range"]),
}
DEFAULT_CONSTANTS = {"num_fill_null": "median", "cat_pareto": 0.8, "num_outlier_range": 1.5}


class Preprocessor(FittedStage):
    """Fitted chain of stages; its output features are the categorical, then the numeric ones."""

    catFeatures = Param(Params._dummy(), "catFeatures", "categorical output columns", TypeConverters.toListString)
    contFeatures = Param(Params._dummy(), "contFeatures", "numeric output columns", TypeConverters.toListString)

    def __init__(
        self, stages: Sequence[FittedStage] = (), cat_features: Sequence[str] = (), cont_features: Sequence[str] = ()
    ):
        super().__init__([*cat_features, *cont_features])
        self._set(catFeatures=list(cat_features), contFeatures=list(cont_features))
        self.stages = list(stages)

    @property
    def cat_features(self) -> list[str]:
        return self.getOrDefault(self.catFeatures)

    @property
    def cont_features(self) -> list[str]:
        return self.getOrDefault(self.contFeatures)

    @property
    def output_columns(self) -> list[str]:
        return [*self.cat_features, *self.cont_features]

    def _transform(self, df: DataFrame) -> DataFrame:
        for stage in self.stages:
            df = stage.transform(df)
        rest = [c for c in df.columns if c not in self.output_columns]
        return df.select(*rest, *self.output_columns)


def fit_stages(
    df: DataFrame,
    cat_features: Sequence[str],
    cont_features: Sequence[str],
    steps_cat: Sequence[str] = ("null", "pareto", "le"),
    steps_cont: Sequence[str] = ("skip",),
    constants: Mapping | None = None,
) -> Preprocessor:
    """Fit the configured steps one after the other, each on the rows as the steps before leave them.

    ``chain.encode_preprocess`` gives the same results from one pass over the rows.
    """
    settings = DEFAULT_CONSTANTS | dict(constants or {})
    stages: list[FittedStage] = []
    cat, cont = list(cat_features), list(cont_features)
    current = df
    for columns, names, registry in ((cat, steps_cat, CATEGORICAL_STEPS), (cont, steps_cont, NUMERIC_STEPS)):
        for name in names:
            if not columns:
                continue
            step = registry[name](columns, settings)
            fitted = step if isinstance(step, Transformer) else step.fit(current)
            stages.append(fitted)
            current = fitted.transform(current)
            if isinstance(fitted, OneHotModel):
                cat = fitted.output_columns
    return Preprocessor(stages, cat, cont)
