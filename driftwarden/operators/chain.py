"""Preprocessing chains fitted on value counts: one pass over the rows, one lookup per categorical column.

Every categorical step maps levels to levels, so a chain of them is one map. It
is composed on the table of levels and their counts, which is all that fitting
needs, and rows are looked up once at the end. Two further lines per column are
carried through the steps without weight: a level that training never had, which
gives the chain's default, and the text for a missing category. Numeric steps
are fitted on the counts of distinct numbers in the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.common import written
from driftwarden.operators import value_counts as V
from driftwarden.operators.encode import (
    CATEGORICAL_STEPS,
    DEFAULT_CONSTANTS,
    MISSING,
    NUMERIC_STEPS,
    OTHERS,
    ClipOutliersModel,
    FittedStage,
    ImputeModel,
    LevelChain,
    OneHotModel,
    Preprocessor,
    ScaleModel,
    cumulative_share,
    level_codes,
    null_category,
    one_hot_of,
)

#: Most levels of a column that become columns of their own.
MAX_LEVELS = 1000


def _stats(table: DataFrame) -> DataFrame:
    """``feature, value, n`` of the levels that rows have."""
    return table.where("value IS NOT NULL").groupBy("feature", "value").agg(F.sum("n").alias("n")).where("n > 0")


def _modes(stats: DataFrame) -> DataFrame:
    """``feature, mode``: the most frequent level, the smallest of equals."""
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return stats.groupBy("feature").agg(best.alias("mode"))


def _step(table: DataFrame, name: str, settings: Mapping) -> DataFrame:
    """``table`` (feature, raw, value, n) with the values that a step gives."""
    if name == "skip":
        return table
    if name == "null":
        return table.withColumn("value", null_category(F.col("value")))
    stats = written(_stats(table), "level-counts")
    if name == "pareto":
        kept = cumulative_share(stats).where(F.col("cumulative_share") < settings["cat_pareto"]).select("feature", "value", F.lit(True).alias("kept"))
        joined = table.join(kept, ["feature", "value"], "left")
        stays = F.col("kept") | F.coalesce(F.col("value") == MISSING, F.lit(False))
        return joined.withColumn("value", F.when(stays, F.col("value")).otherwise(OTHERS)).drop("kept")
    joined = table.join(F.broadcast(_modes(stats)), "feature", "left")  # one row per column
    if name == "type":
        known = stats.select("feature", "value", F.lit(True).alias("known"))
        out = joined.join(known, ["feature", "value"], "left")
        return out.withColumn("value", F.when(F.col("known"), F.col("value")).otherwise(F.col("mode"))).drop("mode", "known")
    if name == "le":
        codes = written(level_codes(stats), "codes").select("feature", "value", F.col("code").cast("string").alias("code"))
        common = codes.withColumnsRenamed({"value": "mode", "code": "usual"})
        out = joined.join(codes, ["feature", "value"], "left").join(common, ["feature", "mode"], "left")
        return out.withColumn("value", F.coalesce("code", "usual")).drop("code", "usual", "mode")
    raise ValueError(f"unknown categorical step {name}")


def fit_levels(counts: DataFrame, columns: Sequence[str], steps: Sequence[str], settings: Mapping) -> list[FittedStage]:
    """The chain of ``steps`` over levels counted as ``feature, value, n``; a one-hot step ends it."""
    steps, ends = list(steps), []
    if "ohe" in steps:
        at = steps.index("ohe")
        if at != len(steps) - 1:
            raise ValueError("one-hot columns cannot be encoded further")
        steps, ends = steps[:at], ["ohe"]
    lead = 0
    while lead < len(steps) and steps[lead] in ("skip", "null"):
        lead += 1
    fill = "null" in steps[:lead]
    table = counts.select("feature", F.col("value").alias("raw"), "value", "n")
    if fill:
        filled = null_category(F.col("value"))
        table = table.select("feature", filled.alias("raw"), "n").groupBy("feature", "raw").agg(F.sum("n").alias("n"))
        table = table.select("feature", "raw", F.col("raw").alias("value"), "n")
    spark = counts.sparkSession
    # A level of its own that no row has, and the missing one where rows may come without it.
    extra = [(c, v, v, 0) for c in columns for v in ([None, MISSING] if fill else [None])]
    table = table.where("raw IS NOT NULL").unionByName(spark.createDataFrame(extra, "feature string, raw string, value string, n bigint"))
    table = table.groupBy("feature", "raw", "value").agg(F.sum("n").alias("n"))
    for name in steps[lead:]:
        table = _step(table, name, settings)
    lookup = any(s != "skip" for s in steps[lead:])
    table = written(table, "level-map")
    kind = "bigint" if "le" in steps else "string"
    default = {r["feature"]: r["value"] for r in table.where("raw IS NULL").collect()}  # one row per column
    levels = table.where("raw IS NOT NULL").select("feature", F.col("raw").alias("value"), F.col("value").alias("out"))
    stages: list[FittedStage] = [LevelChain(columns, {"fill": fill, "lookup": lookup, "default": default, "type": kind}, levels)]
    if ends:
        stats = _stats(table)
        sizes = stats.groupBy("feature").agg(F.count(F.lit(1)).alias("k"))
        if not sizes.where(F.col("k") > MAX_LEVELS).isEmpty():
            raise ValueError(f"more than {MAX_LEVELS} levels per column: bucket the levels before one-hot encoding")
        stages.append(one_hot_of(stats, columns))
    return stages


def _by_feature(values: Mapping[str, float | None]) -> Column:
    """The number of each line's feature."""
    pairs = [x for f, v in values.items() for x in (F.lit(f), F.lit(None if v is None else float(v)).cast("double"))]
    return F.create_map(*pairs)[F.col("feature")]


def _percentiles(counts: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, dict[float, float]]:
    found: dict[str, dict[float, float]] = {c: {} for c in columns}
    places = V.ranked(counts.withColumn("side", F.lit(V.CURRENT)))
    for r in V.percentiles(places, probs=probs).collect():  # a few numbers per column
        found[r["feature"]][r["p"]] = r["percentile"]
    return found


def _numeric_step(counts: DataFrame, columns: Sequence[str], name: str, settings: Mapping) -> tuple[FittedStage | None, DataFrame]:
    """A fitted step and ``counts`` (feature, number, n) as it leaves them."""
    number, n = F.col("number"), F.col("n")
    held = counts.where("number IS NOT NULL")
    if name == "skip":
        return None, counts
    if name == "null":
        strategy = settings["num_fill_null"]
        if strategy == "median":
            fill = {c: v.get(0.5) for c, v in _percentiles(held, columns, [0.5]).items()}
        else:
            best = F.min_by("number", F.struct(-n, number)) if strategy == "most_frequent" else F.sum(n * number) / F.sum("n")
            found = {r["feature"]: r["fill"] for r in held.groupBy("feature").agg(best.alias("fill")).collect()}
            fill = {c: found.get(c) for c in columns}
        return ImputeModel(columns, {"fill": fill, "strategy": strategy}), counts.withColumn("number", F.coalesce(number, _by_feature(fill)))
    if name == "outlier":
        quartiles = {c: v or {0.25: 0.0, 0.75: 0.0} for c, v in _percentiles(held, columns, [0.25, 0.75]).items()}
        reach = {c: settings["num_outlier_range"] * (q[0.75] - q[0.25]) for c, q in quartiles.items()}
        low, high = ({c: q[p] + s * reach[c] for c, q in quartiles.items()} for p, s in ((0.25, -1), (0.75, 1)))
        clipped = F.when(number.isNotNull(), F.least(F.greatest(number, _by_feature(low)), _by_feature(high)))
        return ClipOutliersModel(columns, {"low": low, "high": high}), counts.withColumn("number", clipped)
    if name == "rs":
        quartiles = {c: v or {0.25: 0.0, 0.5: 0.0, 0.75: 1.0} for c, v in _percentiles(held, columns, [0.25, 0.5, 0.75]).items()}
        center = {c: q[0.5] for c, q in quartiles.items()}
        width = {c: q[0.75] - q[0.25] for c, q in quartiles.items()}
    elif name == "ss":
        means = {r["feature"]: r["m"] for r in held.groupBy("feature").agg((F.sum(n * number) / F.sum("n")).alias("m")).collect()}
        center = {c: means.get(c) for c in columns}
        off = F.pow(number - _by_feature(center), 2)
        spread = held.groupBy("feature").agg(F.sqrt(F.sum(n * off) / F.sum("n")).alias("s"))
        found = {r["feature"]: r["s"] for r in spread.collect()}
        width = {c: found.get(c) for c in columns}
    elif name == "ms":
        ends = {r["feature"]: r for r in held.groupBy("feature").agg(F.min("number").alias("lo"), F.max("number").alias("hi")).collect()}
        center = {c: (ends[c]["lo"] if c in ends else 0.0) for c in columns}
        width = {c: (ends[c]["hi"] - ends[c]["lo"] if c in ends else 0.0) for c in columns}
    else:
        raise ValueError(f"unknown numeric step {name}")
    scaled = (number - _by_feature(center)) / _by_feature({c: w or 1.0 for c, w in width.items()})
    return ScaleModel(columns, {"center": center, "width": width}), counts.withColumn("number", scaled)


def encode_preprocess(
    df: DataFrame,
    cat_features: Sequence[str],
    cont_features: Sequence[str],
    steps_cat: Sequence[str] = ("null", "pareto", "le"),
    steps_cont: Sequence[str] = ("skip",),
    constants: Mapping | None = None,
) -> Preprocessor:
    """Fit the configured categorical and numeric steps on ``df``, which is read once.

    Same results as ``fit_stages``. Levels are compared as text, NaN counts as
    missing. A column of NULLs only is filled with nothing and scaled by one; an
    empty frame fits defaults of NULL.
    """
    unknown = [s for s in steps_cat if s not in CATEGORICAL_STEPS] + [s for s in steps_cont if s not in NUMERIC_STEPS]
    if unknown:
        raise ValueError(f"unknown steps {unknown}")
    settings = DEFAULT_CONSTANTS | dict(constants or {})
    cat, cont = list(cat_features), list(cont_features)
    fitted_cat = cat if any(s != "skip" for s in steps_cat) else []
    fitted_cont = cont if any(s != "skip" for s in steps_cont) else []
    stages: list[FittedStage] = []
    if fitted_cat or fitted_cont:
        marked = df.withColumn("__side", F.lit(V.CURRENT))
        counts = written(V.value_counts(marked, fitted_cat, fitted_cont, "__side"), "value-counts")
        if fitted_cat:
            levels = counts.where("kind = 'cat'").select("feature", "value", "n")
            stages += fit_levels(levels, cat, steps_cat, settings)
        numbers = counts.where("kind = 'num'").select("feature", "number", "n")
        for name in steps_cont if fitted_cont else ():
            stage, numbers = _numeric_step(numbers, cont, name, settings)
            if stage is not None:
                stages.append(stage)
    if stages and any(isinstance(s, OneHotModel) for s in stages):
        cat = next(s for s in stages if isinstance(s, OneHotModel)).output_columns
    return Preprocessor(stages, cat, cont)
