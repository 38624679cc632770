"""Reference-versus-current tests, histograms and drift tables."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwarden.common import melt, melt_text, ratio, union_all, written
from driftwarden.functions.scalars import band_number
from driftwarden.operators import value_counts as V
from driftwarden.operators.encode import LabelEncode, null_category
from driftwarden.operators.profile import DELTA_METRICS, data_distribution_mart, data_quality_delta, data_quality_profile
from driftwarden.operators.quantiles import bucket_of, value_cuts
from driftwarden.operators.value_counts import same
from driftwarden.spec import ModelSpec

# Send the helper functions themselves: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

N_BINS = 10
_SERIES_TERMS = 100


def kolmogorov_p(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic p-value of a two-sample distance (alternating exponential series)."""
    reach = distance * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * reach * reach),
    )
    return F.when(reach < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function (series below a+1, continued fraction above)."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * scale)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, scale * h)


@F.pandas_udf(T.DoubleType())
def chi_square_p(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """Survival function of the chi-square distribution; one value per feature."""
    return pd.Series(
        [None if pd.isna(s) or f < 1 else _upper_gamma(f / 2.0, s / 2.0) for s, f in zip(statistic, freedom)],
        dtype="float64",
    )


def numeric_long(df: DataFrame, features: Sequence[str], set_column: str) -> DataFrame:
    long = melt(df, [set_column], list(features), "feature")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def ks_drift(
    df: DataFrame, features: Sequence[str], set_column: str = "set_data", significance: float = 0.01
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per numeric feature.

    Values shrink to counts per distinct value. Inside evenly filled value
    buckets the running difference of the two distributions is taken; a bucket
    contributes only its largest and smallest difference, shifted by what lies
    below it, so the final step works on at most a thousand rows per feature.
    """
    long = numeric_long(df, features, set_column)
    is_reference, is_current = (F.col(set_column) == s for s in ("reference", "current"))
    counts = long.groupBy("feature", "value").agg(
        F.count_if(is_reference).alias("r"), F.count_if(is_current).alias("c")
    )
    sizes = long.groupBy("feature").agg(F.count_if(is_reference).alias("n"), F.count_if(is_current).alias("m"))
    cuts = value_cuts(long, ["feature"], "value")
    per_feature = sizes.join(F.broadcast(cuts), "feature")  # one row per feature
    placed = counts.join(F.broadcast(per_feature), "feature").withColumn("__bucket", bucket_of("value"))
    frame = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy("feature", "__bucket").orderBy("value").rowsBetween(*frame)
    buckets = (
        placed.withColumn("run", ratio(F.sum("r").over(inside), F.col("n")) - ratio(F.sum("c").over(inside), F.col("m")))
        .groupBy("feature", "__bucket")
        .agg(
            F.max("run").alias("high"),
            F.min("run").alias("low"),
            F.sum("r").alias("r"),
            F.sum("c").alias("c"),
            F.first("n").alias("n"),
            F.first("m").alias("m"),
        )
    )
    before = Window.partitionBy("feature").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Counts are carried as whole numbers and divided once.
    earlier = [F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("r", "c")]
    base = ratio(earlier[0], F.col("n")) - ratio(earlier[1], F.col("m"))
    shifted = buckets.withColumn("base", base).select(
        "feature",
        "n",
        "m",
        F.greatest(F.abs(F.col("base") + F.col("high")), F.abs(F.col("base") + F.col("low"))).alias("gap"),
    )
    distance = shifted.groupBy("feature", "n", "m").agg(F.max("gap").alias("distance"))
    p = kolmogorov_p(F.col("distance"), F.col("n").cast("double"), F.col("m").cast("double"))
    tested = distance.select("feature", "distance", p.alias("p_val_distance"))
    return tested.withColumn("is_drift", (F.col("p_val_distance") < significance).cast("int"))


def chi_square_drift(df: DataFrame, features: Sequence[str], set_column: str = "set_data") -> DataFrame:
    """Chi-square statistic of homogeneity between the two sets, per categorical feature."""
    long = melt_text(df, [set_column], list(features)).where(F.col("value").isNotNull())
    levels = long.groupBy("feature", "value").agg(
        F.count_if(F.col(set_column) == "reference").cast("double").alias("r"),
        F.count_if(F.col(set_column) == "current").cast("double").alias("c"),
    )
    # The statistic in one pass over the levels: N * (sum of r^2/(R*k) + c^2/(C*k)) - N, with k = r + c.
    k = F.col("r") + F.col("c")
    sums = levels.groupBy("feature").agg(
        F.sum("r").alias("R"),
        F.sum("c").alias("C"),
        F.sum(F.col("r") * F.col("r") / k).alias("rr"),
        F.sum(F.col("c") * F.col("c") / k).alias("cc"),
        F.count(F.lit(1)).alias("levels"),
    )
    total = F.col("R") + F.col("C")
    statistic = total * (ratio(F.col("rr"), F.col("R")) + ratio(F.col("cc"), F.col("C")) - 1)
    return sums.select(
        "feature", F.greatest(statistic, F.lit(0.0)).alias("statistic"), (F.col("levels") - 1).alias("freedom")
    )


def feature_drift_test(
    df: DataFrame,
    cat_features: Sequence[str],
    cont_features: Sequence[str],
    set_column: str = "set_data",
    confidence: float = 0.95,
    distances: DataFrame | None = None,
) -> DataFrame:
    """Statistic and p-value per feature: Kolmogorov-Smirnov for numbers, chi-square for categories.

    ``distances`` are the results of :func:`ks_drift`, if they are already known.
    """
    parts = []
    if cont_features:
        if distances is None:
            ks = ks_drift(df, cont_features, set_column)
        else:
            ks = distances.where(F.col("feature").isin(*cont_features))
        parts.append(
            ks.select(
                "feature",
                F.lit("num").alias("feature_type"),
                F.col("distance").alias("statistic"),
                F.col("p_val_distance").alias("p_value_drift"),
            )
        )
    if cat_features:
        chi = chi_square_drift(df, cat_features, set_column)
        parts.append(
            chi.select(
                "feature",
                F.lit("cat").alias("feature_type"),
                "statistic",
                chi_square_p(F.col("statistic"), F.col("freedom").cast("double")).alias("p_value_drift"),
            )
        )
    return union_all(parts).withColumn(
        "exist_drift", F.coalesce(F.col("p_value_drift") < F.lit(1.0 - confidence), F.lit(False)).cast("int")
    )


def target_prediction_drift(df: DataFrame, spec: ModelSpec, set_column: str = "set_data") -> DataFrame:
    """The categorical test on label and prediction; NULL for a column that is absent."""
    present = [c for c in (spec.name_target, spec.name_prediction) if c in df.columns]
    if not present:
        return df.limit(0).select(F.lit(None).cast("double").alias("real_drift")).agg(
            F.max("real_drift").alias("real_drift"), F.max("real_drift").alias("prediction_drift")
        )
    tested = feature_drift_test(df, present, [], set_column)

    def of(column: str) -> Column:
        return F.max(F.when(F.col("feature") == column, F.col("p_value_drift")))

    return tested.agg(of(spec.name_target).alias("real_drift"), of(spec.name_prediction).alias("prediction_drift"))


def feature_histograms(
    df: DataFrame, features: Sequence[str], set_column: str = "set_data", bins: int = N_BINS
) -> DataFrame:
    """Rows per feature, set and shared equal-width bin (0..bins-1), empty bins included, with the bin's edges."""
    long = numeric_long(df, features, set_column)
    limits = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    placed = long.join(F.broadcast(limits), "feature")  # one row per feature
    number = band_number(F.col("value"), F.col("lo"), F.col("hi"), bins) - 1
    counts = placed.groupBy("feature", set_column, "lo", "hi", number.alias("own")).agg(F.count(F.lit(1)).alias("n"))
    spread = counts.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (
        spread.groupBy("feature", set_column, "lo", "hi", "bin")
        .agg(F.sum(F.when(F.col("own") == F.col("bin"), F.col("n")).otherwise(0)).alias("n"))
        .select(
            "feature",
            set_column,
            "bin",
            "n",
            (F.col("lo") + F.col("bin") * width).alias("edge_low"),
            (F.col("lo") + (F.col("bin") + 1) * width).alias("edge_high"),
        )
    )


def histogram_arrays(histogram: DataFrame, set_column: str = "set_data", bins: int = N_BINS) -> DataFrame:
    """One array of ``bins`` counts per feature and set."""
    counts = [F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)).cast("double") for i in range(bins)]
    return histogram.groupBy("feature", set_column).agg(F.array(*counts).alias("hist"))


def explode_hist_bins(arrays: DataFrame, set_column: str = "set_data") -> DataFrame:
    """Histogram arrays as lines ``hist_ref_i`` / ``hist_current_i``."""
    short = F.when(F.col(set_column) == "reference", "ref").otherwise("current")
    lines = arrays.select("feature", short.alias("side"), F.posexplode("hist").alias("i", "value"))
    return lines.select(
        "feature", F.concat(F.lit("hist_"), "side", F.lit("_"), F.col("i").cast("string")).alias("metric"), "value"
    ).withColumn("type_metric", F.lit("drift_bins"))


def encoded(df: DataFrame, cat_features: Sequence[str], set_column: str = "set_data") -> DataFrame:
    """Categories as the codes of the reference set, ready for the numeric test; a level it lacks has a code of its own."""
    if not cat_features:
        return df
    filled = df.withColumns({c: null_category(F.col(c)) for c in cat_features})
    fitted = LabelEncode(cat_features, "own").fit(filled.where(F.col(set_column) == "reference"))
    return fitted.transform(filled)


def merge_drift_tables(tests: DataFrame, distances: DataFrame, deltas: DataFrame) -> DataFrame:
    """Test results with distances and quality gaps, one row per feature."""
    return tests.join(F.broadcast(deltas), "feature", "left").join(
        F.broadcast(distances.select("feature", "distance", "p_val_distance")), "feature", "left"
    )


# Every run at once --------------------------------------------------------------------------------------------------

#: Names under which label and prediction are counted beside the features.
LABEL, PREDICTION = "__label", "__prediction"


@dataclass
class DriftTables:
    """Test lines, label drift and the specific drift lines of every run."""

    tests: DataFrame
    general: DataFrame
    specific: DataFrame


def drift_of(
    counts: DataFrame,
    cat: Sequence[str],
    cont: Sequence[str],
    by: Sequence[str] = (),
    confidence: float = 0.95,
    drift_share: float = 0.5,
) -> DriftTables:
    """All drift numbers of every run from one written table of value counts."""
    features = [*cat, *cont]
    plain = counts.where(F.col("feature").isin(*features))
    numbers = V.as_numbers(plain, by)
    places = V.ranked(numbers, by)
    found = V.distances(places, by)
    p = kolmogorov_p(F.col("distance"), F.col("n").cast("double"), F.col("m").cast("double"))
    distances = written(found.select(*by, "feature", "distance", p.alias("p_val_distance")), "distances")
    sums = V.against_reference(counts, by)
    chi = V.chi_square(sums, by).withColumn("p", chi_square_p(F.col("statistic"), F.col("freedom").cast("double")))
    chi = written(chi, "chi-square")
    numeric = distances.where(F.col("feature").isin(*cont)).select(
        *by, "feature", F.lit("num").alias("feature_type"), F.col("distance").alias("statistic"), F.col("p_val_distance").alias("p_value_drift")
    )
    textual = chi.where(F.col("feature").isin(*cat)).select(
        *by, "feature", F.lit("cat").alias("feature_type"), "statistic", F.col("p").alias("p_value_drift")
    )
    drifted = F.coalesce(F.col("p_value_drift") < F.lit(1.0 - confidence), F.lit(False)).cast("int")
    tests = written(numeric.unionByName(textual).withColumn("exist_drift", drifted), "drift-tests")

    def label(name: str) -> Column:
        return F.max(F.when(F.col("feature") == name, F.col("p")))

    labels = chi.where(F.col("feature").isin(LABEL, PREDICTION)).groupBy(*by).agg(
        label(LABEL).alias("real_drift"), label(PREDICTION).alias("prediction_drift")
    )
    share = F.avg(F.col("exist_drift").cast("double"))
    general = tests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum("exist_drift").alias("n_drifted_features"),
        share.alias("share_drifted_features"),
        (share >= drift_share).alias("dataset_drift"),
    )
    general = general.alias("g").join(F.broadcast(labels).alias("l"), same("g", "l", by), "left")  # one line per run
    general = general.select("g.*", "prediction_drift", "real_drift")

    quality = V.quality(plain, by, places)
    reference = quality.where(F.col("side") == V.REFERENCE).alias("r")
    both = quality.where(F.col("side") == V.CURRENT).alias("c").join(F.broadcast(reference), "feature", "left")  # one line per feature
    gaps = []
    for m in DELTA_METRICS:
        if m.endswith("_in_current_values_count"):
            gaps.append(F.coalesce(F.col(f"c.{m}"), F.lit(0.0)).alias(f"difference_{m}"))
        else:
            gaps.append(F.abs(F.col(f"c.{m}") - F.col(f"r.{m}")).alias(f"difference_{m}"))
    deltas = both.select(*[F.col(f"c.{b}").alias(b) for b in by], "feature", *gaps)
    merged = tests.drop("feature_type", "statistic")
    for more in (deltas, distances):
        names = [c for c in more.columns if c not in (*by, "feature")]
        joined = merged.alias("a").join(F.broadcast(more).alias("b"), same("a", "b", [*by, "feature"]), "left")  # runs x features
        merged = joined.select("a.*", *[F.col(f"b.{c}") for c in names])
    indicators = melt(merged, [*by, "feature"], [c for c in merged.columns if c not in (*by, "feature")])
    side = F.when(F.col("side") == V.REFERENCE, "ref").otherwise("current")
    bins = V.histograms(numbers, by).select(
        *by,
        "feature",
        F.concat(F.lit("hist_"), side, F.lit("_"), F.col("bin").cast("string")).alias("metric"),
        F.col("n").cast("double").alias("value"),
    )
    specific = union_all([indicators.withColumn("type_metric", F.lit("drift_indicator")), bins.withColumn("type_metric", F.lit("drift_bins"))])
    return DriftTables(tests, general, specific)


def specific_drift_mart(
    df: DataFrame,
    cat_features: Sequence[str],
    cont_features: Sequence[str],
    set_column: str = "set_data",
    confidence: float = 0.95,
) -> DataFrame:
    """Every drift number of every feature as ``feature, metric, value, type_metric``, from one pass over the rows."""
    counts = written(V.value_counts(df, cat_features, cont_features, set_column), "value-counts")
    return drift_of(counts, cat_features, cont_features, confidence=confidence).specific


def coded_drift_mart(
    codes: DataFrame,
    cat_features: Sequence[str],
    cont_features: Sequence[str],
    distances: DataFrame,
    set_column: str = "set_data",
    confidence: float = 0.95,
) -> DataFrame:
    """The same lines for rows whose categories are numeric codes already; ``distances`` are theirs."""
    features = [*cat_features, *cont_features]
    tests = feature_drift_test(codes, cat_features, cont_features, set_column, confidence, distances)
    deltas = data_quality_delta(data_quality_profile(codes, cat_features, cont_features, set_column), set_column)
    merged = merge_drift_tables(tests.drop("feature_type", "statistic"), distances, deltas)
    indicators = melt(merged, ["feature"], [c for c in merged.columns if c != "feature"])
    bins = explode_hist_bins(histogram_arrays(feature_histograms(codes, features, set_column), set_column), set_column)
    return indicators.withColumn("type_metric", F.lit("drift_indicator")).unionByName(bins)


def drift_summary(tests: DataFrame, labels: DataFrame | None = None, drift_share: float = 0.5) -> DataFrame:
    """One row: features, drifted features, their share, the overall flag, label and prediction p-values."""
    summary = tests.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum("exist_drift").alias("n_drifted_features"),
        F.avg(F.col("exist_drift").cast("double")).alias("share_drifted_features"),
        (F.avg(F.col("exist_drift").cast("double")) >= drift_share).alias("dataset_drift"),
    )
    if labels is None:
        return summary.withColumns({c: F.lit(None).cast("double") for c in ("prediction_drift", "real_drift")})
    return summary.withColumns(
        {c: labels.select(c).scalar() for c in ("prediction_drift", "real_drift")}
    )


def as_reference_and_current(df: DataFrame, set_column: str = "set_data") -> DataFrame:
    side = F.when(F.col("set_analysis") == "training", "reference").otherwise("current")
    return df.withColumn(set_column, side)


def feature_drift_job(df: DataFrame, spec: ModelSpec) -> dict[str, DataFrame]:
    """Distribution, general and specific drift tables of one scored frame.

    All drift numbers come from one written table of value counts, which takes
    one pass over the rows.
    """
    sides = as_reference_and_current(df)
    named = sides.withColumns({LABEL: F.col(spec.name_target), PREDICTION: F.col(spec.name_prediction)})
    counts = written(V.value_counts(named, [*spec.cat_features, LABEL, PREDICTION], spec.cont_features), "value-counts")
    drift = drift_of(counts, spec.cat_features, spec.cont_features)
    return {
        "feature__distribution": data_distribution_mart(df, spec),
        "drift__general": drift.general,
        "drift__specific": drift.specific,
    }


def binary_features(df: DataFrame, features: Sequence[str], limit: int = 4) -> DataFrame:
    """Features with at most ``limit`` distinct values."""
    distinct = melt_text(df, [], list(features)).where(F.col("value").isNotNull()).distinct()
    return distinct.groupBy("feature").agg(F.count(F.lit(1)).alias("n_values")).where(F.col("n_values") <= limit)


def period_drift_job(
    pair: DataFrame, cat_features: Sequence[str], cont_features: Sequence[str], set_column: str = "set_data"
) -> dict[str, DataFrame]:
    """Data-only drift between a month and the next, on encoded categories."""
    filled = pair.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cat_features})
    fitted = LabelEncode(cat_features).fit(filled)
    features = [*cont_features, *cat_features]
    codes = written(fitted.transform(filled).select(set_column, *features), "codes")
    distances = written(ks_drift(codes, features, set_column), "distances")
    reference = codes.where(F.col(set_column) == "reference")
    return {
        "drift__specific": coded_drift_mart(codes, cat_features, cont_features, distances, set_column),
        "drift__distance": distances,
        "bin_features": binary_features(reference, features),
    }
