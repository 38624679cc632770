"""One table of value counts from which distances, tests, quality figures and histograms are folds.

``value_counts`` reads the rows once. A line holds how often a side has a value
of a feature: ``side`` (``reference`` or ``current``), the grouping columns
``by`` (such as the period; NULL on the reference side), ``feature``, ``kind``
(``num`` or ``cat``), ``value`` (text of a category), ``number`` (a numeric
value), ``n``. Missing values have neither ``value`` nor ``number``. Lines add
up, so tables of several batches are merged by ``merged``. The reference's lines
are stored once whatever the number of groups: every figure of a group needs
them only at the values that the group itself has, or in total.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwarden.common import ratio, written
from driftwarden.functions.scalars import band_number
from driftwarden.operators.encode import level_codes, null_category
from driftwarden.operators.quantiles import bucket_of, value_cuts

REFERENCE, CURRENT = "reference", "current"
QUARTILES = (0.25, 0.5, 0.75)


def value_counts(
    df: DataFrame, cat: Sequence[str], cont: Sequence[str], set_column: str = "set_data", by: Sequence[str] = ()
) -> DataFrame:
    """The lines of all features in one pass; partial counts absorb hot values before anything travels.

    Rows of another set than ``reference`` and ``current`` are left out, NaN
    counts as missing, -0.0 as 0.0. ``by`` is not looked at on the reference side.
    """
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    cells = [
        F.struct(F.lit(c).alias("feature"), F.lit("cat").alias("kind"), F.col(f"`{c}`").cast("string").alias("value"), number.alias("number"))
        for c in cat
    ] + [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit("num").alias("kind"),
            text.alias("value"),
            (F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) + F.lit(0.0)).alias("number"),
        )
        for c in cont
    ]
    keys = [F.when(F.col(set_column) == CURRENT, F.col(f"`{b}`")).alias(b) for b in by]
    sides = df.where(F.col(set_column).isin(REFERENCE, CURRENT))
    long = sides.select(F.col(set_column).alias("side"), *keys, F.inline(F.array(*cells)))
    return long.groupBy("side", *by, "feature", "kind", "value", "number").agg(F.count(F.lit(1)).alias("n"))


def merged(tables: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """The lines of several tables added up."""
    both = reduce(DataFrame.unionByName, tables)
    return both.groupBy("side", *by, "feature", "kind", "value", "number").agg(F.sum("n").alias("n"))


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe equality of the columns of two aliased frames."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns], F.lit(True))


# Numbers -----------------------------------------------------------------------------------------------------------


def ranked(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every number of every side with running counts inside evenly filled value buckets, written.

    Columns: side, by, feature, bucket, number, n, ``upto`` (rows of the own
    side in the bucket up to and with the number), ``ref_upto`` and ``ref_here``
    (the reference's, up to and with the number, and at it). One exchange, by
    feature and bucket, serves all windows.
    """
    numbers = counts.where("number IS NOT NULL").select("side", *by, "feature", "number", "n")
    cuts = value_cuts(numbers, ["feature"], "number")
    placed = numbers.join(F.broadcast(cuts), "feature").withColumn("bucket", bucket_of("number"))  # one row per feature
    placed = placed.withColumn("r", F.when(F.col("side") == REFERENCE, F.col("n")).otherwise(F.lit(0))).drop("__coarse", "__fine")
    placed = placed.repartition("feature", "bucket")
    bucket = Window.partitionBy("feature", "bucket")
    running = bucket.orderBy("number").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = Window.partitionBy("feature", "bucket", "side", *by).orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.withColumns(
        {
            "ref_upto": F.sum("r").over(running),
            "ref_here": F.sum("r").over(Window.partitionBy("feature", "bucket", "number")),
            "upto": F.sum("n").over(own),
        }
    )
    return written(out.drop("r"), "ranked")


def distances(places: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Two-sample distance of every group from the reference: ``by, feature, n, m, distance``.

    The difference of the two distributions is largest at, or just before, a
    value of the current side, so only those are looked at: first inside each
    bucket, then shifted by what lies below it.
    """
    # Every bucket that any side has values in: about a thousand lines per feature.
    below = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    under_all = places.groupBy("feature", "bucket").agg(F.sum(F.when(F.col("side") == REFERENCE, F.col("n")).otherwise(0)).alias("r"))
    under_all = under_all.select(
        "feature",
        "bucket",
        F.coalesce(F.sum("r").over(below), F.lit(0)).alias("ref_before"),
        F.sum("r").over(Window.partitionBy("feature")).alias("n_ref"),
    )
    current = places.where(F.col("side") == CURRENT)
    sizes = current.groupBy(*by, "feature").agg(F.sum("n").alias("m"))
    totals = under_all.select("feature", "n_ref").distinct()
    sized = sizes.join(totals, "feature")  # groups x features
    joined = current.alias("p").join(F.broadcast(sized).alias("s"), same("p", "s", [*by, "feature"]))
    high = ratio(F.col("ref_upto"), F.col("n_ref")) - ratio(F.col("upto"), F.col("m"))
    low = ratio(F.col("ref_upto") - F.col("ref_here"), F.col("n_ref")) - ratio(F.col("upto") - F.col("n"), F.col("m"))
    extremes = joined.groupBy(*[F.col(f"p.{b}").alias(b) for b in by], F.col("p.feature").alias("feature"), "bucket", "m").agg(
        F.max(F.greatest(high, low)).alias("high"), F.min(F.least(high, low)).alias("low"), F.sum("n").alias("c")
    )
    under = Window.partitionBy(*by, "feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    lifted = extremes.withColumn("before", F.coalesce(F.sum("c").over(under), F.lit(0))).join(under_all, ["feature", "bucket"])
    base = ratio(F.col("ref_before"), F.col("n_ref")) - ratio(F.col("before"), F.col("m"))
    gap = F.greatest(F.abs(base + F.col("high")), F.abs(base + F.col("low")))
    return lifted.groupBy(*by, "feature", F.col("n_ref").alias("n"), "m").agg(F.max(gap).alias("distance"))


def percentiles(places: DataFrame, by: Sequence[str] = (), probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Linearly interpolated percentiles of every side and group: ``side, by, feature, p, percentile``.

    The bucket of every wanted rank follows from bucket totals; only the lines
    of those buckets are looked at again.
    """
    keys = ["side", *by, "feature"]
    totals = places.groupBy(*keys, "bucket").agg(F.sum("n").alias("c"))
    under = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = totals.withColumn("end", F.sum("c").over(under)).withColumn("all", F.sum("c").over(Window.partitionBy(*keys)))
    wanted = spans.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")).withColumn("rank", (F.col("all") - 1) * F.col("p"))
    wanted = wanted.select("*", F.explode(F.array(F.floor("rank"), F.ceil("rank"))).alias("k"))
    wanted = wanted.where((F.col("end") - F.col("c") <= F.col("k")) & (F.col("k") < F.col("end"))).distinct()
    wanted = wanted.select(*keys, "bucket", "p", "rank", "k", (F.col("k") - F.col("end") + F.col("c")).alias("local"))
    # Two ranks per probability, group and feature.
    hit = places.alias("p").join(F.broadcast(wanted).alias("w"), same("p", "w", [*keys, "bucket"]))
    hit = hit.where((F.col("local") < F.col("upto")) & (F.col("local") >= F.col("upto") - F.col("p.n")))
    part = F.col("rank") - F.floor("rank")
    below = F.max(F.when(F.col("k") == F.floor("rank"), F.col("number")))
    above = F.max(F.when(F.col("k") == F.ceil("rank"), F.col("number")))
    return hit.groupBy(*[F.col(f"w.{c}").alias(c) for c in keys], F.col("w.p").alias("p")).agg(
        (below + F.when(above == below, F.lit(0.0)).otherwise(above - below) * F.max(part)).alias("percentile")
    )


def histograms(counts: DataFrame, by: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """Rows per feature, side and shared equal-width bin; empty bins are listed, with the bin's edges.

    Every group shares its borders with the reference. The reference is counted
    once for each different pair of borders, which is one where the group's
    values lie within the reference's.
    """
    numbers = counts.where("number IS NOT NULL")
    ends = numbers.groupBy("side", *by, "feature").agg(F.min("number").alias("lo"), F.max("number").alias("hi"))
    groups = ends.where(F.col("side") == CURRENT).alias("c")
    known = ends.where(F.col("side") == REFERENCE).alias("r")
    limits = groups.join(known, "feature", "full").select(
        *[F.col(f"c.{b}").alias(b) for b in by],
        "feature",
        F.least("c.lo", "r.lo").alias("lo"),
        F.greatest("c.hi", "r.hi").alias("hi"),
    )
    limits = written(limits, "histogram-limits")  # groups x features
    borders = limits.select("feature", "lo", "hi").distinct()
    of_reference = _binned(numbers.where(F.col("side") == REFERENCE), borders, [], bins)
    reference = limits.alias("l").join(of_reference.alias("h"), same("l", "h", ["feature", "lo", "hi"]))
    reference = reference.select(F.lit(REFERENCE).alias("side"), *[F.col(f"l.{b}") for b in by], "l.feature", "l.lo", "l.hi", "bin", "n")
    mine = _binned(numbers.where(F.col("side") == CURRENT), limits, by, bins).withColumn("side", F.lit(CURRENT))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return reference.unionByName(mine.select(*reference.columns)).select(
        "side",
        *by,
        "feature",
        "bin",
        "n",
        (F.col("lo") + F.col("bin") * width).alias("edge_low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("edge_high"),
    )


def _binned(numbers: DataFrame, limits: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    keys = [*by, "feature"]
    placed = numbers.alias("v").join(F.broadcast(limits).alias("l"), same("v", "l", keys))
    own = band_number(F.col("number"), F.col("lo"), F.col("hi"), bins) - 1
    counted = placed.groupBy(*[F.col(f"v.{k}").alias(k) for k in keys], "lo", "hi", own.alias("own")).agg(F.sum("n").alias("n"))
    spread = counted.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return spread.groupBy(*keys, "lo", "hi", "bin").agg(F.sum(F.when(F.col("own") == F.col("bin"), F.col("n")).otherwise(0)).alias("n"))


# Categories --------------------------------------------------------------------------------------------------------


def against_reference(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums over the categories of every group, beside the reference's own: what the tests and turnover are made of.

    Columns: by, feature, R and C (rows of either side), levels and ref_levels
    (categories with rows), shared (categories both have), held (rows of the
    reference in shared ones), rr and cc (sums of r * r / (r + c) and
    c * c / (r + c) over the group's categories).
    """
    levels = counts.where("kind = 'cat'")
    reference = levels.where((F.col("side") == REFERENCE) & F.col("value").isNotNull()).select("feature", "value", F.col("n").alias("r"))
    totals = reference.groupBy("feature").agg(F.sum("r").alias("R"), F.count(F.lit(1)).alias("ref_levels"))
    current = levels.where(F.col("side") == CURRENT).select(*by, "feature", "value", F.col("n").alias("c"))
    joined = current.join(reference, ["feature", "value"], "left").withColumn("r", F.coalesce("r", F.lit(0)).cast("double"))
    c = F.when(F.col("value").isNotNull(), F.col("c")).otherwise(0).cast("double")
    both = F.col("r") + c
    sums = joined.groupBy(*by, "feature").agg(
        F.sum(c).alias("C"),
        F.count("value").alias("levels"),
        F.count_if(F.col("r") > 0).alias("shared"),
        F.sum("r").alias("held"),
        F.coalesce(F.sum(F.try_divide(F.col("r") * F.col("r"), both)), F.lit(0.0)).alias("rr"),
        F.coalesce(F.sum(F.try_divide(c * c, both)), F.lit(0.0)).alias("cc"),
    )
    sums = sums.join(F.broadcast(totals), "feature", "left")  # one row per feature
    return sums.withColumns({t: F.coalesce(t, F.lit(0)) for t in ("R", "ref_levels")})


def chi_square(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistic of homogeneity and degrees of freedom: categories only the reference has add their rows as they are."""
    total = F.col("R") + F.col("C")
    rr = F.col("rr") + F.col("R") - F.col("held")
    statistic = total * (ratio(rr, F.col("R")) + ratio(F.col("cc"), F.col("C")) - 1)
    freedom = F.col("ref_levels") + F.col("levels") - F.col("shared") - 1
    return sums.select(*by, "feature", F.greatest(statistic, F.lit(0.0)).alias("statistic"), freedom.alias("freedom"))


def as_numbers(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same lines with categories as numbers: places among the reference's sorted categories.

    Missing counts as a category. Categories that the reference lacks share the
    next free number, so that they are as far from the others as any.
    """
    numbers = counts.where("kind = 'num'")
    texts = counts.where("kind = 'cat'").withColumn("value", null_category(F.col("value")))
    texts = texts.groupBy("side", *by, "feature", "value").agg(F.sum("n").alias("n"))
    known = texts.where(F.col("side") == REFERENCE).select("feature", "value", "n")
    codes = written(level_codes(known), "codes")
    free = codes.groupBy("feature").agg((F.max("code") + 1).alias("free"))
    coded = texts.join(codes, ["feature", "value"], "left").join(F.broadcast(free), "feature", "left")  # one row per feature
    number = F.coalesce("code", "free", F.lit(0)).cast("double")
    coded = coded.groupBy("side", *by, "feature", number.alias("number")).agg(F.sum("n").alias("n"))
    return numbers.select("side", *by, "feature", "number", "n").unionByName(coded)


# Quality -----------------------------------------------------------------------------------------------------------


def quality(counts: DataFrame, by: Sequence[str] = (), places: DataFrame | None = None) -> DataFrame:
    """Gaps, categories, infinities, quartiles and moments per side, group and feature, and turnover of categories.

    Same figures as ``data_quality_profile``; ``places`` are the ranked numbers, if they are known.
    """
    keys = ["side", *by, "feature", "kind"]
    filled = F.col("value").isNotNull() | F.col("number").isNotNull()
    n, number = F.col("n"), F.col("number")
    basics = counts.groupBy(*keys).agg(
        F.sum(n).cast("double").alias("n"),
        F.sum(F.when(filled, 0).otherwise(n)).cast("double").alias("missing_count"),
        F.count_if(filled).cast("double").alias("unique_count"),
        F.when(F.col("kind") == "num", F.sum(F.when(F.abs(number) == float("inf"), n).otherwise(0))).cast("double").alias("infinite_count"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        (F.sum(n * number) / F.sum(F.when(number.isNotNull(), n))).alias("mean"),
    )
    basics = written(basics, "quality")  # sides x groups x features
    means = basics.where("kind = 'num'").select("side", *by, "feature", "mean")
    off = counts.where("number IS NOT NULL").alias("v").join(F.broadcast(means).alias("m"), same("v", "m", ["side", *by, "feature"]))
    spread = off.groupBy(*[F.col(f"v.{c}").alias(c) for c in ("side", *by, "feature")]).agg(
        F.sqrt(F.try_divide(F.sum(F.col("n") * F.pow(F.col("number") - F.col("mean"), 2)), F.sum("n") - 1)).alias("std")
    )
    places = ranked(counts, by) if places is None else places
    wide = percentiles(places, by).groupBy("side", *by, "feature").agg(
        *[F.max(F.when(F.col("p") == q, F.col("percentile"))).alias(f"percentile_{int(100 * q)}") for q in QUARTILES]
    )
    turnover = against_reference(counts, by).select(
        F.lit(CURRENT).alias("side"),
        *by,
        "feature",
        (F.col("levels") - F.col("shared")).cast("double").alias("new"),
        (F.col("ref_levels") - F.col("shared")).cast("double").alias("unused"),
    )
    out = basics
    for more in (spread, wide, turnover):
        names = [c for c in more.columns if c not in ("side", *by, "feature")]
        joined = out.alias("a").join(F.broadcast(more).alias("b"), same("a", "b", ["side", *by, "feature"]), "left")
        out = joined.select("a.*", *[F.col(f"b.{c}") for c in names])
    share = {f"{p}_percentage": ratio(100 * F.col(f"{p}_count"), F.col("n")) for p in ("missing", "unique", "infinite")}
    only = (F.col("side") == CURRENT) & (F.col("kind") == "cat")
    return out.withColumns(share).select(
        "side",
        *by,
        "feature",
        F.col("kind").alias("feature_type"),
        "missing_count",
        "missing_percentage",
        "unique_count",
        "unique_percentage",
        "infinite_count",
        "infinite_percentage",
        *[F.when(F.col("kind") == "num", F.col(f"percentile_{int(100 * q)}")).alias(f"percentile_{int(100 * q)}") for q in QUARTILES],
        "min",
        "max",
        "mean",
        "std",
        F.when(only, F.coalesce("new", F.lit(0.0))).alias("new_in_current_values_count"),
        F.when(only, F.coalesce("unused", F.lit(0.0))).alias("unused_in_current_values_count"),
    )
