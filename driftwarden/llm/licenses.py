"""Licence notices by sparse TF-IDF cosine to templates, and inheritance from the nearest directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import columns_of, written

# Standard notices of widely used licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

#: Words and numbers of a text in lower case.
TOKEN = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"
#: Words of the templates that every text holds; a unit needs another one to be compared.
COMMON = tuple("a and any are by copy file form free in into is may not of or the this to use with without work you".split())
#: Least cosine of a notice.
THRESHOLD = 0.7
#: Names of files that speak for their directory.
SPEAKS = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _template_rows(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(n).alias("license"), F.lit(t).alias("text")) for i, (n, t) in enumerate(templates)])
    listed = spark.range(1).select(F.explode(rows).alias("r")).select("r.*")
    return listed.select("template", "license", F.explode(tokens(F.col("text"))).alias("token"))


def _vocabulary(templates: Sequence[tuple[str, str]]) -> list[str]:
    return sorted({w for _, t in templates for w in re.findall(TOKEN, t.lower())})


def _reach(
    templates: Sequence[tuple[str, str]], idf: dict[str, float], threshold: float
) -> Callable[[Column], Column]:
    """Whether a unit's cosine to some template can come up to ``threshold`` at all.

    The dot products are exact; the unit's length is taken from below, with
    weight one for every word of no template, which is the least there is.
    """
    held: dict[str, list[float]] = {w: [0.0] * len(templates) + [x * x - 1] for w, x in idf.items()}
    for i, (_, text) in enumerate(templates):
        counts = Counter(re.findall(TOKEN, text.lower()))
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in counts.items()))
        for w, n in counts.items():
            held[w][i] = idf[w] * n * idf[w] / norm
    shares = F.create_map(*[c for w, x in held.items() for c in (F.lit(w), F.array(*[F.lit(float(v)) for v in x]))])
    zero = F.array(*[F.lit(0.0)] * (len(templates) + 1))

    def reach(tokens: Column) -> Column:
        sums = F.aggregate(
            F.filter(tokens, lambda x: x.isin(list(held))),
            zero,
            lambda acc, x: F.zip_with(acc, F.element_at(shares, x), lambda p, q: p + q),
            lambda acc: F.struct(
                F.array_max(F.slice(acc, 1, len(templates))).alias("dot"), F.element_at(acc, -1).alias("more")
            ),
        )
        return sums["dot"] >= F.lit(threshold - 1e-6) * F.sqrt(F.size(tokens) + sums["more"])

    return reach


def _units(files: DataFrame, anchors: Sequence[str]) -> DataFrame:
    """(file, last, start, line, kind, tokens): the lines (kind 0), blocks of lines (1) and whole texts (2) with an anchor."""
    words = F.array(*[F.lit(w) for w in anchors])
    cells = files.select(
        "file",
        F.transform(
            F.split(F.coalesce("text", F.lit("")), "\n"),
            lambda x: F.struct((F.trim(x) == "").alias("blank"), tokens(x).alias("tokens")),
        ).alias("cells"),
    )
    anchored = F.transform("cells", lambda c: F.arrays_overlap(c["tokens"], words))
    cells = cells.withColumn("hot", anchored).where(F.exists("hot", lambda x: x))
    at = F.sequence(F.lit(1), F.size("cells"))

    def full(i: Column) -> Column:
        return ~F.coalesce(F.get("cells", i - 1)["blank"], F.lit(True))

    edged = cells.withColumn("starts", F.filter(at, lambda i: full(i) & ~full(i - 1))).withColumn(
        "ends", F.filter(at, lambda i: full(i) & ~full(i + 1))
    )
    lines = F.transform(
        F.filter(at, lambda i: F.get("hot", i - 1)),
        lambda i: F.struct(i.alias("start"), i.alias("line"), F.lit(0).alias("kind"), F.get("cells", i - 1)["tokens"].alias("tokens")),
    )

    def block(start: Column, end: Column, kind: int) -> Column:
        held = F.transform(F.slice("cells", start, end - start + 1), lambda c: c["tokens"])
        line = F.array_max(F.filter(F.sequence(start, end), lambda i: F.get("hot", i - 1)))
        return F.struct(start.alias("start"), line.alias("line"), F.lit(kind).alias("kind"), F.flatten(held).alias("tokens"))

    edges = F.filter(F.arrays_zip("starts", "ends"), lambda e: e["ends"] > e["starts"])
    blocks = F.transform(edges, lambda e: block(e["starts"], e["ends"], 1))
    whole = F.filter(F.array(block(F.lit(1), F.size("cells"), 2)), lambda u: F.size("starts") > 1)
    units = edged.select(
        "file", F.element_at("ends", -1).alias("last"), F.explode(F.concat(lines, blocks, whole)).alias("u")
    )
    return units.select("file", "last", "u.*").where("line IS NOT NULL")


def notices(
    files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """(file, line, lines, license, score) of the notices of all files.

    ``files`` (file, text), where equal files have equal texts and count as often as they are listed. Every line of a text is a unit, so is every
    run of lines that are not blank, and the whole text; these longer units count
    where no unit within them does as well. Their line is the last one in them
    that holds an anchor; ``lines`` is the last line that is not blank. A unit's weights are term counts times ln((files + 1) /
    (files with the term + 1)) + 1, with the files counted for every term. A
    unit is compared when it holds an anchor, a template's word that is not in
    COMMON; those that cannot reach the threshold are dropped where they are
    read. Texts are read three times: to count the files of template words, to
    find the units, and to count the files of the other words of these units.
    The template side has one row per template word and is left to Spark's size
    check, as is the list of the units' words.
    """
    spark = files.sparkSession
    vocabulary = _vocabulary(templates)
    anchors = [w for w in vocabulary if w.isalpha() and w not in COMMON]
    words = tokens(F.coalesce("text", F.lit("")))
    known = F.array(*[F.lit(w) for w in vocabulary])
    held = files.select(F.explode(F.array_intersect(words, known)).alias("token")).groupBy("token").count()
    n_files = files.count()
    df = {r["token"]: r["count"] for r in held.collect()}  # one per template word
    ready = {w: math.log((n_files + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}
    reach = _reach(templates, ready, threshold)
    found = _units(files, anchors).where(reach(F.col("tokens")))
    units = written(found.dropDuplicates(["file", "start", "line", "kind"]), "license-units")
    terms = (
        units.select("file", "start", "line", "kind", "last", F.explode("tokens").alias("token"))
        .groupBy("file", "start", "line", "kind", "last", "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    base = _template_rows(spark, templates)
    met = written(terms.select("token").unionByName(base.select("token")).distinct(), "license-words")
    counted = (
        files.select(F.explode(F.array_distinct(words)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("df"))
        .join(met, "token", "left_semi")
    )
    total = F.lit(n_files)
    idf = written(
        met.join(counted, "token", "left").select(
            "token", (F.log((total + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1).alias("idf")
        ),
        "license-idf",
    )
    weights = (
        base.groupBy("template", "license", "token")
        .agg(F.count(F.lit(1)).alias("tf"))
        .join(idf, "token")
        .withColumn("w", F.col("tf") * F.col("idf"))
        .withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("template"))))
        .select("template", "license", "token", (F.col("w") / F.col("norm")).alias("w"))
    )
    unit = ["file", "start", "line", "kind"]
    weighted = terms.join(idf, "token").select(*unit, "last", "token", (F.col("tf") * F.col("idf")).alias("x"))
    norms = weighted.groupBy(*unit).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = (
        weighted.join(weights, "token")
        .groupBy(*unit, "last", "template", "license")
        .agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    )
    scored = dots.join(norms, unit).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    best = Window.partitionBy(*unit).orderBy(F.desc("score"), "template")
    passed = written(
        scored.where(F.col("score") >= threshold).withColumn("n", F.row_number().over(best)).where("n = 1"), "license-passed"
    )
    inner = passed.select("file", F.col("line").alias("at"), F.col("kind").alias("part"), F.col("score").alias("least"))
    within = (F.col("part") < F.col("kind")) & F.col("at").between(F.col("start"), F.col("line"))
    longer = passed.where("kind > 0").join(
        inner.withColumnRenamed("file", "of"), (F.col("file") == F.col("of")) & within & (F.col("least") >= F.col("score")), "left_anti"
    )
    return (
        passed.where("kind = 0")
        .unionByName(longer)
        .select("file", "line", F.col("last").alias("lines"), "license", "score")
    )


def license_files(
    files: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text", closing: bool = True
) -> DataFrame:
    """The licence of every file.

    Columns: doc_id, path, license, score, origin ("own", "inherited" or
    NULL), directory (that of the files it is inherited from). A file's own
    licence is that of its best notice, the first of equals. A file speaks for
    its directory when its name says so (SPEAKS) or, with ``closing``, when a
    notice ends on its last line; the directory's licence is the one most of these
    files hold, the first by name of equals. A file without a notice inherits
    from its own directory or the nearest one above that has a licence. NULL
    and empty texts hold no notice; a NULL path has no directory; rows that
    repeat an id are files of their own, equal rows have equal results; an empty table gives no rows.

    Directories, not files, are joined with their ancestors; files meet the
    result by directory, narrow rows of which a very full directory is dealt
    again by Spark.
    """
    rows = columns_of(files, doc_id=key, path=path, text=text)
    # A file is known by what its row holds, so that every read of the rows names it alike.
    held = F.coalesce("text", F.lit(""))
    rows = rows.withColumn("file", F.struct("doc_id", "path", F.xxhash64(held).alias("h1"), F.xxhash64(F.lit(7), held).alias("h2")))
    found = written(notices(rows.select("file", "text")), "license-notices")
    own = found.groupBy("file").agg(
        F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), F.col("line"))).alias("own"),
        F.max(F.col("line") == F.col("lines")).alias("closes"),
    )
    cut = F.regexp_replace("path", "/?[^/]*$", "")
    known = written(
        rows.select("file", "path").withColumn("dir", cut).withColumn("name", F.regexp_extract("path", "[^/]*$", 0)).join(own, "file", "left"),
        "license-own",
    )
    speaks = F.col("name").rlike(SPEAKS) | (F.lit(closing) & F.col("closes"))
    votes = known.where(F.col("own").isNotNull() & F.col("dir").isNotNull() & speaks).groupBy(
        "dir", F.col("own.license").alias("license")
    ).agg(F.count(F.lit(1)).alias("n"), F.max("own.score").alias("score"))
    speaking = votes.groupBy("dir").agg(
        F.min_by(F.struct("license", "score"), F.struct(-F.col("n"), F.col("license"))).alias("said")
    )
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    wanting = known.where(F.col("own").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    nearest = (
        wanting.select("dir", F.posexplode(above).alias("steps", "ancestor"))
        .join(speaking.withColumnRenamed("dir", "ancestor"), "ancestor")
        .groupBy("dir")
        .agg(F.min_by(F.struct("ancestor", "said"), "steps").alias("from"))
    )
    joined = known.join(nearest, "dir", "left")
    inherits = F.col("own").isNull() & F.col("from").isNotNull()
    return joined.select(
        F.col("file.doc_id").alias("doc_id"),
        "path",
        F.when(inherits, F.col("from.said.license")).otherwise(F.col("own.license")).alias("license"),
        F.when(inherits, F.col("from.said.score")).otherwise(F.col("own.score")).alias("score"),
        F.when(inherits, F.lit("inherited")).when(F.col("own").isNotNull(), F.lit("own")).alias("origin"),
        F.when(inherits, F.col("from.ancestor")).alias("directory"),
    )
